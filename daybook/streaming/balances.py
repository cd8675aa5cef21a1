"""Continuous posting: every micro-batch drops replays, appends to the ledger and records how balances moved."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.fields import checked_cents, in_cents_range
from daybook.operators import posting, references
from daybook.schemas import BALANCE, TRANSACTION
from daybook.session import local_rows
from daybook.sources import files
from daybook.sources.buckets import BucketedTable, matching, write_bucketed

#: Buckets of the ledger and of the balances, fixed when a folder is first used; micro-batches between two bases.
BUCKETS = 16
COMPACT_EVERY = 16

DELTA = T.StructType([T.StructField("account_id", T.LongType()), T.StructField("delta", T.DecimalType(38, 0))])


class BalanceStream:
    """Use ``on_batch`` with ``foreachBatch``.

    The ledger is bucketed by ID, so a batch opens the buckets of its IDs. Balances are a base and the deltas of the
    batches after it, merged when they are read; every ``compact_every`` batches a new base takes the deltas in. A batch
    writes the deltas of its own accounts only, and looks up just these accounts to see whether a balance leaves 64 bits.

    Batch n reads only what batches before n published and overwrites its own directories, so running it again
    after a failure changes nothing. A transaction ID posted before with other contents fails the batch.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, compact_every: int = COMPACT_EVERY):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.buckets, self.compact_every = buckets, compact_every
        for name in ("ledger", "delta", "base"):
            files.make_directory(spark, f"{self.folder}/{name}")
        schema = TRANSACTION.schema.add("batch", T.LongType())
        self.posted = BucketedTable(spark, f"{self.folder}/ledger", schema, ["transaction_id"], buckets, ("batch",))
        self.bases = BucketedTable(
            spark, f"{self.folder}/base", T.StructType(BALANCE.fields + [T.StructField("batch", T.LongType())]), ["account_id"], buckets, ("batch",)
        )

    def _numbers(self, name: str) -> list[int]:
        """Batches that finished their directory of a table."""
        found = (int(n.removeprefix("batch=")) for n in files.names(self.spark, f"{self.folder}/{name}"))
        return sorted(n for n in found if files.exists(self.spark, f"{self.folder}/{name}/batch={n}/_SUCCESS"))

    def _ledger(self, before: int) -> DataFrame:
        self.posted.declare([(n,) for n in self._numbers("ledger") if n < before])
        return self.posted.rows().where(F.col("batch") < before)

    def _moves(self, upto: int, base_before: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The last base at or before a batch, or before another, and the deltas after it up to that batch."""
        latest = upto if base_before is None else base_before - 1
        base = max((n for n in self._numbers("base") if n <= latest), default=-1)
        self.bases.declare([(base,)] if base >= 0 else [])
        kept = self.bases.rows().where(F.col("batch") == base).drop("batch")
        later = [f"{self.folder}/delta/batch={n}" for n in self._numbers("delta") if base < n <= upto]
        deltas = self.spark.read.schema(DELTA).parquet(*later) if later else local_rows(self.spark, [], DELTA)
        return kept, deltas

    def _totals(self, kept: DataFrame, deltas: DataFrame) -> DataFrame:
        moved = kept.select("account_id", F.col("balance").cast("decimal(38,0)").alias("delta")).unionByName(deltas)
        return moved.groupBy("account_id").agg(F.sum("delta").alias("total"))

    def balances(self, number: int | None = None) -> DataFrame:
        """Balances after a batch, by default the last one."""
        if number is None:
            number = max(self._numbers("delta"), default=-1)
        return self._checked(*self._moves(number))

    def _checked(self, kept: DataFrame, deltas: DataFrame) -> DataFrame:
        return self._totals(kept, deltas).select("account_id", checked_cents(F.col("total")).alias("balance"))

    def _replace(self, name: str, number: int) -> str:
        path = f"{self.folder}/{name}/batch={number}"
        files.delete(self.spark, path)
        return path

    def on_batch(self, batch: DataFrame, number: int) -> None:
        path = self._replace("ledger", number)
        write_bucketed(self._fresh(batch, number), path, ["transaction_id"], self.buckets)
        posted = self.spark.read.schema(TRANSACTION.schema).parquet(path)
        path = self._replace("delta", number)
        deltas = posting.account_deltas(posted).select("account_id", F.col("delta").cast("decimal(38,0)").alias("delta"))
        deltas.write.parquet(path)
        moved = self.spark.read.schema(DELTA).parquet(path)
        self._refuse_overflow(moved, number)
        if (number + 1) % self.compact_every == 0:
            compacted = self._checked(*self._moves(number, base_before=number))  # not from an earlier try's base
            write_bucketed(compacted, self._replace("base", number), ["account_id"], self.buckets)

    def _fresh(self, batch: DataFrame, number: int) -> DataFrame:
        """The batch's transactions that are not posted yet, each once."""
        distinct = batch.select(*TRANSACTION.columns).distinct()
        marked = references.with_posted(distinct, self._ledger(number), self.buckets)
        conflict = F.raise_error(F.concat(F.lit("Conflicting transaction ID "), F.col("transaction_id").cast("string")))
        same = F.col("posted").eqNullSafe(F.struct(*references.CONTENTS))
        checked = marked.where(F.when(F.col("posted").isNull(), True).when(same, False).otherwise(conflict.cast("boolean")))
        copies = checked.groupBy("transaction_id").agg(
            F.min(F.struct(*references.CONTENTS)).alias("low"), F.max(F.struct(*references.CONTENTS)).alias("high")
        )
        twice = F.raise_error(F.lit("Duplicate transaction business key")).cast(copies.schema["low"].dataType)
        contents = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(twice)
        return copies.select("transaction_id", contents.alias("low")).select("transaction_id", "low.*")

    def _refuse_overflow(self, moved: DataFrame, number: int) -> None:
        """Stop if a balance that the batch moved has left 64 bits; only the moved accounts are looked up."""
        kept, deltas = self._moves(number - 1)
        kept = matching(kept, moved, "account_id", self.buckets)
        deltas = deltas.join(moved.select("account_id"), "account_id", "left_semi").unionByName(moved)
        beyond = self._totals(kept, deltas).where(~in_cents_range(F.col("total"))).select("account_id").first()
        if beyond:
            raise OverflowError(f"the balance of account {beyond['account_id']} leaves 64 bits")


def run_to_end(stream: DataFrame, on_batch, checkpoint: str) -> None:
    """Drive a stream over everything available now through ``on_batch``."""
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
