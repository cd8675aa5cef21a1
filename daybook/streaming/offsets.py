"""Which offsets of a topic's partitions have been seen, as merged ranges: state that stays small without an expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.session import durable, local_rows
from daybook.sources import files
from daybook.streaming.clock import IDENTITY

PLACE = ["topic", "part"]
RANGES = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("part", T.LongType()),
    T.StructField("low", T.LongType()), T.StructField("high", T.LongType()),
])
#: Offsets of a place that one task puts in order; ranges meet across these cuts afterwards.
CUT = 1 << 16


def _cut(column: str) -> Column:
    """The first offset of the cut that an offset lies in."""
    return F.col(column) - F.pmod(F.col(column), F.lit(CUT).cast("bigint"))


def islands(offsets: DataFrame) -> DataFrame:
    """Runs of adjacent offsets: ``topic, part, low, high``. A partition with most of the offsets is cut into stretches."""
    cut = offsets.select(*PLACE, "off").distinct().withColumn("cut", _cut("off"))
    rank = F.row_number().over(W.partitionBy(*PLACE, "cut").orderBy("off"))
    runs = cut.withColumn("run", F.col("off") - rank).groupBy(*PLACE, "cut", "run")
    return runs.agg(F.min("off").alias("low"), F.max("off").alias("high")).select(*PLACE, "low", "high")


def _pieces(ranges: DataFrame) -> DataFrame:
    """Ranges cut to the ``cut`` they lie in; a range over many cuts stands for as many times ``CUT`` offsets."""
    cuts = F.sequence(_cut("low"), _cut("high"), F.lit(CUT).cast("bigint"))
    return ranges.select(*PLACE, "low", "high", F.explode(cuts).alias("cut")).select(
        *PLACE, "cut", F.greatest("low", "cut").alias("low"), F.least("high", F.col("cut") + (CUT - 1)).alias("high")
    )


def _joined(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges of the same ``keys`` that overlap or touch, as one."""
    at = W.partitionBy(*keys).orderBy("low", "high")
    upto = F.max("high").over(at.rowsBetween(W.unboundedPreceding, -1))
    begins = F.when(upto.isNull() | (F.col("low") > upto + 1), 1).otherwise(0)
    numbered = ranges.withColumn("begins", begins).withColumn("island", F.sum("begins").over(at.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "island").agg(F.min("low").alias("low"), F.max("high").alias("high")).select(*keys, "low", "high")


def merged(ranges: DataFrame) -> DataFrame:
    """Ranges that overlap or touch, as one: in each cut, then across cuts the two at most that reach an edge of theirs."""
    inner = _joined(_pieces(ranges), [*PLACE, "cut"])
    edge = (F.col("low") == F.col("cut")) | (F.col("high") == F.col("cut") + (CUT - 1))
    return inner.where(~edge).select(*PLACE, "low", "high").union(_joined(inner.where(edge), PLACE))


def unseen(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows whose offset lies in none of ``ranges``.

    Rows and ranges of a cut are put in order together, so a row meets the range before it only, however many there are.
    """
    row = F.struct(*rows.columns)
    arrived = rows.select(*PLACE, _cut("off").alias("cut"), F.col("off").alias("at"), F.lit(None).cast("bigint").alias("upto"), row.alias("row"))
    absent = F.lit(None).cast(arrived.schema["row"].dataType)
    held = _pieces(ranges).select(*PLACE, "cut", F.col("low").alias("at"), F.col("high").alias("upto"), absent.alias("row"))
    order = W.partitionBy(*PLACE, "cut").orderBy("at", F.col("row").isNotNull())
    covered = arrived.unionByName(held).withColumn("upto", F.max("upto").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return covered.where(F.col("row").isNotNull() & (F.col("upto").isNull() | (F.col("upto") < F.col("at")))).select("row.*")


class FirstDeliveries:
    """Keeps the first delivery of each ingestion identity; use ``on_batch`` with ``foreachBatch``.

    Batch n reads the ranges that batch n - 1 left, appends the rows they do not hold and leaves its own, overwriting
    what an earlier try of it wrote. So a record delivered again keeps its first assignment, however late it comes.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        for name in ("ranges", "rows"):
            files.make_directory(spark, f"{self.folder}/{name}")

    def ranges(self, before: int | None = None) -> DataFrame:
        """The ranges seen before a batch, by default all."""
        done = [int(n) for n in files.names(self.spark, f"{self.folder}/ranges")]
        last = max((n for n in done if before is None or n < before), default=None)
        if last is None:
            return local_rows(self.spark, [], RANGES)
        return self.spark.read.schema(RANGES).parquet(f"{self.folder}/ranges/{last}")

    def on_batch(self, batch: DataFrame, number: int) -> None:
        batch, seen = durable(batch, "deliveries"), self.ranges(number)
        rest = [c for c in batch.columns if c not in (*IDENTITY, "ts", "event_id")]
        first = F.min(F.struct("ts", "event_id", *rest)).alias("first")
        firsts = batch.groupBy(*IDENTITY).agg(first).select(*IDENTITY, "first.*").select(*batch.columns)
        fresh = unseen(firsts, seen)
        path = f"{self.folder}/rows/batch={number}"
        fresh.write.mode("overwrite").parquet(path)
        added = islands(self.spark.read.schema(batch.schema).parquet(path))
        merged(seen.unionByName(added)).write.mode("overwrite").parquet(f"{self.folder}/ranges/{number}")

    def rows(self, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/rows")
