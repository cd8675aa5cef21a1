"""Table constraints as set-based audits; an empty result means the constraint holds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from daybook.schemas import ACCOUNT_TYPES, CUSTOMER, LAYOUTS, RELATIONSHIP_TYPES, RUN_STATUSES, TRANSACTION_TYPES
from daybook.session import durable

#: Partitions that are sent to the scans as literals; more are joined.
FEW_PARTITIONS = 256
#: Rows whose keys one task holds.
TASK_ROWS = 1 << 19


def _joined(columns: list[str]) -> Column:
    return F.concat_ws(",", *[F.col(c).cast("string") for c in columns])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _counted_in_batches(keys: list[str], kinds: pa.Schema):
    """How often each key comes in a batch: a key with many rows is sent once per batch and not once per row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([([], "count_all")])
            yield from counted.select([*keys, "count_all"]).rename_columns([*keys, "rows"]).cast(kinds).to_batches()

    return count


def _rows_by_key(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Rows of each key. Tasks are as many as rows need, as encoded keys are small and adaptive execution goes by bytes."""
    shown = df.select(*keys)
    schema = T.StructType([*shown.schema.fields, T.StructField("rows", T.LongType())])
    counted = shown.mapInArrow(_counted_in_batches(keys, to_arrow_schema(schema)), schema)
    return counted.repartition(max(1, -(-rows // TASK_ROWS)), *keys).groupBy(*keys).agg(F.sum("rows").alias("rows"))


def pk_audit(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Keys that are not unique: (table_name, key, rows). The tables are counted first."""
    sizes = _union([df.select(F.lit(name).alias("name")) for name, (df, _) in tables.items()]).groupBy("name").count()
    rows = {r["name"]: r["count"] for r in sizes.collect()}
    return _union([
        _rows_by_key(df, keys, rows.get(name, 0))
        .where(F.col("rows") > 1)
        .select(F.lit(name).alias("table_name"), _joined(keys).alias("key"), "rows")
        for name, (df, keys) in tables.items()
    ])


def fk_audit(references: list[tuple[str, DataFrame, DataFrame, list[str]]]) -> DataFrame:
    """Child keys without a parent: (constraint_name, key, rows).

    Children are counted per key before the join, so a hot parent costs one row per task.
    """
    return _union([
        child.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(parent.select(*keys), keys, "left_anti")
        .select(F.lit(name).alias("constraint_name"), _joined(keys).alias("key"), "rows")
        for name, child, parent, keys in references
    ])


@dataclass(frozen=True)
class Check:
    name: str
    fails: Column


def _positive(column: str) -> Check:
    return Check(f"{column}_positive", F.col(column).isNull() | (F.col(column) <= 0))


def _one_of(column: str, values: tuple[str, ...]) -> Check:
    return Check(f"{column}_known", F.col(column).isNull() | ~F.col(column).isin(*values))


def checks_for(record: str, columns: list[str]) -> list[Check]:
    """The row checks of a record type, limited to the columns a table has."""
    layout = LAYOUTS[record]
    checks = [_positive(f.name) for f in layout.fields if f.kind == "id"]
    if record == "customer":
        for field in CUSTOMER.fields[1:]:
            value = F.col(field.name)
            checks.append(Check(f"{field.name}_not_null", value.isNull()))
            checks.append(Check(f"{field.name}_width", F.length(value) > field.width))
    if record == "account":
        checks += [
            Check("start_date_not_null", F.col("start_date").isNull()),
            Check("end_date_order", F.col("end_date") < F.col("start_date")),
            _one_of("account_type", ACCOUNT_TYPES),
        ]
    if record == "relationship":
        checks.append(_one_of("type", RELATIONSHIP_TYPES))
    if record == "transaction":
        checks += [
            _one_of("type", TRANSACTION_TYPES),
            Check("amount_nonnegative", F.col("amount").isNull() | (F.col("amount") < 0)),
        ]
    if "source_line" in columns:
        checks.append(_positive("source_line"))
    if "batch_date" in columns:
        checks.append(Check("batch_date_not_null", F.col("batch_date").isNull()))
    return checks


def check_audit(tables: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Rows that fail a check: (table_name, check_name, key). Each table is scanned once for all its checks."""
    parts = []
    for name, (record, df) in tables.items():
        failed = F.filter(
            F.array(*[F.when(c.fails, F.lit(c.name)) for c in checks_for(record, df.columns)]),
            lambda check: check.isNotNull(),
        )
        parts.append(
            df.select(
                F.lit(name).alias("table_name"),
                F.explode(failed).alias("check_name"),
                _joined(list(LAYOUTS[record].keys)).alias("key"),
            )
        )
    return _union(parts)


class BrokenConstraint(ValueError):
    """Rows that were being written break a check; what was written must not be published."""


class Gate:
    """Counts what breaks the checks of a record type while its rows are written, without another pass over them.

    ``watch`` the rows that are written, ``close`` after the write and before anything refers to it. A count may be too
    high when tasks are run again, but is zero only if every row is sound.
    """

    def __init__(self, record: str):
        self.record = record
        self.seen: Observation | None = None

    def watch(self, rows: DataFrame) -> DataFrame:
        self.seen = Observation(f"checks-{self.record}")
        found = [F.count_if(check.fails).alias(check.name) for check in checks_for(self.record, rows.columns)]
        return rows.observe(self.seen, F.count(F.lit(1)).alias("rows"), *found)

    def close(self) -> None:
        """Refuse the write if a check was broken. To be called where rows were written: an empty plan has no counts."""
        broken = {k: n for k, n in self.seen.get.items() if n and k != "rows"} if self.seen else {}
        if broken:
            raise BrokenConstraint(f"{self.record}: " + ", ".join(f"{k} broken by {n}" for k, n in sorted(broken.items())))


def run_audit(runs: DataFrame) -> DataFrame:
    """Attempts that break the run rules: (rule, batch_date, key).

    ``runs`` has one row per attempt: batch_run_id, batch_date, status, started_at, completed_at, error_message.
    """
    done, running = F.col("completed_at"), F.col("status") == "RUNNING"
    state = F.filter(
        F.array(
            F.when(~F.col("status").isin(*RUN_STATUSES), F.lit("unknown_status")),
            F.when(running != done.isNull(), F.lit("completion_time_state")),
            F.when(done < F.col("started_at"), F.lit("completed_before_start")),
            F.when((F.col("status") != "FAILED") & F.col("error_message").isNotNull(), F.lit("message_without_failure")),
        ),
        lambda rule: rule.isNotNull(),
    )
    broken = runs.select(F.explode(state).alias("rule"), "batch_date", F.col("batch_run_id").alias("key"))
    crowded = (
        runs.where(F.col("status").isin("RUNNING", "COMPLETED"))
        .groupBy("batch_date")
        .agg(F.count(F.lit(1)).alias("active"))
        .where(F.col("active") > 1)
        .select(
            F.lit("one_active_attempt").alias("rule"), "batch_date", F.col("active").cast("string").alias("key")
        )
    )
    return broken.unionByName(crowded)


def digests(table: DataFrame, by: list[str]) -> DataFrame:
    """For each partition ``by`` its rows and two sums of hashes of whole rows, which no order of the rows changes.

    One row a partition, small enough to be kept beside it. Two tables whose digests of a partition differ differ there;
    equal ones hold the same rows but for a chance of about 2^-128.
    """
    rest = sorted(c for c in table.columns if c not in by)
    nulls = F.concat_ws("", *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in rest])
    of = lambda salt: F.sum(F.xxhash64(F.lit(salt), nulls, *rest).cast("decimal(38,0)"))
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), of(1).alias("first_sum"), of(2).alias("second_sum"))


def differing(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """Partitions of digests ``before`` that ``after`` lacks or holds otherwise."""
    return before.join(after, [*by, "rows", "first_sum", "second_sum"], "left_anti").select(*by)


def immutability_by_digest(
    before: DataFrame, after: DataFrame, keys: list[str], by: list[str], known: DataFrame | None = None
) -> DataFrame:
    """``immutability``, looking only at rows of partitions whose digests differ; ``known`` are kept digests of ``before``.

    The differing partitions are written and counted: none ends the audit, and up to ``FEW_PARTITIONS`` become literals,
    so that other partitions of partitioned files are not opened.
    """
    suspects = durable(differing(known if known is not None else digests(before, by), digests(after, by), by), "suspects")
    n = suspects.count()
    if n <= FEW_PARTITIONS:
        found = [reduce(and_, [F.col(c).eqNullSafe(F.lit(r[c])) for c in by]) for r in suspects.collect()]
        wanted = reduce(or_, found, F.lit(False))
        return immutability(before.where(wanted), after.where(wanted), keys)
    return immutability(before.join(suspects, by, "left_semi"), after.join(suspects, by, "left_semi"), keys)


def immutability(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of an append-only table that a later version changed or lost: keys and ``change``."""
    values = [c for c in before.columns if c not in keys]
    old = before.select(*keys, F.struct(*values).alias("old"))
    new = after.select(*keys, F.struct(*values).alias("new"))
    return (
        old.join(new, keys, "left")
        .where(~F.col("old").eqNullSafe(F.col("new")))
        .select(*keys, F.when(F.col("new").isNull(), "vanished").otherwise("changed").alias("change"))
    )
