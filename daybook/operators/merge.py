"""Full-record merges of staged reference data into current state. Omitted records stay as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def upsert(current: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """Staged records replace or join the current ones, whole records at a time.

    Choosing the record by side, not value by value, lets a staged null clear a value. The untouched part is
    an anti join, so a small batch is broadcast and the current table is not shuffled. ``staged`` holds one
    record per key.
    """
    untouched = current.join(staged.select(*keys), keys, "left_anti")
    return untouched.select(*current.columns).unionByName(staged.select(*current.columns))


def upsert_audited(current: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """``upsert`` with processing times: created_at is kept, updated_at moves on every staged record."""
    values = [c for c in current.columns if c not in ("created_at", "updated_at")]
    now = F.current_timestamp()
    stamped = (
        staged.select(*values)
        .join(current.select(*keys, "created_at"), keys, "left")
        .withColumn("created_at", F.coalesce("created_at", now))
        .withColumn("updated_at", now)
    )
    return upsert(current, stamped, keys)


def first_record(rows: DataFrame, keys: list[str], order: list[str], descending: bool = False) -> DataFrame:
    """The whole record that comes first per key in ``order``.

    Spark keeps one row per key and task before the shuffle (a window group limit), so a key with many records
    costs no more than any other.
    """
    by = [F.desc(c) if descending else F.asc(c) for c in order]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*by))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def first_copy(staged: DataFrame, keys: list[str]) -> DataFrame:
    """The record with the lowest source line per key."""
    return first_record(staged, keys, ["source_line"])


def latest_record(staged: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last full record per key in ``order``."""
    return first_record(staged, keys, order, descending=True)


def new_keys(staged: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Staged keys the state before the run does not hold."""
    return staged.select(*keys).distinct().join(current.select(*keys), keys, "left_anti")


def initial_balances(new_accounts: DataFrame) -> DataFrame:
    """A zero balance for every account on creation."""
    return new_accounts.select("account_id", F.lit(0).cast("bigint").alias("balance"))
