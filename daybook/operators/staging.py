"""Staging tables and their control rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import fields as fx
from daybook.operators.merge import latest_record


def staging_by_date(staged: DataFrame, date) -> DataFrame:
    """The rows of one date; on date-partitioned files this prunes to that partition."""
    return staged.where(F.col("batch_date") == fx.day(date))


def staged_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per date and record type."""
    return reduce(
        DataFrame.unionByName,
        [
            df.groupBy("batch_date")
            .agg(F.count(F.lit(1)).alias("rows"))
            .select("batch_date", F.lit(record).alias("record"), "rows")
            for record, df in tables.items()
        ],
    )


def replace_by_date(existing: DataFrame, incoming: DataFrame, dates: DataFrame) -> DataFrame:
    """Staging after a load: the loaded dates hold the incoming rows only, even when there are none.

    The dates are broadcast, so a date with most of the rows does not gather in one task. Distinct calendar days
    of years 1 to 9999 bound them to 3.7 million small rows.
    """
    kept = existing.join(F.broadcast(dates.select("batch_date").distinct()), "batch_date", "left_anti")
    return kept.select(*existing.columns).unionByName(incoming.select(*existing.columns))


def receipts_latest(receipts: DataFrame) -> DataFrame:
    """One receipt per date: the last ingestion."""
    return receipts.groupBy("batch_date").agg(F.max("ingested_at").alias("ingested_at"))


def staging_latest(arrived: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last full record per batch date and business key."""
    return latest_record(arrived, ["batch_date", *keys], order)
