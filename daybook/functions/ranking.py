"""Exact global positions of rows without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.session import durable

# One row per written partition; counted before it is broadcast.
MAX_BROADCAST_PARTITIONS = 1_000_000


def with_position(rows: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in ``order``.

    The rows are range partitioned and sorted once into the shared folder, so the counting pass and the
    numbering pass see the same partitions whatever is re-run in between.
    """
    ranged = rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    written = durable(
        ranged.withColumn("_part", F.spark_partition_id()).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "ranked",
    )
    parts = written.groupBy("_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    parts = parts.select(
        "_part", "_first", (F.sum("_rows").over(W.orderBy("_part")) - F.col("_rows")).alias("_before")
    )
    parts = durable(parts, "rank-offsets")
    if parts.count() <= MAX_BROADCAST_PARTITIONS:
        parts = F.broadcast(parts)
    return written.join(parts, "_part").select(
        *rows.columns, (F.col("_row") - F.col("_first") + F.col("_before")).alias(name)
    )
