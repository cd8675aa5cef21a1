"""Optional edge connector: tables of a database as partitioned reads and writes. Needs a driver on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """Read ``table`` with one range of ``key`` per task."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=str(lower), upperBound=str(upper))
        .options(numPartitions=str(partitions), **options)
        .load()
    )


def append_table(df: DataFrame, url: str, table: str, batch_size: int = 10_000, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_size), **options).mode("append").save()
