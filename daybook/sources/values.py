"""Lists of values for generated records: one per line, blank and comment lines skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import fields as fx


def read_values(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Values of a list in NFC. One that does not fit ``width`` stops the job; an empty list is an error at once."""
    lines = spark.read.option("lineSep", "\n").text(path).where(
        ~F.col("value").rlike(r"\A\s*\z") & ~F.col("value").startswith("#")
    )
    if lines.isEmpty():
        raise ValueError(f"value list without values: {path}")
    text = F.col("text")
    return lines.select(fx.normalized(F.col("value")).alias("text")).select(
        F.when(fx.has_forbidden(text), F.raise_error(F.lit("forbidden character in a value list")))
        .when(F.length(text) > width, F.raise_error(F.lit(f"value list entry exceeds {width} positions")))
        .otherwise(text)
        .alias("value")
    )
