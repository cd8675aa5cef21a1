"""The business-date clock: a record belongs to the day after the last control date received before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.functions import fields as fx
from daybook.session import durable
from daybook.sources import files

IDENTITY = ["topic", "part", "off"]
# Interval rows are small; a thousand years of days stay near 30 MB when broadcast.
MAX_BROADCAST_INTERVALS = 400_000


def control_intervals(controls: DataFrame) -> DataFrame:
    """Arrival intervals with their assigned date: (from_ts, from_id, to_ts, to_id, assigned).

    Repeated control dates change nothing and dates before the active one are refused, so only the first arrival
    of each date can matter; the window runs over distinct dates, not over arrivals.
    """
    firsts = controls.groupBy("control_date").agg(F.min(F.struct("ts", "event_id")).alias("at"))
    arrival = W.orderBy("at")
    earlier = F.max("control_date").over(arrival.rowsBetween(W.unboundedPreceding, -1))
    moves = firsts.withColumn("earlier", earlier).where(
        F.col("earlier").isNull() | (F.col("control_date") > F.col("earlier"))
    )
    after = F.lead("at").over(arrival)
    return moves.select(
        F.col("at.ts").alias("from_ts"),
        F.col("at.event_id").alias("from_id"),
        after["ts"].alias("to_ts"),
        after["event_id"].alias("to_id"),
        F.date_add("control_date", 1).alias("assigned"),
    )


def assign_business_dates(data: DataFrame, controls: DataFrame) -> DataFrame:
    """Add ``batch_date`` to data rows by arrival order (ts, event_id); null while no control date has come.

    An as-of join by calendar day: each closed interval is listed under the days it covers, so a row meets only
    the intervals of its own day. The open last interval is a pair of scalars.
    """
    intervals = durable(control_intervals(controls), "intervals")
    last = intervals.where(F.col("to_ts").isNull())
    closed = intervals.where(F.col("to_ts").isNotNull()).withColumn(
        "day", F.explode(F.sequence(F.to_date("from_ts"), F.to_date("to_ts")))
    )
    if closed.count() <= MAX_BROADCAST_INTERVALS:
        closed = F.broadcast(closed)
    arrival = F.struct("ts", "event_id")
    joined = data.withColumn("day", F.to_date("ts")).join(
        closed.withColumnRenamed("day", "interval_day"),
        (F.col("day") == F.col("interval_day"))
        & (arrival >= F.struct(F.col("from_ts"), F.col("from_id")))
        & (arrival < F.struct(F.col("to_ts"), F.col("to_id"))),
        "left",
    )
    last_from = last.select(F.struct("from_ts", "from_id")).scalar()
    current = F.when(
        arrival >= F.struct(last_from["from_ts"].alias("ts"), last_from["from_id"].alias("event_id")),
        last.select("assigned").scalar(),
    )
    return joined.select(*data.columns, F.coalesce("assigned", current).alias("batch_date"))


def first_assignments(stamped: DataFrame) -> DataFrame:
    """One row per ingestion identity: a record delivered again keeps its first assignment."""
    rest = [c for c in stamped.columns if c not in (*IDENTITY, "ts", "event_id")]
    first = stamped.groupBy(*IDENTITY).agg(F.min(F.struct("ts", "event_id", *rest)).alias("first"))
    return first.select(*IDENTITY, "first.*").select(*stamped.columns)


def closed_dates(stamped: DataFrame, controls: DataFrame) -> DataFrame:
    """Rows of dates that are closed: before the active assignment date."""
    active = controls.agg(F.date_add(F.max("control_date"), 1)).scalar()
    return stamped.where(F.col("batch_date") < active)


def dedup_stream(stream: DataFrame) -> DataFrame:
    """Drop redelivered records of a stream by topic, partition and offset."""
    return stream.dropDuplicates(IDENTITY)


class ClockStream:
    """Stamps a stream in micro-batches; use ``on_batch`` with ``foreachBatch``.

    The active date after batch n is a one-row table named by n, so a batch that is run again after a failure
    starts from the same date and overwrites its own output. Records before the first control date wait in
    ``pending`` and are stamped by the batch that brings it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def on_batch(self, batch: DataFrame, number: int) -> None:
        spark, folder = self.spark, self.folder
        batch = durable(batch, "clock-batch")
        before = None
        if number > 0:
            row = spark.read.parquet(f"{folder}/active/{number - 1}").first()
            before = row["active"]
        controls = batch.where(F.col("control_date").isNotNull()).select("control_date", "ts", "event_id")
        if before is not None:
            controls = controls.where(F.date_add("control_date", 1) > fx.day(before))
        data = batch.where(F.col("control_date").isNull())
        stamped = assign_business_dates(data, controls)
        after = controls.agg(F.date_add(F.max("control_date"), 1).alias("active"))
        if before is not None:
            stamped = stamped.withColumn("batch_date", F.coalesce("batch_date", fx.day(before)))
            after = after.select(F.coalesce("active", fx.day(before)).alias("active"))
        after.write.mode("overwrite").parquet(f"{folder}/active/{number}")
        now_active = spark.read.parquet(f"{folder}/active/{number}").first()["active"]
        if now_active is None:
            data.write.mode("overwrite").parquet(f"{folder}/pending/{number}")
            return
        if before is None:
            first = controls.agg(
                F.date_add(F.min_by("control_date", F.struct("ts", "event_id")), 1).alias("d")
            ).scalar()
            waited = [p for p in (f"{folder}/pending/{k}" for k in range(number)) if files.exists(spark, p)]
            if waited:
                stamped = stamped.unionByName(
                    spark.read.schema(data.schema).parquet(*waited).withColumn("batch_date", F.lit(None).cast("date"))
                )
            stamped = stamped.withColumn("batch_date", F.coalesce("batch_date", first))
        stamped.write.mode("overwrite").parquet(f"{folder}/stamped/batch={number}")

    def stamped(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/stamped").drop("batch")
