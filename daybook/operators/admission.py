"""Which batch dates may be ingested, posted or run. Control tables have one row per date or attempt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.fields import compact_date, parsed_compact_date
from daybook.schemas import LAYOUTS, RUN_COUNTS

# Trigger names.
READY_TRIGGER = r"\Abatch_([0-9]{8})\.trg\z"


def current_runs(events: DataFrame) -> DataFrame:
    """The state of each attempt from its append-only events: started, then completed or failed once.

    An attempt that ended is never downgraded: the first end counts.
    """
    started = F.min(F.when(F.col("status") == "RUNNING", F.col("at")))
    ended = F.col("status") != "RUNNING"
    end = F.min(F.when(ended, F.struct("at", "status", *RUN_COUNTS, "error_message")))
    return (
        events.groupBy("batch_run_id", "batch_date")
        .agg(started.alias("started_at"), end.alias("end"))
        .select(
            "batch_run_id",
            "batch_date",
            F.coalesce("end.status", F.lit("RUNNING")).alias("status"),
            "started_at",
            F.col("end.at").alias("completed_at"),
            *[F.coalesce(f"end.{name}", F.lit(0)).cast("bigint").alias(name) for name in RUN_COUNTS],
            F.col("end.error_message").alias("error_message"),
        )
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last attempt per date."""
    return runs.groupBy("batch_date").agg(
        F.max_by("status", F.struct("started_at", "batch_run_id")).alias("last_status"),
        F.max(F.col("status") == "COMPLETED").alias("completed"),
        F.max(F.col("status") == "RUNNING").alias("running"),
    )


def latest_jobs(jobs: DataFrame) -> DataFrame:
    """Per date whether its last launch ended well, from events (number, batch_date, status).

    A launch covers ingestion, posting and export. One that only started counts as unfinished, as its driver may
    have been lost.
    """
    last = F.max_by("status", "number")
    return jobs.groupBy("batch_date").agg((last == "COMPLETED").alias("finished"))


def batch_admission(
    dates: DataFrame,
    runs: DataFrame,
    receipts: DataFrame,
    exported: DataFrame,
    missing_files: DataFrame,
    jobs: DataFrame | None = None,
) -> DataFrame:
    """Decide every date at once: (batch_date, ingest, process, job).

    ``ingest``: ok, or ingest_locked while an attempt runs or has completed.
    ``process``: noop, blocked_running, not_ingested, out_of_order or run; refusals leave no attempt behind.
    ``job``: the same with its own barriers: export_only after posting, blocked_by_earlier while an earlier date
    is unfinished, missing_input before anything is staged. A date is unfinished if its last posting attempt failed,
    or if its last launch (``jobs``, events) did not end well, be it for its input, its posting or its export.

    The barriers between dates are scalar subqueries over the runs and launches.
    """
    latest = latest_runs(runs)
    facts = (
        dates.select("batch_date")
        .distinct()
        .join(latest, "batch_date", "left")
        .join(receipts.select("batch_date", F.lit(True).alias("ingested")).distinct(), "batch_date", "left")
        .join(exported.select("batch_date", F.lit(True).alias("exported")).distinct(), "batch_date", "left")
        .join(missing_files.select("batch_date", F.lit(True).alias("lacks_input")).distinct(), "batch_date", "left")
    )
    done = F.coalesce("completed", F.lit(False))
    running = latest.agg(F.count_if("running")).scalar() > 0
    last_completed = latest.where("completed").agg(F.max("batch_date")).scalar()
    first_failed = latest.where(F.col("last_status") == "FAILED").agg(F.min("batch_date")).scalar()
    if jobs is not None:
        first_unfinished = latest_jobs(jobs).where(~F.col("finished")).agg(F.min("batch_date")).scalar()
        first_failed = F.least(first_failed, first_unfinished)
    late = F.coalesce(F.col("batch_date") < last_completed, F.lit(False))
    behind_failure = F.coalesce(first_failed < F.col("batch_date"), F.lit(False))
    return facts.select(
        "batch_date",
        F.when(done | F.coalesce("running", F.lit(False)), "ingest_locked").otherwise("ok").alias("ingest"),
        F.when(done, "noop")
        .when(running, "blocked_running")
        .when(F.col("ingested").isNull(), "not_ingested")
        .when(late, "out_of_order")
        .otherwise("run")
        .alias("process"),
        F.when(running, "blocked_running")
        .when(behind_failure, "blocked_by_earlier")
        .when(done & F.col("exported").isNotNull(), "noop")
        .when(done, "export_only")
        .when(F.col("lacks_input").isNotNull(), "missing_input")
        .when(late, "out_of_order")
        .otherwise("run")
        .alias("job"),
    )


def ready_batches(listing: DataFrame) -> DataFrame:
    """Ready triggers of a listing: (name, batch_date, status). Temporary and terminal names are ignored.

    A trigger that names no real day is ``bad_date``; the oldest name comes first when ordered by name.
    """
    digits = F.regexp_extract("name", READY_TRIGGER, 1)
    date = parsed_compact_date(digits)
    return listing.where(F.col("name").rlike(READY_TRIGGER)).select(
        "name",
        date.alias("batch_date"),
        F.when(~F.col("is_regular"), "not_regular").when(date.isNull(), "bad_date").otherwise("ready").alias("status"),
    )


def oldest_ready(listing: DataFrame) -> DataFrame:
    return ready_batches(listing).orderBy("name").limit(1)


def missing_input_files(dates: DataFrame, listing: DataFrame) -> DataFrame:
    """Dated files that are required but not there as regular files: (batch_date, name). Empty files count."""
    names = F.explode(
        F.array(*[F.concat(F.lit(f"{r}_"), compact_date(F.col("batch_date")), F.lit(".dat")) for r in LAYOUTS])
    )
    expected = dates.select("batch_date", names.alias("name"))
    return expected.join(listing.where("is_regular").select("name"), "name", "left_anti").select("batch_date", "name")


def exportable_snapshots(headers: DataFrame, runs: DataFrame) -> DataFrame:
    """Snapshot headers whose run completed for the same date."""
    return headers.join(
        runs.where(F.col("status") == "COMPLETED").select("batch_run_id", "batch_date"),
        ["batch_run_id", "batch_date"],
    ).select("batch_date", "batch_run_id", "record_count")
