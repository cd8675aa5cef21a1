"""Field rules, admission, audits, and plans that must hold for hot keys and large tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.functions import fields as fx
from daybook.functions.ranking import with_position
from daybook.operators import admission, merge, posting, references, staging
from daybook.plans import backfill
from daybook.plans.store import EVENT
from daybook.schemas import LISTING, RUN_EVENT
from daybook.session import local_rows, shared_folder

MAX = 2**63 - 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_date_arguments():
    assert fx.batch_date("0001-01-01") == dt.date(1, 1, 1) and fx.compact(dt.date(1, 2, 3)) == "00010203"
    for bad in ("10000-01-01", "2026-2-9", "2026-02-30", "20260209", ""):
        with pytest.raises(ValueError):
            fx.batch_date(bad)


def test_compact_dates(spark):
    names = ["20260101", "20260230", "00000101", "00010101", "2026010", "2026-1-1"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in rows.select(fx.parsed_compact_date(F.col("n"))).collect()]
    assert got == [dt.date(2026, 1, 1), None, None, dt.date(1, 1, 1), None, None]


def test_sums_are_exact_past_64_bits(spark):
    rows = spark.createDataFrame([(1, "CR", MAX), (1, "CR", MAX), (1, "DR", MAX), (2, "DR", MAX), (2, "DR", 1)],
                                 "account_id long, type string, amount long")
    zero = spark.createDataFrame([(1, 0), (2, 0)], "account_id long, balance long")
    got = {r[0]: r[1] for r in posting.balances_after(zero, posting.account_deltas(rows)).collect()}
    assert got == {1: MAX, 2: -(2**63)}
    more = rows.union(spark.createDataFrame([(1, "CR", 1)], rows.schema))
    assert [r["account_id"] for r in posting.overflowing(zero, posting.account_deltas(more)).collect()] == [1]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="outside signed 64-bit"):
                posting.balances_after(zero, posting.account_deltas(more)).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_upsert_can_clear_a_value_and_keeps_creation_time(spark):
    old, new = dt.datetime(2020, 1, 1), "created_at timestamp, updated_at timestamp"
    current = spark.createDataFrame([(1, "a", old, old), (2, "b", old, old)], f"k long, v string, {new}")
    staged = spark.createDataFrame([(1, None), (3, "c")], "k long, v string")
    got = {r["k"]: r for r in merge.upsert_audited(current, staged, ["k"]).collect()}
    assert (got[1]["v"], got[2]["v"], got[3]["v"]) == (None, "b", "c")
    assert got[1]["created_at"] == old < got[1]["updated_at"] and got[2]["updated_at"] == old


def test_replacing_a_date_with_nothing(spark):
    rows = spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2)], "batch_date string, k long")
    dates = rows.where("k = 1").select("batch_date")
    assert [r["k"] for r in staging.replace_by_date(rows, rows.limit(0), dates).collect()] == [2]


def test_triggers_and_missing_files(spark):
    names = ["batch_20260103.trg", "batch_20260101.trg", "batch_20260101.INPROGRESS.trg", "batch_20260102.COMPLETE.trg",
             "batch_20260102.ERROR.trg", "batch_20260102.trg.tmp", "xbatch_20260104.trg", "batch_20260230.trg"]
    listing = local_rows(spark, [dict(directory="in", name=n, length=0, is_regular=True) for n in names], LISTING)
    got = {r["name"]: r["status"] for r in admission.ready_batches(listing).collect()}
    assert got == {"batch_20260103.trg": "ready", "batch_20260101.trg": "ready", "batch_20260230.trg": "bad_date"}
    assert admission.oldest_ready(listing).first()["batch_date"] == dt.date(2026, 1, 1)


def runs_of(spark, *attempts):
    """Attempts as (run, date, final status or None)."""
    at = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    events = []
    for n, (run, date, status) in enumerate(attempts):
        day = dt.date.fromisoformat(date)
        events.append(dict(batch_run_id=run, batch_date=day, status="RUNNING", at=at + dt.timedelta(hours=n)))
        if status:
            events.append(dict(batch_run_id=run, batch_date=day, status=status, at=at + dt.timedelta(hours=n, minutes=1)))
    return admission.current_runs(local_rows(spark, events, RUN_EVENT))


def decide(spark, runs, dates, receipts=(), exported=(), missing=()):
    def days(values):
        schema = EVENT["batch_date"]
        return local_rows(spark, [{"batch_date": dt.date.fromisoformat(d)} for d in values], type(EVENT)([schema]))

    rows = admission.batch_admission(days(dates), runs, days(receipts), days(exported), days(missing)).collect()
    return {str(r["batch_date"])[-2:]: (r["ingest"], r["process"], r["job"]) for r in rows}


def test_admission(spark):
    dates = [f"2026-01-0{d}" for d in range(1, 8)]
    runs = runs_of(spark, ("a", dates[1], "COMPLETED"), ("b", dates[2], "FAILED"), ("c", dates[2], "COMPLETED"),
                   ("d", dates[4], "FAILED"))
    got = decide(spark, runs, dates, receipts=dates[:6], exported=dates[1:2], missing=dates[3:4])
    assert got == {
        "01": ("ok", "out_of_order", "out_of_order"),
        "02": ("ingest_locked", "noop", "noop"),
        "03": ("ingest_locked", "noop", "export_only"),
        "04": ("ok", "run", "missing_input"),
        "05": ("ok", "run", "run"),
        "06": ("ok", "run", "blocked_by_earlier"),
        "07": ("ok", "not_ingested", "blocked_by_earlier"),
    }
    running = runs_of(spark, ("a", dates[0], "COMPLETED"), ("b", dates[1], None))
    got = decide(spark, running, dates[:3], receipts=dates)
    assert got == {
        "01": ("ingest_locked", "noop", "blocked_running"),
        "02": ("ingest_locked", "blocked_running", "blocked_running"),
        "03": ("ok", "blocked_running", "blocked_running"),
    }


def test_an_ended_attempt_is_not_downgraded(spark):
    at, day = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc), dt.date(2026, 1, 1)
    events = [dict(batch_run_id="a", batch_date=day, status=s, at=at + dt.timedelta(minutes=m), transaction_count=c)
              for m, (s, c) in enumerate([("RUNNING", None), ("COMPLETED", 5), ("FAILED", None)])]
    row = admission.current_runs(local_rows(spark, events, RUN_EVENT)).first()
    assert (row["status"], row["transaction_count"]) == ("COMPLETED", 5)


def test_positions_are_dense_and_ordered(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    got = with_position(rows, ["k"]).collect()
    assert [r["position"] for r in sorted(got, key=lambda r: r["k"])] == list(range(5000))


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_a_hot_account_is_split_where_its_rows_are_the_result(small_partitions):
    """A third of all rows on one account: the check is one row per task, the fetch a split join."""
    spark = small_partitions
    staged = spark.range(0, 60000, 1, 12).select(
        F.lit(dt.date(2026, 1, 1)).alias("batch_date"),
        F.lit("transaction_20260101.dat").alias("source_file"),
        (F.col("id") + 1).alias("source_line"),
        (F.col("id") + 1).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500 + 1000).alias("account_id"),
        F.lit("CR").alias("type"),
        F.lit(5).cast("bigint").alias("amount"),
    )
    known = spark.range(1000, 1500).select(F.col("id").alias("account_id"))
    found = references.missing_accounts(staged, known, known.limit(0)).withColumn("_", F.lit(1))
    assert len(found.collect()) == 20000
    assert "skew=true" in plan(found)


def test_sound_rows_are_not_shuffled_to_be_checked(spark):
    staged = spark.range(1000).select(F.col("id").alias("account_id"), F.lit("x").alias("payload"))
    found = references.missing_accounts(staged, staged.select("account_id"), staged.limit(0))
    assert found.collect() == []
    assert "SortMergeJoin" not in plan(found) and "Exchange hashpartitioning" not in plan(found)


def test_hot_ids_leave_a_task_as_one_row(spark):
    feed = spark.range(0, 9000, 1, 6).select(
        F.lit(dt.date(2026, 1, 1)).alias("batch_date"),
        (F.col("id") + 1).alias("source_line"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("transaction_id"),
        (F.col("id") % 5).alias("account_id"),
        F.lit("CR").alias("type"),
        F.col("id").alias("amount"),
    )
    first = backfill.winners(feed)
    text = plan(first)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    rows = {r["transaction_id"]: r["amount"] for r in first.collect()}
    assert len(rows) == 6001 and rows[0] == 0


def test_replays_and_conflicts_by_brute_force(spark):
    rows = [(dt.date(2026, 1, 1 + d), line, t, a, "CR", m)
            for line, (d, t, a, m) in enumerate([(0, 1, 1, 5), (1, 1, 1, 5), (2, 1, 1, 6), (3, 1, 1, 5), (3, 2, 1, 5),
                                                (4, 2, 2, 5), (5, 2, 1, 5), (0, 3, 1, 1)])]
    feed = spark.createDataFrame(rows, "batch_date date, source_line long, transaction_id long, account_id long, type string, amount long")
    got = {r["transaction_id"]: (r["amount"], r["replays"], r["conflicts"]) for r in backfill.first_postings(feed).collect()}
    assert got == {1: (5, 2, 1), 2: (5, 1, 1), 3: (1, 0, 0)}
    second = backfill.first_two_contents(feed).where("turn = 2").collect()
    assert {r["transaction_id"]: r["batch_date"].day for r in second} == {1: 3, 2: 5}


def test_date_filter_prunes_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(dt.date(2026, 1, d), d) for d in (1, 2, 3)], "batch_date date, k long")
    rows.write.partitionBy("batch_date").parquet(str(tmp_path / "t"))
    pruned = staging.staging_by_date(spark.read.parquet(str(tmp_path / "t")), dt.date(2026, 1, 2))
    assert "PartitionFilters: [isnotnull(batch_date" in plan(pruned) and pruned.count() == 1


def test_shared_folder_is_named_by_the_session():
    class Session:
        def __init__(self, master, settings):
            self.conf = self.sparkContext = self
            self.master, self.settings = master, settings

        def get(self, key, default=None):
            return self.settings.get(key, default)

        def getConf(self):
            return self

        def getCheckpointDir(self):
            return None

    assert shared_folder(Session("yarn", {"spark.checkpoint.dir": "hdfs://shared/dir/"})) == "hdfs://shared/dir"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn", {}))
