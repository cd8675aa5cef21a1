"""The ledger and current state laid out in buckets: what a batch reads, moves and writes."""

import json
import re

import pytest
from ledger_files import account_line, customer_line, relationship_line, transaction_line, write_files
from pyspark.sql import functions as F

from daybook.operators import references
from daybook.plans.daily import Ledger
from daybook.schemas import LEDGER
from daybook.sources import buckets, files

BY = ("batch_date", "batch_run_id")


@pytest.fixture
def ledger(spark, tmp_path):
    table = buckets.BucketedTable(spark, str(tmp_path / "ledger"), LEDGER, ["transaction_id"], 4, BY)
    for day in (1, 2):
        rows = spark.range(day * 2000, (day + 1) * 2000).select(
            F.col("id").alias("transaction_id"), (F.col("id") % 7).alias("account_id"), F.lit("CR").alias("type"), F.col("id").alias("amount")
        )
        table.append(rows, (f"2026-01-0{day}", f"run{day}"))
    return table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ledger_side(text):
    """The plan from the join's ledger side down to its scan."""
    lines = text.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "daybook_" in line)
    depth = lambda line: len(re.match(r"[ :|+*()0-9-]*", line).group())
    out, level = [lines[at]], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            out.append(line)
            level = depth(line)
            if "Join" in line:
                break
    return "\n".join(out)


def test_a_large_batch_leaves_the_ledger_where_it_is(spark, ledger):
    staged = spark.range(1000, 5000).select(F.col("id").alias("transaction_id"))
    found = buckets.matching(ledger.rows(), staged, "transaction_id", 4)
    side = ledger_side(plan(found))
    assert "Join" in side and "Exchange" not in side and "Bucketed: true" in side
    assert found.count() == 3000


def test_a_small_batch_opens_its_buckets_only(spark, ledger):
    staged = spark.createDataFrame([(2500,), (2500,), (99,)], "transaction_id long")
    # The plan names the buckets only where it reads one a task; it leaves the others out either way.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        found = buckets.matching(ledger.rows(), staged, "transaction_id", 4)
        side = plan(found)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert re.search(r"SelectedBucketsCount: [12] out of 4", side) and "In(transaction_id, [" in side
    assert [r["amount"] for r in found.collect()] == [2500]


def test_matches_equal_those_of_a_plain_ledger(spark, ledger):
    staged = spark.range(1500, 2500).select(F.col("id").alias("transaction_id"), (F.col("id") % 7).alias("account_id"), F.lit("CR").alias("type"), F.lit(2400).cast("long").alias("amount"))
    plain = ledger.rows()
    for taken in (staged, staged.limit(3)):
        with_buckets = references.with_posted(taken, ledger.rows(), 4).collect()
        assert sorted(with_buckets) == sorted(references.with_posted(taken, plain).collect())


def test_undeclared_partitions_are_not_read(spark, ledger):
    rows = spark.range(1).select(F.lit(1).cast("long").alias("transaction_id"), F.lit(1).cast("long").alias("account_id"), F.lit("CR").alias("type"), F.lit(1).cast("long").alias("amount"))
    buckets.write_bucketed(rows, f"{ledger.path}/batch_date=2026-01-03/batch_run_id=lost", ["transaction_id"], 4)
    assert ledger.rows().count() == 4000
    again = buckets.BucketedTable(spark, ledger.path, LEDGER, ["transaction_id"], 4, BY)
    again.declare([("2026-01-03", "lost")])
    assert again.rows().count() == 4001


def test_a_date_writes_only_the_buckets_it_touches(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "root"), buckets=8)
    folder = tmp_path / "in"
    keys = range(1, 41)
    customers, accounts = [customer_line(k) for k in keys], [account_line(k) for k in keys]
    links = [relationship_line(k, k) for k in keys]
    posted = [transaction_line(k, k, "CR", 100) for k in keys]
    write_files(folder, "20260105", customers, accounts, links, posted)
    write_files(folder, "20260106", [customer_line(3, "Ida")], [], [], [transaction_line(100, 7, "DR", 30)])
    for date in ("2026-01-05", "2026-01-06"):
        ledger.ingest(str(folder), date)
        ledger.process(date)
    first, second = (e["paths"] for e in ledger.store.entries() if e["status"] == "COMPLETED")
    changed = {}
    for name in ("customer", "account", "relationship", "balance"):
        old, new = (json.loads(files.read_text(spark, p[name])) for p in (first, second))
        assert len(old) > 4 and old.keys() == new.keys()
        changed[name] = sum(old[b] != new[b] for b in old)
    assert changed == {"customer": 1, "account": 0, "relationship": 0, "balance": 1}
    state = ledger.store.state("customer")
    assert state.count() == 40 and state.where("first_name = 'Ida'").count() == 1
    balances = {r["account_id"]: r["balance"] for r in ledger.store.state("balance").collect()}
    assert balances == {k: 70 if k == 7 else 100 for k in keys}
    reopened = Ledger(spark, str(tmp_path / "root"))
    assert reopened.store.buckets == 8 and reopened.store.ledger().count() == 41
