"""Checks during the write, and immutability by digests."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.operators import audits
from daybook.plans.store import Store

TXN = "transaction_id long, account_id long, type string, amount long"


def test_a_gate_refuses_what_was_written_unsound(spark, tmp_path):
    gate = audits.Gate("transaction")
    rows = spark.createDataFrame([(1, 1, "CR", 5), (2, 0, "CR", 5), (3, 1, "XX", -5)], TXN)
    gate.watch(rows).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(audits.BrokenConstraint, match="account_id_positive broken by 1, amount_nonnegative broken by 1, type_known broken by 1"):
        gate.close()
    gate = audits.Gate("transaction")
    gate.watch(rows.limit(1)).write.parquet(str(tmp_path / "good"))
    gate.close()
    audits.Gate("transaction").close()


def test_a_state_that_breaks_a_check_is_not_published(spark, tmp_path):
    store, gate = Store(spark, str(tmp_path), buckets=2), audits.Gate("account")
    bad = spark.createDataFrame(
        [(5, dt.date(2026, 1, 2), dt.date(2026, 1, 1), "SAVINGS", None, None)],
        store.state("account").schema,
    )
    store.write_state("account", "run", bad, lambda current: gate.watch(current.unionByName(bad)))
    with pytest.raises(audits.BrokenConstraint, match="account: end_date_order broken by 1"):
        gate.close()
    assert store.state("account").isEmpty()


def test_only_differing_partitions_are_compared(spark, tmp_path):
    rows = spark.range(3000).select(F.expr("date_add(DATE'2026-01-01', int(id % 5))").alias("day"), "id", (F.col("id") * 2).alias("v"))
    changed = rows.where("id <> 7").withColumn("v", F.expr("if(id = 12, -1, if(id = 22, null, v))"))
    paths = [str(tmp_path / n) for n in ("before", "after")]
    for df, path in zip((rows, changed.orderBy(F.desc("id"))), paths):
        df.write.partitionBy("day").parquet(path)
    before, after = (spark.read.parquet(p) for p in paths)
    found = audits.immutability_by_digest(before, after, ["day", "id"], ["day"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(day" in plan and "2026-01-03" in plan and "2026-01-04" not in plan
    assert sorted((r["id"], r["change"]) for r in found.collect()) == [(7, "vanished"), (12, "changed"), (22, "changed")]
    assert audits.immutability_by_digest(before, before, ["day", "id"], ["day"]).isEmpty()


def test_digests_know_nulls_and_moved_values(spark):
    table = lambda *rows: spark.createDataFrame(rows, "p int, a string, b string")
    base = audits.digests(table((1, "x", None), (1, None, "y")), ["p"])
    for other in (table((1, None, "x"), (1, None, "y")), table((1, "x", None)), table((1, "x", None), (1, "x", None)), table((1, "x", ""), (1, None, "y"))):
        assert audits.differing(base, audits.digests(other, ["p"]), ["p"]).count() == 1
    assert audits.differing(base, audits.digests(table((1, None, "y"), (1, "x", None)), ["p"]), ["p"]).isEmpty()


def test_keys_are_counted_in_tasks_of_so_many_rows(spark, monkeypatch):
    monkeypatch.setattr(audits, "TASK_ROWS", 500, raising=False)
    n = F.col("id")
    unique = spark.range(20_000).select(n.alias("a"), F.lit(dt.date(2026, 1, 1)).alias("day"))
    twice = unique.where("a % 100 = 0")
    hot = spark.range(3_000).select(F.lit(None).cast("long").alias("a"), F.lit(dt.date(2026, 1, 2)).alias("day"))
    text = spark.range(60, numPartitions=3).select(F.concat(F.lit("k"), (n % 20).cast("string")).alias("b"))
    found = audits.pk_audit({
        "wide": (unique.unionByName(twice).unionByName(hot), ["day", "a"]),
        "text": (text, ["b"]),
        "none": (unique.where("a < 0"), ["a"]),
    })
    rows = sorted(tuple(r) for r in found.collect())
    expected = [("wide", f"2026-01-01,{k}", 2) for k in range(0, 20_000, 100)] + [("wide", "2026-01-02", 3_000)]
    assert rows == sorted([*expected, *[("text", f"k{k}", 3) for k in range(20)]])
    per_task = found.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(per_task) >= (20_000 + 200 + 3_000) / 500
