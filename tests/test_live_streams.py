"""Streams with state: merged offsets, the keyed clock across restarts, staging, closed dates, balances as deltas."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from test_streaming import SCHEMA, arrivals, expected

from daybook.functions.fields import compact
from daybook.schemas import TRANSACTION
from daybook.sources import files
from daybook.streaming import balances, keyed_clock, offsets, staged


def brute_ranges(seen):
    out = []
    for off in sorted(seen):
        if out and off == out[-1][1] + 1:
            out[-1][1] = off
        else:
            out.append([off, off])
    return [tuple(r) for r in out]


def test_ranges_stay_merged_and_know_what_was_seen(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(offsets, "CUT", 8)
    sink = offsets.FirstDeliveries(spark, str(tmp_path))
    draw, first = random.Random(2), {}
    schema = "topic string, part long, off long, ts timestamp, event_id long, batch_date date"
    number, at = 0, dt.datetime(2026, 1, 1)
    for number in range(3):
        rows = []
        for i in range(60):
            place = ("t", draw.randrange(2), draw.randrange(40))
            at += dt.timedelta(minutes=1)
            rows.append((*place, at, number * 60 + i, at.date() + dt.timedelta(days=number)))
            first.setdefault(place, rows[-1][-2:])
        draw.shuffle(rows)
        batch = spark.createDataFrame(rows, schema)
        sink.on_batch(batch, number)
    sink.on_batch(batch, number)  # run again
    kept = {(r["topic"], r["part"], r["off"]): (r["event_id"], r["batch_date"]) for r in sink.rows(batch.schema).collect()}
    assert kept == first
    for part in (0, 1):
        found = sorted((r["low"], r["high"]) for r in sink.ranges().where(F.col("part") == part).collect())
        assert found == brute_ranges(o for _, p, o in first if p == part)


def test_a_row_meets_one_range_however_many_its_partition_has(spark, monkeypatch):
    monkeypatch.setattr(offsets, "CUT", 64)
    draw = random.Random(4)
    held = [(topic, part, off) for topic, part in (("t", 0), ("t", 1), (None, 1)) for off in range(-300, 3000) if draw.random() < 0.6]
    held += [("u", 0, off) for off in range(1000)]  # in sequence over many cuts
    ranges = offsets.merged(offsets.islands(spark.createDataFrame(held, "topic string, part long, off long")))
    by_place = {}
    for topic, part, off in held:
        by_place.setdefault((topic, part), set()).add(off)
    found = {}
    for r in ranges.collect():
        found.setdefault((r["topic"], r["part"]), []).append((r["low"], r["high"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: brute_ranges(v) for k, v in by_place.items()}
    rows = [(topic, part, off, n) for n, (topic, part, off) in enumerate((t, p, o) for t, p in (("t", 0), (None, 1), ("u", 0), ("v", 9)) for o in range(-310, 3010, 3))]
    batch = spark.createDataFrame([*rows, ("t", 0, None, -1)], "topic string, part long, off long, event_id long")
    kept = offsets.unseen(batch, ranges)
    assert {r["event_id"] for r in kept.collect()} == {n for t, p, o, n in rows if o not in by_place.get((t, p), ())} | {-1}
    assert "Join" not in kept._jdf.queryExecution().executedPlan().toString()


def drive(spark, folder, cuts, on_batch):
    rows = arrivals()
    keyed_clock.use_keyed_state(spark)
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        spark.createDataFrame(rows[a:b], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/input")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/input")
        balances.run_to_end(keyed_clock.stamp_stream(stream, shards=3), on_batch, f"{folder}/checkpoint")


def test_the_keyed_clock_goes_on_after_each_restart(spark, tmp_path):
    out = []
    drive(spark, tmp_path, [2, 5, 10], lambda batch, number: out.extend(batch.collect()))
    first = dt.date(2026, 10, 9)
    assert {r["event_id"]: r["batch_date"] for r in out if not r["control"]} == {k: v or first for k, v in expected().items()}
    moves = [r["batch_date"] for r in out if r["control"]]
    assert moves == [dt.date(2026, 10, 9), dt.date(2026, 10, 10), dt.date(2026, 10, 13)]


def test_closed_dates_are_published_once(spark, tmp_path):
    def lines(topic):
        def make(rows):
            return rows.where(F.col("topic") == topic).select("batch_date", "event_id", F.format_string("%s %d", F.lit(topic), "event_id").alias("value"))

        return make

    out = tmp_path / "files"
    sink = staged.ClosedDates(spark, str(tmp_path / "state"), str(out), {"transaction": lines("data"), "customer": lines("none")})
    again = []

    def twice(batch, number):
        batch = batch.persist()
        sink.on_batch(batch, number)
        names = {n: os.stat(out / n).st_mtime_ns for n in os.listdir(out)} if out.exists() else {}
        sink.on_batch(batch, number)
        again.append(names == ({n: os.stat(out / n).st_mtime_ns for n in os.listdir(out)} if out.exists() else {}))

    drive(spark, tmp_path, [5, 13], twice)
    assert all(again)
    want = {}
    for key, date in expected().items():
        want.setdefault(date or dt.date(2026, 10, 9), []).append(key)
    closed = [d for d in want if d < dt.date(2026, 10, 13)]
    assert sorted(n for n in os.listdir(out) if not n.startswith(".")) == sorted(f"{r}_{compact(d)}.dat" for r in ("transaction", "customer") for d in closed)
    for date in closed:
        found = spark.read.text(f"{out}/transaction_{compact(date)}.dat").collect()
        assert [r["value"] for r in found] == [f"data {k}" for k in sorted(want[date])]
        assert os.path.getsize(out / f"customer_{compact(date)}.dat") == 0


def test_a_date_half_published_is_finished(spark, tmp_path):
    make = lambda rows: rows.select("batch_date", "event_id", F.col("event_id").cast("string").alias("value"))
    sink = staged.ClosedDates(spark, str(tmp_path / "state"), str(tmp_path / "out"), {"account": make, "transaction": make})
    batch = spark.createDataFrame(
        [(1, dt.date(2026, 1, 1), False), (2, dt.date(2026, 1, 1), False), (3, dt.date(2026, 1, 2), True)], "event_id long, batch_date date, control boolean"
    )
    os.makedirs(tmp_path / "out")
    (tmp_path / "out" / "account_20260101.dat").write_text("as it was\n")
    sink.on_batch(batch, 0)
    assert (tmp_path / "out" / "account_20260101.dat").read_text() == "as it was\n"
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out" / "transaction_20260101.dat")).collect()] == ["1", "2"]
    assert files.names(spark, str(tmp_path / "state" / "published")) == ["2026-01-01"]


def test_staging_batches_may_be_run_again(spark, tmp_path):
    draw, latest = random.Random(7), {}
    schema = "batch_date date, account_id long, place long, amount long"
    sink = None
    for number in range(3):
        rows = [(dt.date(2026, 1, 1 + draw.randrange(2)), draw.randrange(9), draw.randrange(1000), draw.randrange(99)) for _ in range(30)]
        rows = [r for r in rows if r[2] not in {x[2] for x in latest.values()}]
        batch = spark.createDataFrame(rows, schema)
        sink = sink or staged.StagingStream(spark, str(tmp_path), batch.schema, ["account_id"], ["place", "amount"], buckets=4)
        for _ in range(2):
            sink.on_batch(batch, number)
        for r in rows:
            latest[r[:2]] = max(latest.get(r[:2], r), r, key=lambda x: x[2:])
    assert sorted(tuple(r) for r in sink.rows().collect()) == sorted(latest.values())


def posted(spark, *rows):
    return spark.createDataFrame(rows, TRANSACTION.schema)


def test_a_batch_reads_only_what_it_touches(spark, tmp_path):
    stream = balances.BalanceStream(spark, str(tmp_path), buckets=4, compact_every=2)
    for number in range(5):
        rows = [(100 * number + k, k % 10 + 1, "CR" if k % 3 else "DR", k) for k in range(1, 60)]
        if number:
            rows.append((100 * (number - 1) + 1, 2, "CR", 1))  # posted before
        stream.on_batch(posted(spark, *rows), number)
        stream.on_batch(posted(spark, *rows), number)
    total = {}
    for k in range(1, 60):
        total[k % 10 + 1] = total.get(k % 10 + 1, 0) + (k if k % 3 else -k)
    assert {r["account_id"]: r["balance"] for r in stream.balances().collect()} == {a: 5 * t for a, t in total.items()}
    assert stream._numbers("base") == [1, 3]
    kept, deltas = stream._moves(4)
    assert deltas.inputFiles() and all("batch=4" in f for f in deltas.inputFiles())
    near = balances.matching(kept, posted(spark, (1, 3, "CR", 1)), "account_id", 4)
    text = near._jdf.queryExecution().executedPlan().toString()
    assert "In(account_id" in text or "EqualTo(account_id" in text
    with pytest.raises(Exception, match="Conflicting transaction ID 1"):
        stream.on_batch(posted(spark, (1, 2, "CR", 7)), 5)
    with pytest.raises(OverflowError):
        stream.on_batch(posted(spark, (901, 1, "CR", 2**63 - 1), (902, 1, "CR", 2**63 - 1)), 5)
