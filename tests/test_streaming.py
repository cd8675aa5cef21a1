"""The business-date clock, redelivery, and continuous posting, in micro-batches and against their bounded forms."""

import datetime as dt

import pytest

from daybook.schemas import TRANSACTION
from daybook.streaming import balances, clock

SCHEMA = (
    "event_id long, ts timestamp, topic string, part long, off long, account_id long, control_date date, amount long"
)


def arrivals():
    start = dt.datetime(2026, 10, 8, 12)
    controls = {3: dt.date(2026, 10, 8), 6: dt.date(2026, 10, 8), 9: dt.date(2026, 10, 9), 12: dt.date(2026, 10, 7),
                15: dt.date(2026, 10, 12)}
    rows = []
    for i in range(20):
        ts = start + dt.timedelta(hours=5 * i)
        rows.append((i, ts, "control" if i in controls else "data", 0, i, 1 + i % 3, controls.get(i), i))
    return rows


def expected():
    active, out = None, {}
    for event_id, _, _, _, _, _, control, _ in arrivals():
        if control:
            day = control + dt.timedelta(days=1)
            active = day if active is None or day > active else active
        else:
            out[event_id] = active
    return out


def test_bounded_clock(spark):
    rows = spark.createDataFrame(arrivals(), SCHEMA)
    data, controls = rows.where("control_date is null"), rows.where("control_date is not null")
    stamped = clock.assign_business_dates(data, controls.select("control_date", "ts", "event_id"))
    assert {r["event_id"]: r["batch_date"] for r in stamped.collect()} == expected()
    closed = clock.closed_dates(stamped, controls)
    assert {str(r["batch_date"]) for r in closed.collect()} == {"2026-10-09", "2026-10-10"}


@pytest.mark.parametrize("cuts", [[2, 5, 10], [4, 16]])
def test_clock_stream_equals_bounded(spark, tmp_path, cuts):
    rows = arrivals()
    edges = [0, *cuts, len(rows)]
    stream = clock.ClockStream(spark, str(tmp_path))
    for number, (a, b) in enumerate(zip(edges, edges[1:])):
        batch = spark.createDataFrame(rows[a:b], SCHEMA)
        stream.on_batch(batch, number)
        if number == 1:
            stream.on_batch(batch, number)  # run again after a failure
    want = expected()
    first = dt.date(2026, 10, 9)
    assert {r["event_id"]: r["batch_date"] for r in stream.stamped().collect()} == {
        k: v or first for k, v in want.items()
    }
    assert stream.stamped().count() == len(want)


def test_redelivered_records_are_dropped(spark, tmp_path):
    rows = [r for r in arrivals() if r[6] is None]
    for n, part in enumerate((rows[:8], rows[4:])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = []
    balances.run_to_end(
        clock.dedup_stream(source), lambda df, n: seen.extend(r["off"] for r in df.collect()), str(tmp_path / "ckpt")
    )
    assert sorted(seen) == [r[4] for r in rows]


def test_balance_stream_is_idempotent_and_refuses_conflicts(spark, tmp_path):
    def frame(*rows):
        return spark.createDataFrame(list(rows), TRANSACTION.schema)

    stream = balances.BalanceStream(spark, str(tmp_path))
    one = frame((1, 7, "CR", 100), (2, 8, "DR", 30), (2, 8, "DR", 30))
    stream.on_batch(one, 0)
    stream.on_batch(frame((1, 7, "CR", 100), (3, 7, "DR", 150), (4, 9, "CR", 0)), 1)
    stream.on_batch(frame((1, 7, "CR", 100), (3, 7, "DR", 150), (4, 9, "CR", 0)), 1)
    assert {r["account_id"]: r["balance"] for r in stream.balances().collect()} == {7: -50, 8: -30, 9: 0}
    with pytest.raises(Exception, match="Conflicting transaction ID 1"):
        stream.on_batch(frame((1, 7, "CR", 101)), 2)
    with pytest.raises(Exception, match="Duplicate transaction"):
        stream.on_batch(frame((5, 7, "CR", 1), (5, 7, "CR", 2)), 2)
    assert {r["account_id"]: r["balance"] for r in stream.balances(1).collect()}[7] == -50
