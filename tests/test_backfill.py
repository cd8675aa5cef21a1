"""Posting many dates in one plan gives what posting them one after the other gives."""

import datetime as dt
import random

import pytest
from ledger_files import account_line, customer_line, relationship_line, transaction_line, write_files

from daybook.plans import backfill
from daybook.plans.daily import BadInput, BatchRefused, BatchRejected, Ledger
from daybook.schemas import LAYOUTS

DAYS = [f"2026-10-{d:02}" for d in range(10, 15)]


def make_days(folder, seed):
    """Five dates with new and closed accounts, replays and, on the fourth, a conflicting replay."""
    draw = random.Random(seed)
    sent, accounts, next_id = [], [], 100
    for n, day in enumerate(DAYS):
        new = [n * 3 + k + 1 for k in range(3)]
        records = dict(
            customer=[customer_line(i, f"N{n}") for i in new] + ([customer_line(1, f"U{n}")] if n == 1 else []),
            account=[account_line(i, "2026-10-10" if n == 0 else day) for i in new]
            + ([account_line(2, "2026-10-10", day)] if n == 2 else []),
            relationship=[relationship_line(i, i) for i in new] + ([relationship_line(1, 1, "SECONDARY")] if n == 1 else []),
        )
        accounts += new
        lines = []
        for _ in range(8):
            account = draw.choice([a for a in accounts if a != 2])
            sent.append((next_id, account, draw.choice(["CR", "DR"]), draw.randint(0, 500)))
            lines.append(transaction_line(*sent[-1]))
            next_id += 1
        if n:
            lines += [transaction_line(*t) for t in draw.sample(sent[:-8], 3)]
        if n == 3:
            lines.append(transaction_line(sent[0][0], sent[0][1], sent[0][2], sent[0][3] + 1))
        write_files(folder, day.replace("-", ""), transaction=lines, **records)
    return str(folder)


def contents(ledger):
    store = ledger.store
    tables = {
        name: store.state(name).drop("created_at", "updated_at")
        for name in ("customer", "account", "relationship", "balance")
    }
    tables["ledger"] = store.ledger().drop("batch_run_id")
    tables["snapshot"] = store.snapshots().drop("batch_run_id")
    tables["runs"] = store.runs().drop("batch_run_id", "started_at", "completed_at", "error_message")
    tables |= {
        f"staged {record} {day}": store.staged(record, dt.date.fromisoformat(day)) for record in LAYOUTS for day in DAYS
    }
    tables["receipts"] = store.receipts().select("batch_date").distinct()
    tables["headers"] = store.snapshot_headers().drop("batch_run_id")
    return {name: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr) for name, df in tables.items()}


def test_backfill_equals_a_loop(spark, tmp_path):
    folder = make_days(tmp_path / "input", 7)
    loop = Ledger(spark, str(tmp_path / "loop"))
    posted = []
    for day in DAYS:
        try:
            loop.ingest(folder, day)
            loop.process(day)
            posted.append(day)
        except BatchRejected:
            break
    assert posted == DAYS[:3]

    at_once = Ledger(spark, str(tmp_path / "at-once"))
    assert [str(d) for d in at_once.backfill(folder, DAYS)] == posted
    assert contents(at_once) == contents(loop)

    # On top of published state: the first date by itself, the rest in one plan.
    mixed = Ledger(spark, str(tmp_path / "mixed"))
    for day in DAYS[:1]:
        mixed.ingest(folder, day)
        mixed.process(day)
    assert [str(d) for d in mixed.backfill(folder, DAYS[1:])] == posted[1:]
    assert contents(mixed) == contents(loop)


def test_backfill_stops_at_bad_and_missing_input(spark, tmp_path):
    folder = make_days(tmp_path / "input", 11)
    (tmp_path / "input" / "transaction_20261012.dat").write_text("bad\n")
    (tmp_path / "input" / "account_20261013.dat").unlink()
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert [str(d) for d in ledger.backfill(folder, DAYS)] == DAYS[:2]
    assert [r["status"] for r in ledger.store.runs().collect()] == ["COMPLETED"] * 2
    assert DAYS[2] not in [str(r["batch_date"]) for r in ledger.store.receipts().collect()]
    with pytest.raises(BatchRefused, match="blocked_by_earlier"):
        ledger.run(folder, str(tmp_path / "output"), DAYS[4])
    with pytest.raises(BatchRefused, match="blocked_by_earlier"):
        ledger.backfill(folder, DAYS[3:])
    try:
        ledger.ingest(folder, DAYS[2])
        raise AssertionError("a bad line was staged")
    except BadInput as fault:
        assert "transaction_20261012.dat:1: record_length" in str(fault)


def test_the_first_date_there_is_has_a_snapshot(spark):
    first = dt.date(1, 1, 1)
    postings = spark.createDataFrame(
        [(1, 7, "CR", 5, first), (2, 7, "DR", 2, dt.date(2026, 1, 1))],
        "transaction_id long, account_id long, type string, amount long, batch_date date",
    )
    accounts = spark.createDataFrame([(7, first)], "account_id long, batch_date date")
    opening = spark.createDataFrame([(7, 100)], "account_id long, balance long")
    rows = backfill.snapshots_all_dates(postings, accounts, opening).collect()
    assert sorted((r["batch_date"], r["balance"]) for r in rows) == [(first, 105), (dt.date(2026, 1, 1), 103)]
