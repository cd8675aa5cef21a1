"""One date at a time: posting, replays, merges, refusals, snapshots and the exported file."""

import datetime as dt

import pytest
from ledger_files import account_line, customer_line, relationship_line, transaction_line, write_files
from pyspark.sql import functions as F

from daybook.operators import rules
from daybook.plans.daily import BadInput, BatchRefused, BatchRejected, Ledger
from daybook.schemas import LAYOUTS

MAX = 2**63 - 1
DAY = [f"2026-10-{d:02}" for d in range(9, 16)]


def compact(day):
    return day.replace("-", "")


class Bank:
    """A ledger in a temporary folder and the files sent to it."""

    def __init__(self, spark, root):
        self.root = root
        self.ledger = Ledger(spark, str(root / "ledger"))

    def send(self, day, customer=(), account=(), relationship=(), transaction=()):
        folder = write_files(self.root / "input", compact(day), customer, account, relationship, transaction)
        return self.ledger.ingest(folder, day)

    def post(self, day, **records):
        self.send(day, **records)
        return self.ledger.process(day)

    def balances(self):
        return {r["account_id"]: r["balance"] for r in self.ledger.store.state("balance").collect()}

    def snapshot(self, day):
        rows = self.ledger.store.snapshots().where(F.col("batch_date") == F.lit(day)).collect()
        return {r["account_id"]: r["balance"] for r in rows}

    def statuses(self):
        return sorted((str(r["batch_date"]), r["status"]) for r in self.ledger.store.runs().collect())

    def export(self, day):
        with open(self.ledger.export(str(self.root / "output"), day), encoding="utf-8") as file:
            return file.read()


@pytest.fixture
def bank(spark, tmp_path):
    return Bank(spark, tmp_path)


BASE = dict(customer=[customer_line(1)], account=[account_line(2)], relationship=[relationship_line(2, 1)])


def test_posting_replays_upserts_and_snapshots(bank):
    first = dict(BASE, account=[account_line(2), account_line(3)])
    counts = bank.post(
        DAY[0], **first, transaction=[transaction_line(10, 2, "CR", 100), transaction_line(11, 2, "DR", 150)]
    )
    assert counts == {"customer": 1, "account": 2, "relationship": 1, "transaction": 2}
    assert bank.balances() == {2: -50, 3: 0} == bank.snapshot(DAY[0])
    assert bank.ledger.process(DAY[0]) == counts
    assert bank.statuses() == [(DAY[0], "COMPLETED")]
    with pytest.raises(BatchRefused, match="COMPLETED"):
        bank.send(DAY[0])

    # A replay, a net-zero pair, a new account and reference-only updates.
    counts = bank.post(
        DAY[1],
        customer=[customer_line(1, "Jo")],
        account=[account_line(3, kind="SAVINGS"), account_line(4)],
        relationship=[relationship_line(2, 1, "SECONDARY")],
        transaction=[
            transaction_line(10, 2, "CR", 100),
            transaction_line(12, 2, "CR", 20),
            transaction_line(13, 2, "DR", 20),
        ],
    )
    assert counts["transaction"] == 2
    assert bank.snapshot(DAY[1]) == {2: -50, 4: 0}
    state = bank.ledger.store.state
    assert [r["first_name"] for r in state("customer").collect()] == ["Jo"]
    assert {r["account_id"]: r["account_type"] for r in state("account").collect()}[3] == "SAVINGS"
    assert [r["type"] for r in state("relationship").collect()] == ["SECONDARY"]
    kept = state("customer").first()
    assert kept["created_at"] < kept["updated_at"]

    # An account closed by the batch, a harmless replay on it, and an empty next day.
    assert bank.post(
        DAY[2], account=[account_line(2, end="2027-01-01")], transaction=[transaction_line(10, 2, "CR", 100)]
    )["transaction"] == 0
    assert bank.snapshot(DAY[2]) == {}
    assert bank.post(DAY[3], account=[account_line(2)])["account"] == 1
    assert {r["account_id"]: r["end_date"] for r in state("account").collect()}[2] is None
    # A zero amount still counts as activity.
    bank.post(DAY[4], transaction=[transaction_line(14, 2, "CR", 0)])
    assert bank.snapshot(DAY[4]) == {2: -50}


def test_export_text_retry_and_conflict(bank, tmp_path):
    with pytest.raises(BatchRefused, match="no completed"):
        bank.export(DAY[0])
    bank.post(DAY[0], **dict(BASE, account=[account_line(2), account_line(1)]),
              transaction=[transaction_line(10, 1, "DR", 50)])
    expected = f"{1:>19}{-50:>20}\n{2:>19}{0:>20}\n"
    assert bank.export(DAY[0]) == expected == bank.export(DAY[0])
    bank.post(DAY[1], transaction=[transaction_line(11, 1, "CR", 200)])
    target = tmp_path / "output" / f"balance_{compact(DAY[0])}.dat"
    target.unlink()
    assert bank.export(DAY[0]) == expected
    target.write_text(expected.replace("50", "51"))
    (target.parent / f".{target.name}.crc").unlink()
    with pytest.raises(FileExistsError):
        bank.export(DAY[0])
    assert bank.balances()[1] == 150
    bank.post(DAY[2])
    assert bank.export(DAY[2]) == ""


def test_extremes(bank):
    bank.post(
        DAY[0],
        customer=[customer_line(1)],
        account=[account_line(2), account_line(MAX)],
        transaction=[
            transaction_line(10, 2, "DR", MAX),
            transaction_line(11, 2, "DR", 1),
            transaction_line(12, MAX, "CR", MAX),
            transaction_line(13, MAX, "CR", MAX),
            transaction_line(14, MAX, "DR", MAX),
        ],
    )
    assert bank.export(DAY[0]) == f"{2:>19}{-(2**63):>20}\n{MAX:>19}{MAX:>20}\n"
    bank.send(DAY[1], transaction=[transaction_line(15, MAX, "CR", 1)])
    with pytest.raises(BatchRejected, match="out of range"):
        bank.ledger.process(DAY[1])
    assert bank.balances() == {2: -(2**63), MAX: MAX}


def test_every_rule_is_reported_in_order(bank):
    """One batch that breaks every rule a batch can break on an empty ledger."""
    bank.send(
        DAY[0],
        customer=[customer_line(1)] * 2,
        account=[
            account_line(2), account_line(2), account_line(3, end="2025-01-01"), account_line(4, "2027-01-01"),
            account_line(5, end="2027-01-01"), account_line(6),
        ],
        relationship=[relationship_line(2, 1), relationship_line(2, 1), relationship_line(2, 999),
                      relationship_line(999, 1)],
        transaction=[
            transaction_line(10, 2, "CR", 10), transaction_line(10, 2, "CR", 10), transaction_line(11, 999, "CR", 1),
            transaction_line(12, 4, "CR", 1), transaction_line(13, 5, "CR", 1), transaction_line(14, 6, "DR", MAX),
            transaction_line(15, 6, "DR", 2),
        ],
    )
    day = dt.date.fromisoformat(DAY[0])
    store = bank.ledger.store
    staged = rules.Staged(day, **{record: store.staged(record, day) for record in LAYOUTS})
    found = rules.violations(staged, bank.ledger._state()).orderBy("rule_rank", "source_line").collect()
    compact_day = compact(DAY[0])
    assert [(r["rule"], r["source_line"], r["key"]) for r in found] == [
        ("duplicate_customer", 1, "1"),
        ("duplicate_account", 1, "2"),
        ("duplicate_relationship", 1, "2,1"),
        ("duplicate_transaction", 1, "10"),
        ("account_dates", 3, "3"),
        ("missing_account_relationship", 4, "999"),
        ("missing_account_transaction", 3, "999"),
        ("missing_customer", 3, "999"),
        ("ineligible_transaction", 4, "12"),
        ("ineligible_transaction", 5, "13"),
        ("balance_overflow", 0, "6"),
        ("missing_balance", 3, "999"),
    ]
    messages = {r["rule"]: r["message"] for r in found}
    assert messages["duplicate_transaction"] == "Duplicate transaction business key; first source line 1"
    assert messages["missing_customer"] == f"Missing customer at relationship_{compact_day}.dat:3"
    with pytest.raises(BatchRejected, match="Duplicate customer"):
        bank.ledger.process(DAY[0])


def test_rejections_apply_nothing(bank):
    one = [transaction_line(10, 2, "CR", 10)]
    bank.send(DAY[0], **dict(BASE, account=[account_line(2, end="2027-01-01")], transaction=one))
    with pytest.raises(BatchRejected, match=f"Ineligible transaction at transaction_{compact(DAY[0])}.dat:1"):
        bank.ledger.process(DAY[0])
    store = bank.ledger.store
    assert store.state("account").count() == store.state("customer").count() == store.ledger().count() == 0
    failed = store.runs().collect()
    assert [(r["status"], r["customer_count"]) for r in failed] == [("FAILED", 0)] and failed[0]["error_message"]

    # Corrected and retried; then a conflicting replay on the next date.
    bank.post(DAY[0], **BASE, transaction=one)
    bank.send(DAY[1], account=[account_line(3)], transaction=[transaction_line(10, 2, "DR", 10)])
    with pytest.raises(BatchRejected, match="Conflicting transaction ID"):
        bank.ledger.process(DAY[1])
    assert bank.balances() == {2: 10}
    with pytest.raises(BatchRefused, match="blocked_by_earlier"):
        bank.ledger.run(str(bank.root / "input"), str(bank.root / "output"), DAY[2])


def test_admission_and_ingest_faults(bank, tmp_path):
    with pytest.raises(BatchRefused, match="not_ingested"):
        bank.ledger.process(DAY[1])
    with pytest.raises(BadInput, match="missing input file"):
        bank.ledger.ingest(str(tmp_path / "nowhere"), DAY[1])
    assert bank.statuses() == []
    bank.send(DAY[1], **BASE, transaction=[transaction_line(10, 2, "CR", 5)])
    # A bad file keeps the earlier load; an empty one replaces it.
    good = [transaction_line(i, 2, "CR", 20) for i in range(1, 502)]
    with pytest.raises(BadInput, match="transaction_20261010.dat:502: record_length"):
        bank.send(DAY[1], transaction=[*good, "bad"])
    day = dt.date.fromisoformat(DAY[1])
    assert {r: bank.ledger.store.staged(r, day).count() for r in ("customer", "transaction")} == {
        "customer": 1, "transaction": 1}
    bank.send(DAY[1], **BASE)
    assert bank.ledger.store.staged("transaction", day).count() == 0
    counts = bank.ledger.run(str(bank.root / "input"), str(bank.root / "output"), DAY[1])
    assert counts["transaction"] == 0
    assert bank.ledger.run(str(bank.root / "input"), str(bank.root / "output"), DAY[1]) == counts
    bank.send(DAY[0])
    with pytest.raises(BatchRefused, match="out_of_order"):
        bank.ledger.process(DAY[0])
    bank.ledger.store.append(dict(kind="run", batch_date=DAY[3], batch_run_id="lost", status="RUNNING"))
    bank.send(DAY[2])
    with pytest.raises(BatchRefused, match="blocked_running"):
        bank.ledger.process(DAY[2])
    with pytest.raises(BatchRefused, match="RUNNING"):
        bank.send(DAY[3])


def test_failed_attempt_leaves_no_rows(bank, monkeypatch):
    from daybook.operators import posting

    real = posting.balance_snapshot
    monkeypatch.setattr(posting, "balance_snapshot", lambda members, balances: real(members, balances).limit(0))
    bank.send(DAY[0], **BASE, transaction=[transaction_line(10, 2, "CR", 5)])
    with pytest.raises(BatchRejected, match="Missing balance for output account"):
        bank.ledger.process(DAY[0])
    store = bank.ledger.store
    assert store.ledger().count() == store.snapshots().count() == store.state("account").count() == 0
    monkeypatch.undo()
    bank.ledger.process(DAY[0])
    assert store.ledger().count() == 1 and bank.snapshot(DAY[0]) == {2: 5}
    assert [s for _, s in bank.statuses()] == ["COMPLETED", "FAILED"]


def run(bank, day):
    return bank.ledger.run(str(bank.root / "input"), str(bank.root / "output"), day)


def test_an_earlier_launch_that_failed_blocks_until_it_is_repeated(bank):
    def files(day, **records):
        write_files(bank.root / "input", compact(day), **records)

    files(DAY[1], **BASE, transaction=["bad"])
    files(DAY[2], customer=[customer_line(5)])
    with pytest.raises(BadInput, match="record_length"):
        run(bank, DAY[1])
    with pytest.raises(BatchRefused, match="blocked_by_earlier"):
        run(bank, DAY[2])
    files(DAY[1], **BASE, transaction=[transaction_line(1, 2, "CR", 5)])
    assert run(bank, DAY[1])["transaction"] == 1 and run(bank, DAY[2])["customer"] == 1
    with pytest.raises(BatchRefused, match="missing_input"):
        run(bank, DAY[3])
    files(DAY[4])
    with pytest.raises(BatchRefused, match="blocked_by_earlier"):
        run(bank, DAY[4])
    files(DAY[3])
    run(bank, DAY[3]), run(bank, DAY[4])


def test_a_failed_export_blocks_and_is_repeated_alone(bank):
    write_files(bank.root / "input", compact(DAY[1]), **BASE)
    write_files(bank.root / "input", compact(DAY[2]))
    other = bank.root / "output" / f"balance_{compact(DAY[1])}.dat"
    other.parent.mkdir()
    other.write_text("something else\n")
    with pytest.raises(FileExistsError):
        run(bank, DAY[1])
    with pytest.raises(BatchRefused, match="blocked_by_earlier"):
        run(bank, DAY[2])
    other.unlink()
    run(bank, DAY[1]), run(bank, DAY[2])
    assert bank.statuses() == [(DAY[1], "COMPLETED"), (DAY[2], "COMPLETED")]


def test_the_form_of_the_balance_file_is_the_callers_choice(bank):
    bank.post(DAY[1], **BASE, transaction=[transaction_line(1, 2, "CR", 5)])
    whole = bank.export(DAY[1])
    target = bank.ledger.export(str(bank.root / "parts"), DAY[1], as_parts=True)
    parts = sorted((bank.root / "parts" / target.rsplit("/", 1)[1]).glob("part-*"))
    assert "".join(p.read_text() for p in parts) == whole


def test_a_failure_keeps_its_whole_message(bank, monkeypatch):
    bank.send(DAY[1], **BASE)
    monkeypatch.setattr(rules, "violations", lambda *_: (_ for _ in ()).throw(RuntimeError("x" * 5000)))
    with pytest.raises(RuntimeError):
        bank.ledger.process(DAY[1])
    assert [len(r["error_message"]) for r in bank.ledger.store.runs().collect()] == [5000]


def test_an_empty_value_list_is_an_error(spark, tmp_path):
    from daybook.sources.values import read_values

    path = tmp_path / "names.txt"
    path.write_text("# none\n\n")
    with pytest.raises(ValueError, match="without values"):
        read_values(spark, str(path), 10)
    path.write_text("# one\nAnn\n")
    assert [r["value"] for r in read_values(spark, str(path), 10).collect()] == ["Ann"]
