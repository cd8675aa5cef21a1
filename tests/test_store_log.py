"""The store's log: read by increment, joined to checkpoints."""

import datetime as dt

from daybook.plans import store as stores
from daybook.plans.store import Store
from daybook.sources import files


def dates(store):
    return [(e["number"], str(e["batch_date"]), dict(e["paths"] or {})) for e in store.entries()]


def test_an_entry_costs_one_file_however_long_the_log(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "ENTRIES_APART", 4)
    reads = []
    plain = Store._events_of
    monkeypatch.setattr(Store, "_events_of", lambda self, paths: reads.append(paths) or plain(self, paths))
    store, other = Store(spark, str(tmp_path), buckets=2), None
    start, expected = dt.date(2026, 1, 1), []
    for n in range(10):
        date = start + dt.timedelta(days=n)
        event = dict(kind="ingested", batch_date=date, paths={"customer": f"p{n}"})
        store.append(event, dict(kind="exported", batch_date=date))
        expected += [(2 * n + 1, str(date), {"customer": f"p{n}"}), (2 * n + 2, str(date), {})]
        assert dates(store) == expected
    assert all(len(paths) == 1 for paths in reads)
    assert files.names(spark, f"{tmp_path}/checkpoints") == ["000000000007.json", "000000000015.json"]
    reads.clear()
    other = Store(spark, str(tmp_path))
    assert dates(other) == expected and other.entries() == store.entries()
    assert [len(p) for p in reads] == [1, 2] and "checkpoints" in reads[0][0]
    other.append(dict(kind="exported", batch_date=start))
    assert dates(store) == dates(other) and len(dates(store)) == 21
