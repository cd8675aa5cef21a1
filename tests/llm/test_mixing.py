import random

import pytest
import xxhash

from daybook.llm import mixing


def brute_targets(sizes):
    """Reshare what exceeds twice a source's size until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while left > 1e-9 and free:
        share = left / sum(weight[s] for s in free)
        left = 0.0
        for s in sorted(free, key=str):
            target[s] += share * weight[s]
        for s in list(free):
            if target[s] > 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    return target


def some_documents(n=400):
    draw = random.Random(4)
    names = ["a", "b", "c", "Z", "é", None]
    return [(i, "w " * draw.randrange(0, 60), "en", names[min(draw.randrange(9), 5)]) for i in range(n)]


def test_targets_equal_resharing_and_sources_come_near_them(documents):
    rows = some_documents()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    wanted = brute_targets(sizes)
    source_of = {i: s for i, _, _, s in rows}
    taken = dict.fromkeys(sizes, 0)
    found = mixing.mix(documents(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        source = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(wanted[source])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    for source in sizes:
        assert taken[source] == pytest.approx(wanted[source], rel=0.02)


def test_taken_equals_the_schedule_walked_slot_by_slot(documents, monkeypatch):
    monkeypatch.setattr(mixing, "MIN_SLOTS", 64)
    monkeypatch.setattr(mixing, "SLOTS_PER_DOC", 1)
    monkeypatch.setattr(mixing, "RUN", 8)
    monkeypatch.setattr(mixing, "BUCKET", 16)
    rows = some_documents(100)
    docs = documents(rows)
    sources = {r["source"]: r for r in mixing.targets(mixing.sized(docs)).collect()}
    mix = max(r["mix"] for r in sources.values())
    block = max(1, -int(-mix // max(64, len(rows))))
    turns = {}
    rank = dict.fromkeys(sources, 0)
    for slot in range(-int(-mix // block)):
        point = slot * mixing.GOLDEN % (1 << 32)
        for name, r in sources.items():
            if r["low"] <= point < r["high"]:
                n_blocks = -(-r["source_size"] // block)
                if rank[name] < 2 * n_blocks:
                    at = name, rank[name] % n_blocks
                    turns[at] = turns.get(at, 0) + 1
                rank[name] += 1
    sized = mixing.sized(docs).collect()
    unsigned = lambda r: r["place"] % (1 << 64)
    expected = {}
    for name, source in sources.items():
        n_buckets = -(-source["docs"] // 16)
        mine = [r for r in sized if r["source"] == name]
        mine.sort(key=lambda r: (int((unsigned(r) >> 11) / 2**53 * n_buckets), r["place"], r["doc_id"], r["size"]))
        begin = 0
        for r in mine:
            expected[r["doc_id"]] = sum(turns.get((name, w // block), 0) for w in range(begin, begin + r["size"]))
            begin += r["size"]
    assert {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()} == expected


def test_small_sources_reach_their_targets(documents):
    """A long tail of sources, each below or about a block of the mix (21 words), beside large ones."""
    draw = random.Random(5)
    sizes = [1, 3, 20, 22, 23, 30, 43, 50, 100, 700, 2500, 6000, *[draw.randrange(1, 200) for _ in range(60)]]
    rows = [(i, "w " * 600, "en", "abc"[i % 3]) for i in range(1500)]
    for k, words in enumerate(sizes):
        parts = [words // 3, words // 3, words - 2 * (words // 3)]
        rows += [(10_000 + 10 * k + i, "w " * part, "en", f"host{k:03}") for i, part in enumerate(parts)]
    source_of = {i: s for i, _, _, s in rows}
    taken, wanted = {}, {}
    found = mixing.mix(documents(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        source = source_of[r["doc_id"]]
        taken[source] = taken.get(source, 0) + r["taken"]
        wanted[source] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert len(wanted) == len(sizes) + 3
    for source in wanted:
        assert abs(taken[source] - wanted[source]) <= max(0.5, 0.01 * wanted[source]), source


def test_a_target_below_a_block_is_met_among_many_like_it(documents):
    """Every third source stays below its limit, where its weight decides and the target ends inside a document."""
    rows = [(10 * k + i, "w " * 400, "en", f"s{k:04}") for k in range(300) for i in range(2 if k % 3 != 1 else 5)]
    source_of = {i: s for i, _, _, s in rows}
    taken, wanted = {}, {}
    for r in mixing.mix(documents(rows)).collect():
        source = source_of[r["doc_id"]]
        taken[source] = taken.get(source, 0) + r["taken"]
        wanted[source] = r["target"]
    assert any(t % 400 for t in wanted.values())
    for source in wanted:
        assert abs(taken[source] - wanted[source]) <= 0.5, source


def test_words_of_a_small_source_are_taken_in_turn(spark):
    from pyspark.sql import functions as F

    rows = [(at, slots, size) for size in (1, 7, 10) for slots in range(2 * size + 1) for at in range(size + 1)]
    table = spark.createDataFrame(rows, "at long, slots long, source_size long")
    got = table.select("*", mixing.words_taken(F.col("at"), F.col("slots")).alias("words")).collect()
    for r in got:
        assert r["words"] == sum(slot % r["source_size"] < r["at"] for slot in range(r["slots"]))


def test_points_are_multiples_of_the_golden_ratio(spark):
    from pyspark.sql import functions as F

    values = [0, 1, 2, 65535, 65536, 123456789, (1 << 31) + 5, (1 << 40) + 77]
    got = spark.createDataFrame([(v,) for v in values], "i long").select(mixing.point(F.col("i"))).collect()
    assert [r[0] for r in got] == [v * mixing.GOLDEN % (1 << 32) for v in values]


def test_reruns_agree_and_odd_rows_have_sizes(odd, empty, documents):
    first, second = (sorted(map(str, mixing.mix(odd).drop("place").collect())) for _ in range(2))
    assert first == second and len(first) == odd.count()
    by_key = {r["doc_id"]: r for r in mixing.mix(odd).collect()}
    assert by_key[1]["size"] == by_key[2]["size"] == by_key[3]["size"] == 0 == by_key[3]["taken"]
    assert by_key[4]["size"] == 30_000
    assert mixing.mix(empty).count() == 0
    blank = mixing.mix(documents([(1, None), (2, " ")])).collect()
    assert {(r["target"], r["taken"]) for r in blank} == {(0.0, 0)}


def test_repeated_documents_keep_their_columns(documents, odd):
    docs = documents(some_documents())
    times = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in mixing.mix(docs).collect() if r["size"]}
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    counts = {}
    for r in out.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert counts == {k: n for k, n in times.items() if n}
    assert mixing.repeated(odd).columns == odd.columns


def test_the_shuffle_is_a_hash_of_key_and_text(documents):
    row = mixing.sized(documents([(7, "a b")])).first()
    inner = xxhash.xxh64_intdigest((7).to_bytes(8, "little"), 42)
    assert row["place"] % (1 << 64) == xxhash.xxh64_intdigest(b"a b", inner)
