import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from daybook.llm import exact_dedup


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for key, text, *_ in rows:
        groups[lowered(text)].append(key)
    out = []
    for key, text, *_ in rows:
        members = groups[lowered(text)]
        keep = max((k for k in members if k is not None), default=None)
        digest = hashlib.sha256(lowered(text).encode()).hexdigest()
        out.append((key, keep if len(members) > 1 else key, len(members), digest))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect()), key=repr)


ROWS = [(i, ["Copy of ONE", "copy of one", "É stays", "é stays", "ÉA", "Éa", f"own {i}"][i % 7]) for i in range(80)]


def one_stays(df):
    kept = df.where("kept").groupBy("text_sha256").count().collect()
    assert all(r["count"] == 1 for r in kept)
    assert len(kept) == df.select("text_sha256").distinct().count()


def test_equals_brute_force(documents):
    df = exact_dedup.dedup(documents(ROWS))
    assert found(df) == brute(ROWS)
    one_stays(df)
    assert df.where("kept AND NOT doc_id <=> keep_id").isEmpty()


@pytest.mark.parametrize("sent", [0, 1 << 20])
@pytest.mark.parametrize(
    "hashed", [lambda t: F.shiftleft(F.length(t).cast("long"), 58), lambda t: F.lit(7).cast("long"), lambda t: -F.xxhash64(t)]
)
def test_collisions_are_told_apart_by_their_bytes(documents, hashed, sent):
    df = exact_dedup.dedup(documents(ROWS), hashed, capacity=2, owned=3, sent=sent)
    assert found(df) == brute(ROWS)
    one_stays(df)


def test_buckets_split_until_they_fit(spark):
    chains = spark.range(300).select(F.shiftleft("id", 42).alias("h"), F.lit(1).alias("n"))
    buckets, depths = exact_dedup.directory(chains, 300, 16)
    assert depths[0] == 5 and depths[-1] == 18  # crowded hashes: the directory doubles until they come apart
    held = exact_dedup.looked_up(chains, buckets, depths).collect()
    assert sorted(r["h"] for r in held) == [i << 42 for i in range(300)]
    sizes = defaultdict(int)
    for r in held:
        sizes[r["bucket"]] += 1
        assert (r["h"] - r["bucket"]) >> (64 - r["depth"]) == 0
    assert max(sizes.values()) <= 16


def test_owners_write_key_ranges_that_do_not_overlap(spark):
    chains = spark.range(5000).select(F.xxhash64("id").alias("h"), F.lit(1).alias("n"))
    written = exact_dedup.index(chains, capacity=64, owned=500)
    ranges = written.groupBy(F.input_file_name().alias("f")).agg(F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    ranges = sorted((r["a"], r["b"]) for r in ranges.collect())
    assert len(ranges) > 5 and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:], strict=False))
    assert written.count() == 5000


def test_defined_cases(odd, empty):
    df = exact_dedup.dedup(odd)
    rows = df.collect()
    assert len(rows) == 9 and exact_dedup.dedup(empty).count() == 0
    one_stays(df)
    blank = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert sorted((r["doc_id"] or 0, r["keep_id"], r["kept"]) for r in blank) == [(0, 2, False), (1, 2, False), (2, 2, True)]
    same = [r for r in rows if r["keep_id"] == 5]
    assert len(same) == 3 and sum(r["kept"] for r in same) == 1 and {r["group_size"] for r in same} == {3}


def test_a_group_without_keys_keeps_one(documents):
    rows = exact_dedup.dedup(documents([(None, "x"), (None, "X"), (None, "y")])).collect()
    assert sorted((r["group_size"], r["kept"], r["keep_id"]) for r in rows) == [(1, True, None), (2, False, None), (2, True, None)]
