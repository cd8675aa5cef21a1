import random
import re

import xxhash
from pyspark.sql import functions as F

from daybook.llm import simhash
from daybook.llm.graph import components


def brute_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return prints, group


def near_copies():
    draw = random.Random(3)
    rows = []
    for base in range(12):
        words = [f"w{draw.randrange(500)}" for _ in range(150)]
        for copy in range(4):
            changed = list(words)
            if copy:
                changed[draw.randrange(150)] = f"c{copy}"
            rows.append((len(rows), " ".join(changed).upper() if base % 2 else " ".join(changed)))
    return rows


def test_fingerprints_and_groups_equal_brute_force(documents):
    rows = [*near_copies(), (100, "A b"), (101, "a  B"), (102, ""), (103, None), (104, "ÀB c"), (105, "Àb C")]
    prints, group = brute_groups(rows)
    found = {r["doc_id"]: r for r in simhash.near_duplicates(documents(rows)).collect()}
    assert len(found) == len(rows)
    for i, (key, _) in enumerate(rows):
        assert found[key]["fp"] % (1 << 64) == prints[i]
        assert found[key]["component_id"] == min(k for (k, _), g in zip(rows, group, strict=True) if g == group[i])


def test_odd_rows_keep_a_row_each_and_blank_texts_are_linked(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] == 5} == {5}
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each_group_stays_with_its_columns(odd, empty, documents):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 8]
    assert simhash.keep_one(empty).count() == 0
    nameless = documents([(None, "a b c d"), (None, "a b c d"), (None, "x y z x y"), (7, "q r s t")])
    assert sorted(str(r["text"]) for r in simhash.keep_one(nameless).collect()) == ["a b c d", "q r s t", "x y z x y"]


def test_links_cover_every_pair_within_the_radius(spark):
    draw = random.Random(5)
    base = [draw.getrandbits(64) for _ in range(20)]
    prints = {b ^ sum(1 << x for x in draw.sample(range(64), k)) for b in base for k in (0, 1, 1, 2, 3)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    group = {p: p for p in signed}
    for row in simhash.links(frame).collect():
        assert ((row["a"] ^ row["b"]) % (1 << 64)).bit_count() <= 2
        old, new = group[row["a"]], group[row["b"]]
        group = {p: new if g == old else g for p, g in group.items()}
    for p in signed:
        for q in signed:
            if ((p ^ q) % (1 << 64)).bit_count() <= 2:
                assert group[p] == group[q]


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(40)]
    found = components(spark.createDataFrame([*path, *star, (5, 5)], "a long, b long"))
    roots = {r["node"]: r["root"] for r in found.collect()}
    assert len(roots) == 61 + 41
    assert len({roots[i] for i in range(61)}) == 1 and len({roots[i] for i in range(1000, 1041)}) == 1
    assert roots[0] != roots[1000]
    assert components(spark.createDataFrame([], "a long, b long")).agg(F.count("*")).first()[0] == 0
