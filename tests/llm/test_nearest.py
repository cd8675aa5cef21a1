import numpy as np
from pyspark.sql import functions as F

from daybook.llm import nearest


def brute(rows, query, top=10):
    vectors = np.array([v for _, v in rows], dtype=np.float64)
    keys = np.array([k for k, _ in rows])
    own = vectors[keys == query][0]
    distance = np.sqrt(((vectors - own) ** 2).sum(1))
    order = [i for i in np.lexsort((keys, distance)) if keys[i] != query][:top]
    return [(int(keys[i]), float(distance[i])) for i in order]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, key string, cell string")


def of(rows):
    return [(k, [float(np.float32(x)) for x in v], "x", "x") for k, v in rows]


def test_recall_scores_and_order(spark):
    draw = np.random.default_rng(0)
    centres = draw.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.3 * draw.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    found = nearest.search(frame(spark, of(rows)), F.col("vec_id") % 100 == 0).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for query in range(0, 3000, 100):
        got = sorted(by_query[query])
        assert [g[0] for g in got] == list(range(1, 11))
        assert [g[2] for g in got] == sorted(g[2] for g in got)
        true = dict(brute(rows, query))
        hits += len(true.keys() & {g[1] for g in got})
    assert hits / 300 >= 0.9


def test_a_frequent_vector_ties_to_smaller_keys(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 32)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(300)] + [(300 + i, [float(i), 1.0, 0.0, -1.0]) for i in range(300)]
    found = nearest.search(frame(spark, of(rows)), F.col("vec_id") == 100).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(i, 0.0) for i in range(10)]


def test_what_takes_no_part_and_few_candidates(spark):
    good = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])]
    nan, inf = float("nan"), float("inf")
    bad = [(10, None), (11, [0.0, 0.0]), (12, [nan, 1.0]), (13, [inf, 1.0]), (14, [None, 1.0]), (15, []), (16, [1.0] * 3), (None, [1.0, 0.5])]
    rows = of(good) + [(k, v, "x", "x") for k, v in bad]
    found = nearest.search(frame(spark, rows), F.lit(True)).collect()
    assert {r["query_id"] for r in found} == {0, 1, 2} == {r["vec_id"] for r in found}
    assert sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == 0) == [(1, 2), (2, 2), (3, 1)]
    assert nearest.search(frame(spark, []), F.lit(True)).count() == 0
    single = nearest.search(frame(spark, of([(1, [2.0]), (2, [5.0])])), F.lit(True)).collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in sorted(single)] == [(1, 2, 3.0), (2, 1, 3.0)]


def test_cells_come_in_order_of_summed_distance():
    draw = np.random.default_rng(1)
    a, b = draw.random(7), draw.random(5)
    index = nearest.Index(np.zeros((7, 1)), np.zeros((5, 1)), np.ones(35, dtype=np.int64))
    order = list(index.traverse(a, b))
    sums = [a[c // 5] + b[c % 5] for c in order]
    assert sorted(order) == list(range(35)) and sums == sorted(sums)
