import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import hard_negatives

FIELDS = "vec_id long, embedding array<double>, label int, row string, scores string, rank string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], FIELDS)


def brute(rows, every):
    held = []
    for at, (key, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = int(math.fmod(label + 1, 10)) if key is not None and key % 7 == 0 else label
        held.append((at, key, label, [math.floor(256 * x) for x in vector]))
    out = []
    for at, key, label, vector in held:
        if key is None or key % every:
            continue
        dot = lambda other: sum(x * y for x, y in zip(vector, other, strict=False))
        order = lambda e: (-e[0], e[1] is None, e[1] or 0)
        others = [(dot(v), k, y) for i, k, y, v in held if i != at]
        positives = sorted([e for e in others if e[2] == label], key=order)[:5]
        for score, positive, _ in positives:
            near = [e for e in others if e[2] != label and 50 * score <= 100 * e[0] <= 95 * score]
            out += [(key, positive, i + 1, n, score, s) for i, (s, n, _) in enumerate(sorted(near, key=order)[:3])]
    return sorted(out, key=repr)


def found(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shape", [(1, 1, 1), (128, 64, 4096), (130, 70, 333), (5, 200, 7), (64, 65, 66)])
def test_strassen_equals_the_plain_product(shape):
    m, d, n = shape
    draw = np.random.default_rng(4)
    a, b = draw.integers(-(1 << 20), 1 << 20, (m, d)), draw.integers(-(1 << 20), 1 << 20, (d, n))
    assert (hard_negatives.strassen(a, b, leaf=4) == a @ b).all()
    assert (hard_negatives.strassen(a, b) == a @ b).all()


def made(n, width, copies=0):
    draw = random.Random(6)
    rows = [(i, [draw.gauss(0.1, 0.3) for _ in range(width)], draw.randrange(3)) for i in range(n)]
    return rows + [(n + i, rows[i % 3][1], rows[i % 5][2]) for i in range(copies)]


@pytest.mark.parametrize("block_bytes", [1 << 24, 8 * 9 * 17])
def test_equals_brute_force(spark, block_bytes):
    rows = made(150, 9, copies=20)
    df = hard_negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0, block_bytes=block_bytes)
    expected = brute(rows, 10)
    assert found(df) == expected and len(expected) > 50


def test_a_hot_label_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CANDIDATE_TILE", 16)
    rows = [(k, v, 1 if k % 3 else y) for k, v, y in made(120, 5)]
    assert found(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0)) == brute(rows, 10)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(50, None, 1), (100, [1.0, None], 1), (150, [nan, 1.0], 1), (200, [1.0, inf], 1), (250, [1.0, 1.0], None)]
    odd += [(300, [], 2), (None, [1.0, 0.5], 1), (None, [0.5, 0.9], 2), (-50, [1.0], 3), (2, [0.75, 0.1, 0.2], 3)]
    rows = odd + [(0, [1.0, 1.0], 1), (0, [1.0, 0.75], 1), (3, [0.9, 0.2], 0), (3, [0.9, 0.2], 1), (7, [0.8, 0.2], 1), (50, [1.0, 0.9], 1)]
    expected = brute(rows, 50)
    assert found(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 50 == 0)) == expected and expected
    assert found(hard_negatives.mine(table(spark, []), F.col("vec_id") % 50 == 0)) == []


def test_large_components_are_exact(spark):
    rows = [(50, [2.0**30, 1.0], 1), (1, [2.0**14, 3.0], 1), (2, [2.0**13 + 2.0**12, 1.0], 2), (3, [2.0**13, 7.0], 2), (4, [1e300, 1.0], 2)]
    assert found(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 50 == 0)) == brute(rows, 50)
