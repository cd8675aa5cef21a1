import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import quality_classifier as classifier
from daybook.llm import quality_rules as rules

SPLIT = re.compile("[\x20\x09-\x0d]+")


def brute(text):
    words = [w for w in SPLIT.split(text or "") if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if SPLIT.sub("", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force():
    draw = random.Random(1)
    texts = ["".join(draw.choice("ab# |\n\t\x0b é") for _ in range(draw.randrange(60))) for _ in range(400)]
    for text in [None, "", " ", "a", "a b c", "a b c a b c", "x x x x", *texts]:
        assert rules.measures(text)[:5] == brute(text)


def test_many_different_words_do_not_overflow():
    words = [str(i).encode() for i in range(2_000_010)]
    assert rules.repeat_words(words) == 0
    assert rules.repeat_words([*words, *words[5:9]]) == 8


def verdicts(docs):
    measured = rules.measure(docs, ["doc_id"])
    return rules.judge(measured, rules.fences(rules.sketches(measured))).select("row.doc_id", "*")


def test_odd_rows_are_judged_and_an_empty_table_is_none(odd, empty):
    rows = verdicts(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] != 8)
    assert verdicts(empty).count() == 0


def test_fences_follow_the_group_and_clean_documents_stay(documents):
    draw = random.Random(2)
    word = lambda long: "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(3, 7) + long))
    rows = [(i, " ".join(word(0) for _ in range(80)), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(word(9) for _ in range(80)), "de", "s") for i in range(300)]
    rows += [(2000 + i, " ".join(word(0) + "###" for _ in range(80)), "en", "s") for i in range(10)]
    rows += [(3000 + i, " ".join(word(9) for _ in range(80)), "en", "s") for i in range(10)]
    kept = {r["doc_id"]: r["kept"] for r in verdicts(documents(rows)).collect()}
    assert all(kept[i] for i in range(300)) and all(kept[1000 + i] for i in range(300))
    assert not any(kept[2000 + i] or kept[3000 + i] for i in range(10))


def test_each_rate_has_cutoffs_of_its_group(documents):
    """Twice the repeats are usual in one source and odd in another, whatever the size of the groups."""
    draw = random.Random(3)

    def text(lines, again):
        own = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(5)) for _ in range(lines)]
        return "\n".join([*own, *own[:again]])

    rows = [(i, text(40, i % 3), "en", "plain") for i in range(400)] + [(400, text(40, 12), "en", "plain")]
    rows += [(1000 + i, text(40, 6 + i % 3), "en", "songs") for i in range(400)] + [(1400, text(40, 9), "en", "songs")]
    rows += [(2000 + i, text(40, i % 3), "fr", "tiny") for i in range(12)]
    kept = {r["doc_id"]: r["kept"] for r in verdicts(documents(rows)).collect()}
    assert not kept.pop(400)
    assert all(kept.values())


def test_fences_are_drawn_towards_the_wider_group_smoothly(documents):
    words = lambda n, sign: " ".join(["word" + sign] * n)
    texts = lambda n, sign, source: [
        (i, " ".join(f"w{i}x{k}{sign}" for k in range(60)), "en", source) for i in range(n)
    ]
    highs = []
    for n in (5, 20, 80):
        measured = rules.measure(documents(texts(1000, "", "a") + texts(n, "#", "b") + [(0, words(60, ""), "en", "c")]), ["doc_id"])
        found = {r["f_source"]: r for r in rules.fences(rules.sketches(measured)).collect()}
        highs.append(found["b"]["symbol_rate_high"])
        assert "c" not in found  # its only document fails the base rules
    assert highs == sorted(highs) and len(set(highs)) == 3 and highs[-1] > 300


def test_sketches_merge_to_the_sketch_of_all(documents, spark):
    rows = [(i, " ".join(f"a{k}" for k in range(60 + i)) + "#" * i, "en", "s") for i in range(80)]
    one = rules.sketches(rules.measure(documents(rows), ["doc_id"]))
    parts = [rules.sketches(rules.measure(documents(rows[i::3]), ["doc_id"])) for i in range(3)]
    both = parts[0].union(parts[1]).union(parts[2]).groupBy("lang", "source", "rate", "bucket").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, both.collect()))


def test_buckets_keep_ten_bits(spark):
    values = [0, 1, 1023, 1024, 1025, 2047, 2048, 2051, 123456789]
    got = spark.createDataFrame([(v,) for v in values], "v long").select(rules.bucket(F.col("v"))).collect()
    assert [r[0] for r in got] == [v >> max(0, v.bit_length() - 10) << max(0, v.bit_length() - 10) for v in values]


def test_ftrl_learns_a_separable_rule():
    model, hasher = classifier.Ftrl((1 << classifier.BITS) + 1), classifier.Hasher()
    texts = [("good fine words here", 1), ("BAD!! LOUD!! NOISE!!", 0)] * 40
    for text, label in texts:
        model.learn(*hasher.sparse(text), label)
    weights = model.weights()
    for text, label in texts[:2]:
        at, values = hasher.sparse(text)
        assert (classifier.sigmoid(weights[at] @ values) > 0.5) == bool(label)


def test_score_is_the_sparse_dot_product(documents):
    weights = np.random.default_rng(0).normal(size=(1 << classifier.BITS) + 1)
    text = "Some words, some more words; and some 9 signs!!"
    at, values = classifier.Hasher().sparse(text)
    got = classifier.score(documents([(1, text)]), ["doc_id"], weights).first()["score"]
    assert got == pytest.approx(classifier.sigmoid(weights[at] @ values), abs=1e-5)


def test_held_out_quality_is_predicted_and_odd_rows_are_scored(table, odd, empty, spark):
    labels = table("labels")
    found = classifier.classify(table("documents"), labels, "quality", 3, 1).join(labels, "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.9
    rows = classifier.classify(odd, labels, "quality", 3, 1).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = labels.where("false")
    assert {r["score"] for r in classifier.classify(odd, none, "quality", 3, 1).collect()} == {0.5}
    assert classifier.classify(empty, labels, "quality", 3, 1).count() == 0


def test_held_out_labels_do_not_change_scores(table):
    docs, labels = table("documents"), table("labels")
    flipped = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a, b = (classifier.classify(docs, x, "quality", 3, 1).orderBy("doc_id", "score").collect() for x in (labels, flipped))
    assert [r["score"] for r in a] == [r["score"] for r in b]
