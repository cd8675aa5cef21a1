import numpy as np
from pyspark.sql import functions as F

from daybook.llm import toxicity


def test_held_out_toxicity_is_found_and_clean_text_left_alone(spark):
    at = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    found = toxicity.score(docs, labels, "toxic", 5, 0).join(labels, "doc_id").where("held_out")
    rates = {r["toxic"]: r["rate"] for r in found.groupBy("toxic").agg(F.avg("predicted").alias("rate")).collect()}
    assert rates[1] >= 0.6 and rates[0] <= 0.05


def labelled(spark, documents):
    rows = [(i, "calm plain words of a page number" + " more" * (i % 7), "en", "s") for i in range(60)]
    rows += [(100 + i, "calm plain words you utter zorkhead " + "of a page", "en", "s") for i in range(40)]
    marks = [(i, int(i >= 100)) for i, *_ in rows]
    return documents(rows), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_parts_of_known_words_carry_over_to_new_ones(spark, documents):
    docs, labels = labelled(spark, documents)
    known = toxicity.learn(docs, labels, "toxic", 5, 0)
    new, plain, seen = map(known.of_word, ["zorkbrain", "plainly", "zorkhead"])
    assert seen > toxicity.MARGIN and new > toxicity.MARGIN and plain < toxicity.MARGIN


def padded(word):
    return toxicity.START * 4 + word + toxicity.END


def brute_continuations(words):
    found = {}
    for length in range(1, toxicity.ORDER):
        for run in {padded(w)[i - length : i + 1] for w in words for i in range(4, len(padded(w)))}:
            found[run[1:]] = found.get(run[1:], 0) + 1
    return found


def brute_shared(counts, run):
    if not run:
        return 1 / (sum(len(r) == 1 for r in counts) + 1)
    beside = {r: n for r, n in counts.items() if len(r) == len(run) and r[:-1] == run[:-1]}
    below, whole = brute_shared(counts, run[1:]), sum(beside.values())
    if not whole:
        return below
    return max(counts.get(run, 0) - toxicity.DISCOUNT, 0) / whole + len(beside) * toxicity.DISCOUNT / whole * below


def brute_ratio(rows, corpus, word):
    """Log ratio of a word from the models as they are defined."""
    counts = brute_continuations({w for t in corpus for w in t.lower().split()})
    log = 0.0
    for label, side in ((1, 1), (0, -1)):
        runs = {}
        for text, toxic in rows:
            for w in text.lower().split() if toxic == label else []:
                for i in range(4, len(padded(w))):
                    runs[padded(w)[i - 4 : i + 1]] = runs.get(padded(w)[i - 4 : i + 1], 0) + 1
        for i in range(4, len(padded(word))):
            run = padded(word)[i - 4 : i + 1]
            beside = [n for r, n in runs.items() if r[:-1] == run[:-1]]
            whole = sum(beside) + toxicity.STRENGTH
            left = min(1, (toxicity.STRENGTH + len(beside) * toxicity.DISCOUNT) / whole)
            log += side * np.log(max(runs.get(run, 0) - toxicity.DISCOUNT, 0) / whole + left * brute_shared(counts, run[1:]))
    return log


def test_continuations_equal_brute_force(documents):
    texts = ["abc ab", "Bab cab", None, "x9y"]
    found = {r["run"]: r["n"] for r in toxicity.continuations(documents(list(enumerate(texts)))).collect()}
    assert found == brute_continuations({"abc", "ab", "bab", "cab", "x", "y"})


def test_shared_probabilities_equal_brute_force_and_sum_to_one(spark, documents):
    texts = ["abc ab abba", "bab cab"]
    shared = toxicity.continuations(documents(list(enumerate(texts)))).persist()
    counts = brute_continuations(set(" ".join(texts).split()))
    signs = ["a", "b", "c", toxicity.END]
    wanted = [(toxicity.START * 4 + before)[-3:] + sign for before in ("", "a", "ab", "abb", "ca") for sign in signs]
    found = toxicity.shared_probabilities(shared, spark.createDataFrame([(w,) for w in wanted], "run string"))
    found = {r["run"]: r["p"] for r in found.collect()}
    assert found.keys() == set(wanted)
    assert all(abs(found[w] - brute_shared(counts, w)) < 1e-12 for w in wanted)
    for at in {w[:-1] for w in wanted}:
        unknown = brute_shared(counts, at + "z")  # a sign the corpus lacks takes what is left
        assert abs(sum(found[at + sign] for sign in signs) + unknown - 1) < 1e-9


def test_log_ratios_equal_brute_force(spark, documents):
    rows = [("calm ab abc plain", 0), ("abc abba ab", 1), ("plain ab", 0), ("abba zab", 1)]
    corpus = [t for t, _ in rows] + ["other words able"]
    marked = spark.createDataFrame(rows, "text string, label int")
    shared = toxicity.continuations(documents(list(enumerate(corpus))))
    runs, contexts = ({r["run"]: r["ratio"] for r in f.collect()} for f in toxicity.ratios(toxicity.run_counts(marked), shared))
    known = toxicity.Evidence(runs, contexts)
    for word in ("ab", "abba", "zabba", "plainly", "unknown", "\u00e9ab"):
        assert abs(known.of_word(word) - brute_ratio(rows, corpus, word)) < 1e-9, word
    gain, excess = known.of_texts(["ab abba", "", None, "9 -"], {})
    assert abs(gain[0] - (brute_ratio(rows, corpus, "ab") + brute_ratio(rows, corpus, "abba")) / 2) < 1e-9
    assert gain[1:].tolist() == excess[1:].tolist() == [0, 0, 0]


def test_odd_rows_and_missing_labels(spark, documents, odd, empty):
    docs, labels = labelled(spark, documents)
    columns = ["doc_id", "text", "lang", "source"]
    both = docs.select(columns).union(odd.select(columns))
    rows = toxicity.score(both, labels, "toxic", 5, 0).collect()
    assert len(rows) == both.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == 0 for r in rows if r["doc_id"] in (1, 2, 3) and r["gain"] == 0)
    assert {r["score"] for r in toxicity.score(odd, labels.where("toxic = 0"), "toxic", 5, 0).collect()} == {0.0}
    assert toxicity.score(empty, labels, "toxic", 5, 0).count() == 0


def test_the_curve_rises_with_the_excess():
    values = np.array([[0.1 * (i % 3), 0.0] for i in range(50)] + [[0.0, 0.5]] * 10)
    constant, gain, excess = toxicity.calibrate(values, (values[:, 1] > 0).astype(int))
    assert constant < 0 and constant + 0.5 * excess > 0 and abs(gain) * 0.2 < -constant
    assert toxicity.calibrate(np.zeros((0, 2)), np.zeros(0)) == [-4.0, 0.0, 40.0]
