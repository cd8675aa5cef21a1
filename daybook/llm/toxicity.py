"""Toxicity by class-conditional Kneser-Ney models.

Words are spelt out by two models of their signs, one of toxic and one of ordinary text: each predicts a sign from
those before it in the word, from the class's own counts with an absolute discount, and backs off to one distribution
shared by both classes, interpolated Kneser-Ney of continuation counts down to single signs. What a class has not
seen it takes from the shared counts, and a rare word is judged by the parts it shares with known ones.

A text's two log-likelihoods are compared over its number of words. Beside the plain difference, ``gain``, stands
``excess``, the part by which words go beyond ``MARGIN`` in favour of the toxic model: what languages and subjects that
happen to be more common in one class bring about stays below it. A logistic curve weighs both, fitted on at most
``CALIBRATION_ROWS`` labelled rows of one fold that the counts leave out.

The shared counts are exact, gathered from the words of all documents, and grow with the corpus; they stay in Spark.
The counts of the classes are those of a bounded sample of labelled rows (``TRAIN_ROWS``, smallest hash of the key
first), found without shuffling texts. Joins give each run of signs the classes have seen its shared probability and
with it its log ratio; a run neither has seen falls back to the same shared probability in both, so only the ratio of
their weights is left, one number for each context. These two tables are bounded by the sample and are broadcast.

Defined cases: a null text, or one without letters, has no evidence and scores what the curve gives for none (below
one half); without labelled rows of both classes all scores are 0; keys labelled twice take their smallest label;
null keys are scored and never learnt from; rows that repeat count as often as they stand there; very long texts are
read whole; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import annotate, durable, held_out

ORDER = 5
DISCOUNT = 0.75
#: Counts that the shared distribution weighs as much as, before a class's own counts in a context take over.
STRENGTH = 1.0
#: Log ratio of a word that languages and subjects may bring about.
MARGIN = 3.0
TRAIN_ROWS = 40_000
CALIBRATION_ROWS = 6_000
THRESHOLD = 0.5
#: Signs that stand for the start and the end of a word.
START, END = "\x02", "\x03"
TOKEN = re.compile(r"[^\W\d_]+")
_MEMO = 200_000


def words_of(text: str) -> Column:
    """All words of a text: runs of letters in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def runs_of(word: Column) -> Column:
    """The runs of ``ORDER`` signs that end at each sign of a word and at its end, as an array."""
    padded = F.concat(F.lit(START * (ORDER - 1)), word, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda i: F.substring(padded, i, ORDER))


def run_counts(rows: DataFrame) -> DataFrame:
    """``run, toxic, ordinary``: how often each class has each run of ``ORDER`` signs within padded words."""
    counted = rows.select("label", F.explode(words_of("text")).alias("word")).groupBy("label", "word").agg(F.count("*").alias("n"))
    of = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
    runs = counted.select("label", "n", F.explode(runs_of(F.col("word"))).alias("run"))
    return runs.groupBy("run").agg(of(1).alias("toxic"), of(0).alias("ordinary"))


def continuations(docs: DataFrame) -> DataFrame:
    """``run, n``: for each run of up to ``ORDER - 1`` signs, how many different signs stand before it in the corpus.

    The distinct runs of ``ORDER`` signs hold all shorter ones as their ends.
    """
    words = docs.select(F.explode(words_of("text")).alias("word")).distinct()
    longest = words.select(F.explode(runs_of(F.col("word"))).alias("run")).distinct()
    longer = F.array(*[F.substring("run", ORDER - k, k + 1) for k in range(1, ORDER)])
    kinds = longest.select(F.explode(longer).alias("longer")).distinct()
    return kinds.groupBy(F.substring("longer", 2, ORDER).alias("run")).agg(F.count("*").alias("n"))


def context(run: str) -> Column:
    """All but the last sign of a run."""
    return F.expr(f"substring({run}, 1, length({run}) - 1)")


def shared_probabilities(shared: DataFrame, wanted: DataFrame) -> DataFrame:
    """``run, p`` for the ``wanted`` runs of ``ORDER - 1`` signs: interpolated Kneser-Ney over ``shared`` (``run, n``).

    Each order joins its runs with the totals of their contexts and with the order below, which holds their ends.
    """
    totals = shared.groupBy(context("run").alias("context"), F.length("run").alias("length"))
    totals = durable(totals.agg(F.sum("n").alias("whole"), F.count("*").alias("kinds")), "contexts")
    below = None
    for length in range(1, ORDER):
        ends = wanted.select(F.substring("run", ORDER - length, length).alias("run")).distinct()
        own = ends.join(shared, "run", "left").withColumn("context", context("run"))
        found = own.join(totals.where(F.col("length") == length).drop("length"), "context", "left")
        if below is None:
            found = found.withColumn("lower", 1.0 / (F.col("kinds") + 1))
        else:
            found = found.withColumn("end", F.substring("run", 2, ORDER)).join(below.select(F.col("run").alias("end"), F.col("p").alias("lower")), "end")
        held = F.greatest(F.coalesce("n", F.lit(0)) - DISCOUNT, F.lit(0.0)) / F.col("whole")
        p = F.coalesce(held + F.col("kinds") * DISCOUNT / F.col("whole") * F.col("lower"), F.col("lower"))
        below = found.select("run", p.alias("p"))
    return below


def ratios(classes: DataFrame, shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Log ratios of the toxic over the ordinary probability: of runs seen by a class, and of contexts for all other runs."""
    both = ("toxic", "ordinary")
    kinds = [F.count(F.when(F.col(c) > 0, 1)).alias(f"{c}_kinds") for c in both]
    contexts = classes.groupBy(context("run").alias("context")).agg(*[F.sum(c).alias(f"{c}_whole") for c in both], *kinds)
    left = {c: F.least((STRENGTH + F.col(f"{c}_kinds") * DISCOUNT) / (STRENGTH + F.col(f"{c}_whole")), F.lit(1.0)) for c in both}
    ends = classes.select(F.substring("run", 2, ORDER).alias("run"))
    known = shared_probabilities(shared, ends.distinct()).withColumnRenamed("run", "end")
    seen = classes.select("*", context("run").alias("context"), F.substring("run", 2, ORDER).alias("end"))
    seen = seen.join(contexts, "context").join(known, "end")
    p = {c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / (STRENGTH + F.col(f"{c}_whole")) + left[c] * F.col("p") for c in both}
    of_runs = seen.select("run", F.log(p["toxic"] / p["ordinary"]).alias("ratio"))
    return of_runs, contexts.select(F.col("context").alias("run"), F.log(left["toxic"] / left["ordinary"]).alias("ratio"))


class Evidence:
    """Log ratios of the runs that the classes have seen, and of the contexts of all others."""

    def __init__(self, runs: dict[str, float], contexts: dict[str, float]) -> None:
        self.runs, self.contexts = runs, contexts

    def of_word(self, word: str) -> float:
        """Log of the toxic over the ordinary probability of a word."""
        padded = START * (ORDER - 1) + word + END
        ratio = 0.0
        for i in range(len(word) + 1):
            run = padded[i : i + ORDER]
            own = self.runs.get(run)
            ratio += self.contexts.get(run[:-1], 0.0) if own is None else own
        return ratio

    def of_texts(self, texts: list[str | None], memo: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """``gain`` and ``excess`` of each text, a word's mean."""
        if len(memo) > _MEMO:
            memo.clear()
        gain, excess = np.zeros(len(texts)), np.zeros(len(texts))
        for i, text in enumerate(texts):
            words = TOKEN.findall(text.lower()) if text else []
            if words:
                for word in words:
                    if word not in memo:
                        memo[word] = self.of_word(word)
                found = list(map(memo.__getitem__, words))
                gain[i] = sum(found) / len(words)
                excess[i] = sum(x - MARGIN for x in found if x > MARGIN) / len(words)
        return gain, excess


def sample(labels: DataFrame, rows: Column, label: str, bound: int) -> DataFrame:
    """``doc_id, label`` of at most ``bound`` labelled keys for which ``rows`` holds, smallest hash first."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & rows)
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    return durable(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound), "sample")


def learn(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int) -> Evidence | None:
    """The evidence that words give, with labels from neither the held-out nor the next fold; None without both."""
    key = F.col("doc_id")
    learnt = ~held_out(key, folds, fold) & ~held_out(key, folds, (fold + 1) % folds)
    chosen = sample(labels, learnt, label, TRAIN_ROWS)
    if chosen.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most TRAIN_ROWS pairs of numbers
    found = ratios(durable(run_counts(rows), "runs"), durable(continuations(docs), "continuations"))
    runs, contexts = (dict(zip(*(t.column(c).to_pylist() for c in ("run", "ratio")), strict=True)) for t in (f.toArrow() for f in found))
    return Evidence(runs, contexts)


SIGNS = ["gain", "excess"]


def evidence(docs: DataFrame, keep: list[str], known: Evidence) -> DataFrame:
    """The ``keep`` columns in a struct ``row``, with ``gain`` and ``excess`` of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def make():
        memo: dict[str, float] = {}
        return lambda texts: [pa.array(x, pa.float64()) for x in shared.value.of_texts(texts, memo)]

    return annotate(docs, keep, "text", T.StructType([T.StructField(c, T.DoubleType()) for c in SIGNS]), make)


def calibrate(values: np.ndarray, labels: np.ndarray) -> list[float]:
    """Weights of the logistic curve of the label: a constant, then one of each sign (penalised, by Newton's method).

    More excess never speaks for ordinary text, and a text without evidence is not toxic.
    """
    if not len(values) or labels.min() == labels.max():
        return [-4.0, 0.0, 40.0]
    centre, scale = values.mean(axis=0), np.where(values.std(axis=0) > 0, values.std(axis=0), 1.0)
    design = np.column_stack([np.ones(len(values)), (values - centre) / scale])
    weights, penalty = np.zeros(design.shape[1]), np.array([1e-6] + [0.05] * values.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (p - labels) + penalty * np.r_[0.0, weights[1:]]
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    slopes = weights[1:] / scale
    slopes[-1] = max(slopes[-1], 1e-3)
    return [min(float(weights[0] - slopes @ centre), -1e-3), *map(float, slopes)]


def score(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """One row for each document: ``doc_id, held_out, score, predicted, gain, excess``."""
    key = F.col("doc_id")
    known = learn(docs, labels, label, folds, fold)
    if known is None:
        nothing = docs.select("doc_id", held_out(key, folds, fold).alias("held_out"), F.lit(0.0).alias("score"))
        return nothing.select("*", F.lit(0).alias("predicted"), *[F.lit(0.0).alias(c) for c in SIGNS])
    apart = sample(labels, held_out(key, folds, (fold + 1) % folds), label, CALIBRATION_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(apart), "doc_id")  # at most CALIBRATION_ROWS pairs
    found = evidence(rows, ["label"], known).select("row.label", *SIGNS).toPandas()
    constant, *slopes = calibrate(found[SIGNS].to_numpy(), found["label"].to_numpy())
    scored = evidence(docs, ["doc_id"], known).select("row.doc_id", *SIGNS)
    odds = sum((F.col(c) * w for c, w in zip(SIGNS, slopes, strict=True)), F.lit(constant))
    probability = 1.0 / (1.0 + F.exp(-F.greatest(F.least(odds, F.lit(35.0)), F.lit(-35.0))))
    return scored.select(
        "doc_id",
        held_out(key, folds, fold).alias("held_out"),
        probability.alias("score"),
        (probability >= THRESHOLD).cast("int").alias("predicted"),
        *SIGNS,
    )
