"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of letters and digits, and runs of other signs. Features are hashed into ``2 ** BITS`` buckets:
the words and word pairs themselves, and runs of three token shapes (case, length, signs; a token equal to the one
before it has a shape of its own). A text's value for a bucket is the share of its features that fall there, so a
score is a sparse dot product that does not depend on the length of the text.

Training takes a bounded sample of the labelled rows (``TRAIN_ROWS``, smallest hash of the key first), dealt to
``SHARDS`` tasks. Each runs FTRL-proximal over its rows, and the weights of all shards are averaged. A shard replays
what fits into ``REPLAY`` feature values; further rows are learnt from once. Weights are at most one number for each
bucket, a bound that does not depend on the data, and are broadcast for scoring.

Defined cases: a null or empty text has no features and scores the bias alone; without any labelled row all weights
are 0 and all scores 0.5; keys labelled twice take their smallest label; null keys are scored and never learnt from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import annotate, durable, held_out

BITS = 18
TRAIN_ROWS = 12_000
SHARDS = 8
EPOCHS = 4
REPLAY = 4_000_000
#: FTRL-proximal: learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.6, 1.0, 0.0005, 0.0001
#: Values are shares; this factor brings them to the size the learning rate is made for.
GAIN = 30.0
#: Features added to a text's number of features, so that a text of a few words stays near the bias.
PRIOR = 12
THRESHOLD = 0.5

TOKEN = re.compile(r"\w+|[^\w\s]+")
_MEMO = 200_000


def shape(token: str) -> str:
    """Kind of a token: its sign if it is one, else case or digits, and whether it is long."""
    first = token[0]
    if not (first.isalnum() or first == "_"):
        return token[:3]
    kind = "9" if token.isdigit() else "X" if token.isupper() else "Xx" if first.isupper() else "x"
    return kind + ("+" if len(token) > 14 else "")


class Hasher:
    """Hashed features of whole texts, with the hashes of tokens remembered (the memo is emptied when it is full)."""

    def __init__(self) -> None:
        self.memo: dict[str, tuple[int, int]] = {}

    def features(self, text: str | None) -> np.ndarray:
        """The bucket of each feature of a text, repeats included."""
        tokens = TOKEN.findall(text) if text else []
        if not tokens:
            return np.empty(0, dtype=np.int64)
        if len(self.memo) > _MEMO:
            self.memo.clear()
        memo = self.memo
        for token in set(tokens).difference(memo):
            memo[token] = zlib.crc32(token.lower().encode()), zlib.crc32(shape(token).encode())
        codes = np.array([memo[t] for t in tokens], dtype=np.uint64)
        word, kind = codes[:, 0], codes[:, 1].copy()
        kind[1:][word[1:] == word[:-1]] = 7
        mix = np.uint64(0x9E3779B97F4A7C15)
        runs = (kind[:-2] * mix + kind[1:-1]) * mix + kind[2:] + np.uint64(2)
        pairs = word[:-1] * mix + word[1:] + np.uint64(1)
        found = np.concatenate([word, pairs, runs]) * mix
        return (found >> np.uint64(64 - BITS)).astype(np.int64)

    def sparse(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets and their values, the bias first."""
        found = self.features(text)
        buckets, counts = np.unique(found, return_counts=True)
        values = counts * (GAIN / (len(found) + PRIOR))
        return np.concatenate([[1 << BITS], buckets]), np.concatenate([[1.0], values])


class Ftrl:
    """FTRL-proximal with one learning rate for each coordinate."""

    def __init__(self, size: int) -> None:
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        gradient = (sigmoid(weights @ values) - label) * values
        n = self.n[at]
        rate = (np.sqrt(n + gradient**2) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - rate * weights
        self.n[at] = n + gradient**2


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, model, replayed, held = Hasher(), Ftrl((1 << BITS) + 1), [], 0
    seen = False
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            at, values = hasher.sparse(text)
            model.learn(at, values, label)
            seen = True
            if held + len(at) <= REPLAY:
                replayed.append((at, values, label))
                held += len(at)
    for _ in range(EPOCHS - 1):
        for at, values, label in replayed:
            model.learn(at, values, label)
    weights = model.weights()
    at = np.nonzero(weights)[0] if seen else np.empty(0, dtype=np.int64)
    one = 1.0 if seen else 0.0
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(weights[at], one), pa.float64())],
        names=["bucket", "weight"],
    )


def train(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int) -> np.ndarray:
    """Averaged weights of all shards, the bias last. Learns from labelled rows outside the held-out fold only."""
    order = F.xxhash64("doc_id")
    usable = F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), folds, fold)
    known = labels.where(usable).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    sample = durable(known.orderBy(order, "doc_id").limit(TRAIN_ROWS), "sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most TRAIN_ROWS pairs of numbers
    dealt = rows.repartition(SHARDS, F.xxhash64("doc_id")).sortWithinPartitions(order, "doc_id", "text")
    shards = dealt.select("text", "label").mapInArrow(_train, "bucket int, weight double")
    total = shards.groupBy("bucket").agg(F.sum("weight").alias("weight"))
    found = total.toArrow()  # one row for each bucket at most
    weights = np.zeros((1 << BITS) + 1)
    at, values = found.column("bucket").to_numpy(), found.column("weight").to_numpy()
    trained = values[at == -1].sum()
    weights[at[at >= 0]] = values[at >= 0] / max(trained, 1.0)
    return weights


def score(docs: DataFrame, keep: list[str], weights: np.ndarray) -> DataFrame:
    """The ``keep`` columns in a struct ``row``, and ``score``: the probability of label 1 for each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def make():
        hasher, known = Hasher(), shared.value

        def run(texts: list) -> list[pa.Array]:
            scores = np.empty(len(texts))
            for i, text in enumerate(texts):
                found = hasher.features(text)
                scores[i] = known[-1] + known[found].sum(dtype=np.float64) * (GAIN / (len(found) + PRIOR))
            return [pa.array(sigmoid(scores), pa.float64())]

        return run

    return annotate(docs, keep, "text", T.StructType([T.StructField("score", T.DoubleType())]), make)


def classify(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """One row for each document: ``doc_id, held_out, score, predicted``."""
    scored = score(docs, ["doc_id"], train(docs, labels, label, folds, fold)).select("row.doc_id", "score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
