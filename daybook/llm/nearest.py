"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, each quantised by its own ``CENTROIDS`` centroids, so every vector falls into one of
``CENTROIDS ** 2`` cells. A query visits cells in order of summed distance of its halves to the two centroids, by a
heap, until the cells visited hold ``quota`` entries; their entries are reranked by exact distance.

The codebooks are fitted on a bounded sample (``SAMPLE_ROWS``); every row is indexed. The quota is measured, not
guessed: for ``PROBES`` vectors of the sample the true neighbours among all rows are found by brute force, and the
quota is what covers the share ``COVERAGE`` of them. Vectors without any structure therefore get a large quota.

Cells are dealt to ``SHARDS`` shards, a shard's entries to blocks of about ``BLOCK`` rows by a hash of the key and its
queries to blocks likewise, so neither a full cell nor a frequent vector lands in one task. A block keeps the best of
each query, and the best of all blocks are merged. What goes through the driver is the sample, the probes'
neighbours and the number of entries of each cell, all of fixed size.

Defined cases: vectors that are null, zero, of another length than most (the shorter on a tie), or hold a null or
non-finite component, and rows without a key take no part; a query whose key occurs more than once is its smallest
vector; repeated rows are candidates as often as they occur, but never for their own key; ties go to the smaller
key; with fewer candidates than asked for all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import durable

CENTROIDS = 32
SAMPLE_ROWS = 8192
ROUNDS = 12
PROBES = 128
COVERAGE = 0.97
SHARDS = 64
BLOCK = 4096
TOP = 10


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def entries(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, vector`` of the rows that take part."""
    rows = table.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("key").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1)
    most = sizes.first()
    return rows.where(F.size("vector") == (most["size"] if most else 0))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances of the rows of two matrices, to rounding."""
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1) - 2.0 * (a @ b.T), 0.0)


def fit(sample: np.ndarray, centroids: int = CENTROIDS) -> np.ndarray:
    """Centroids of one half by Lloyd's rounds from distinct rows of the sample."""
    if not sample.shape[1]:  # the first half of vectors with one component
        return np.zeros((1, 0))
    distinct = np.unique(sample, axis=0)
    chosen = np.random.default_rng(7).permutation(len(distinct))[:centroids]
    found = distinct[np.sort(chosen)].copy()
    for _ in range(ROUNDS):
        nearest = squared(sample, found).argmin(1)
        for i in np.unique(nearest):
            found[i] = sample[nearest == i].mean(0)
    return found


@dataclass(frozen=True)
class Index:
    """Both codebooks, the number of entries of each cell, and how many entries a query visits at least."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray
    quota: int = 0

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.first.shape[1]
        return squared(vectors[:, :at], self.first), squared(vectors[:, at:], self.second)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = self.halves(vectors)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def traverse(self, a: np.ndarray, b: np.ndarray) -> Iterator[int]:
        """All cells by summed distance ``a[i] + b[j]``: a pair enters the heap when both its predecessors are out."""
        by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        near_a, near_b = a[by_a].tolist(), b[by_b].tolist()
        done = [0] * len(near_a)  # of each row, how many pairs are out
        queue = [(near_a[0] + near_b[0], 0, 0)]
        while queue:
            _, i, j = heapq.heappop(queue)
            yield int(by_a[i]) * len(near_b) + int(by_b[j])
            done[i] = j + 1
            if i + 1 < len(near_a) and done[i + 1] == j:
                heapq.heappush(queue, (near_a[i + 1] + near_b[j], i + 1, j))
            if j + 1 < len(near_b) and (i == 0 or done[i - 1] > j + 1):
                heapq.heappush(queue, (near_a[i] + near_b[j + 1], i, j + 1))

    def visited(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Cells with entries that a query visits."""
        found, held = [], 0
        for cell in self.traverse(a, b):
            if self.counts[cell]:
                found.append(cell)
                held += int(self.counts[cell])
                if held >= self.quota:
                    break
        return found


def best(queries: np.ndarray, keys: np.ndarray, vectors: np.ndarray, own: np.ndarray, top: int):
    """``query, key, distance`` of the ``top`` nearest of each query but its own key, exact and in double precision.

    Products pick whatever may be among them, with a margin for their rounding; differences give the distances.
    """
    if not len(keys) or not len(queries):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    rough = squared(queries, vectors)
    rough[own[:, None] == keys] = np.inf
    scale = max((queries**2).sum(1).max(), (vectors**2).sum(1).max())
    kth = np.partition(rough, min(top, rough.shape[1]) - 1, axis=1)[:, min(top, rough.shape[1]) - 1]
    row, column = np.nonzero((rough <= (kth + 1e-9 * scale)[:, None]) & np.isfinite(rough))
    distance = np.sqrt(((queries[row] - vectors[column]) ** 2).sum(1))
    order = np.lexsort((keys[column], distance, row))
    row, column, distance = row[order], column[order], distance[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < top
    return row[keep], keys[column[keep]], distance[keep]


def stacked(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(np.float64)


def top_of(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` nearest of each query, ranked."""
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def build(rows: DataFrame, top: int = TOP) -> tuple[Index, DataFrame] | None:
    """The index of ``key, vector`` rows, and the rows with their cell; None if there are none."""
    spark = rows.sparkSession
    place = F.xxhash64("key", "vector")
    sample = rows.orderBy(place, "key").limit(SAMPLE_ROWS).toPandas()
    if sample.empty:
        return None
    vectors = stacked(sample["vector"])
    half = vectors.shape[1] // 2
    index = Index(fit(vectors[:, :half]), fit(vectors[:, half:]), np.zeros(0))
    books = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = books.value.cells(stacked(batch["vector"])) if len(batch) else np.empty(0, np.int64)
            yield batch.assign(cell=cells)

    celled = durable(rows.mapInPandas(assign, "key long, vector array<double>, cell long"), "cells")
    counts = np.zeros(len(index.first) * len(index.second), dtype=np.int64)
    for row in celled.groupBy("cell").count().collect():  # one row for each cell at most
        counts[row["cell"]] = row["count"]
    index = Index(index.first, index.second, counts)
    return Index(index.first, index.second, counts, quota(index, celled, sample[:PROBES], top)), celled


def quota(index: Index, celled: DataFrame, probes: pd.DataFrame, top: int) -> int:
    """How many entries a query has to visit for ``COVERAGE`` of the probes' true neighbours."""
    queries, own = stacked(probes["vector"]), probes["key"].to_numpy()
    shared = celled.sparkSession.sparkContext.broadcast((queries, own))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                q, o = shared.value
                row, at, distance = best(q, np.arange(len(batch)), stacked(batch["vector"]), np.full(len(o), -1), top + 1)
                other = batch["key"].to_numpy()[at] != o[row]
                cells = batch["cell"].to_numpy()[at]
                yield pd.DataFrame({
                    "query_id": row[other], "vec_id": batch["key"].to_numpy()[at][other], "score": distance[other], "cell": cells[other]
                })

    local = celled.mapInPandas(nearest, "query_id long, vec_id long, score double, cell long")
    found = top_of(local, top).select("query_id", "cell").collect()  # at most PROBES times top rows
    a, b = index.halves(queries)
    needed, upto = [], {}
    for row in found:
        probe = row["query_id"]
        if probe not in upto:
            held, seen = 0, np.zeros(len(index.counts), dtype=np.int64)
            for cell in index.traverse(a[probe], b[probe]):
                held += int(index.counts[cell])
                seen[cell] = held
            upto[probe] = seen
        needed.append(upto[probe][row["cell"]])
    least = 4 * top
    return max(least, int(np.quantile(needed, COVERAGE, method="higher"))) if needed else least


def search(table: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", top: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of every row for which ``queries`` (of ``key``) holds."""
    spark = table.sparkSession
    rows = durable(entries(table, key, vector), "vectors")
    built = build(rows, top)
    if built is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, celled = built
    asked = rows.withColumnRenamed("key", key).where(queries).groupBy(F.col(key).alias("query_id")).agg(F.min("vector").alias("query"))
    asked = durable(asked, "queries")
    sizes = np.bincount(np.arange(len(index.counts)) % SHARDS, weights=index.counts, minlength=SHARDS)
    blocks = np.maximum(1, np.ceil(sizes / BLOCK)).astype(np.int64)
    query_blocks = max(1, -(-asked.count() // BLOCK))
    shared = spark.sparkContext.broadcast((index, blocks))

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, n_blocks = shared.value
        for batch in batches:
            out = []
            a, b = known.halves(stacked(batch["query"])) if len(batch) else ((), ())
            for i, (query_id, query) in enumerate(zip(batch["query_id"], batch["query"], strict=True)):
                by_shard: dict[int, list[int]] = {}
                for cell in known.visited(a[i], b[i]):
                    by_shard.setdefault(cell % SHARDS, []).append(cell)
                out += [(query_id, query, s, k, cells) for s, cells in by_shard.items() for k in range(n_blocks[s])]
                if len(out) > 4096:
                    yield pd.DataFrame(out, columns=["query_id", "query", "shard", "block", "cells"])
                    out = []
            yield pd.DataFrame(out, columns=["query_id", "query", "shard", "block", "cells"])

    wanted = asked.mapInPandas(visits, "query_id long, query array<double>, shard long, block long, cells array<long>")
    wanted = wanted.withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)))
    shard = F.pmod(F.col("cell"), F.lit(SHARDS))
    of_shard = F.element_at(F.lit(blocks.tolist()), shard.cast("int") + 1)
    dealt = celled.select("key", "vector", "cell", shard.alias("shard"), F.pmod(F.xxhash64("key", "vector"), of_shard).alias("block"))
    dealt = dealt.withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))))

    def rerank(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(held) and len(asking):
            held = held.sort_values("cell", kind="stable")
            cells, begins = np.unique(held["cell"].to_numpy(), return_index=True)
            ends = [*begins[1:], len(held)]
            keys, vectors = held["key"].to_numpy(), stacked(held["vector"])
            asker, ids = stacked(asking["query"]), asking["query_id"].to_numpy()
            of_cell: dict[int, list[int]] = {}
            for i, visited in enumerate(asking["cells"]):
                for cell in visited:
                    of_cell.setdefault(int(cell), []).append(i)
            for cell, begin, end in zip(cells, begins, ends, strict=True):
                at = np.array(of_cell.get(int(cell), []), dtype=np.int64)
                for part in range(0, len(at), 512):
                    few = at[part : part + 512]
                    row, near, distance = best(asker[few], keys[begin:end], vectors[begin:end], ids[few], top)
                    found.append((ids[few][row], near, distance))
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        out = pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))
        return out.sort_values(["query_id", "score", "vec_id"]).groupby("query_id").head(top)

    by = ["shard", "block", "query_block"]
    reranked = dealt.groupBy(*by).cogroup(wanted.groupBy(*by)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    return top_of(reranked, top).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
