"""Hard negatives by exact inner products: Strassen's multiplication on integer tiles, then mergeable heaps.

Vectors become whole numbers. Anchors and candidates are cut into blocks of at most ``BLOCK_BYTES``; every pair of
blocks is one group of a cogroup, so a task holds two blocks of a known size and no row meets another outside of such a
pair. A pair is multiplied tile by tile: tiles are padded with zeros so that all three sides halve ``levels`` times, seven
products of half-size tiles give each level, and all additions are exact.

The work is done twice. First each pair of blocks keeps a heap of the best positives for each anchor, and heaps of an
anchor merge into its positives. Then anchors carry the score windows of their positives, each pair keeps a heap of the
best negatives for each window, and these merge in turn. Heaps hold ``POSITIVES`` or ``NEGATIVES`` entries, so what is
shuffled after the products does not depend on how many rows share a label.

Defined cases: rows with a null label or vector, or a null or non-finite component, take no part; shorter vectors are
padded with zeros, an empty one is all zeros; ties go to the smaller ``vec_id`` (null last), then to an arbitrary but
fixed row; rows that repeat a ``vec_id`` are rows of their own, also beside an anchor of that ``vec_id``; a row without
``vec_id`` is a candidate, never an anchor; components too large for exact 64-bit products are multiplied as unbounded
integers, and scores beyond 64 bits end at their limits; an empty table gives an empty result; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import durable

#: Fixed values of the task: scale of a component, positives, negatives, and the window as hundredths of a score.
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
#: Bytes of vectors in a block, rows of a tile on either side, and the side below which a product is not split.
BLOCK_BYTES = 16 << 20
ANCHOR_TILE, CANDIDATE_TILE = 128, 4096
LEAF = 32
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of whole numbers, exact as long as the result fits the type (sums wrap around in between)."""
    m, d, n = len(a), a.shape[1], b.shape[1]
    levels = 0
    while min(m, d, n) >> levels > leaf:
        levels += 1
    unit = 1 << levels
    up = lambda x: -(-x // unit) * unit
    wide = lambda x, rows, columns: np.pad(x, ((0, rows - x.shape[0]), (0, columns - x.shape[1])))
    return _product(wide(a, up(m), up(d)), wide(b, up(d), up(n)), levels)[:m, :n]


def _product(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return a @ b
    (m, d), n = (s // 2 for s in a.shape), b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :d], a[:m, d:], a[m:, :d], a[m:, d:]
    b11, b12, b21, b22 = b[:d, :n], b[:d, n:], b[d:, :n], b[d:, n:]
    down = levels - 1
    p1 = _product(a11 + a22, b11 + b22, down)
    p2 = _product(a21 + a22, b11, down)
    p3 = _product(a11, b12 - b22, down)
    p4 = _product(a22, b21 - b11, down)
    p5 = _product(a11 + a12, b22, down)
    p6 = _product(a21 - a11, b11 + b12, down)
    p7 = _product(a12 - a22, b21 + b22, down)
    out = np.empty((2 * m, 2 * n), dtype=a.dtype)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` with the rows of ``b``."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    bound = max(abs(int(a.max())), abs(int(a.min()))) * max(abs(int(b.max())), abs(int(b.min()))) * a.shape[1]
    if bound <= MOST:
        return strassen(a, b.T)
    exact = strassen(a.astype(object), b.T.astype(object))
    return np.clip(exact, LEAST, MOST).astype(np.int64)


def entries(table: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``row, vec_id, label, vector`` of the rows that take part, whole numbers in ``vector``."""
    x = lambda c: F.floor(c.cast("double") * float(SCALE))
    huge = float(1 << 62)
    whole = lambda c: F.when(F.abs(c.cast("double") * float(SCALE)) < huge, x(F.when(F.abs(c.cast("double")) < huge / SCALE, c).otherwise(F.lit(0)))).otherwise(
        F.when(c > 0, F.lit(1 << 62)).otherwise(F.lit(-(1 << 62)))
    )
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    moved = F.when(F.col(key) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))
    rows = table.where(F.col(label).isNotNull() & F.col(vector).isNotNull()).where(finite)
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("vec_id"),
        moved.cast("long").alias("label"),
        F.transform(vector, whole).alias("vector"),
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of int64, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def ordered(block: pa.Table, *by: str) -> pa.Table:
    """A block in the order of ties: smaller ``vec_id`` first, null last, then by row."""
    keys = [(k, "ascending") for k in (*by, "vec_id", "row")]
    return block.sort_by(keys) if block.num_rows else block


def best(found: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """Of the columns ``at`` (in order of ties) those with the ``most`` largest of ``found``, largest first."""
    if len(at) > 4 * most:
        at = at[found[at] >= np.partition(found[at], len(at) - most)[len(at) - most]]
    return at[np.argsort(-found[at].astype(object) if len(at) and found[at].min() == LEAST else -found[at], kind="stable")][:most]


def merged(held: list, more: list, most: int) -> list:
    """Two heaps of ``(score, vec_id, row)`` as one."""
    return sorted(held + more, key=rank)[:most]


def rank(entry: tuple) -> tuple:
    score, vec_id, row = entry
    return -score, vec_id is None, vec_id or 0, row


def positive_heaps(candidates: pa.Table, anchors: pa.Table, width: int, top: int = POSITIVES) -> pa.Table:
    """For each anchor the best candidates of its label but itself, among the pair's."""
    candidates, anchors = ordered(candidates, "label"), ordered(anchors, "label")
    labels, of_anchor = candidates["label"].to_numpy(), anchors["label"].to_numpy()
    rows, keys, anchor_rows = candidates["row"].to_numpy(), candidates["vec_id"].to_pylist(), anchors["row"].to_numpy()
    c, a = matrix(candidates["vector"], width), matrix(anchors["vector"], width)
    heaps: dict[int, list] = {}
    for label in np.intersect1d(of_anchor, labels):
        begin, end = np.searchsorted(labels, [label, label + 1])
        first, last = np.searchsorted(of_anchor, [label, label + 1])
        for i, j, tile in tiles(a[first:last], c[begin:end]):
            for k, found in enumerate(tile):
                anchor = int(anchor_rows[first + i + k])
                at = np.flatnonzero(rows[begin + j : begin + j + len(found)] != anchor)
                picked = [(int(found[x]), keys[begin + j + x], int(rows[begin + j + x])) for x in best(found, at, top)]
                heaps[anchor] = merged(heaps.get(anchor, []), picked, top)
    return flat([(anchor, None, *e) for anchor, heap in heaps.items() for e in heap])


def negative_heaps(candidates: pa.Table, anchors: pa.Table, width: int, top: int = NEGATIVES) -> pa.Table:
    """For each anchor and each of its positives' scores the best candidates of another label in the score's window."""
    candidates, anchors = ordered(candidates), ordered(anchors)
    labels, of_anchor = candidates["label"].to_numpy(), anchors["label"].to_numpy()
    rows, keys, anchor_rows = candidates["row"].to_numpy(), candidates["vec_id"].to_pylist(), anchors["row"].to_numpy()
    c, a = matrix(candidates["vector"], width), matrix(anchors["vector"], width)
    windows = [[(s, -(-LOW * s // 100), HIGH * s // 100) for s in sorted(set(held))] for held in anchors["scores"].to_pylist()]
    heaps: dict[tuple, list] = {}
    for i, j, tile in tiles(a, c):
        for k, found in enumerate(tile):
            wanted = [w for w in windows[i + k] if w[1] <= w[2]]
            if not wanted:
                continue
            other = labels[j : j + len(found)] != of_anchor[i + k]
            for score, low, high in wanted:
                at = np.flatnonzero(other & (found >= low) & (found <= high))
                if len(at):
                    picked = [(int(found[x]), keys[j + x], int(rows[j + x])) for x in best(found, at, top)]
                    name = (int(anchor_rows[i + k]), score)
                    heaps[name] = merged(heaps.get(name, []), picked, top)
    return flat([(*name, *e) for name, heap in heaps.items() for e in heap])


def tiles(a: np.ndarray, c: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    for i in range(0, len(a), ANCHOR_TILE):
        for j in range(0, len(c), CANDIDATE_TILE):
            yield i, j, scores(a[i : i + ANCHOR_TILE], c[j : j + CANDIDATE_TILE])


FOUND = ["anchor", "window", "score", "vec_id", "found"]


def flat(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(FOUND)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=FOUND)


def spread(rows: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
    """Rows dealt evenly to blocks of their own side, once for each block of the other."""
    block = F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
    return rows.withColumn(own, block).withColumn(other, every)


def heaps(candidates: DataFrame, anchors: DataFrame, cut: tuple[int, int], width: int, make, by: list[str], most: int) -> DataFrame:
    """What ``make`` finds in each pair of blocks, merged: the first ``most`` of each group ``by``, with their ``rank``."""
    n_candidates, n_anchors = cut
    left = spread(candidates, "c_block", n_candidates, "a_block", n_anchors)
    right = spread(anchors, "a_block", n_anchors, "c_block", n_candidates)
    pair = ["a_block", "c_block"]

    def both(held: pa.Table, asking: pa.Table) -> pa.Table:
        return make(held, asking, width)

    schema = ", ".join(f"{n} long" for n in FOUND)
    found = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(both, schema)
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), "found"]
    return found.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= most)


def mine(
    table: DataFrame, asking: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors (``asking``, of ``vec_id``)."""
    spark = table.sparkSession
    rows = durable(entries(table, key, vector, label), "vectors")
    held = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"), F.count(F.when(asking, 1)).alias("anchors")).first()
    width = max(1, held["width"] or 0)
    in_block = max(1, block_bytes // (8 * width))
    at_least = spark.sparkContext.defaultParallelism
    cut = max(1, min(held["n"], max(-(-held["n"] // in_block), at_least))), max(1, -(-held["anchors"] // in_block))
    anchors = rows.where(asking)
    positives = durable(heaps(rows, anchors, cut, width, positive_heaps, ["anchor"], POSITIVES), "positives")
    asked = positives.groupBy("anchor").agg(F.collect_set("score").alias("scores"))
    windowed = durable(anchors.join(asked, F.col("row") == F.col("anchor")).drop("anchor"), "anchors")
    negatives = heaps(rows, windowed, cut, width, negative_heaps, ["anchor", "window"], NEGATIVES)
    names = windowed.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    chosen = positives.select("anchor", F.col("score").alias("window"), F.col("vec_id").alias("positive_id"))
    out = chosen.join(negatives.withColumnRenamed("vec_id", "negative_id"), ["anchor", "window"]).join(names, "anchor")
    return out.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        F.col("window").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
