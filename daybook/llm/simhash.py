"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius. Two fingerprints within the radius have a
variant in common, so a shuffle on variants brings them together. At most ``1 + 64`` distinct fingerprints can
share a variant when half the radius is 1 (copies of a text share one fingerprint, which is emitted once), so no
bucket grows with the data. Within a bucket neighbours in order are paired, deduplicated and verified by bit count;
as any two fingerprints of a bucket are within the radius of each other, the chain connects what all pairs would.

Defined cases: a null, empty or blank text has fingerprint 0, linked like any other; rows whose key is null are
linked, but a group's smallest key ignores nulls (null if it has none); repeated rows keep a row each.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import annotate, durable
from daybook.llm.graph import components

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Hashes whose bits are counted at once.
_BLOCK = 1 << 15


def shingles(words: list[bytes], length: int = SHINGLE) -> list[bytes]:
    """All runs of ``length`` words joined by a space, repeats included; the whole sequence if it is shorter."""
    if len(words) <= length:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*[words[i:] for i in range(length)], strict=False)))


def fingerprint(text: str | None, length: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: a bit is set where more than half of the shingles' hashes have it."""
    if not text:
        return 0
    found = shingles(text.encode().lower().split(), length)  # lower() of bytes changes A-Z only
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(found), _BLOCK):
        block = found[begin : begin + _BLOCK]
        hashes = np.fromiter((digest(s, SEED) for s in block), dtype="<u8", count=len(block))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    set_bits = (counts * 2 > len(found)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def _fingerprinter(length: int):
    def make():
        return lambda texts: [pa.array([fingerprint(t, length) for t in texts], pa.int64())]

    return make


def fingerprints(docs: DataFrame, keep: list[str], length: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns in a struct ``row``, and the fingerprint ``fp`` of each whole text."""
    return annotate(docs, keep, "text", T.StructType([T.StructField("fp", T.LongType())]), _fingerprinter(length))


def masks(radius: int) -> list[int]:
    """Signed 64-bit masks of at most ``radius`` set bits."""
    chosen = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified pairs ``a < b`` of fingerprints (column ``fp``, distinct) that connect all within ``radius`` bits."""
    ball = masks((radius + 1) // 2)
    variants = distinct.select("fp", F.explode(F.lit(ball)).alias("mask"))
    variants = variants.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    before = F.lag("fp").over(W.partitionBy("variant").orderBy("fp"))
    pairs = variants.select(before.alias("a"), F.col("fp").alias("b")).where("a is not null").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def groups(prints: DataFrame, key: str, radius: int = RADIUS) -> DataFrame:
    """``fp, root, component_id`` for each distinct ``fp`` of ``prints``; ``key`` is the column minima are taken of."""
    distinct = durable(prints.groupBy("fp").agg(F.min(key).alias("least")), "fingerprints")
    roots = durable(components(durable(links(distinct.select("fp"), radius), "links")), "roots")
    linked = roots.withColumnRenamed("node", "fp").join(distinct, "fp")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "root").select("fp", "root", "component_id")
    alone = distinct.join(roots.select(F.col("node").alias("fp")), "fp", "left_anti")
    return linked.unionByName(alone.select("fp", F.xxhash64("fp").alias("root"), F.col("least").alias("component_id")))


def near_duplicates(docs: DataFrame, length: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row for each document: ``doc_id, fp, root, component_id``."""
    prints = durable(fingerprints(docs, ["doc_id"], length).select("row.doc_id", "fp"), "prints")
    return prints.join(durable(groups(prints, "doc_id", radius), "groups"), "fp")


def keep_one(docs: DataFrame, length: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents that stay: of each group the row with the smallest key, all columns as they are.

    A group whose rows have no key keeps one of them; of rows that repeat the smallest key one stays.
    """
    columns = docs.columns
    found = near_duplicates(docs, length, radius)
    first = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("copies"))
    first = durable(first, "kept")
    chosen = first.where("copies = 1").select("doc_id")
    kept = docs.join(chosen, "doc_id", "left_semi").select(columns)
    several = first.where("copies > 1").select("doc_id")
    if not several.isEmpty():  # texts are shuffled for them only if there are any
        kept = kept.unionByName(docs.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(columns))
    nameless = docs.where("doc_id is null")
    if nameless.isEmpty():
        return kept
    marked = fingerprints(nameless, columns, length).join(
        durable(groups_without_key(found), "nameless"), "fp"
    )
    return kept.unionByName(marked.dropDuplicates(["root"]).select("row.*"))


def groups_without_key(found: DataFrame) -> DataFrame:
    """``fp, root`` of the groups none of whose rows has a key."""
    return found.where("component_id is null").select("fp", "root").distinct()
