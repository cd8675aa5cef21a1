"""Exact duplicates by an extendible-hash index on shared files.

Texts are equal if they are the same bytes after lower-casing A-Z. Each document gives one slim entry: a row number,
its key, the 64-bit hash of its normalised text and that text's digest. Entries of one hash form a chain; chains are
combined within tasks before they are shuffled, so a text with any number of copies reaches its owner as one row a task.

**Directory.** Buckets are the leading bits of the hash. They start at the depth that holds all chains at ``CAPACITY``
a bucket on average; a bucket that is overfull splits by its next bit, which doubles the directory where its depth was
the whole one. Only chains of overfull buckets are looked at again. Distinct hashes always split apart in the end.

**Index.** Chains look up their bucket and are written by owner tasks: each owns a range of buckets and with it a range
of hashes, and writes its file in the order of bucket and hash. Files of owners do not overlap, so a later lookup reads
one of them.

**Chains.** Where a chain has several entries, their texts are read again and compared byte by byte, by grouping on the
text itself; equal texts are combined within tasks first. Different texts of one hash become different links of the
chain. Rows learn their link by hash and digest. Only DataFrame functions are used.

Defined cases: null text counts as empty; the row with the largest key stays; rows with a null key only stay where their
group has no key at all, then one of them does; of rows that repeat the largest key one stays; very long texts are
hashed and compared whole; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Chains a bucket holds, and chains an owner's file holds at most on average.
CAPACITY = 1 << 12
OWNED = 1 << 20
#: Repeated hashes are broadcast up to this many (8 bytes each); beyond, texts are shuffled to them.
SENT = 1 << 20
BITS = 64


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def prefix(h: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a hash, as a number."""
    return F.shiftrightunsigned(h, BITS - depth) if depth else F.lit(0).cast("long")


def directory(chains: DataFrame, n_chains: int, capacity: int) -> tuple[DataFrame, list[int]]:
    """Buckets ``prefix, depth, n`` that cover every hash of ``chains`` (``h``, distinct), and the depths in use."""
    depth = max(0, (max(n_chains, 1) - 1) // capacity).bit_length()
    settled, left, depths = None, chains.select("h"), []
    while True:
        buckets = left.groupBy(prefix(F.col("h"), depth).alias("prefix")).agg(F.count("*").alias("n"))
        buckets = durable(buckets.withColumn("depth", F.lit(depth)), "buckets")
        overfull = buckets.where(F.col("n") > capacity)
        fitting = buckets.where(F.col("n") <= capacity)
        settled = fitting if settled is None else settled.unionByName(fitting)
        depths.append(depth)
        if depth == BITS or overfull.isEmpty():
            return settled, depths
        at = prefix(F.col("h"), depth)
        left = left.withColumn("prefix", at).join(overfull.select("prefix"), "prefix", "left_semi").select("h")
        left = durable(left, "overfull")
        depth += 1


def looked_up(chains: DataFrame, buckets: DataFrame, depths: list[int]) -> DataFrame:
    """Chains with their bucket, named by its smallest hash, and its depth.

    A bucket above the directory's depth stands for several of its cells. These are not listed, as a crowded stretch of
    hashes would make them many: a chain asks at each depth in use, and one bucket answers.
    """
    asked = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), prefix(F.col("h"), d).alias("prefix")) for d in depths]))
    cells = chains.select("*", asked.alias("cell")).select("h", "n", "cell.depth", "cell.prefix")
    found = cells.join(buckets.select("depth", "prefix"), ["depth", "prefix"])
    first = F.expr(f"shiftleft(prefix, {BITS} - depth)")
    return found.select(first.alias("bucket"), "depth", "h", "n")


def index(chains: DataFrame, capacity: int = CAPACITY, owned: int = OWNED) -> DataFrame:
    """Chains ``h, n`` with their ``bucket, depth``, written by owners of key ranges in order of bucket and hash."""
    n_chains = chains.count()
    found = looked_up(chains, *directory(chains, n_chains, capacity))
    owners = max(1, -(-n_chains // owned))
    return durable(found.repartitionByRange(owners, "bucket").sortWithinPartitions("bucket", "h"), "index")


def links(docs: DataFrame, repeated: DataFrame, hashed: Callable[[Column], Column], sent: int = SENT) -> DataFrame:
    """The links of repeated chains: ``bucket, h, text_sha256, group_size, keep_id``, one for each different text."""
    texts = docs.select("doc_id", normalised(F.col("text")).alias("norm")).withColumn("h", hashed(F.col("norm")))
    wanted = repeated.select("bucket", "h")
    wanted = F.broadcast(wanted) if repeated.count() <= sent else wanted
    grouped = texts.join(wanted, "h").groupBy("bucket", "h", "norm")
    same = grouped.agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    return same.select("bucket", "h", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "group_size", "keep_id")


def dedup(
    docs: DataFrame,
    hashed: Callable[[Column], Column] = F.xxhash64,
    capacity: int = CAPACITY,
    owned: int = OWNED,
    sent: int = SENT,
) -> DataFrame:
    """One row for each document: ``doc_id, keep_id, group_size, kept, text_sha256, bucket, link``.

    ``link`` numbers the different texts of a hash; ``bucket`` is the chain's, named by its smallest hash. Both are
    null where a hash has one document only.
    """
    norm = normalised(F.col("text"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", norm.alias("norm"))
    digest = F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")
    entries = durable(rows.select("row", "doc_id", hashed(F.col("norm")).alias("h"), digest), "entries")
    chains = durable(entries.groupBy("h").agg(F.count("*").alias("n")), "chains")
    repeated = index(chains, capacity, owned).where(F.col("n") > 1)
    chained = links(docs, repeated, hashed, sent)
    chained = chained.withColumn("link", F.row_number().over(W.partitionBy("bucket", "h").orderBy("text_sha256")))
    chained = durable(chained, "links")
    found = entries.join(chained, ["h", "text_sha256"], "left")
    alone = F.col("group_size").isNull()
    chosen = alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # Several rows of a group may repeat the key that stays; the first of them does.
    several = durable(
        found.where(chosen & ~alone).groupBy("bucket", "h", "link").agg(F.min("row").alias("first"), F.count("*").alias("same")),
        "chosen",
    ).where("same > 1")
    kept = chosen
    if not several.isEmpty():
        found = found.join(several, ["bucket", "h", "link"], "left")
        kept = chosen & (F.col("first").isNull() | (F.col("row") == F.col("first")))
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        kept.alias("kept"),
        "text_sha256",
        "bucket",
        "link",
    )
