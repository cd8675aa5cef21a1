"""Mixing sources to target weights by a low-discrepancy schedule.

Slots of the mix are numbered; slot ``i`` goes to the point ``frac(i * golden ratio)`` (kept as a 32-bit whole
number), and the source whose interval of cumulative target weights holds the point gives the slot its next block.
Blocks are cut from each source's shuffled documents, laid end to end, every block with the same number of words
(the last one of a source may be shorter). Slots are ranked within their source; the rank, modulo the number of
blocks, is the block it takes, so a source runs through all its blocks before it repeats one.

A source whose target is worth fewer than ``MIN_SLOTS / FEW_PART`` blocks would miss it by whole blocks, so it is cut
into blocks of one word: its target, to the nearest word, is the number of its slots, and the turns of its words follow
from that number alone. The slots of the mix that fall into its interval stand for these and take no block themselves.

Nothing is ranked or summed over a whole source in one task: slots are numbered within runs of ``RUN`` slots,
documents within buckets of about ``BUCKET`` documents of their hash, and only the runs' and buckets' totals are
summed in order. Only DataFrame functions are used.

Defined cases: a null or blank text has size 0 and is never taken; a null source is a source of its own, ordered
last; repeated rows are documents of their own; if all sizes are 0 all targets are 0; an empty table gives an empty
result. A source takes no block a third time, so no document exceeds twice its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import durable, n_words

#: Fixed values of the mix: weights by position of the source, share of all sizes, most times a source is repeated.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
#: Slots for each document (so a block is a part of a typical document), and the least number of slots.
SLOTS_PER_DOC = 2
MIN_SLOTS = 1 << 16
RUN = 1 << 12
#: A source with a target of fewer than the ``MIN_SLOTS / FEW_PART`` blocks of the mix is cut into single words.
FEW_PART = 1 << 8
BUCKET = 4096
#: The golden ratio's fraction times 2^32, and the bits of a point that name its cell.
GOLDEN = 2654435769
CELL = 1 << 20


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, place``: place is the hash that shuffles a source's documents."""
    return docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("place")
    )


def targets(sizes: DataFrame) -> DataFrame:
    """One row for each source: ``source, sid, docs, source_size, target`` and its interval ``low, high`` of points.

    Shares that exceed a source's limit are cut to it and given to the others by weight, until none exceeds. What
    stays below its limit is in proportion to its weight by one common factor, so sorting sources by limit over
    weight finds the factor: those before the first one it suits are at their limits.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ordered = by_source.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    weight = F.element_at(F.lit(list(WEIGHTS)), F.pmod(F.col("sid") - 1, F.lit(len(WEIGHTS))).cast("int") + 1)
    limit = F.col("source_size").cast("double") * REPEATS
    rows = ordered.withColumn("weight", weight.cast("double")).withColumn("limit", limit)
    fill = W.orderBy(F.col("limit") / F.col("weight"), "sid")
    before, after = fill.rowsBetween(W.unboundedPreceding, -1), fill.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy()
    rows = rows.withColumn("mix", F.sum("source_size").over(whole) * SHARE)
    left = F.col("mix") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rows = rows.withColumn("factor", left / F.sum("weight").over(after))
    rows = rows.withColumn("free", F.col("factor") * F.col("weight") <= F.col("limit"))
    factor = F.min(F.when(F.col("free"), F.struct(F.col("limit") / F.col("weight"), F.col("sid"), F.col("factor").alias("f"))))
    rows = rows.withColumn("common", factor.over(whole).getField("f"))
    target = F.least("limit", F.coalesce(F.col("common") * F.col("weight"), F.col("limit")))
    rows = rows.withColumn("target", F.when(F.col("mix") > 0, target).otherwise(F.lit(0.0)))
    upto = F.sum("target").over(W.orderBy("sid").rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("upto", upto).withColumn("all", F.sum("target").over(whole))
    point = lambda c: F.coalesce(F.floor(F.least(c / F.nullif(F.col("all"), F.lit(0.0)), F.lit(1.0)) * float(1 << 32)), F.lit(0))
    rows = rows.withColumn("high", point(F.col("upto")).cast("long"))
    low = F.coalesce(F.lag("high").over(W.orderBy("sid")), F.lit(0).cast("long"))
    return rows.select("source", "sid", "docs", "source_size", "target", low.alias("low"), "high", "mix")


def point(i: Column) -> Column:
    """``frac(i * golden ratio)`` as a whole number below 2^32, without a product that leaves 64 bits."""
    upper = F.pmod(F.floor(i / F.lit(1 << 16)), F.lit(1 << 16)) * GOLDEN
    lower = F.pmod(i, F.lit(1 << 16)) * GOLDEN
    return F.pmod(F.pmod(upper, F.lit(1 << 16)) * (1 << 16) + lower, F.lit(1 << 32))


def is_small(target: Column, block: int) -> Column:
    return target < float(MIN_SLOTS // FEW_PART * block)


def schedule(sources: DataFrame, n_slots: int, block: int) -> DataFrame:
    """``slot, sid, rank, block, turn``: which block of which source each slot of the mix takes, but small sources."""
    spark = sources.sparkSession
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), point(F.col("id")).alias("point"))
    slots = slots.withColumn("cell", F.floor(F.col("point") / CELL)).withColumn("run", F.floor(F.col("slot") / RUN))
    held = sources.where((F.col("high") > F.col("low")) & ~is_small(F.col("target"), block)).withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / CELL), F.floor((F.col("high") - 1) / CELL)))
    )
    n_blocks = F.ceil(F.col("source_size") / block)
    held = held.select("cell", "low", "high", "sid", n_blocks.alias("n_blocks"))
    given = slots.join(held, "cell").where("point >= low AND point < high").select("slot", "run", "sid", "n_blocks")
    run = W.partitionBy("sid", "run")
    given = given.withColumn("rank_in_run", F.row_number().over(run.orderBy("slot")) - 1)
    runs = given.groupBy("sid", "run").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(W.partitionBy("sid").orderBy("run").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select("sid", "run", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    ranked = given.join(runs, ["sid", "run"]).withColumn("rank", F.col("earlier") + F.col("rank_in_run"))
    ranked = ranked.withColumn("turn", F.floor(F.col("rank") / F.col("n_blocks")))
    return ranked.where(F.col("turn") < REPEATS).select(
        "slot", "sid", "rank", F.pmod("rank", "n_blocks").alias("block"), "turn"
    )


def taken_blocks(slots: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """``sid, block, turns, earlier``: how often each block is taken, and the words taken from blocks before it."""
    sizes = sources.select("sid", "source_size")
    blocks = slots.groupBy("sid", "block").agg(F.count("*").alias("turns")).join(sizes, "sid")
    length = F.least(F.lit(block).cast("long"), F.col("source_size") - F.col("block") * block)
    blocks = blocks.withColumn("words", F.col("turns") * length).withColumn("run", F.floor(F.col("block") / RUN))
    runs = blocks.groupBy("sid", "run").agg(F.sum("words").alias("run_words"))
    before_run = F.sum("run_words").over(W.partitionBy("sid").orderBy("run").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select("sid", "run", F.coalesce(before_run, F.lit(0)).alias("before_run"))
    in_run = F.sum("words").over(W.partitionBy("sid", "run").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    blocks = blocks.withColumn("in_run", F.coalesce(in_run, F.lit(0))).join(runs, ["sid", "run"])
    return blocks.select("sid", "block", "turns", "words", (F.col("before_run") + F.col("in_run")).alias("earlier"))


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with ``sid, source_size, target`` and the words ``begin`` to ``finish`` they hold in their source."""
    named = sources.select(F.col("source").alias("named"), "sid", "docs", "source_size", "target")
    docs = sizes.join(named, F.col("source").eqNullSafe(F.col("named")))
    spread = F.shiftrightunsigned("place", 11).cast("double") / float(1 << 53)
    docs = docs.withColumn("bucket", F.floor(spread * F.ceil(F.col("docs") / BUCKET)))
    buckets = docs.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    earlier = F.sum("words").over(W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    buckets = buckets.select("sid", "bucket", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    inside = W.partitionBy("sid", "bucket").orderBy("place", "doc_id", "size")
    docs = docs.withColumn("upto", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    docs = docs.join(buckets, ["sid", "bucket"]).withColumn("finish", F.col("earlier") + F.col("upto"))
    return docs.select(
        "doc_id", "place", "size", "sid", "source_size", "target", (F.col("finish") - F.col("size")).alias("begin"), "finish"
    )


def words_taken(at: Column, slots: Column) -> Column:
    """Words taken before word ``at`` of a source whose ``slots`` slots take one word each, in order and again."""
    turns = F.floor(slots / F.nullif(F.col("source_size"), F.lit(0)))
    return turns * at + F.least(at, slots - turns * F.col("source_size"))


def mix(docs: DataFrame) -> DataFrame:
    """One row for each document: ``doc_id, place, size, source_size, target, taken`` (words, repeats counted)."""
    sizes = durable(sized(docs), "sizes")
    sources = durable(targets(sizes), "sources")
    total = sources.agg(F.sum("docs").alias("docs"), F.max("mix").alias("mix")).first()
    n_docs, wanted = total["docs"] or 0, total["mix"] or 0.0
    n_slots = max(MIN_SLOTS, SLOTS_PER_DOC * n_docs)
    block = max(1, -int(-wanted // n_slots))
    slots = schedule(sources, -int(-wanted // block), block)
    blocks = durable(taken_blocks(slots, sources, block), "blocks")
    all_taken = blocks.groupBy("sid").agg(F.sum("words").alias("all_taken"))
    where = placed(sizes, sources).join(all_taken, "sid", "left")
    for end in ("begin", "finish"):
        at = blocks.select(
            "sid", F.col("block").alias(f"{end}_block"), F.col("turns").alias(f"{end}_turns"), F.col("earlier").alias(f"{end}_earlier")
        )
        where = where.withColumn(f"{end}_block", F.floor(F.col(end) / block)).join(at, ["sid", f"{end}_block"], "left")
        part = F.col(f"{end}_turns") * (F.col(end) - F.col(f"{end}_block") * block)
        words = F.coalesce(F.col(f"{end}_earlier") + part, F.col("all_taken"), F.lit(0))
        where = where.withColumn(f"{end}_taken", words)
        where = where.withColumn(f"{end}_words", words_taken(F.col(end), F.round("target").cast("long")))
    small = is_small(F.col("target"), block)
    of = lambda end: F.when(small, F.col(f"{end}_words")).otherwise(F.col(f"{end}_taken"))
    taken = F.when(F.col("size") > 0, of("finish") - of("begin")).otherwise(0).cast("long")
    return where.select("doc_id", "place", "size", "source_size", "target", taken.alias("taken"))


def repeated(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each as often as the mix takes it, to the nearest whole number; columns unchanged."""
    columns = docs.columns
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    chosen = mix(docs).where("size > 0").select(F.col("doc_id").alias("m_id"), F.col("place").alias("m_place"), times.alias("times"))
    chosen = durable(chosen.where("times > 0"), "mixed").groupBy("m_id", "m_place").agg(F.sum("times").alias("m_times"), F.count("*").alias("m_rows"))
    keyed = docs.select(*columns, F.xxhash64("doc_id", "text").alias("m_at"))
    joined = keyed.join(chosen, F.col("m_at").eqNullSafe(F.col("m_place")) & F.col("doc_id").eqNullSafe(F.col("m_id")))
    copies = F.greatest(F.round(F.col("m_times") / F.col("m_rows")).cast("int"), F.lit(1))
    return joined.select(*columns, F.explode(F.sequence(F.lit(1), copies)).alias("m_copy")).select(columns)
