"""Quality rules with thresholds that adapt to each language and source.

Four base measures are taken from every whole text. From them come rates as whole numbers, whose distribution in
each (language, source) is kept as a mergeable quantile sketch: a histogram over a fixed grid of buckets that is
exact below 1,024 and keeps ten significant bits above (relative error under 0.2 %). Adding bucket counts merges
sketches, in any order and with the same result. Sketches are of the documents that pass the base rules.

Fences replace fixed cutoffs: an upper quantile of the group, and ``SPREAD`` times its distance from the median beyond
it (mirrored below for word lengths). ``GUARD`` only keeps a group of equal rates from judging by a single word. The
fence of a language is drawn towards that of all documents and that of a (language, source) towards its language's, as
if ``PRIOR`` documents spoke for the wider group: the pull fades smoothly as a group grows. Documents are joined with
the fences of their group and judged.

Defined cases: a null or empty text has no words and fails the base rules; null languages and sources form groups of
their own; a text of any length is measured whole; repeated rows count and are judged as often as they occur; columns
beside ``text, lang, source`` are carried in ``row`` whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import SPACE, annotate

#: Base rules, and the symbols that are counted.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Rates judged by an upper fence, with the quantile (in percent) it is taken from; and by a lower one.
UPPER = {"symbol_rate": 90, "dup_line_rate": 98, "repeat_rate": 98, "word_length": 90}
LOWER = {"word_length": 10}
#: Quantile distances between a quantile and its fence, a least distance in the rates' unit, documents of a prior.
SPREAD = 2
GUARD = 20
PRIOR = 200

MEASURES = T.StructType([
    T.StructField(name, T.LongType())
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
])


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words found at least twice in the list."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    codes = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    size = len(seen)
    windows = codes[:-1] * size + codes[1:]
    if size >= 2_000_000:  # three codes no longer fit into 64 bits
        windows = np.unique(windows, return_inverse=True)[1]
    windows = windows[:-1] * size + codes[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    found = np.zeros(len(windows), dtype=bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(found)] |= found
    return int(covered.sum())


def measures(text: str | None) -> tuple[int, ...]:
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
    )


def _measurer():
    def run(texts: list) -> list[pa.Array]:
        columns = zip(*map(measures, texts), strict=True) if texts else [[] for _ in MEASURES]
        return [pa.array(column, pa.int64()) for column in columns]

    return run


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns), ``lang``, ``source`` and the measures of each document."""
    columns = list(dict.fromkeys([*keep, "lang", "source"]))
    measured = annotate(docs, columns, "text", MEASURES, _measurer)
    rate = lambda part, whole, unit: F.when(
        F.col(whole) > 0, F.floor(F.col(part) * unit / F.col(whole)).cast("long")
    )
    return measured.select(
        F.struct(*[F.col(f"row.`{c}`") for c in keep]).alias("row"),
        F.col("row.lang").alias("lang"),
        F.col("row.source").alias("source"),
        *MEASURES.names,
        rate("n_symbols", "n_words", 1000).alias("symbol_rate"),
        rate("n_dup_lines", "n_lines", 1000).alias("dup_line_rate"),
        rate("n_repeat_words", "n_words", 1000).alias("repeat_rate"),
        rate("word_chars", "n_words", 100).alias("word_length"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def bucket(value: Column) -> Column:
    """The sketch's bucket of a whole number: its ten highest bits, as the smallest number that has them."""
    spare = F.greatest(F.length(F.bin(value)) - 10, F.lit(0))
    size = F.call_function("shiftleft", F.lit(1).cast("long"), spare)
    return value - F.pmod(value, size)


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, rate, bucket, n``: the sketch of each rate in each group. Sketches merge by adding ``n``."""
    rates = [F.struct(F.lit(r).alias("rate"), bucket(F.col(r)).alias("bucket")) for r in UPPER]
    return (
        measured.where(~base_failed())
        .select("lang", "source", F.inline(F.array(*rates)))
        .groupBy("lang", "source", "rate", "bucket")
        .agg(F.count("*").alias("n"))
    )


def levels() -> Column:
    """The groups a (lang, source) belongs to: itself, its language, all documents."""
    none = F.lit(None).cast("string")
    keys = [(2, F.col("lang"), F.col("source")), (1, F.col("lang"), none), (0, none, none)]
    return F.array(*[F.struct(F.lit(i).alias("level"), x.alias("l"), s.alias("s")) for i, x, s in keys])


def fences(sketch: DataFrame) -> DataFrame:
    """One row for each (f_lang, f_source) of the sketches, with ``<rate>_high`` and ``<rate>_low``."""
    merged = (
        sketch.select("rate", "bucket", "n", F.inline(levels()))
        .groupBy("level", "l", "s", "rate", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    group = W.partitionBy("level", "l", "s", "rate")  # a group has no more rows than the grid has buckets
    quantile = lambda q: F.min(F.when(F.col("below") * 100 >= F.col("total") * q, F.col("bucket")))
    tail = lambda of: F.coalesce(*[F.when(F.col("rate") == r, F.lit(q)) for r, q in of.items()])
    quantiles = (
        merged.withColumn("below", F.sum("n").over(group.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("total", F.sum("n").over(group))
        .groupBy("level", "l", "s", "rate")
        .agg(
            F.max("total").alias("total"),
            quantile(50).alias("middle"),
            quantile(tail(UPPER)).alias("upper"),
            quantile(tail(LOWER)).alias("lower"),
        )
    )
    high = F.col("upper") + (F.col("upper") - F.col("middle")) * SPREAD + GUARD
    low = F.greatest(F.col("lower") - (F.col("middle") - F.col("lower")) * SPREAD - GUARD, F.lit(0))
    limits = {f"{r}_high": F.max(F.when(F.col("rate") == r, high)) for r in UPPER}
    limits |= {f"{r}_low": F.max(F.when(F.col("rate") == r, low)) for r in LOWER}
    own = F.struct(F.max("total").alias("total"), *[limit.alias(name) for name, limit in limits.items()])
    known = quantiles.groupBy("level", "l", "s").agg(own.alias("own"))
    asked = sketch.select("lang", "source").distinct()
    asked = asked.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), F.inline(levels()))
    found = (
        asked.join(known, [asked[c].eqNullSafe(known[c]) for c in ("level", "l", "s")])
        .groupBy("f_lang", "f_source")
        .agg(*[F.max(F.when(known["level"] == i, F.col("own"))).alias(f"of_{i}") for i in range(3)])
    )

    def drawn(name: str) -> Column:
        limit = F.col(f"of_0.{name}")
        for i in (1, 2):
            total = F.col(f"of_{i}.total")
            limit = F.call_function("div", total * F.col(f"of_{i}.{name}") + PRIOR * limit, total + PRIOR)
        return limit.alias(name)

    return found.select("f_lang", "f_source", *map(drawn, limits))


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``, from the fences of each document's group."""
    inside = F.lit(True)
    for r in UPPER:
        inside = inside & (F.col(r) <= F.col(f"{r}_high"))
    for r in LOWER:
        inside = inside & (F.col(r) >= F.col(f"{r}_low"))
    joined = measured.join(
        limits, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left"
    )
    verdict = ~base_failed() & F.coalesce(inside, F.lit(False))
    return joined.select(*[joined[c] for c in measured.columns], base_failed().alias("base_failed"), verdict.alias("kept"))
