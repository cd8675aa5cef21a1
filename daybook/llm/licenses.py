"""License scans: base phrases by word position, and an exact set-similarity join of text blocks with templates.

A block is a window of words of the whole text, across its lines, seen as its set of words. Windows overlap by half and
are twice as long as the step of a template's size (16 or 32 words), so a notice of that size lies wholly in one of them
wherever its lines end, and words scattered over a long line do not meet. A block holds a template if at least
``CONTAINMENT`` of the template's words are among them, and all of its deciding words, which tell it from the other
licenses. Words are ordered by how many blocks hold them over the whole corpus, rarest first;
a template that is contained shares with the block one of its first ``|T| - need + 1`` words (prefix), the block has
at least ``need`` words of the templates' vocabulary (length), and a match at positions i and j leaves room for the
rest (position). Candidates that pass are verified by intersecting the sets, so the join is exact. Only words that
occur in some template can match, so all others are left out of the sets; blocks that fail the length filter, or hold no
template's deciding words, are dropped while the text is scanned. Only DataFrame functions are used; the templates (fixed values) are the one small
side. A row of the join is a block, so no word, however frequent, gathers rows in one place.

Defined cases: a null or empty text has no words, no labels and score 0; null keys and repeated rows keep a row
each; ties cannot occur, as all labels of a document are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import durable

#: The base phrases with their labels, and the templates with theirs.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Label, deciding words, text.
TEMPLATES = [
    ("gpl", "gnu", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gnu", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                   "general public license as published by the free software foundation"),
    ("apache", "apache", "licensed under the apache license version 2 0"),
    ("apache", "compliance copy", "you may not use this file except in compliance with the license you may obtain a copy of "
                                  "the license at"),
    ("cc-by-nc", "cc nc", "licensed under cc by nc 4 0"),
    ("cc-by", "creative commons attribution", "this work is licensed under a creative commons attribution 4 0 international "
                                              "license"),
    ("mit", "mit", "released under the mit license"),
    ("mit", "permission granted copy", "permission is hereby granted free of charge to any person obtaining a copy of this "
                                       "software and associated documentation files"),
    ("bsd", "redistribution source binary", "redistribution and use in source and binary forms with or without modification "
                                            "are permitted provided that the following conditions are met"),
    ("mpl", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
CONTAINMENT = 0.8
#: Steps between windows; a template belongs to the first that is no shorter than its text.
STEPS = (16, 32)
#: A word: ASCII letters and digits, and whatever is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def need(n_words: int) -> int:
    """The least number of a template's words that a block must hold."""
    return -int(-(CONTAINMENT * n_words) // 1)


def step(text: str) -> int:
    """The step between the windows in which a template is looked for."""
    return next(size for size in STEPS if size >= len(text.split()))


def template_sets() -> list[tuple[int, str, int, list[str], list[str]]]:
    """Number, label, step, deciding words and set of words of each template."""
    return [(i, label, step(text), must.split(), sorted(set(text.split()))) for i, (label, must, text) in enumerate(TEMPLATES)]


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0))


def starts(tokens: Column, phrase: str) -> Column:
    """Where in an array of words the phrase's words stand one after the other, counted from 0."""
    wanted = phrase.split()
    last = F.size(tokens) - len(wanted)

    def here(i: Column) -> Column:
        found = F.lit(True)
        for k, word in enumerate(wanted):
            found = found & (F.get(tokens, i + k) == word)
        return found

    places = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
    return F.when(last >= 0, F.filter(places, here)).otherwise(F.array().cast("array<int>"))


def windows(tokens: Column, size: int) -> Column:
    """Windows of ``2 * size`` words, ``size`` apart, as sets of template words, where a template of that size may be."""
    mine = [(must, t) for _, _, s, must, t in template_sets() if s == size]
    vocabulary = F.lit(sorted({w for _, t in mine for w in t}))
    least = min(need(len(t)) for _, t in mine)
    begins = F.sequence(F.lit(0), F.greatest(F.size(tokens) - 1, F.lit(0)), F.lit(size))
    held = F.transform(begins, lambda i: F.array_intersect(F.slice(tokens, i + 1, 2 * size), vocabulary))

    def decided(block: Column) -> Column:
        found = F.lit(False)
        for must, _ in mine:
            found = found | F.array_contains(block, must[0])
        return (F.size(block) >= least) & found

    return F.transform(F.filter(held, decided), lambda block: F.struct(F.lit(size).alias("step"), block.alias("held")))


def scanned(docs: DataFrame) -> DataFrame:
    """Of each document: key, number of words, base places and labels, and the blocks long enough for a template."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64("text").alias("text_key"))
    # A text with none of these as a substring, in any case, holds no phrase and no deciding word; the words themselves are cut only then.
    deciding = sorted({must[0] for _, _, _, must, _ in template_sets()})
    hint = F.col("text").rlike("(?i)license|cc[^a-z0-9]+by|" + "|".join(deciding))
    rows = rows.withColumn("n_words", F.regexp_count("text", F.lit(WORD)).cast("long"))
    rows = rows.withColumn("tokens", F.when(hint, words(F.col("text"))).otherwise(F.array().cast("array<string>")))
    found = {p: starts(F.col("tokens"), p) for p in PHRASES}
    rows = rows.select("*", *[places.alias(f"at_{i}") for i, places in enumerate(found.values())])
    labels = [F.when(F.size(f"at_{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())]
    places = F.concat(*[F.col(f"at_{i}") for i in range(len(PHRASES))])
    kinds = [windows(F.col("tokens"), size) for size in STEPS]
    return rows.select(
        "doc_id",
        "text_key",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"),
        F.concat(*kinds).alias("blocks"),
    )


def contained(blocks: DataFrame) -> DataFrame:
    """``block_id, label, containment`` of every block (``block_id, step, held``: its set of words) and template it holds."""
    spark = blocks.sparkSession
    listed = [(i, label, size, must, word, len(t), need(len(t))) for i, label, size, must, t in template_sets() for word in t]
    wanted = spark.createDataFrame(
        listed, "template int, label string, t_step int, must array<string>, word string, size int, need int"
    )
    # How many blocks hold each word, over all blocks: at most one row for each word of the templates.
    frequency = blocks.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    ranked = wanted.join(frequency, "word", "left").withColumn("order", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word"))
    of_template = ranked.groupBy("template", "label", "t_step", "must", "size", "need").agg(F.sort_array(F.collect_list("order")).alias("ordered"))
    prefix = of_template.withColumn("ordered", F.col("ordered.word")).select(
        "template", "label", "t_step", "must", "size", "need", F.col("ordered").alias("all"), F.posexplode("ordered").alias("i", "word")
    )
    prefix = prefix.where("i <= size - need")
    order = F.map_from_entries(F.collect_list(F.struct("word", F.col("order.n"))))
    counts = ranked.select("word", "order").distinct().agg(order.alias("counts"))
    keyed = blocks.join(F.broadcast(counts))  # one row
    sorted_words = F.array_sort(
        F.transform("held", lambda w: F.struct(F.element_at("counts", w).alias("n"), w.alias("word")))
    )
    mine = keyed.select("block_id", "step", sorted_words["word"].alias("held"))
    probes = mine.select("block_id", "step", "held", F.posexplode("held").alias("j", "word"))
    room = F.least(F.col("size") - F.col("i"), F.size("held") - F.col("j"))
    candidates = (
        probes.join(F.broadcast(prefix), "word")  # at most the words of all templates
        .where((F.col("step") == F.col("t_step")) & (F.size("held") >= F.col("need")) & (room + F.least("i", "j") >= F.col("need")))
        .where(F.size(F.array_except("must", "held")) == 0)
        .select("block_id", "template", "label", "size", "need", "all", "held")
    )
    overlap = F.size(F.array_intersect("all", "held"))
    verified = candidates.withColumn("overlap", overlap).where("overlap >= need")
    return verified.select("block_id", "label", (F.col("overlap") / F.col("size")).alias("containment")).distinct()


def scan(docs: DataFrame) -> DataFrame:
    """One row for each document: counts, places, ``base_labels``, ``labels`` and ``score``.

    ``score`` is 1 where a base phrase stands, else the highest containment of a template in one of its blocks.
    """
    rows = durable(scanned(docs), "licenses")
    one = rows.where(F.size("blocks") > 0).select("doc_id", "text_key", "blocks").dropDuplicates(["doc_id", "text_key"])
    blocks = one.select(F.struct("doc_id", "text_key").alias("block_id"), F.inline("blocks"))
    blocks = durable(blocks.distinct(), "blocks")
    found = contained(blocks).groupBy("block_id").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("containment")
    )
    joined = rows.join(
        found,
        rows["doc_id"].eqNullSafe(found["block_id.doc_id"]) & (rows["text_key"] == found["block_id.text_key"]),
        "left",
    )
    none = F.array().cast("array<string>")
    joint = lambda *sets: F.array_join(F.array_sort(F.array_distinct(F.concat(*sets))), ",")
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0)))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        joint(F.col("base")).alias("base_labels"),
        joint(F.col("base"), F.coalesce("more", none)).alias("labels"),
        score.alias("score"),
    )
