"""Language identification by cross-parsing: the language whose text explains a document in the fewest phrases.

A suffix automaton is built for each language from a bounded sample of its labelled text. A document is parsed
greedily against each: a phrase is the longest piece, from where the last one ended, that occurs in the language's
text. The number of phrases times the logarithm of the sample's length, over the length of the document, estimates
the cross entropy; the language with the smallest value wins.

Case is folded, and every run of signs that are not letters is one space. Texts are parsed in segments of
``SEGMENT`` signs, all segments of a batch in step; a cut costs each language one phrase at most. Every letter of the
samples is a sign of its own and transitions are kept sparse, in a hash table of state and sign, so the alphabet of
all scripts together has no bound; a letter that a language's sample lacks is a miss there. The sample is ``SAMPLE_DOCS`` documents of each language, smallest hash of the key first, a slice of each; the
samples of all languages together are bounded by ``SAMPLE_SIGNS``, whatever the size of the corpus.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text if no language was
learnt; ties go to the language with the most labelled documents; null languages and keys are never learnt from; repeated rows keep
a row each.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import annotate, durable, held_out

UNKNOWN = "und"
SAMPLE_DOCS = 64
SLICE = 500
#: Signs of sample text kept of one language, and of all languages together.
LANGUAGE_SIGNS = 24_000
SAMPLE_SIGNS = 600_000
SEGMENT = 2048
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def folded(text: str) -> str:
    """Letters in lower case; each run of other signs as one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def sample(docs: DataFrame, folds: int, fold: int) -> dict[str, str]:
    """Sample text of each language, from documents outside the held-out fold. Bounded, so it may be collected."""
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    usable = usable & ~held_out(F.col("doc_id"), folds, fold)
    place = F.xxhash64("doc_id")
    first = W.partitionBy("lang").orderBy(place, "doc_id")
    picked = docs.where(usable).select("doc_id", "lang", F.row_number().over(first).alias("nth"))
    picked = durable(picked.where(F.col("nth") <= SAMPLE_DOCS), "picked")
    keys = F.broadcast(picked.select("doc_id").distinct())  # SAMPLE_DOCS for each language at most
    begin = F.pmod(place, F.greatest(F.length("text") - SLICE, F.lit(1))).cast("int") + 1
    slices = docs.where(usable).join(keys, "doc_id", "left_semi")
    slices = slices.select("lang", F.col("text").substr(begin, F.lit(SLICE)).alias("slice"), place.alias("place"))
    top = W.partitionBy("lang").orderBy("place", "slice")
    slices = slices.withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= SAMPLE_DOCS)
    gathered: dict[str, list[str]] = {}
    for row in slices.orderBy("lang", "nth").collect():
        gathered.setdefault(row["lang"], []).append(folded(row["slice"]))
    limit = min(LANGUAGE_SIGNS, SAMPLE_SIGNS // max(len(gathered), 1))
    joined = {lang: " ".join(filter(None, parts))[:limit] for lang, parts in gathered.items()}
    counts = docs.where(usable).groupBy("lang").count().collect()  # one row for each language
    common_first = sorted((-row["count"], row["lang"]) for row in counts)
    return {lang: joined[lang] for _, lang in common_first if joined.get(lang)}


def suffix_automaton(signs: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring of ``signs``; state 0 is the start."""
    following: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for sign in signs:
        current = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state != -1 and sign not in following[state]:
            following[state][sign] = current
            state = link[state]
        if state != -1:
            target = following[state][sign]
            if length[target] == length[state] + 1:
                link[current] = target
            else:
                clone = len(following)
                following.append(dict(following[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                link[target] = link[current] = clone
                while state != -1 and following[state].get(sign) == target:
                    following[state][sign] = clone
                    state = link[state]
        last = current
    return following


class Edges:
    """Targets by key (a state and a sign in one number) as a hash table with linear probing, at most half full."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray) -> None:
        bits = max((2 * len(keys)).bit_length(), 1)
        self.shift = np.uint64(64 - bits)
        self.last = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.targets = np.full(1 << bits, -1, dtype=np.int64)
        place, left = self.place(keys), np.arange(len(keys))
        while len(left):
            open_ = left[self.keys[place[left]] < 0]
            put = open_[np.unique(place[open_], return_index=True)[1]]
            self.keys[place[put]] = keys[put]
            self.targets[place[put]] = targets[put]
            left = left[self.keys[place[left]] != keys[left]]
            place[left] = (place[left] + 1) & self.last

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _GOLDEN) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The target of each key, -1 if there is none."""
        at = self.place(keys)
        held = self.keys.take(at)
        found = np.where(held == keys, self.targets.take(at), -1)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            at[left] = next_ = (at[left] + 1) & self.last
            held, wanted = self.keys.take(next_), keys[left]
            same = held == wanted
            found[left[same]] = self.targets.take(next_[same])
            left = left[~same & (held >= 0)]
        return found


class Parser:
    """Automata of all languages in one table, and phrase counts of texts against each. Ties go to the first."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.languages = list(samples)
        known = sorted({sign for text in samples.values() for sign in text if sign != " "})
        size = len(known) + 2  # a space is 0, a letter that no sample holds 1
        codes = {sign: i + 2 for i, sign in enumerate(known)} | {" ": 0}
        self.code_of = alphabet().astype(np.int32)
        self.code_of[[ord(sign) for sign in known]] = np.arange(2, size)
        keys, targets, roots, starts, offset = [], [], [], [], 0
        for language in self.languages:
            following = suffix_automaton([codes[c] for c in samples[language]])
            for state, edges in enumerate(following, offset):
                keys += [state * size + sign for sign in edges]
                targets += [(offset + target) * size for target in edges.values()]
            roots.append(offset * size)
            starts.append((offset + len(following)) * size)  # a state without transitions lies between phrases
            offset += len(following) + 1
        self.edges = Edges(np.array(keys, dtype=np.int64), np.array(targets, dtype=np.int64))
        self.roots = np.array(roots, dtype=np.int64)
        self.starts = np.array(starts, dtype=np.int64)
        self.weight = np.array([math.log2(len(samples[x]) + 1) for x in self.languages])

    def codes(self, text: str) -> np.ndarray:
        """The signs of a text as codes, runs of spaces as one, none at the ends."""
        found = self.code_of[np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)]
        space = found == 0
        keep = ~space
        keep[1:] |= keep[:-1]  # a space stays where it follows a letter
        found = found[keep]
        return found[:-1] if len(found) and found[-1] == 0 else found

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text in each language."""
        total = np.zeros((len(self.languages), len(texts)), dtype=np.int64)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        if not lengths.sum() or not self.languages:
            return total
        flat = np.concatenate(texts)
        begins = np.cumsum(lengths) - lengths
        n_segments = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), n_segments)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_segments) - n_segments, n_segments)
        begin = begins[owner] + nth * SEGMENT
        length = np.minimum(lengths[owner] - nth * SEGMENT, SEGMENT)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        state = np.repeat(self.starts[:, None], len(owner), axis=1)
        found = np.zeros(state.shape, dtype=np.int32)
        language = np.repeat(np.arange(len(self.languages)), len(owner)).reshape(state.shape)
        active = np.searchsorted(-length, -np.arange(length[0]), side="left")  # segments longer than each step
        for step in range(int(length[0])):
            n = active[step]
            signs = flat.take(begin[:n] + step)
            reached = self.edges.find((state[:, :n] + signs).ravel())
            missed = np.flatnonzero(reached < 0)
            of, nth = language[:, :n].ravel()[missed], missed % n
            again = self.edges.find(self.roots[of] + signs[nth])
            reached[missed] = np.where(again >= 0, again, self.starts[of])
            found[of, nth] += 1
            state[:, :n] = reached.reshape(-1, n)
        for i in range(len(self.languages)):
            total[i] = np.bincount(owner, weights=found[i], minlength=len(texts))
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        codes = [self.codes(t) if t else np.empty(0, dtype=np.int32) for t in texts]
        found = self.phrases(codes)
        names, scores = [], []
        for i, code in enumerate(codes):
            if not len(code) or not self.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            cost = found[:, i] * self.weight / len(code)
            best = int(np.argmin(cost))
            rest = np.delete(cost, best)
            names.append(self.languages[best])
            scores.append(float(1.0 - cost[best] / rest.min()) if len(rest) else 1.0)
        return names, scores


@cache
def alphabet() -> np.ndarray:
    """For every code point 0 or, if it is a letter, 1."""
    letters = np.zeros(0x110000, dtype=np.uint8)
    letters[[i for i in range(0x110000) if chr(i).isalpha()]] = 1
    return letters


def identify(docs: DataFrame, folds: int, fold: int) -> DataFrame:
    """One row for each document: ``doc_id, held_out, lang_pred, score`` (how far the best is ahead of the next)."""
    shared = docs.sparkSession.sparkContext.broadcast(sample(docs, folds, fold))  # at most SAMPLE_SIGNS signs
    outputs = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def make():
        parser = parser_of(tuple(shared.value.items()))

        def run(texts: list) -> list[pa.Array]:
            names, scores = parser.predict(texts)
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return run

    scored = annotate(docs, ["doc_id"], "text", outputs, make)
    key = F.col("row.doc_id")
    return scored.select(key.alias("doc_id"), held_out(key, folds, fold).alias("held_out"), "lang_pred", "score")


_PARSERS: dict[tuple, Parser] = {}


def parser_of(samples: tuple[tuple[str, str], ...]) -> Parser:
    """The parser of these samples, built once in each Python worker; only the last one is kept."""
    if samples not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[samples] = Parser(dict(samples))
    return _PARSERS[samples]
