"""SentencePiece encoding and decoding with N-best segmentation.

A text is normalised as its vocabulary asks for (a space in front, every space written as U+2581) and segmented over
the lattice of all pieces that occur in it; signs that are no piece fall back to their UTF-8 bytes. Forward Viterbi
finds the best score of every prefix. These scores are exact heuristics for an A-star search from the end of the
text backwards, which therefore yields segmentations in order of score and expands no more than it must.

No piece goes on where U+2581 follows another sign, and some signs are in no piece but their own, so every
segmentation is cut there, and the search over a text is the search over its chunks: each distinct chunk is segmented once and remembered (a bounded memo, emptied when full).
The best N of a text replace chunks by their next best; only the N - 1 occurrences that lose least can take part. They are
given as what they change in the best one (``best_changes``: from which piece on, how many pieces, by which ids), so
N segmentations of a long text take little more room than one; ``nth_best`` writes one out.

Scores: the vocabulary at hand lists pieces by rank and has no probabilities, so a piece of rank r counts
``-log(r + 2)``, as frequencies of words fall with their rank; a byte counts ``BYTE_SCORE``. Where a vocabulary has
log-probabilities, ``ranked=False`` takes them as they are.

Defined cases: a null or empty text has no pieces and decodes to the empty text; U+2581 in a text decodes to a space, as the
vocabulary cannot tell them apart; ties go to the longer last piece, and among N-best to the earlier chunk; texts are
processed whole, however long; repeated rows keep a row each.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from daybook.llm.common import annotate

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
BYTE_SCORE = -12.0
SPACE = "▁"
#: Chunks remembered by a task, and signs of a text that are cut into chunks at once.
MEMO = 500_000
WINDOW = 1 << 20
#: Longest chunk that is segmented side by side with others, and how many at once.
SIDE_BY_SIDE = 40
ROWS = 20_000


class Trie:
    """All prefixes of pieces as states of one hash table, walked for many chunks at once."""

    def __init__(self, pieces: dict[str, tuple[int, float]]) -> None:
        self.longest = max(map(len, pieces), default=1)
        signs = sorted({c for p in pieces for c in p})
        self.code_of = np.zeros(0x110000, dtype=np.int64)
        self.code_of[[ord(c) for c in signs]] = np.arange(1, len(signs) + 1)
        self.width = len(signs) + 1
        states = {"": 0}
        for piece in pieces:
            for end in range(1, len(piece) + 1):
                states.setdefault(piece[:end], len(states))
        self.score = np.full(len(states), -np.inf)
        self.piece = np.full(len(states), -1, dtype=np.int64)
        for piece, (i, score) in pieces.items():
            self.score[states[piece]], self.piece[states[piece]] = score, i
        codes = self.code_of
        edges = [(states[p[:-1]] * self.width + int(codes[ord(p[-1])]), i) for p, i in states.items() if p]
        self.bits = max(4, (4 * len(edges)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.target = np.zeros(1 << self.bits, dtype=np.int64)
        if edges:
            keys, targets = (np.array(x, dtype=np.int64) for x in zip(*edges, strict=True))
            slot = self.slot(keys)
            while len(keys):  # of those that want a free slot the first gets it; the others try the next one
                free = self.keys[slot] == -1
                _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
                placed = np.zeros(len(keys), dtype=bool)
                placed[first] = True
                placed &= free
                self.keys[slot[placed]], self.target[slot[placed]] = keys[placed], targets[placed]
                keys, targets, slot = keys[~placed], targets[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The state each state reaches by a sign, -1 if none."""
        keys = states * self.width + codes
        slot = self.slot(keys)
        held = self.keys[slot]
        reached = np.where(held == keys, self.target[slot], -1)
        open_ = np.nonzero((held != keys) & (held != -1))[0]
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot[open_]]
            same = held == keys[open_]
            reached[open_[same]] = self.target[slot[open_[same]]]
            open_ = open_[~same & (held != -1)]
        return reached

    def segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward Viterbi of chunks whose signs are all pieces: ids of all in a row, their numbers, scores, gaps.

        The gap is what the second best segmentation loses, from the two best scores of every prefix.
        """
        lengths = np.array([len(c) for c in chunks], dtype=np.int64)
        n, wide = len(chunks), int(lengths.max())
        codes = np.zeros((n, wide), dtype=np.int64)
        signs = np.frombuffer("".join(chunks).encode("utf-32-le"), dtype=np.uint32)
        codes[np.arange(wide) < lengths[:, None]] = self.code_of[signs]
        best = np.full((n, wide + 1), -np.inf)
        second = np.full((n, wide + 1), -np.inf)
        back = np.zeros((n, wide + 1), dtype=np.int64)
        last = np.zeros((n, wide + 1), dtype=np.int64)
        best[:, 0] = 0.0
        for i in range(wide):
            rows = np.nonzero(lengths > i)[0]
            states = np.zeros(len(rows), dtype=np.int64)
            for j in range(i + 1, min(wide, i + self.longest) + 1):
                states = self.step(states, codes[rows, j - 1])
                alive = states >= 0
                rows, states = rows[alive], states[alive]
                if not len(rows):
                    break
                score = self.score[states]
                whole = np.isfinite(score)
                to, score, at = rows[whole], score[whole], states[whole]
                first, next_ = best[to, i] + score, second[to, i] + score
                known = best[to, j]
                better = first > known
                second[to, j] = np.maximum(np.maximum(second[to, j], next_), np.where(better, known, first))
                to, at = to[better], at[better]
                best[to, j], back[to, j], last[to, j] = first[better], i, self.piece[at]
        every = np.arange(n)
        end, steps = lengths.copy(), []
        while (going := end > 0).any():
            steps.append(np.where(going, last[every, end], -1))
            end = np.where(going, back[every, end], 0)
        ids = np.stack(steps[::-1], axis=1)
        used = ids >= 0
        gap = best[every, lengths] - second[every, lengths]
        return ids[used], used.sum(axis=1), best[every, lengths], gap


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with ids and scores, and the ids of the 256 bytes."""

    pieces: dict[str, tuple[int, float]]
    bytes_: tuple[int, ...]
    size: int

    @classmethod
    def load(cls, path: str = VOCABULARY, ranked: bool = True) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size, pieces, bytes_ = model.get_piece_size(), {}, {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                bytes_[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                score = model.get_score(i)
                pieces[piece] = i, -math.log(2.0 - score) if ranked else score
        return cls(pieces, tuple(bytes_[b] for b in range(256)), size)


class Segmenter:
    """Viterbi, A-star and whole-text encoding over one vocabulary."""

    def __init__(self, vocabulary: Vocabulary, n_best: int = N_BEST) -> None:
        self.vocabulary, self.n_best = vocabulary, n_best
        self.pieces = vocabulary.pieces
        self.longest = max(map(len, self.pieces), default=1)
        self.prefixes: dict[str, float] = {}  # of pieces; minus infinity where the prefix is no piece itself
        for piece, (_, score) in self.pieces.items():
            for end in range(1, len(piece)):
                self.prefixes.setdefault(piece[:end], -math.inf)
            self.prefixes[piece] = score
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces):
            raise ValueError("a piece goes on after a space that follows another sign; texts cannot be cut there")
        joined = set("".join(p for p in self.pieces if len(p) > 1)) - {SPACE}
        signs = re.escape("".join(sorted(joined))) or "\\Z"
        # A sign that is in no longer piece stands alone, so texts are cut on both sides of it.
        self.chunk = re.compile(f"{SPACE}*[{signs}]+|{SPACE}+|[^{signs}{SPACE}]")
        self.sound = [b""] * vocabulary.size
        for piece, (i, _) in self.pieces.items():
            self.sound[i] = piece.replace(SPACE, " ").encode()
        for byte, i in enumerate(vocabulary.bytes_):
            self.sound[i] = bytes([byte])
        self.trie = Trie(self.pieces)
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.ids, self.begin, self.score, self.gap = array("i"), array("q", [0]), array("d"), array("d")
        self.found: dict[str, list[tuple[float, tuple[int, ...]]]] = {}

    def ids_of(self, piece: str) -> tuple[int, ...]:
        known = self.pieces.get(piece)
        if known:
            return (known[0],)
        return tuple(self.vocabulary.bytes_[b] for b in piece.encode())

    def score_of(self, piece: str) -> float | None:
        """Score of an arc of the lattice: a piece, or one sign spelt in bytes; None if there is no such arc."""
        known = self.pieces.get(piece)
        if known:
            return known[1]
        return BYTE_SCORE * len(piece.encode()) if len(piece) == 1 else None

    def forward(self, chunk: str) -> tuple[list[float], list[int]]:
        """Best score of each prefix, and where the last piece of that segmentation begins."""
        n, longest, prefixes = len(chunk), self.longest, self.prefixes
        best, back = [-math.inf] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            so_far = best[i]
            if chunk[i] not in self.pieces:
                reached = so_far + BYTE_SCORE * len(chunk[i].encode())
                if reached > best[i + 1]:
                    best[i + 1], back[i + 1] = reached, i
            for j in range(i + 1, min(n, i + longest) + 1):
                score = prefixes.get(chunk[i:j])
                if score is None:
                    break
                if so_far + score > best[j]:
                    best[j], back[j] = so_far + score, i
        return best, back

    def arcs_to(self, chunk: str, end: int):
        """``start, score`` of each arc that ends at ``end``, longest first."""
        for start in range(max(0, end - self.longest), end):
            score = self.score_of(chunk[start:end])
            if score is not None:
                yield start, score

    def search(self, chunk: str, n: int, best: list[float] | None = None) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations, best first, each a score and where its pieces begin, by backward A-star.

        The score of a state is that of its pieces so far plus the best score of the prefix before them.
        """
        best = best or self.forward(chunk)[0]
        queue, found = [(-best[-1], len(chunk), 0, 0.0, None)], []
        pushed, expanded = 0, [0] * (len(chunk) + 1)
        while queue and len(found) < n:
            _, end, _, tail, after = heapq.heappop(queue)
            if end == 0:
                found.append((tail, _starts(after)))
                continue
            expanded[end] += 1
            if expanded[end] > n:  # n better ways from here to the end are known
                continue
            for start, score in self.arcs_to(chunk, end):
                pushed += 1
                value = -(best[start] + score + tail)
                heapq.heappush(queue, (value, start, pushed, tail + score, (start, after)))
        return found

    def runner_up(self, chunk: str, best: list[float], back: list[int]) -> float:
        """Score of the second best segmentation: the best state A-star has queued once it has walked the best path."""
        end, tail, second = len(chunk), 0.0, -math.inf
        while end:
            chosen = back[end]
            for start, score in self.arcs_to(chunk, end):
                if start == chosen:
                    taken = score
                elif best[start] + score + tail > second:
                    second = best[start] + score + tail
            end, tail = chosen, tail + taken
        return second

    def index(self, chunk: str) -> int:
        """Number of a chunk in the memo, segmenting it if it is new."""
        best, back = self.forward(chunk)
        starts, end = [], len(chunk)
        while end:
            starts.append((back[end], end))
            end = back[end]
        for start, end in reversed(starts):
            self.ids.extend(self.ids_of(chunk[start:end]))
        self.begin.append(len(self.ids))
        self.score.append(best[-1])
        self.gap.append(best[-1] - self.runner_up(chunk, best, back))
        self.memo[chunk] = len(self.score) - 1
        return len(self.score) - 1

    def chunks(self, text: str):
        """Lists of chunks of the normalised text, a window at a time."""
        signs = SPACE + text.replace(" ", SPACE)
        begin = 0
        while begin < len(signs):
            end = min(len(signs), begin + WINDOW)
            while end < len(signs) and not (signs[end] == SPACE and signs[end - 1] != SPACE):
                end += 1
            yield self.chunk.findall(signs[begin:end])
            begin = end

    def index_all(self, chunks: list[str]) -> None:
        """Number chunks that are not in the memo: short ones side by side, the others one by one."""
        short = []
        for chunk in chunks:
            if len(chunk) <= SIDE_BY_SIDE and all(map(self.pieces.__contains__, chunk)):
                short.append(chunk)
            else:
                self.index(chunk)
        short.sort(key=len)
        for at in range(0, len(short), ROWS):
            block = short[at : at + ROWS]
            ids, lengths, score, gap = self.trie.segment(block)
            first = len(self.score)
            self.ids.frombytes(ids.astype(np.int32).tobytes())
            self.begin.frombytes((self.begin[-1] + np.cumsum(lengths)).astype(np.int64).tobytes())
            self.score.frombytes(score.tobytes())
            self.gap.frombytes(gap.tobytes())
            self.memo.update(zip(block, range(first, first + len(block)), strict=True))

    def numbered(self, texts: list[str | None]) -> list[np.ndarray]:
        """The chunks of each text as numbers of the memo; new chunks of many texts are segmented together."""
        if len(self.memo) > MEMO:
            self.forget()
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            self.index_all(sorted(set().union(*(found for _, found in waiting)).difference(self.memo)))
            for k, found in waiting:
                parts[k].append(np.fromiter(map(self.memo.__getitem__, found), dtype=np.int64, count=len(found)))
            waiting.clear()

        for k, text in enumerate(texts):
            for found in self.chunks(text) if text else ():
                waiting.append((k, found))
                size += len(found)
                if size > WINDOW:
                    flush()
                    size = 0
        flush()
        return [np.concatenate([np.empty(0, np.int64), *p]) for p in parts]

    def encode_all(self, texts: list[str | None]):
        """For each text: ids of the best segmentation, its score, and scores and lengths of the best ``n_best``."""
        numbered = self.numbered(texts)
        begins, all_ids = np.frombuffer(self.begin, dtype=np.int64), np.frombuffer(self.ids, dtype=np.int32)
        all_scores, all_gaps = np.frombuffer(self.score), np.frombuffer(self.gap)
        listed = list(self.memo)
        for at in numbered:
            if not len(at):
                yield np.empty(0, dtype=np.int32), 0.0, [0.0], [0], [[]]
                continue
            begin = begins[at]
            lengths = begins[at + 1] - begin
            ends = np.cumsum(lengths)
            ids = all_ids[np.arange(ends[-1]) + np.repeat(begin - (ends - lengths), lengths)]
            score = float(all_scores[at].sum())
            gaps = all_gaps[at]
            few = min(self.n_best - 1, len(gaps))
            limit = np.partition(gaps, few - 1)[few - 1] if few else -math.inf
            below = np.nonzero(gaps < limit)[0]
            nearest = np.concatenate([below, np.nonzero(gaps == limit)[0][: few - len(below)]])
            nearest = nearest[np.lexsort((nearest, gaps[nearest]))]
            places = [(int(ends[k] - lengths[k]), int(lengths[k])) for k in nearest]
            yield ids, score, *self.best_of(score, len(ids), [listed[i] for i in at[nearest]], places)

    def encode(self, text: str | None) -> tuple[np.ndarray, float, list[float], list[int], list[list[dict]]]:
        return next(iter(self.encode_all([text])))

    def best_of(
        self, score: float, length: int, names: list[str], places: list[tuple[int, int]]
    ) -> tuple[list[float], list[int], list[list[dict]]]:
        """Scores, lengths and changes of the best segmentations that change only the named chunks.

        ``places`` has the first piece and the number of pieces of each named chunk in the best segmentation.
        """
        options = []
        for name in names:
            if name not in self.found:
                ranked = self.search(name, self.n_best)
                spelt = [(s, [i for piece in cut(name, starts) for i in self.ids_of(piece)]) for s, starts in ranked]
                self.found[name] = [(s - spelt[0][0], ids) for s, ids in spelt]
            options.append(self.found[name])
        first = (0,) * len(options)
        queue, seen, scores, lengths, changes = [(0.0, first)], {first}, [], [], []
        while queue and len(scores) < self.n_best:
            loss, chosen = heapq.heappop(queue)
            scores.append(score - loss)
            mine = sorted((*place, o[c][1]) for place, o, c in zip(places, options, chosen, strict=True) if c)
            changes.append([{"at": at, "pieces": size, "ids": ids} for at, size, ids in mine])
            lengths.append(length + sum(len(ids) - size for _, size, ids in mine))
            for k in range(len(options)):
                if chosen[k] + 1 < len(options[k]):
                    following = (*chosen[:k], chosen[k] + 1, *chosen[k + 1 :])
                    if following not in seen:
                        seen.add(following)
                        heapq.heappush(queue, (-sum(o[c][0] for o, c in zip(options, following, strict=True)), following))
        return scores, lengths, changes

    def known(self, ids: pa.ListScalar) -> np.ndarray:
        """The ids of a list that are numbers of pieces."""
        held = ids.values.drop_null().to_numpy(zero_copy_only=False)
        return held[(held >= 0) & (held < len(self.sound))]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces and bytes in a row, without the space that encoding puts in front."""
        spelt = b"".join(map(self.sound.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return spelt.removeprefix(" ")


def _starts(linked: tuple | None) -> tuple[int, ...]:
    found = []
    while linked:
        found.append(linked[0])
        linked = linked[1]
    return tuple(found)


def cut(chunk: str, starts: tuple[int, ...]) -> list[str]:
    return [chunk[a:b] for a, b in zip(starts, (*starts[1:], len(chunk)), strict=True)]


CHANGE = T.StructType([
    T.StructField("at", T.IntegerType()),
    T.StructField("pieces", T.IntegerType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
])
OUTPUTS = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("n_pieces", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("best_scores", T.ArrayType(T.DoubleType())),
    T.StructField("best_lengths", T.ArrayType(T.LongType())),
    T.StructField("best_changes", T.ArrayType(T.ArrayType(CHANGE))),
    T.StructField("n_decoded", T.LongType()),
    T.StructField("round_trip", T.BooleanType()),
])


def encode(docs: DataFrame, keep: list[str], path: str = VOCABULARY, n_best: int = N_BEST, ranked: bool = True) -> DataFrame:
    """The ``keep`` columns in a struct ``row``, and the encoding of each whole text.

    ``ids`` of the best segmentation with its ``score``; scores, lengths and changes of the best ``n_best``; the number of
    signs that ``ids`` decode to, and whether they are the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path, ranked))  # a fixed number of pieces
    key = (path, ranked, n_best)

    def make():
        mine = segmenter_of(key, shared, n_best)

        def run(texts: list) -> list[pa.Array]:
            rows = []
            for text, (ids, score, *best) in zip(texts, mine.encode_all(texts), strict=True):
                decoded = mine.decode(ids)
                rows.append((ids, len(ids), score, *best, len(decoded), decoded == (text or "").replace(SPACE, " ")))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in OUTPUTS]
            sizes = np.cumsum([0, *map(len, columns[0])]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int32), *columns[0]]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))
            changed = to_arrow_type(OUTPUTS["best_changes"].dataType)
            kinds = [pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.int64()), changed, pa.int64(), pa.bool_()]
            return [listed, *[pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True)]]

        return run

    return annotate(docs, keep, "text", OUTPUTS, make)


def nth_best(n: int) -> Column:
    """Ids of the ``n``-th best segmentation (from 1) of an encoded text, null if it has fewer."""
    changes, empty = F.get("best_changes", F.lit(n - 1)), F.array().cast("array<int>")
    start = F.struct(empty.alias("ids"), F.lit(0).alias("done"))

    def replaced(state: Column, change: Column) -> Column:
        kept = F.slice("ids", state["done"] + 1, change["at"] - state["done"])
        return F.struct(F.concat(state["ids"], kept, change["ids"]).alias("ids"), (change["at"] + change["pieces"]).alias("done"))

    last = F.aggregate(changes, start, replaced, lambda state: F.concat(state["ids"], F.slice("ids", state["done"] + 1, F.size("ids"))))
    return F.when(changes.isNotNull(), last)


def decode(rows: DataFrame, ids: str, keep: list[str], path: str = VOCABULARY, ranked: bool = True) -> DataFrame:
    """The ``keep`` columns in a struct ``row``, and ``decoded``: the text of the column ``ids``.

    Null ids decode to null, no ids to the empty text; null elements and numbers that are no piece are left out;
    bytes that are no UTF-8 become U+FFFD.
    """
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(path, ranked))  # a fixed number of pieces
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{ids}`").cast("array<int>").alias("ids"))
    schema = T.StructType([packed.schema["row"], T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = segmenter_of((path, ranked, N_BEST), shared, N_BEST)
        for batch in batches:
            listed = batch.column(1)
            texts = [mine.decode(mine.known(listed[i])) if listed[i].is_valid else None for i in range(len(listed))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return packed.mapInArrow(run, schema)


_SEGMENTERS: dict[tuple, Segmenter] = {}


def segmenter_of(key: tuple, shared, n_best: int) -> Segmenter:
    """The segmenter of a vocabulary, built once in each Python worker, with what it remembers; the last one is kept."""
    if key not in _SEGMENTERS:
        _SEGMENTERS.clear()
        _SEGMENTERS[key] = Segmenter(shared.value, n_best)
    return _SEGMENTERS[key]
