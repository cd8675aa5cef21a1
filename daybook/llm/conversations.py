"""Repair of conversation structure by Knuth's lightest derivation.

A repaired conversation's role initials have the form ``(s?(ua)+)?``. Its items are ``(i, state)``: the first ``i`` rows
are edited and what they gave has led to ``state`` of that form. Each row is an item of its own, lightest of all. A
deduction takes a state and a row to the next state (keep, rerole, delete), another a state alone (insert). Its function
adds the edit's cost and appends its initial; that is monotone in the state's weight and never below any of its
antecedents' weights, a superior function, so items leave the agenda with their lightest weight ``(cost, audit)``, ties
to the ASCII-least audit. Audits of one item have a letter for each row, so one can only be the beginning of another by
fewer inserts, at a lower cost; at equal costs their order survives appending.

**Long conversations.** Rows are shuffled to their conversation once, sorted (with spill) and streamed. A derivation is
taken over ``SEGMENT`` rows or ``SEGMENT_BYTES`` of text at a time; what crosses to the next segment is the weight of
the four states, their digests so far and the part of their audits in which they differ. So a task holds one segment,
whatever the size of a conversation; only its digest must see its rows in order, as SHA-256 does.

Damage and faults come from DataFrame functions before the stream.

Defined cases: in a damage key a null counts as one space, and so do a null role and text; null turns come first; rows
of one turn are ordered by role and text after damage, so repeated rows are duplicates of each other; rows without
``conv_id`` are one conversation; an empty role has no initial: it is illegal beside any, and may be kept anywhere; an empty table gives an empty
result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import count
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import SPACE

#: Fixed values of the damage: remainders of the key's checksum and what they do.
DAMAGE = 20
DROP, EMPTY, UNSTOP, REPEAT, AS_USER = range(5)
#: Fixed values of the repair: costs of the edits, and of leaving a truncated row.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: The form as states: nothing yet, after a system row, after a user row, after an assistant row.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
START, FINAL = 0, (0, 3)
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}

#: Items beside the states: a row, and the goal, which follows from either final state after the last row.
ROW, GOAL = -2, -1

SEGMENT = 256
SEGMENT_BYTES = 4 << 20
MOST = (1 << 63) - 1

NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = ", ".join(f"{n} {'string' if n in ('audit', 'repaired_sha256') else 'long'}" for n in NAMES)


def damaged(table: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows after damage; one that is dropped stays with ``gone`` and no text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % DAMAGE
    rows = table.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    is_kind = lambda k: F.col("kind") == k
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(is_kind(AS_USER), F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(is_kind(DROP) | is_kind(EMPTY), F.lit(""))
        .when(is_kind(UNSTOP), F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        is_kind(DROP).alias("gone"),
        F.when(is_kind(REPEAT), F.lit(2)).otherwise(F.lit(1)).alias("times"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")


def faulted(rows: DataFrame) -> DataFrame:
    """Rows with their first ``fault`` (``b, d, t`` or empty), those of a conversation together and in order."""
    tail = F.rtrim(F.col("text"), F.lit(SPACE))
    dealt = rows.repartition("conv_id")
    seen = W.partitionBy("conv_id", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first(), "copy")
    fault = (
        F.when(F.col("gone") | (tail == ""), F.lit("b"))
        .when(F.row_number().over(seen) > 1, F.lit("d"))
        .when(~F.substring(tail, -1, 1).isin(".", "!", "?"), F.lit("t"))
        .otherwise(F.lit(""))
    )
    marked = dealt.select("conv_id", "turn", "role", "text", "gone", fault.alias("fault"))
    return marked.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")


def edits(row: tuple[str, str, str], state: int) -> Iterator[tuple[int, str, int]]:
    """What may happen to a row ``(role, text, fault)`` in a state: cost, initial of the edit, next state."""
    role, _, fault = row
    yield DELETE, "D", state
    if fault in ("b", "d"):
        return
    left = TRUNCATED if fault == "t" else 0
    given = role[:1]
    if not given or given in NEXT[state]:
        yield KEEP + left, "K", NEXT[state][given] if given else state
    for initial in ROLES:
        if initial in NEXT[state]:
            yield REROLE + left, "R", NEXT[state][initial]


def lightest(rows: list[tuple[str, str, str]], entries: dict[int, tuple[int, str]], goals: set) -> dict:
    """Final items with ``(cost, audit, way)``, found until all of ``goals`` are final or nothing is left to deduce.

    ``entries`` weighs the states before the first row. A way is the antecedent state and the edit. The agenda pops the
    lightest item; it is final, and each deduction whose antecedents are all final puts its consequence there.
    """
    final: dict = {}
    agenda: list = []
    number = count()

    def put(cost: int, audit: str, item: tuple, way: tuple | None) -> None:
        if item not in final:
            heapq.heappush(agenda, (cost, audit, next(number), item, way))

    for i in range(len(rows)):
        put(0, "", (i, ROW), None)
    for state, (cost, audit) in entries.items():
        put(cost, audit, (0, state), None)
    wanted = set(goals)
    while agenda and wanted:
        cost, audit, _, item, way = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit, way)
        wanted.discard(item)
        i, state = item
        if state == GOAL:
            continue
        if state != ROW:
            for initial in ROLES:
                if initial in NEXT[state]:
                    put(cost + INSERT, audit + "I", (i, NEXT[state][initial]), (item, "I"))
            if i == len(rows) and state in FINAL:
                put(cost, audit, (i, GOAL), (item, ""))
        if (i, ROW) in final:
            for s in [state] if state != ROW else [s for s in range(len(NEXT)) if (i, s) in final]:
                before, earlier, _ = final[(i, s)]
                for more, edit, to in edits(rows[i], s):
                    put(before + more, earlier + edit, (i + 1, to), ((i, s), edit))
    return final


class Repair:
    """The repair of one conversation, a segment at a time."""

    def __init__(self) -> None:
        self.weights = {START: (0, "")}
        self.digests = {START: (hashlib.sha256(), True)}  # and whether nothing was spelt yet
        self.shared: list[str] = []  # audits as far as all states agree

    def take(self, rows: list[tuple[str, str, str]], last: bool) -> None:
        """Derive over a segment; after the last one only the goal is left."""
        ends = [GOAL] if last else list(range(len(NEXT)))
        final = lightest(rows, self.weights, {(len(rows), end) for end in ends})
        found = {end: final[(len(rows), end)] for end in ends if (len(rows), end) in final}
        self.digests = {end: self.spelt(rows, final, (len(rows), end)) for end in found}
        agreed = commonprefix([audit for _, audit, _ in found.values()])
        self.shared.append(agreed)
        self.weights = {end: (cost, audit[len(agreed) :]) for end, (cost, audit, _) in found.items()}

    def spelt(self, rows: list[tuple[str, str, str]], final: dict, item: tuple[int, int]):
        """The digest of what the lightest way to an item gives, on top of the digest of its entry."""
        steps = []
        while (way := final[item][2]) is not None:
            steps.append((way[0][0], way[1], item[1]))
            item = way[0]
        digest, empty = self.digests[item[1]]
        digest = digest.copy()
        for i, edit, to in reversed(steps):
            if edit in ("D", ""):
                continue
            role = rows[i][0] if edit == "K" else ROLES["u" if to == NEXT[START]["u"] else "a"]
            line = f"{role}:{'' if edit == 'I' else rows[i][1]}"
            digest.update((line if empty else "\n" + line).encode())
            empty = False
        return digest, empty

    def result(self) -> tuple[int, str, str]:
        cost, audit = self.weights[GOAL]
        return cost, "".join(self.shared) + audit, self.digests[GOAL][0].hexdigest()


class Conversation:
    """Counts and repair of the conversation whose rows are arriving."""

    def __init__(self, key: int | None, segment: int) -> None:
        self.key, self.segment = key, segment
        self.work, self.rows, self.size = Repair(), [], 0
        self.turns, self.first, self.latest = 0, None, None
        self.faults = dict.fromkeys(("b", "d", "t"), 0)
        self.illegal, self.before = 0, None

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if len(self.rows) >= self.segment or self.size > SEGMENT_BYTES:
            self.work.take(self.rows, last=False)
            self.rows, self.size = [], 0
        self.rows.append((role, text, fault))
        self.size += len(text)
        if turn is not None and turn != self.latest:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.latest = turn
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]

    def close(self) -> tuple:
        self.work.take(self.rows, last=True)
        gaps = min(MOST, self.latest - self.first + 1 - self.turns) if self.turns else 0
        return (self.key, gaps, *self.faults.values(), self.illegal, *self.work.result())


def repair(table: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row for each ``conv_id`` of the table, after damage: its counts, cost, audit and digest of the repair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, out = None, []
        for batch in batches:
            for key, turn, role, text, gone, fault in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if open_ is None or open_.key != key:
                    if open_ is not None:
                        out.append(open_.close())
                    open_ = Conversation(key, segment)
                if not gone:
                    open_.add(turn, role, text, fault)
            if out:
                yield packed(out)
                out = []
        if open_ is not None:
            yield packed([open_.close()])

    return faulted(damaged(table)).mapInArrow(run, SCHEMA)


def packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=NAMES)
