import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from daybook.llm import conversations

FIELDS = "conv_id long, turn long, role string, text string, kind string, fault string, gone string"
GOOD = re.compile("(s?(ua)+)?")


def brute_damage(rows):
    """Rows after damage of one conversation, in order."""
    out = []
    for conv, turn, role, text in rows:
        shown = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        kept = re.sub("[\x20\x09-\x0d]", "", text)
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else "" if kept[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def brute_repair(rows, found):
    """Every choice of edits with at most two inserts at any place, the lightest first."""
    options = []
    for (_, role, text), fault in zip(rows, found, strict=True):
        left = 5 if fault == "truncated" else 0
        own = [("D", 2, None)]
        if fault not in ("blank", "duplicate"):
            own += [("K", left, (role, text)), ("R", 1 + left, ("user", text)), ("R", 1 + left, ("assistant", text))]
        options.append(own)
    blank = [("user", ""), ("assistant", "")]
    inserts = [(), *[(x,) for x in blank], *product(blank, repeat=2)]
    best = None
    for chosen in product(*options):
        if len(rows) > 3 and sum(c[1] for c in chosen) > (best[0] if best else 10**9):
            continue
        for put in product(inserts, repeat=len(rows) + 1):
            given, audit, cost = [], "", 0
            for i, added in enumerate(put):
                given += added
                audit += "I" * len(added)
                cost += 5 * len(added)
                if i < len(rows):
                    audit += chosen[i][0]
                    cost += chosen[i][1]
                    given += [chosen[i][2]] if chosen[i][2] else []
            if (best is None or (cost, audit) < best[:2]) and GOOD.fullmatch("".join(r[:1] for r, _ in given)):
                best = (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in given).encode()).hexdigest())
    return best


def brute(rows):
    after = brute_damage(rows)
    found = faults(after)
    turns = [t for t, *_ in after if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:], strict=False))
    counts = [found.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal), after, found


def made(draw, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "and then", " ", "", None, "Why? ", "Yes.", "Well\u00a0."]
    turns = [*range(n), *range(n), None, 9]
    return [(draw.choice(turns), draw.choice(roles), draw.choice(texts)) for _ in range(n)]


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], FIELDS)
    return {r["conv_id"]: tuple(r)[1:] for r in conversations.repair(df, **more).collect()}


@pytest.mark.parametrize("segment", [1, 256])
def test_equals_brute_force(spark, segment):
    draw = random.Random(5)
    talks = {k: [(k, *r) for r in made(draw, draw.randrange(1, 4))] for k in range(40)}
    found = run(spark, [r for rows in talks.values() for r in rows], segment=segment)
    assert found.keys() == talks.keys()
    for key, rows in talks.items():
        counts, after, marks = brute(rows)
        if len(after) <= 3:
            assert found[key] == (*counts, *brute_repair(after, marks)), rows


def test_segments_change_nothing(spark):
    draw = random.Random(8)
    rows = [(k, t, draw.choice(["user", "assistant", "system"]), draw.choice(["a.", "b!", "c", f"{t}."])) for k in range(6) for t in range(120)]
    whole = run(spark, rows, segment=1000)
    assert run(spark, rows, segment=1) == whole == run(spark, rows, segment=7)
    assert all(len(r[6]) >= 100 for r in whole.values())


def plain(rows):
    """The lightest audit by a table over all states, row by row."""
    table = {0: (0, "")}
    for row in [*rows, None]:
        for _ in range(3):
            for s, (cost, audit) in list(table.items()):
                for to in (conversations.NEXT[s].get("u"), conversations.NEXT[s].get("a")):
                    if to is not None:
                        table[to] = min(table.get(to, (10**9, "")), (cost + 5, audit + "I"))
        if row is None:
            break
        after = {}
        for s, (cost, audit) in table.items():
            for more, edit, to in conversations.edits(row, s):
                after[to] = min(after.get(to, (10**9, "")), (cost + more, audit + edit))
        table = after
    return min(table[s] for s in (0, 3) if s in table)


def test_long_ones_equal_a_table_of_all_states():
    draw = random.Random(11)
    for n in (0, 1, 2, 5, 30, 200):
        for _ in range(8):
            rows = [(draw.choice(["user", "assistant", "system", "x"]), "t", draw.choice(["", "", "b", "d", "t"])) for _ in range(n)]
            work = conversations.Repair()
            work.take(rows[: n // 2], last=False)
            work.take(rows[n // 2 :], last=True)
            assert work.result()[:2] == plain(rows)


def test_defined_cases(spark):
    assert run(spark, []) == {}
    none = hashlib.sha256(b"").hexdigest()
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    found = run(spark, [(dropped, 0, "user", "Hi."), (None, None, None, None), (None, None, "user", "x" * 3_000_000 + ".")])
    assert found[dropped] == (0, 0, 0, 0, 0, 0, "", none)
    counts, after, marks = brute([(None, None, None, None), (None, None, "user", "x" * 3_000_000 + ".")])
    assert found[None] == (*counts, *brute_repair(after, marks))
