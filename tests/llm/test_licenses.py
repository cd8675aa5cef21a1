import random
import re

from daybook.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(text):
    words = WORD.findall(lowered(text))
    places, base, labels, best = [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        wanted = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
        places += found
        base |= {label} if found else set()
    for label, must, template in licenses.TEMPLATES:
        wanted, size = set(template.split()), 16 if len(template.split()) <= 16 else 32
        for at in range(0, len(words), size):
            held = set(words[at : at + 2 * size])
            share = len(wanted & held) / len(wanted)
            if share >= licenses.CONTAINMENT and held >= set(must.split()):
                labels.add(label)
                best = max(best, share)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if places else best,
    )


def test_scan_equals_brute_force(documents):
    draw = random.Random(6)
    texts = ["MIT-License, mit\nlicense; (CC) BY 4.0 cc by cc by", "the gnu general public license gnu general", "K license ſ"]
    for _, _, template in licenses.TEMPLATES:
        words = template.split()
        for dropped in range(0, len(words) // 3 + 1):
            kept = [w for i, w in enumerate(words) if i not in draw.sample(range(len(words)), dropped)]
            draw.shuffle(kept)
            filler = ["Lorem", "ÿ9", "x"] * draw.randrange(3)
            texts.append("\n".join(["Before it.", " ".join(filler + [w.upper() for w in kept]), "after"]))
    found = {r["doc_id"]: tuple(r)[1:] for r in licenses.scan(documents(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert found[i] == brute(text), text


def test_notices_are_found_across_lines_and_told_apart(documents):
    lorem = "lorem ipsum dolor sit amet consectetur " * 20
    texts = {}
    for i, (label, _, template) in enumerate(licenses.TEMPLATES):
        words = template.split()
        for shift in range(0, 60, 7):  # wherever windows begin, and wrapped after every fifth word
            wrapped = "\n".join(" ".join(words[k : k + 5]) for k in range(0, len(words), 5))
            texts[100 * i + shift] = label, f"{' '.join(lorem.split()[:shift])}\n{wrapped}\n{lorem}"
    near = {
        2001: ("Licensed under the Mozilla Public License, Version 2.0", ""),
        2002: ("Released under the Apache License", "apache"),
        2003: ("licensed under CC BY 4.0", "cc-by"),
        2004: ("released " + lorem + "under " + lorem + " the " + lorem + "mit " + lorem + "license", ""),
    }
    rows = [(i, t) for i, (_, t) in texts.items()] + [(i, t) for i, (t, _) in near.items()]
    found = {r["doc_id"]: r["labels"] for r in licenses.scan(documents(rows)).collect()}
    assert all(label in found[i].split(",") for i, (label, _) in texts.items())
    assert {i: found[i] for i in near} == {i: labels for i, (_, labels) in near.items()}


def test_odd_rows_keep_a_row_each(odd, empty):
    rows = licenses.scan(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["labels"] == "" and r["score"] == 0.0 and r["first_word"] is None for r in rows)
    assert {r["n_words"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert licenses.scan(empty).count() == 0


def test_repeated_rows_and_null_keys_get_the_same_labels(documents):
    text = "Licensed under CC BY-NC 4.0."
    rows = licenses.scan(documents([(1, text), (1, text), (None, text), (None, "none")])).collect()
    assert sorted(r["labels"] for r in rows) == ["", *["cc-by,cc-by-nc"] * 3]
