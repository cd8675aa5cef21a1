import random

import numpy as np
from pyspark.sql import functions as F

from daybook.llm import language_id


def brute_phrases(text, sample):
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        count += 1
        at = max(end - 1, at + 1)
    return count


def test_automaton_accepts_exactly_the_substrings():
    draw = random.Random(7)
    for _ in range(30):
        signs = [draw.randrange(3) for _ in range(draw.randrange(1, 14))]
        following = language_id.suffix_automaton(signs)

        def accepts(run, following=following):
            state = 0
            for sign in run:
                if sign not in following[state]:
                    return False
                state = following[state][sign]
            return True

        text = "".join(map(str, signs))
        for _ in range(60):
            run = "".join(str(draw.randrange(3)) for _ in range(draw.randrange(1, 6)))
            assert accepts(map(int, run)) == (run in text)


def test_phrase_counts_equal_greedy_parsing():
    draw = random.Random(8)
    samples = {x: language_id.folded("".join(draw.choice("abcd ") for _ in range(300))) for x in ("one", "two")}
    parser = language_id.Parser(samples)
    texts = ["".join(draw.choice("abcde ") for _ in range(draw.randrange(0, 400))) for _ in range(50)]
    found = parser.phrases([parser.codes(t) for t in texts])
    for i, text in enumerate(texts):
        text = language_id.folded(text)
        assert [brute_phrases(text, samples[x]) for x in parser.languages] == found[:, i].tolist()


def test_every_letter_of_every_script_is_told_apart():
    draw = random.Random(9)
    scripts = {"zh": 0x4E00, "ja": 0x5200, "ko": 0xAC00, "ru": 0x430, "en": 0x61}
    letters = {x: [chr(begin + i) for i in range(400 if begin > 0x1000 else 26)] for x, begin in scripts.items()}
    prose = lambda x, n: " ".join("".join(draw.choices(letters[x], k=4)) for _ in range(n))
    samples = {x: prose(x, 300 if x in ("zh", "ja", "ko") else 1000) for x in scripts}
    parser = language_id.Parser(samples)
    unseen = "".join(chr(0x0E01 + i) for i in range(40))  # Thai, in no sample: one phrase for each letter
    texts = [prose(x, 40) for x in scripts] + [samples["zh"][300:500].strip(), unseen]
    found = parser.phrases([parser.codes(t) for t in texts])
    for i, text in enumerate(texts):
        assert [brute_phrases(text, samples[x]) for x in parser.languages] == found[:, i].tolist()
    names, scores = parser.predict(texts[:-1])
    assert names == [*scripts, "zh"] and min(scores) > 0


def test_the_hash_table_finds_each_key_and_no_other():
    draw = np.random.default_rng(10)
    keys = np.unique(draw.integers(0, 1 << 40, 5000))
    edges = language_id.Edges(keys[::2].copy(), np.arange(len(keys[::2])))
    found = edges.find(keys)
    assert np.array_equal(found[::2], np.arange(len(keys[::2]))) and (found[1::2] == -1).all()
    none = language_id.Edges(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    assert none.find(keys).max() == -1


def test_segments_cost_a_phrase_at_most(monkeypatch):
    samples = {"x": "abc abd abe " * 20}
    parser = language_id.Parser(samples)
    text = parser.codes("abc abd abe " * 50)
    whole = parser.phrases([text])[0, 0]
    monkeypatch.setattr(language_id, "SEGMENT", 64)
    assert whole <= parser.phrases([text])[0, 0] <= whole + len(text) // 64 + 1


def test_codes_are_the_folded_text():
    parser = language_id.Parser({"x": "abc é"})
    for text in ["", "  ", "A b--C", "é1É", " x "]:
        assert len(parser.codes(text)) == len(language_id.folded(text))
    assert np.array_equal(parser.codes("A  bé"), parser.codes("a, BÉ!"))


def test_held_out_languages_are_predicted(table):
    docs = table("documents")
    found = language_id.identify(docs, 3, 1).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.95


def test_odd_rows_are_undetermined_or_learnt(odd, empty):
    rows = language_id.identify(odd, 3, 1).collect()
    assert len(rows) == odd.count()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert language_id.identify(empty, 3, 1).count() == 0
    nothing = language_id.identify(odd.withColumn("lang", F.lit(None).cast("string")), 3, 1).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
