import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import sentencepieces as sp


@pytest.fixture(scope="module")
def segmenter():
    return sp.Segmenter(sp.Vocabulary.load())


def every(segmenter, text):
    """All segmentations of a text, best first."""
    found = []

    def go(at, score, starts):
        if at == len(text):
            found.append((score, tuple(starts)))
        for end in range(at + 1, min(len(text), at + segmenter.longest) + 1):
            arc = segmenter.score_of(text[at:end])
            if arc is not None:
                go(end, score + arc, [*starts, at])

    go(0, 0.0, [])
    return sorted(found, key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["▁there", "▁été", "é一😀x", "▁▁▁the", "aaaaaa", "▁"])
def test_search_yields_the_best_in_order(segmenter, text):
    brute = every(segmenter, text)[:6]
    found = segmenter.search(text, 6)
    assert [s for s, _ in found] == pytest.approx([s for s, _ in brute])
    assert all(s == pytest.approx(sum(segmenter.score_of(p) for p in sp.cut(text, starts))) for s, starts in found)
    assert segmenter.forward(text)[0][-1] == pytest.approx(brute[0][0])


def brute_pieces(segmenter, text):
    """Id and score of every piece that is one id and occurs in a text."""
    signs = sp.SPACE + text.replace(" ", sp.SPACE)
    parts = {signs[a:b] for a in range(len(signs)) for b in range(a + 1, len(signs) + 1)}
    for part in parts:
        score = segmenter.score_of(part)
        if score is not None and len(segmenter.ids_of(part)) == 1:
            yield segmenter.ids_of(part)[0], score


@pytest.mark.parametrize("text", ["the at", "a b a", "in\non", "x  y"])
def test_the_best_of_a_text_are_those_of_its_whole_lattice(segmenter, text):
    ids, score, scores, lengths, changes = segmenter.encode(text)
    brute = every(segmenter, sp.SPACE + text.replace(" ", sp.SPACE))
    assert score == pytest.approx(brute[0][0])
    assert scores == pytest.approx([s for s, _ in brute[: sp.N_BEST]])
    assert len(lengths) == len(scores) == len(changes)
    for size, total, changed in zip(lengths, scores, changes, strict=True):
        own = ids.tolist()
        for change in reversed(changed):
            own[change["at"] : change["at"] + change["pieces"]] = change["ids"]
        assert len(own) == size and segmenter.decode(np.array(own)) == text
        spelt = {i: score for piece in brute_pieces(segmenter, text) for i, score in [piece]}
        assert sum(spelt.get(i, sp.BYTE_SCORE) for i in own) == pytest.approx(total)


def test_side_by_side_equals_one_by_one():
    draw = random.Random(9)
    chunks = {"▁" + "".join(draw.choice("abcdeinrst,.éß") for _ in range(draw.randrange(0, 14))) for _ in range(500)}
    many, single = (sp.Segmenter(sp.Vocabulary.load()) for _ in range(2))
    many.index_all(sorted(chunks))
    for chunk in chunks:
        i, j = many.memo[chunk], single.index(chunk)
        assert many.ids[many.begin[i] : many.begin[i + 1]] == single.ids[single.begin[j] : single.begin[j + 1]]
        assert many.score[i] == pytest.approx(single.score[j])
        assert many.gap[i] == pytest.approx(single.gap[j])


def test_decoding_undoes_encoding(segmenter):
    draw = random.Random(10)
    texts = ["".join(draw.choice("ab \n\t▁é一😀\u0000​9.") for _ in range(draw.randrange(80))) for _ in range(200)]
    for text in ["", " ", "  a", "a  ", "\n\n", "x" * 5000, *texts]:
        assert segmenter.decode(segmenter.encode(text)[0]) == text.replace("▁", " ")


def test_memo_and_windows_do_not_change_results(segmenter, monkeypatch):
    text = "some words " * 300 + "others"
    expected = segmenter.encode(text)
    monkeypatch.setattr(sp, "WINDOW", 50)
    monkeypatch.setattr(sp, "MEMO", 1)
    again = segmenter.encode(text)
    assert again[0].tolist() == expected[0].tolist() and again[2] == pytest.approx(expected[2])


def test_odd_rows_are_encoded(odd, empty):
    out = sp.encode(odd, odd.columns)
    rows = out.collect()
    assert out.select("row.*").columns == odd.columns and len(rows) == odd.count()
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in rows)
    assert all(r["n_decoded"] == len(r["row"]["text"] or "") for r in rows)
    assert sp.encode(empty, ["doc_id"]).count() == 0


def test_every_listed_segmentation_decodes_to_its_text(documents, odd):
    texts = ["the at", "some words and a few more of them", "été 一😀", None, "", "x" * 300, "tail  spaces  "]
    for docs in (documents(list(enumerate(texts))), odd.select("doc_id", "text")):
        encoded = sp.encode(docs, ["doc_id", "text"]).select("row.*", *sp.OUTPUTS.names)
        for n in range(1, sp.N_BEST + 1):
            listed = encoded.withColumn("nth", sp.nth_best(n)).where("nth is not null")
            rows = sp.decode(listed, "nth", ["text", "nth", "best_lengths", "ids"]).select("row.*", "decoded").collect()
            assert rows and all(r["decoded"] == (r["text"] or "") and len(r["nth"]) == r["best_lengths"][n - 1] for r in rows)
            assert n > 1 or all(r["nth"] == r["ids"] for r in rows)


def test_odd_ids_are_decoded(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [None, -1, 10**9])], "decoded int, ids array<int>")
    found = sp.decode(rows, "ids", rows.columns)
    assert [(r["row"]["decoded"], r["decoded"]) for r in found.collect()] == [(1, None), (2, ""), (3, "")]
    assert sp.decode(rows.where(F.lit(False)), "ids", ["decoded"]).count() == 0
