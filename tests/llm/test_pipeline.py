import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import compare  # noqa: E402
import corpus_pipeline  # noqa: E402
from daybook.llm import mixing, quality_rules, sentencepieces, simhash  # noqa: E402
from daybook.llm.common import durable  # noqa: E402
from daybook.llm.queries import QUERIES, SQL  # noqa: E402


SF = "/root/testdata/sf0.001"


def stage(spark, name, docs):
    return durable(dict(corpus_pipeline.STAGES)[name](spark, docs, SF), "stage")


def keys(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_stages_follow_each_other(spark, table):
    documents = table("documents")
    good = stage(spark, "quality classifier", documents)
    labels = table("labels").where("quality = 1")
    clean = documents.join(labels, "doc_id", "left_semi")
    assert good.columns == documents.columns
    assert clean.join(good, "doc_id", "left_anti").count() <= 0.02 * clean.count()

    ruled = stage(spark, "quality rules", good)
    measured = quality_rules.measure(good, ["doc_id"])
    kept = quality_rules.judge(measured, quality_rules.fences(quality_rules.sketches(measured))).where("kept")
    assert ruled.columns == documents.columns and keys(ruled) == keys(kept.select("row.doc_id"))

    single = stage(spark, "simhash near-dedup", ruled)
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in ruled.collect()}
    group = {k: k for k in prints}
    for a in sorted(prints):
        for b in prints:
            if ((prints[a] ^ prints[b]) % (1 << 64)).bit_count() <= 2 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert single.columns == documents.columns and keys(single) == sorted(set(group.values()))

    mixed = stage(spark, "mixing sources to target weights", single)
    times = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in mixing.mix(single).collect() if r["size"]}
    assert mixed.columns == documents.columns
    assert keys(mixed) == sorted(k for k, n in times.items() for _ in range(n))

    encoded = stage(spark, "sentencepiece encoding", mixed)
    assert keys(encoded) == keys(mixed)
    segmenter = sentencepieces.Segmenter(sentencepieces.Vocabulary.load())
    text = {r["doc_id"]: r["text"] for r in mixed.collect()}
    for r in encoded.limit(20).collect():
        assert segmenter.decode(np.array(r["ids"])) == text[r["doc_id"]]


def test_odd_and_empty_documents_pass_every_stage(spark, odd, empty):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd.select(columns), empty):
        for name, _ in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, name, docs).columns == columns
        assert stage(spark, corpus_pipeline.STAGES[-1][0], docs).count() == docs.count()


def test_run_gives_what_the_last_stage_gives(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.where(~F.col("round_trip")).count() == 0 and rows.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    good, note = compare.compare(spark, compare.tables(SF), SF, QUERIES[name], SQL[name])
    assert good, note


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
