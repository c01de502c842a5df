"""The stages of the pipeline, each against a plain version on what it was given."""

from collections import Counter

import corpus
import pytest
from test_decontam import ITEM, brute
from test_neardup import fold as near_fold

import corpus_pipeline as pipeline
from farelake.llm.decontam import Overlap
from farelake.llm.neardup import Similarity
from farelake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in pipeline.STAGES] == [
        "quality classifier", "exact dedup", "near dedup", "decontamination", "mixing sources",
    ]
    assert pipeline.ORACLE_SQL is None


def test_run(spark):
    """Every document that the classifier keeps and no copy, and all of its words."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    passed = {r.doc_id for r in QUERIES["op6_quality"](spark, SF_DIR).where("predicted = 1").collect()}
    first = {}
    for key in sorted(passed):
        first.setdefault(" ".join(docs[key].text.split(" ")), key)
    unique = sorted(first.values())
    kept = [r[0] for r in near_fold([(k, docs[k].text) for k in unique], Similarity()) if r[3]]
    leaked = set()
    for item in items:
        leaked |= {kept[i] for i in brute([docs[k].text for k in kept], item, Overlap())}
    clean = set(kept) - leaked

    blocks = pipeline.run(spark, SF_DIR).collect()
    size = Counter()
    for key in clean:
        size[docs[key].source] += len(docs[key].text.split())
    assert {k for b in blocks for k in b.doc_ids} <= clean
    assert sum(b.n_words for b in blocks) == pytest.approx(sum(size.values()), abs=len(size))
    assert all(len(b.text.split()) == b.n_words for b in blocks)


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES[:-1]])
def test_stages_cope_with_odd_rows_and_empty_tables(spark, tmp_path, name):
    stage = dict(pipeline.STAGES)[name]
    spark.createDataFrame([(1, " ".join(ITEM)), (2, None)], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    spark.createDataFrame([(4, 1, 0), (8, 1, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    for docs in (corpus.odd(spark), corpus.empty(spark)):
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        assert got.count() <= docs.count()


def test_the_mix_copes_with_odd_rows_and_empty_tables(spark, tmp_path):
    assert pipeline.mix(spark, corpus.odd(spark), str(tmp_path)).count() > 0
    assert pipeline.mix(spark, corpus.empty(spark), str(tmp_path)).count() == 0
