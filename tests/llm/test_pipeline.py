"""The pipeline's stages against what their operators are for."""

import corpus_pipeline
from crashlake.llm.common import stage
from tests.llm.helpers import word_list

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_near_dedup", "mixing", "packing"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns, before = docs.columns, None
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, SF), name)
        if name == "packing":
            assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").distinct().collect()}
            break
        assert out.columns == columns
        before, docs = docs, out
        was, rows = before.collect(), docs.collect()
        assert {r.doc_id for r in rows} <= {r.doc_id for r in was}
        if name in ("quality_rules", "quality_classifier"):
            clean = [r.doc_id for r in was if labels.get(r.doc_id) == 1 and len(word_list(r.text)) >= 60]
            assert {r.doc_id for r in rows} >= set(clean)
        if name == "simhash_near_dedup":
            assert len({r.text for r in rows}) == len(rows)
    assert len(rows) > 0


def test_empty_table_through_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
    assert docs.count() == 0
