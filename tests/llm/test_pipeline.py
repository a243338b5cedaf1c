from collections import Counter

import pytest
from corpus import DOCS, documents

import corpus_pipeline
from smeltery.llm import common


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = documents(120)
    leak = " ".join(rows[9][1].split()[:14])
    rows.append((900, rows[3][1], "en", "src1", 1))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_one_after_the_other(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.stored(stage(spark, docs, sf_dir), name)
        seen[name] = docs.collect()
        if name != "shards":
            assert docs.columns == before.columns
    texts = Counter(r.text for r in seen["near_dedup"])
    assert max(texts.values()) == 1 and len(texts) == len({r.text for r in seen["language_id"]})
    assert {r.doc_id for r in seen["near_dedup"]} - {r.doc_id for r in seen["decontamination"]} == {9}
    assert max(Counter(r.doc_id for r in seen["source_mix"]).values()) <= 2
    assert Counter(r.doc_id for r in seen["shards"]) == Counter(r.doc_id for r in seen["source_mix"])


def test_run_gives_the_last_stage(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
