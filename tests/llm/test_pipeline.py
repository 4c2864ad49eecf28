import corpus_pipeline
import __spark_entry__ as contract
from shelfgap.llm.queries import QUERIES
from tests.llm.cases import TEXTS, documents, no_documents

SF_DIR = "/root/testdata/sf0.001"


def test_stages_and_registration():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["known_language", "near_duplicates", "decontaminated", "source_mix", "token_records"]
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert {q.split("_")[0] for q in QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_each_stage_works_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, [{r.doc_id for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({r.doc_id for r in docs.collect()})
        assert seen[-1] <= seen[-2] and seen[-1]
        assert docs.columns == columns or name == "token_records"
    again = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_take_odd_and_no_rows(spark, tmp_path):
    for k, first in enumerate((documents(spark), no_documents(spark))):
        docs = first
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{k}-{name}")
        assert 0 < docs.count() < 2 * len(TEXTS) if k == 0 else docs.count() == 0
