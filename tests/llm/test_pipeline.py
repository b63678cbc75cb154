"""The pipeline on a small fixture, stage by stage, against plain Python."""

import os

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm.test_models_leaks import corpus
from tests.llm.test_secrets_licenses import slow_base
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_tokens_packing import check_packed
from tidemark.llm import toxicity
from tidemark.session import scratch_path


@pytest.fixture(scope="module")
def folder(spark):
    docs, labels = corpus(8, 300)
    item = "Every farmer in the valley keeps many goats and several hens near the old wooden barn behind the mill."
    docs = [(i, t + " " + item if i % 50 == 1 else t + " password=hunter2secret" if i % 50 == 2 else t) for i, t in docs]
    docs += [(1000 + i, docs[i][1]) for i in range(0, 40)]
    d = scratch_path(spark, "sf")
    spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, docs, item


def test_run(spark, folder):
    d, docs, item = folder
    frame = spark.read.parquet(f"{d}/documents.parquet")
    model = toxicity.fit(frame, spark.read.parquet(f"{d}/labels.parquet"))
    rejected = {x.doc_id for x in toxicity.score(frame, model, ["doc_id"]).where("score >= 0.5").collect()}
    assert 30 < len(rejected) < 120
    left = {i: t for i, t in docs if i not in rejected}
    least = slow_components({i: slow_fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if least[i] == i}
    left = {i: t for i, t in left.items() if item not in t}
    left = {i: t.replace("password=hunter2secret", "[SECRET]") for i, t in left.items()}
    assert not any(slow_base(t)[2] for t in left.values())
    check_packed(corpus_pipeline.run(spark, d).collect(), sorted(left.items()))


def test_stages_keep_columns(spark, folder):
    d, _, _ = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, d).columns == docs.columns


def test_empty_documents(spark, folder):
    d, _, _ = folder
    none = spark.read.parquet(f"{d}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, d).count() == 0


def test_registered():
    names = set(queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(oracle_sql()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "packing"]
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
