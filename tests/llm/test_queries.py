"""The registered queries and the pipeline on the smallest driver tables."""

import pytest

import corpus_pipeline
from suite.check import _sorted, connect
from tallyworks.llm import registry

FOLDER = "/root/testdata/sf0.001"
DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_query_for_each_operator():
    import __spark_entry__

    names = sorted(registry.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert {*names, "pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_runs(spark, name):
    df = registry.QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in registry.SQL:
        found = connect(FOLDER).execute(registry.SQL[name])
        columns, want = [d[0] for d in found.description], found.fetchall()
        assert sorted(columns) == sorted(df.columns) and _sorted(rows, df.columns) == _sorted(want, columns)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.common.stored(stage(spark, docs, FOLDER), "stage")
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == DOCS
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0 and counts[4] == counts[5] > 0


def test_pipeline_on_odd_rows(spark, tmp_path):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa "
    rows = [(1, long, "en", "a", 9), (2, long + "x", "en", "a", 9), (3, None, None, None, None), (4, "", "en", "b", 0), (None, "no id", "en", None, 5), (5, "five", "en", "b", 4),
            (5, "five", "en", "b", 4)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = corpus_pipeline.common.stored(stage(spark, kept, str(tmp_path)), "stage")
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == sorted([1, 3, 4, None, 5], key=str)  # 2 has 6 of 7 shingles in common with 1
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
