"""Stages of the pipeline on rows that they must not cut short."""

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import documents


def test_short_lines_on_many_sources_go(spark):
    rows = [(i, f"own line number {i}\nThing.\n\nend {i}", f"s{i % 6}") for i in range(12)] + [(50, "Thing.", "s1"), (51, "Few.\nx", "s1"), (52, "Few.\ny", "s2")]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.without_boilerplate(spark, documents(spark, rows), "").collect()}
    assert got == {0: rows[0][1], 51: "Few.\nx", 52: "Few.\ny"} | {i: f"own line number {i}\n\nend {i}" for i in range(1, 12)}


def test_texts_under_one_id_are_told_apart(spark):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa "
    rows = [(1, long, "a"), (2, long + "x", "a"), (2, "a clean text of its own", "b"), (3, "one text", "a"), (3, "another text", "a"), (3, "another text", "a"),
            (None, "null here null there", "a"), (None, "null here null there", "a"), (None, long, "b"), (None, None, "a"), (None, None, "a"), (7, None, "a"), (7, "", "a"), (7, "", "a")]
    got = corpus_pipeline.one_of_each_group(spark, documents(spark, rows), "").collect()
    want = [rows[i] for i in (0, 2, 3, 4, 6, 9, 10, 11, 12)]
    assert sorted([(r["doc_id"], r["text"], r["source"]) for r in got], key=str) == sorted(want, key=str)


def test_columns_named_like_those_of_the_mix_stay(spark):
    docs = documents(spark, [(i, "some words here", f"s{i % 2}") for i in range(20)])
    for i, c in enumerate(["size", "source_size", "target", "rate", "copies", "taken", "Words"]):
        docs = docs.withColumn(c, F.col("doc_id") * 100 + i)
    got = corpus_pipeline.mixed(spark, docs, "")
    assert got.columns == docs.columns
    rows = got.collect()
    assert rows and set(rows) <= set(docs.collect())


def test_line_ends_of_either_kind_are_one_line(spark):
    rows = [(i, f"own {i}\n" + ["a common line", "a common line\r", "\ta common line "][i % 3] + f"\nend {i}", f"s{i}") for i in range(6)] + [(9, "a common line\r", "s1")]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.without_boilerplate(spark, documents(spark, rows), "").collect()}
    assert got == {0: rows[0][1]} | {i: f"own {i}\nend {i}" for i in range(1, 6)}
