"""The corpus pipeline: stages over documents, each written as a table before the next one reads it.

Every stage takes the documents its predecessor kept and returns their columns (the last one returns tokens). A row is
dropped only by what the stage is for: toxic documents, documents all of whose lines stand elsewhere, documents like
another one, and documents that the mix takes no copy of. Rows whose removal depends on their text alone are found by a
hash of the text, so null ids and repeated rows are treated like the others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import bpe, common, lines, mixing, ngram_join, toxicity

#: Rows of two numbers that may be broadcast (about 100 MB); more of them are joined by a shuffle.
SMALL = 4_000_000


def without(docs: DataFrame, drop: DataFrame, on: list[str | Column]) -> DataFrame:
    drop = common.stored(drop, "drop")
    return docs.join(F.broadcast(drop) if drop.count() <= SMALL else drop, on, "left_anti")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score under 0.5; the scores come from labels of rows that are not held out."""
    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("__text_hash"))
    scored = toxicity.score_documents(marked, common.table(spark, sf_dir, "labels"), keys=("__text_hash",))
    rejected = scored.where("predicted = 1").select("__text_hash").distinct()
    return without(docs.withColumn("__text_hash", F.xxhash64("text")), rejected, ["__text_hash"]).select(docs.columns)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another document holds first, of any length; one left without any text goes.

    Lines are compared without outer spaces, tabs and carriage returns.
    """
    done = lines.dedup_lines(docs)
    blank = F.length(F.trim(F.coalesce("kept_text", F.lit("")), F.lit(lines.BLANKS))) == 0
    done = done.where((F.col("n_removed") == 0) | ~blank)
    changed = F.col("n_removed") > 0
    return done.select(*[F.col("kept_text").alias(c) if c == "text" else
                         F.when(changed, F.length("kept_text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
                         for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are alike, the one with the least id, null last; rows of one id and text count as one document.

    Different texts under one id are documents of their own, told apart by a hash of id and text. Documents without words
    are like no other, so they stay; rows that repeat one of them under the same id go, those without an id stay.
    """
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    alike = common.stored(ngram_join.jaccard_classes(keyed.select("__key", "text"), key="__key"), "classes")
    ids = common.stored(keyed.groupBy("__key").agg(F.first("doc_id").alias("id"), F.count("*").alias("rows")), "ids")
    places = alike.where("n_shingles > 0").select("__key", "component_id").distinct().join(ids, "__key")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "__key")
    least = places.groupBy("component_id").agg(F.min(order)["__key"].alias("kept"))
    kept = without(keyed, places.join(least, "component_id").where("__key <> kept").select("__key"), ["__key"])
    empty = alike.where("n_shingles = 0").select("__key").distinct().join(ids.where("id is null"), "__key", "left_semi")
    again = common.stored(ids.where("rows > 1").join(empty, "__key", "left_anti").select("__key"), "again")
    if again.isEmpty():
        return kept.select(docs.columns)
    once = kept.join(again, "__key", "left_semi").dropDuplicates(["__key"])
    return kept.join(again, "__key", "left_anti").union(once).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes; columns named like the mix's own keep their values."""
    aside = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    times = F.slice(F.sequence(F.lit(0), F.col("copies")), 1, F.col("copies"))
    taken = mixing.mix(docs.withColumnsRenamed(aside)).withColumn("__copy", F.explode(times))
    return taken.select([F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of each document's tokens and of the text decoded from them."""
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keys=("doc_id", "source"),
                                outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [("toxicity", not_toxic), ("line dedup", without_boilerplate), ("n-gram Jaccard join", one_of_each_group),
          ("mixing sources", mixed), ("BPE encoding and decoding", tokens)]
#: Shingle sets, learned scores and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
