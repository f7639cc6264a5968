"""What several operators share: reading tables, tables written in the shared folder, text passes, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.session import shared_folder

#: White space that separates words, as a Java regular expression class.
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the folder that all executors share: cuts the lineage, and no branch works it out again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


_KEPT: dict = {}


def kept(key: str, make: Callable[[], object]) -> object:
    """What make returns, kept by this Python worker for its later tasks: a vocabulary and what it has worked out.

    One at a time: workers are used again by other stages, so what an earlier stage kept goes when the next one comes.
    """
    if key not in _KEPT:
        forget()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Give up what this worker keeps, for stages that need its memory."""
    _KEPT.clear()


class TwoAges(dict):
    """A memory of bounded size: when full it becomes the old one, whose entries come back when they are asked for."""

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most, self.old = most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.work(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def over_texts(df: DataFrame, keys: Iterable[str], text: str, schema: str,
               make: Callable[[], Callable[[list], dict[str, list]]], as_bytes: bool = False, at_once: int | None = None) -> DataFrame:
    """The key columns, and what a Python function makes of each whole text, batch by batch.

    `make` runs once a task and returns the function; that gets a list of texts (null: None) and returns a list for
    each column of `schema`. Columns of df other than keys and text are not read, so their names cannot clash.
    `at_once` bounds the texts that are handed over together; by default they are those of an Arrow batch.
    """
    keys = list(keys)
    value = F.col(text).cast("binary") if as_bytes else F.col(text)
    rows = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], value.alias("t"))
    kinds = ", ".join(f"k{i} {rows.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keys)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for b in (part for whole in batches for part in ([whole] if at_once is None else (whole.slice(i, at_once) for i in range(0, whole.num_rows, at_once)))):
            made = work(b.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(f"k{i}") for i in range(len(keys))]
                                             + [v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()],
                                             names=[f"k{i}" for i in range(len(keys))] + list(made))

    out = rows.mapInArrow(run, f"{kinds}, {schema}" if kinds else schema)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)],
                      *[c for c in out.columns if c not in {f"k{i}" for i in range(len(keys))}])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (id, root) per linked id, root the smallest id of its component.

    Alternating large-star and small-star rounds. Each round points every neighbour at the least one by a partial
    aggregation and a join back, never by gathering a node's neighbours; a hub's rows can be split by the join. A round
    is written to the shared folder, so a lost executor costs one round. The rounds grow with the logarithm of the size.
    """
    links = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "links")
    before = None
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        links = stored(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
                links.select("b", F.col("b").alias("root")).distinct())
        before = now
