"""Nearest neighbours by inner product with an inverted multi-index.

Vectors are cut into two halves; each half is quantised by a codebook of its own, fitted on a bounded sample. A cell is
a pair of centroids, and every vector is entered in one cell. A query goes through the cells by the sum of its halves'
distances (how far each centroid's inner product falls short of the best), with a heap over the two sorted lists, until
the cells it has opened hold a given share of all vectors. Their entries are ranked by the original vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import query, stored, table
from tallyworks.llm.vectors import matrix, usable

#: Centroids a half, vectors the codebooks are fitted on, and entries or queries that one task has at a time.
CENTROIDS, FIT, CHUNK = 32, 8192, 8192


def codebook(points: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """k-means with the farthest-first start thinned by order; the sample decides it, so equal samples give equal books."""
    points = np.unique(points, axis=0)
    size = min(size, len(points))
    book = points[np.linspace(0, len(points) - 1, size).astype(int)] if size else points
    for _ in range(rounds):
        near = nearest_centroid(points, book)
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=size)[:, None]
        book = np.where(n > 0, sums / np.maximum(n, 1), book)
    return book


def nearest_centroid(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(axis=1)[None] - 2 * (points @ book.T)).argmin(axis=1)


def cells_in_order(short_u: np.ndarray, short_v: np.ndarray) -> Iterator[tuple[int, int]]:
    """Centroid pairs by the sum of their distances, by a heap over the two sorted lists."""
    iu, iv = np.argsort(short_u, kind="stable").tolist(), np.argsort(short_v, kind="stable").tolist()
    du, dv = short_u[iu].tolist(), short_v[iv].tolist()
    heap = [(du[0] + dv[0], 0, 0)]
    while heap:
        _, a, b = heapq.heappop(heap)
        yield iu[a], iv[b]
        # Each pair is reached once: along the second list from any pair, along the first only from its start.
        if b + 1 < len(iv):
            heapq.heappush(heap, (du[a] + dv[b + 1], a, b + 1))
        if b == 0 and a + 1 < len(iu):
            heapq.heappush(heap, (du[a + 1] + dv[0], a + 1, 0))


def search(df: DataFrame, is_query: Column, k: int = 20, share: float = 0.6, centroids: int = CENTROIDS, fit: int = FIT,
           key: str = "vec_id", vec: str = "embedding", chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, key, score): for each query row the k rows of largest inner product found, but its own.

    Rows are told apart by the key, and a query's own are all rows with its key; rows with a null key take no part, nor
    do vectors that are null, empty, zero or hold null or non-finite components, nor ones of another length than most
    of the sample. A query key that repeats is answered once, for the least of its vectors; a candidate key that repeats takes
    one place, with its best score. Ties go to the smaller key. Fewer than k candidates: all.
    Only the codebooks depend on the sample (`fit` rows at most); every row is entered. `share` of all entries are
    compared with a query at least: more gives more recall. Tasks work on a chunk of a centroid's entries and a chunk
    of the queries, so neither a full centroid nor many queries meet in one task.
    """
    spark = df.sparkSession
    rows = df.where(usable(F.col(vec)) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vec).alias("v"), is_query.alias("q"))
    empty = spark.createDataFrame([], f"query_id long, rank int, {key} long, score double")
    sample = rows.orderBy(F.xxhash64(F.lit("fit"), "id"), "id").limit(fit).select("v", F.size("v").alias("n")).toArrow()  # at most fit rows
    if not sample.num_rows:
        return empty
    lengths = sample["n"].to_numpy()
    width = int(np.bincount(lengths).argmax())
    rows = rows.where(F.size("v") == width)
    points = matrix(sample["v"].filter(pa.array(lengths == width)))
    half = max(1, width // 2)
    books = spark.sparkContext.broadcast((codebook(points[:, :half], centroids), codebook(points[:, half:], centroids) if width > half else np.zeros((1, 0))))

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v")) if b.num_rows else np.zeros((0, width))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), b.column("q"), pa.array(nearest_centroid(x[:, :half], books.value[0]).astype(np.int32)),
                                              pa.array(nearest_centroid(x[:, half:], books.value[1]).astype(np.int32))], names=["id", "v", "q", "cu", "cv"])

    kind = rows.schema["v"].dataType.simpleString()
    entries = stored(rows.mapInArrow(enter, f"id long, v {kind}, q boolean, cu int, cv int"), "entries")
    held = np.zeros((len(books.value[0]), len(books.value[1])), np.int64)
    for r in entries.groupBy("cu", "cv").agg(F.count("*").alias("n")).collect():  # one row a cell: centroids squared at most
        held[r["cu"], r["cv"]] = r["n"]
    total = int(held.sum())
    if not total:
        return empty
    sizes = spark.sparkContext.broadcast(held)
    # A margin for the query's own rows, which do not count.
    wanted = max(int(np.ceil(share * total)), 2 * k + 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("v"))
            by_u, by_v = x[:, :half] @ books.value[0].T, x[:, half:] @ books.value[1].T
            by_u, by_v = by_u.max(axis=1, keepdims=True) - by_u, by_v.max(axis=1, keepdims=True) - by_v
            at, cu, opened = [], [], []
            for i in range(len(x)):
                found, cells = 0, {}
                for u, v in cells_in_order(by_u[i], by_v[i]):
                    if n := sizes.value[u, v]:
                        cells.setdefault(u, []).append(v)
                        found += n
                        if found >= wanted:
                            break
                for u, vs in cells.items():
                    at.append(i)
                    cu.append(u)
                    opened.append(vs)
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("id").take(at), b.column("v").take(at), pa.array(cu, pa.int32()), pa.array(opened, pa.list_(pa.int32()))],
                                             names=["query_id", "v", "cu", "cells"])

    queries = entries.where("q").groupBy("id").agg(F.min("v").alias("v"))  # of several vectors under one id the least asks
    n_queries = queries.count()
    parts = {u: max(1, -(-int(n) // chunk)) for u, n in enumerate(held.sum(axis=1))}
    q_parts = max(1, -(-n_queries // chunk))
    layout = F.broadcast(spark.createDataFrame(list(parts.items()), "cu int, parts int"))  # one row a centroid
    asked = (queries.mapInArrow(probe, f"query_id long, v {kind}, cu int, cells array<int>").join(layout, "cu")
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("q_part", F.pmod(F.xxhash64("query_id"), F.lit(q_parts)).cast("int")))
    offered = (entries.join(layout, "cu").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
               .withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(q_parts - 1)))))
    cells = len(books.value[1])

    def rank(asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(offered):
            ids, cv, x = offered["id"].to_numpy(), offered["cv"].to_numpy(), np.stack(offered["v"].to_numpy()).astype(np.float64)
            # Rows under one id take one place: as many more are looked at as an id has rows here.
            wide = k * int(np.unique(ids, return_counts=True)[1].max())
            for s in range(0, len(asked), 256):
                some = asked.iloc[s:s + 256]
                qid, q = some["query_id"].to_numpy(), np.stack(some["v"].to_numpy()).astype(np.float64)
                opened = np.zeros((len(some), cells), bool)
                for i, c in enumerate(some["cells"]):
                    opened[i, np.asarray(c, int)] = True
                score = np.where(opened[:, cv] & (ids[None] != qid[:, None]), q @ x.T, -np.inf)
                top = np.argpartition(-score, wide - 1, axis=1)[:, :wide] if len(ids) > wide else np.tile(np.arange(len(ids)), (len(some), 1))
                least = np.take_along_axis(score, top, axis=1).min(axis=1)
                for i in range(len(some)):
                    # Whatever comes within rounding of the last place is scored again, alike for equal vectors.
                    near = np.flatnonzero((score[i] > -np.inf) & (score[i] >= least[i] - 1e-9 * (1 + abs(least[i]))))
                    exact = (x[near] * q[i]).sum(axis=1)
                    best = np.lexsort((ids[near], -exact))
                    best = best[np.sort(np.unique(ids[near][best], return_index=True)[1])[:k]]
                    out.append(pd.DataFrame({"query_id": qid[i], "id": ids[near][best], "score": exact[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "score": np.zeros(0)})

    by = ["cu", "part", "q_part"]
    found = asked.groupBy(*by).cogroup(offered.select(*by, "id", "cv", "v").groupBy(*by)).applyInPandas(rank, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.groupBy("query_id", "id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(key), "score"))


@query("op3_multi_index")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
