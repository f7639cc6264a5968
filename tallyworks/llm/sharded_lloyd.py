"""Centroid clustering with the dimensions dealt to shards, in whole numbers.

Vectors are cut into chunks of rows and shards of columns; one row of the written table is one such block, in buckets of
(shard, chunk). In a round each block's task works out the exact partial distances of its rows to its slice of the
centroids. The partial distances of a chunk are added up over its shards and give each row's nearest centroid. These
choices, a few bytes a row, go back to the blocks by a join whose large side is never shuffled again, and each shard adds
up its own columns for each cluster and moves its own slice. Only the slices come to the driver: centroids x components
numbers. The next round's tasks get them with their function, each using its own slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import query, stored, table
from tallyworks.sources.staging import bucketed

#: Rows of a chunk: its partial distances to a hundred centroids take 1.6 MB.
ROWS = 2048
#: Whole numbers beyond this could overflow 64 bits when squared and added up.
LARGEST = 1 << 27
BLOCK = "chunk long, shard int, n int, data binary"


def whole_numbers(vec: F.Column, components: int) -> F.Column:
    """Whether a vector has the number of components and all of them are finite numbers."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) == components) & fine, F.lit(False))


def blocks(rows: DataFrame, components: int, shards: int, scale: float) -> DataFrame:
    """One row a chunk and shard: the whole numbers of its rows and columns; shard 0 also has the keys of the rows."""
    edges = np.linspace(0, components, shards + 1).astype(int).tolist()
    kind = rows.schema["key"].dataType
    schema = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("n", pa.int32()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                b = whole.slice(start, ROWS)
                x = b.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, components)
                with np.errstate(over="ignore"):
                    x = np.floor(x * scale)
                if np.abs(x).max() > LARGEST:
                    raise ValueError(f"a component times {scale:g} lies beyond {LARGEST}")
                x = x.astype(np.int64)
                data = [np.ascontiguousarray(x[:, a:z]).tobytes() for a, z in zip(edges, edges[1:])]
                made = pa.RecordBatch.from_arrays([pa.array([v] * shards, f.type) if not isinstance(v, list) else pa.array(v, f.type)
                                                   for v, f in zip((chunk, list(range(shards)), b.num_rows, data), schema)], schema=schema)
                keys = b.column("key")
                lists = pa.ListArray.from_arrays(pa.array([0] + [len(keys)] * shards, pa.int32()), keys)
                yield made.append_column("keys", lists)
                chunk += 1

    return rows.mapInArrow(run, f"{BLOCK}, keys array<{kind.simpleString()}>")


def partial_distances(parts: DataFrame, centroids: np.ndarray, edges: list[int]) -> DataFrame:
    """Column-block tasks: squared distances of a block's rows to the centroids, over the block's columns alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for shard, n, data in zip(*(b.column(c).to_pylist() for c in ("shard", "n", "data"))):
                part, own = np.frombuffer(data, np.int64).reshape(n, -1), centroids[:, edges[shard]:edges[shard + 1]]
                sums = np.empty((n, len(own)), np.int64)
                for k, centre in enumerate(own):
                    off = part - centre
                    sums[:, k] = np.einsum("ij,ij->i", off, off)
                out.append(sums.tobytes())
            yield pa.RecordBatch.from_arrays([b.column("chunk"), b.column("n"), pa.array(out, pa.binary())], names=["chunk", "n", "sums"])

    return parts.select("chunk", "shard", "n", "data").mapInArrow(run, "chunk long, n int, sums binary")


def nearest(partial: DataFrame, k: int) -> DataFrame:
    """The blocks of a chunk added up, and each row's nearest centroid; of equally near ones the first.

    A group is one chunk: as many rows as there are shards.
    """
    def add(group: pa.Table) -> pa.Table:
        n = group.column("n")[0].as_py()
        total = np.zeros(n * k, np.int64)
        for sums in group.column("sums"):
            total += np.frombuffer(sums.as_buffer(), np.int64)
        total = total.reshape(n, k)
        best = total.argmin(1)
        return pa.table({"chunk": pa.array([group.column("chunk")[0].as_py()], pa.int64()),
                         "choice": pa.array([best.astype(np.int32).tobytes()], pa.binary()),
                         "far": pa.array([total[np.arange(n), best].tobytes()], pa.binary())})

    return partial.groupBy("chunk").applyInArrow(add, "chunk long, choice binary, far binary")


def slice_sums(parts: DataFrame, chosen: DataFrame, k: int, edges: list[int]) -> DataFrame:
    """Each shard's own columns added up for each cluster: rows (cluster, component, total, n), reduced in the tasks."""
    shards = len(edges) - 1
    to_all = chosen.select("chunk", "choice", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, seen = [np.zeros((k, z - a), np.int64) for a, z in zip(edges, edges[1:])], np.zeros((shards, k), np.int64), set()
        for b in batches:
            for shard, n, data, choice in zip(*(b.column(c).to_pylist() for c in ("shard", "n", "data", "choice"))):
                choice = np.frombuffer(choice, np.int32)
                np.add.at(sums[shard], choice, np.frombuffer(data, np.int64).reshape(n, -1))
                counts[shard] += np.bincount(choice, minlength=k)
                seen.add(shard)
        for shard in sorted(seen):
            width = edges[shard + 1] - edges[shard]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(k, dtype=np.int32), width)), pa.array(np.tile(np.arange(edges[shard], edges[shard + 1], dtype=np.int32), k)),
                 pa.array(sums[shard].ravel()), pa.array(np.repeat(counts[shard], width))], names=["cluster", "component", "total", "n"])

    met = parts.select("shard", "chunk", "n", "data").join(to_all, ["shard", "chunk"])
    rows = met.mapInArrow(run, "cluster int, component int, total long, n long")
    return rows.groupBy("cluster", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def first_centroids(rows: DataFrame, k: int, seed: str) -> DataFrame:
    """The k rows with the least sha256 of seed and key; of one key the lesser vector first, null keys last."""
    return rows.withColumn("order", F.sha2(F.concat(F.lit(seed), F.col("key").cast("string")), 256)).orderBy(F.asc_nulls_last("order"), "v").limit(k)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, key: str = "vec_id", vec: str = "embedding", components: int = 64,
            scale: float = 1024.0, seed: str = "3:", shards: int = 8) -> DataFrame:
    """Lloyd's rounds over floor(scale * x), exact in 64-bit whole numbers; one row for each kept vector.

    Columns: the key, cluster, distance (squared, to the final centroid), cluster_inertia, inertia, centroid_sha256.
    Vectors that are null or have another number of components, a null or a non-finite one, are left out. Rows are
    vectors of their own: a key that stands twice, or a null key, is kept as often. With fewer than k rows there are as
    many centroids as rows; an empty table gives no rows. Ties go to the smaller number, and an empty cluster keeps its
    centroid. Other columns are not read. Components beyond 2^27 after scaling are refused: they would overflow.
    """
    shards = min(shards, components)
    edges = np.linspace(0, components, shards + 1).astype(int).tolist()
    kept = vectors.select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("v"))
    kept = kept.where(whole_numbers(F.col("v"), components))
    parts = bucketed(blocks(kept, components, shards, scale), "lloyd_blocks", ["shard", "chunk"])
    centroids = np.array([r["v"] for r in first_centroids(kept, k, seed).collect()], np.float64).reshape(-1, components)
    centroids = np.floor(centroids * scale).astype(np.int64)
    k = len(centroids)
    if not k:
        return kept.select(F.col("key").alias(key), *[F.lit(0).cast(t).alias(c) for c, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"))], F.lit("").alias("centroid_sha256"))
    for _ in range(rounds):
        chosen = nearest(partial_distances(parts, centroids, edges), k)
        moved = centroids.copy()
        for c, j, total, n in slice_sums(parts, chosen, k, edges).collect():
            if n:
                moved[c, j] = total // n
        if (moved == centroids).all():
            break
        centroids = moved
    chosen = nearest(partial_distances(parts, centroids, edges), k)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, choice, far in zip(b.column("keys"), b.column("choice"), b.column("far")):
                yield pa.RecordBatch.from_arrays([keys.values, pa.array(np.frombuffer(choice.as_buffer(), np.int32)), pa.array(np.frombuffer(far.as_buffer(), np.int64))],
                                                 names=["key", "cluster", "distance"])

    placed = parts.where("shard = 0").select("chunk", "keys").join(chosen, "chunk")
    kind = kept.schema["key"].dataType.simpleString()
    placed = stored(placed.mapInArrow(spread, f"key {kind}, cluster int, distance long"), "lloyd-clusters")
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    sizes = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sizes = sizes.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))  # k rows at most
    sizes = sizes.join(F.broadcast(vectors.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")), "cluster")
    return placed.join(F.broadcast(sizes), "cluster").select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def lloyd_sql(k: int = 8, rounds: int = 10, components: int = 64) -> str:
    """The same rounds, one after the other, as common table expressions."""
    floor_div = "((s - ((s % n) + n) % n) // n)::BIGINT"
    parts = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
      WHERE len(embedding) = {components} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {components})""",
             "flat AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM kept)",
             f"""c0 AS MATERIALIZED (SELECT c, unnest(v) AS y, generate_subscripts(v, 1) AS j FROM (SELECT v, row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR), v) - 1 AS c FROM kept)
      WHERE c < {k})"""]

    def near(i: int) -> str:
        return f"""d{i} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, c := c)) AS m FROM (SELECT r, c, sum((x - y) * (x - y))::BIGINT AS d
      FROM flat JOIN c{i} USING (j) GROUP BY r, c) GROUP BY r)"""

    for i in range(rounds):
        parts += [near(i), f"""c{i + 1} AS MATERIALIZED (SELECT o.c, o.j, CASE WHEN t.n IS NULL THEN o.y ELSE t.y END AS y FROM c{i} o LEFT JOIN (
      SELECT c, j, n, {floor_div} AS y FROM (SELECT m.c AS c, j, sum(x) AS s, count(*) AS n FROM flat JOIN d{i} USING (r) GROUP BY ALL)) t ON o.c = t.c AND o.j = t.j)"""]
    parts += [near(rounds), f"""digest AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY j)) AS h FROM c{rounds} GROUP BY c)"""]
    return "WITH " + ",\n    ".join(parts) + f"""
    SELECT vec_id, m.c::INTEGER AS "cluster", m.d AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia,
      (sum(m.d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
    FROM d{rounds} JOIN kept USING (r) JOIN digest ON digest.c = m.c"""


@query("op12_sharded_lloyd", lloyd_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return cluster(table(spark, folder, "embeddings"))
