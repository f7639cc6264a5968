"""Exact near-duplicate vectors by a dual traversal of a cover tree.

Nested levels of centres with halving radii are laid over a bounded sample; every vector goes to its nearest leaf
centre. Covering radii are then measured over all vectors, so the bounds hold whatever the sample was. Starting with
(root, root), a pair of nodes is dropped when its centres are further apart than both radii and the threshold distance
together; the leaf pairs that are left are compared vector by vector. Leaves in tree order are cut into blocks of
bounded size, and a task has two blocks at once, whatever the size of a leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import components, query, stored, table
from tallyworks.llm.vectors import matrix, unit, usable

#: Vectors the centres are chosen from, centres at most in all, vectors in a block (as a mean), and blocks at most
#: (give or take a leaf's last one): with more vectors than BLOCK * BLOCKS the blocks grow instead.
FIT, CENTRES, BLOCK, BLOCKS = 4096, 512, 4096, 512


@dataclass
class Tree:
    """Centres of the leaves, and for each node its centre (a leaf's number), its children and its covering radius."""

    centres: np.ndarray
    node_centre: list[int]
    children: list[list[int]]
    leaf_node: list[int]


def lay(sample: np.ndarray, most: int) -> Tree:
    """Nested nets over unit vectors: at each level a centre lies further than the level's radius from all others.

    Radii halve from 2 (one centre covers the sphere) until the net would exceed `most` centres or holds every vector.
    A level keeps the centres of the one above, and a new centre is the child of the nearest centre above it.
    """
    chosen = [0] if len(sample) else []
    centre, children = list(chosen), [[] for _ in chosen]
    at = {0: 0}  # centre (row of the sample) -> its node at the present level
    radius = 2.0
    while len(chosen) < len(sample) and radius > 1e-3:
        radius /= 2
        net = list(chosen)
        near = np.full(len(sample), np.inf)
        for c in net:
            near = np.minimum(near, apart(sample, sample[c:c + 1])[:, 0])
        for i in range(len(sample)):
            if near[i] > radius:
                net.append(i)
                if len(net) > most:
                    break
                near = np.minimum(near, apart(sample, sample[i:i + 1])[:, 0])
        if len(net) > most:
            break
        parents = apart(sample[net], sample[chosen]).argmin(axis=1)
        below = {}
        for c, parent in zip(net, parents):
            parent = chosen.index(c) if c in at else parent
            below[c] = len(centre)
            centre.append(c)
            children.append([])
            children[at[chosen[parent]]].append(below[c])
        chosen, at = net, below
    leaves: list[int] = []  # in tree order, so that near leaves stand together

    def walk(node: int) -> None:
        if not children[node]:
            leaves.append(node)
        for c in children[node]:
            walk(c)

    if centre:
        walk(0)
    number = {centre[n]: i for i, n in enumerate(leaves)}
    return Tree(sample[[centre[n] for n in leaves]], [number[c] for c in centre], children, leaves)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(0.0, 2 - 2 * (a @ b.T)))


def surviving(tree: Tree, radius: np.ndarray, far: float) -> list[tuple[int, int]]:
    """Pairs of leaves (i <= j) that may hold vectors at most `far` apart, by traversing the tree with itself."""
    covers = [0.0] * len(tree.children)
    for node in reversed(range(len(covers))):  # children come after their parents
        mine = tree.centres[tree.node_centre[node]][None]
        covers[node] = max((float(apart(mine, tree.centres[tree.node_centre[c]][None])[0, 0]) + covers[c] for c in tree.children[node]), default=0.0)
        if not tree.children[node]:
            covers[node] = float(radius[tree.node_centre[node]])
    between = apart(tree.centres, tree.centres)
    out, todo = set(), [(0, 0)] if tree.children else []
    while todo:
        a, b = todo.pop()
        ca, cb = tree.node_centre[a], tree.node_centre[b]
        if between[ca, cb] > covers[a] + covers[b] + far + 1e-6:
            continue
        if not tree.children[a] and not tree.children[b]:
            if radius[ca] >= 0 and radius[cb] >= 0:
                out.add((min(ca, cb), max(ca, cb)))
        elif a == b:
            kids = tree.children[a]
            todo += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
        elif tree.children[a] and (not tree.children[b] or covers[a] >= covers[b]):
            todo += [(c, b) for c in tree.children[a]]
        else:
            todo += [(a, c) for c in tree.children[b]]
    return sorted(out)


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a[i] with b[i]; a label is the least member of its group."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label = up


def near_links(vectors: DataFrame, vec: str = "embedding", cosine: float = 0.95, fit: int = FIT, centres: int = CENTRES, block: int = BLOCK) -> DataFrame:
    """(rep, n_links, root) of distinct usable vectors given as rows (rep, m, vec); m is how many rows have the vector.

    n_links counts rows of other vectors with at least the given cosine, root is the least rep reachable by links.
    Blocks that may hold links meet in pairs, each pair in a task of its own with at most some thousand vectors a side.
    Of the links found there, counts and a spanning forest leave the task, never all pairs of a dense group.
    """
    spark = vectors.sparkSession
    far = float(np.sqrt(2 - 2 * cosine))
    sample = vectors.orderBy(F.xxhash64(F.lit("fit"), "rep")).limit(fit).select(F.col(vec).alias("v")).toArrow()  # at most fit rows
    points = unit(matrix(sample["v"])) if sample.num_rows else np.zeros((0, 1))
    tree = lay(points, centres)
    known = spark.sparkContext.broadcast(tree.centres)
    step = 1024

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = unit(matrix(b.column("v")))
            d = np.concatenate([apart(x[i:i + step], known.value) for i in range(0, len(x), step)])
            leaf = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("m"), pa.array(leaf.astype(np.int32)), pa.array(d[np.arange(len(x)), leaf]),
                                              b.column("v")], names=["rep", "m", "leaf", "d", "v"])

    placed = stored(vectors.select("rep", "m", F.col(vec).alias("v")).mapInArrow(assign, f"rep long, m long, leaf int, d double, v {vectors.schema[vec].dataType.simpleString()}"), "placed")
    facts = {r["leaf"]: r for r in placed.groupBy("leaf").agg(F.count("*").alias("n"), F.max("d").alias("d")).collect()}  # centres rows
    radius = np.array([facts[i]["d"] if i in facts else -1.0 for i in range(len(tree.centres))])
    pairs = surviving(tree, radius, far)
    # Leaves in tree order are packed into blocks; a leaf larger than a block is cut into several.
    block = max(block, -(-sum(f["n"] for f in facts.values()) // BLOCKS))
    first, cuts, room, number = {}, {}, 0, -1
    for leaf in range(len(tree.centres)):
        n = facts[leaf]["n"] if leaf in facts else 0
        if not n:
            continue
        parts = -(-n // block)
        if parts > 1 or number < 0 or room < n:
            number, room = number + 1, block
        first[leaf], cuts[leaf] = number, parts
        number, room = number + parts - 1, room - n if parts == 1 else 0
    meet: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a, b in pairs:
        for i in range(cuts[a]):
            for j in range(cuts[b]):
                p, q = sorted((first[a] + i, first[b] + j))
                meet.setdefault((p, q), []).append((a, b))
    places = spark.createDataFrame([(leaf, first[leaf], cuts[leaf]) for leaf in first] or [(-1, 0, 1)], "leaf int, first int, cuts int")
    of_block = spark.createDataFrame([(b, p * (number + 1) + q) for p, q in meet for b in {p, q}] or [(-1, 0)], "block int, meeting long")
    rows = (placed.join(F.broadcast(places), "leaf")
            .withColumn("block", (F.col("first") + F.pmod(F.xxhash64("rep"), F.col("cuts"))).cast("int"))
            .join(F.broadcast(of_block), "block").select("meeting", "block", "rep", "m", "leaf", "v"))
    n_blocks = number + 1

    allowed = np.zeros((len(tree.centres), len(tree.centres)), bool)
    for a, b in pairs:
        allowed[a, b] = allowed[b, a] = True
    open_pairs = spark.sparkContext.broadcast(allowed)

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = divmod(int(key[0]), n_blocks)
        pdf = pdf.sort_values(["leaf", "rep"], ignore_index=True)
        u = unit(np.stack(pdf["v"].to_numpy()).astype(np.float64))
        blocks, rep, m, leaf = (pdf[c].to_numpy() for c in ("block", "rep", "m", "leaf"))
        ia, ib = np.flatnonzero(blocks == p), np.flatnonzero(blocks == q)
        count, label = np.zeros(len(u), np.int64), np.arange(len(u))
        # Half of the components and the length of the rest bound the cosine from above; only what may reach the
        # threshold is worked out in full.
        legs = max(1, u.shape[1] // 2)
        rest = np.sqrt((u[:, legs:] ** 2).sum(axis=1, keepdims=True))
        short = np.concatenate([u[:, :legs], rest], axis=1).astype(np.float32)
        for s in range(0, len(ia), step):
            for t in range(s if p == q else 0, len(ib), step):
                x, y = ia[s:s + step], ib[t:t + step]
                if not open_pairs.value[np.ix_(np.unique(leaf[x]), np.unique(leaf[y]))].any():
                    continue
                i, j = np.nonzero(short[x] @ short[y].T >= cosine - 1e-4)
                if p == q and s == t:
                    i, j = i[i < j], j[i < j]
                for at in range(0, len(i), 1 << 15):
                    a, b = x[i[at:at + (1 << 15)]], y[j[at:at + (1 << 15)]]
                    hit = (u[a] * u[b]).sum(axis=1) >= cosine
                    a, b = a[hit], b[hit]
                    np.add.at(count, a, m[b])
                    np.add.at(count, b, m[a])
                    label = joined(label, a, b)
        linked = count > 0
        return pd.DataFrame({"rep": rep[linked], "n": count[linked], "other": rep[label[linked]]})

    found = stored(rows.groupBy("meeting").applyInPandas(compare, "rep long, n long, other long"), "links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n_links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    return counts.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select("rep", "n_links", "root")


def near_duplicates(df: DataFrame, key: str = "vec_id", vec: str = "embedding", cosine: float = 0.95, **sizes: int) -> DataFrame:
    """One row per vector: key, `n_links`, `component_id`, `kept`.

    Links: cosine >= `cosine` in double precision. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing. Equal vectors are worked out once; repeated rows count as vectors of their own, so two
    equal rows link with each other. component_id is the least key reachable, a null key counts as none; vectors of
    unlike lengths never link. Ties cannot arise. Other columns are not read; an empty table gives an empty one.
    """
    rows = df.select(F.col(key).alias("id"), F.col(vec).alias("v")).withColumn("ok", usable(F.col("v")))
    rows = rows.withColumn("v", F.when(F.col("ok"), F.col("v")))
    # Equal vectors by their value: one row each with their number and least id.
    same = stored(rows.where("ok").groupBy("v").agg(F.count("*").alias("m"), F.min("id").alias("least"))
                  .withColumn("rep", F.monotonically_increasing_id()).withColumn("size", F.size("v")), "same")
    found = None
    for (size,) in same.select("size").distinct().collect():  # lengths of vectors, as a rule one
        part = near_links(same.where(F.col("size") == size).select("rep", "m", "v"), "v", cosine, **sizes)
        found = part if found is None else found.union(part)
    if found is None:
        found = same.select("rep", F.lit(0).cast("long").alias("n_links"), F.col("rep").alias("root"))
    each = (same.join(found, "rep", "left").select("v", "m", "least", F.coalesce("n_links", F.lit(0)).alias("others"), F.coalesce("root", "rep").alias("root")))
    least = each.groupBy("root").agg(F.min("least").alias("component_id"))
    each = each.join(least, "root").select("v", (F.col("others") + F.col("m") - 1).alias("n_links"), "component_id")
    linked = rows.where("ok").join(each, "v").select("id", "n_links", "component_id")
    alone = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.union(alone)
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op1_embedding_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))
