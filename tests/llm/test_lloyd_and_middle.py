"""Sharded centroid rounds and fill-in-the-middle against plain Python."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from tallyworks.llm import fill_middle, sharded_lloyd

NAN, INF = float("nan"), float("inf")


def plain_lloyd(rows, k, rounds, components, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            own = [v for (_, v), i in zip(kept, at) if i == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    out = [(i, near(v)) for i, v in kept]
    each = [sum(d for _, (d, j) in out if j == c) for c in range(len(centroids))]
    return sorted(((i, c, d, each[c], sum(each), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, (d, c) in out), key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, key int, chunk int, shard int")


@pytest.mark.parametrize("seed, shards", [(1, 1), (2, 3), (3, 8)])
def test_rounds_as_plain_python(spark, seed, shards):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice((-1, 0, 1)) + rnd.randrange(-64, 64) / 256 for _ in range(8)]) for i in range(300)]
    rows += [(7, rows[3][1]), (7, rows[4][1]), (None, rows[5][1]), (None, rows[6][1]), (400, None), (401, []), (402, [1.0] * 7), (403, [NAN] * 8), (404, [INF] + [0.0] * 7),
             (405, [None] + [0.0] * 7), (406, [0.0] * 8), (406, [0.0] * 8)]
    got = sharded_lloyd.cluster(table(spark, rows).repartition(5), k=5, rounds=4, components=8, shards=shards)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_lloyd(rows, 5, 4, 8)


def test_many_chunks_add_up(spark, monkeypatch):
    monkeypatch.setattr(sharded_lloyd, "ROWS", 16)
    rnd = random.Random(9)
    rows = [(i, [float(np.float32(rnd.gauss(0, 1))) for _ in range(4)]) for i in range(500)]
    got = sharded_lloyd.cluster(table(spark, rows).repartition(3), k=4, rounds=3, components=4, shards=4)
    assert sorted(map(tuple, got.collect()), key=str) == plain_lloyd(rows, 4, 3, 4)


def test_few_and_no_vectors(spark):
    rows = [(1, [0.5, 0.5]), (2, [0.25, 1.0])]
    got = sharded_lloyd.cluster(table(spark, rows), k=8, components=2)
    assert sorted(map(tuple, got.collect()), key=str) == plain_lloyd(rows, 8, 10, 2)
    none = sharded_lloyd.cluster(table(spark, [(1, None)]), components=2)
    assert none.columns == got.columns and none.collect() == []


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="lies beyond"):
        sharded_lloyd.cluster(table(spark, [(1, [1e30, 0.0])]), components=2).collect()


def plain_middle(i, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    a, b, c, d = (int(h[8 * j:8 * j + 8], 16) for j in range(4))
    a, b = sorted((a % (len(units) + 1), b % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return i, len(units), "plain", None, None, text, text
    form = "spm" if d % 100 < 20 else "psm"
    return i, len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}", text


def test_middle_as_plain_python(spark, monkeypatch):
    rnd = random.Random(4)
    alphabet = "abcXYZ  <>PSM\n\t\r.,éß日😀ÿ\x00"
    rows = [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60)))) for i in range(400)]
    rows += [(500 + i, f"{'<' * i}<{m}>") for i, m in enumerate("PSMQ")] + [(600, None), (601, ""), (None, "no id é"), (None, "no id é"), (602, "same"), (602, "same"), (603, "x" * 300_000 + " y" * 50_000)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, key int, h0 int")
    for size in (fill_middle.BYTES, 100):
        monkeypatch.setattr(fill_middle, "BYTES", size)
        made = fill_middle.fill_middle(docs)
        got = made.withColumn("restored", fill_middle.restored(made["output"], made["form"])).collect()
        assert sorted(map(tuple, got), key=str) == sorted([plain_middle(i, t) for i, t in rows], key=str)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_middle(docs.where("false")).count() == 0
