"""Vector operators and archives against brute force."""

import base64
import gzip
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import covertree, multi_index, warc
from tallyworks.llm.common import components
from tests.llm.helpers import groups

VECTORS = "vec_id long, embedding array<float>, n_links int"


def clustered(n, dims, seed, spread=0.05, centres=12):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dims))
    return (c[rng.integers(0, centres, n)] * rng.uniform(0.5, 2, (n, 1)) + spread * rng.normal(size=(n, dims))).astype(np.float32)


def plain_links(ids, rows, cosine=0.95):
    u = np.asarray(rows, float)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(u @ u.T >= cosine, 1))
    links = list(zip(i.tolist(), j.tolist()))
    part = groups(range(len(ids)), links)
    least = {}
    for k, p in part.items():
        least[p] = min(least.get(p, ids[k]), ids[k])
    count = np.bincount([x for link in links for x in link], minlength=len(ids))
    return {ids[k]: (int(count[k]), least[part[k]]) for k in range(len(ids))}


@pytest.mark.parametrize("spread, centres, sizes", [(0.05, 12, {}), (0.3, 40, {"fit": 64, "centres": 16, "block": 50}), (0.6, 5, {"fit": 300, "centres": 200, "block": 33})])
def test_links_as_all_pairs(spark, spread, centres, sizes):
    x = clustered(600, 16, 3, spread, centres)
    ids = np.random.default_rng(1).permutation(600).tolist()
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in zip(ids, x)], VECTORS)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in covertree.near_duplicates(df, **sizes).collect()}
    assert got == plain_links(ids, x)


def test_tree_radii_halve_and_hold_their_bounds():
    u = covertree.unit(clustered(300, 8, 5, 0.4).astype(float))
    tree = covertree.lay(u, 128)
    assert 1 < len(tree.centres) <= 128
    d = covertree.apart(u, tree.centres)
    leaf = d.argmin(axis=1)
    radius = np.array([d[leaf == i, i].max(initial=-1.0) for i in range(len(tree.centres))])
    pairs = set(covertree.surviving(tree, radius, 0.3))
    near = np.argwhere(covertree.apart(u, u) <= 0.3)
    assert {tuple(sorted((int(leaf[a]), int(leaf[b])))) for a, b in near} <= pairs
    assert len(pairs) < len(tree.centres) * (len(tree.centres) + 1) / 2


def test_odd_vectors(spark):
    v, nan = [1.0, 2.0, 3.0], float("nan")
    rows = [(1, v), (2, v), (2, v), (3, [2.0, 4.0, 6.0]), (None, v), (4, None), (5, [0.0] * 3), (6, [1.0, None, 1.0]), (7, [nan, 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]),
            (9, []), (10, [1.0, 2.0]), (11, [-1.0, 2.0, 0.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], VECTORS)
    got = sorted([tuple(r) for r in covertree.near_duplicates(df).collect()], key=str)
    linked = [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (3, 4, 1, False), (None, 4, 1, False)]
    assert got == sorted(linked + [(i, 0, i, True) for i in range(4, 12)], key=str)
    assert covertree.near_duplicates(df.limit(0)).collect() == []
    asked = multi_index.search(df, F.col("vec_id") % 2 == 1).collect()
    assert {r["query_id"] for r in asked} == {1, 3, 11} and {r["vec_id"] for r in asked} <= {1, 2, 3, 11}
    assert [r["vec_id"] for r in sorted(asked, key=lambda r: r["rank"]) if r["query_id"] == 1] == [3, 2, 11]
    assert multi_index.search(df.limit(0), F.lit(True)).collect() == []


def test_search_recall_and_order(spark):
    x = clustered(3000, 32, 9, 0.4, 30)
    x[1500:1600] = x[7]  # a hot vector
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    got = {}
    for r in multi_index.search(df, F.col("vec_id") % 20 == 0, chunk=400).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    scores = x.astype(float) @ x.astype(float).T
    hit = 0
    assert sorted(got) == list(range(0, 3000, 20))
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21)) and q not in [r[1] for r in rows]
        assert all(s == pytest.approx(scores[q, v], rel=1e-12) for _, v, s in rows)
        assert rows == [(n, v, s) for n, (s, v) in zip(range(1, 21), sorted(((s, v) for _, v, s in rows), key=lambda p: (-p[0], p[1])))]
        order = np.lexsort((np.arange(3000), -np.where(np.arange(3000) == q, -np.inf, (x.astype(float) * x[q].astype(float)).sum(axis=1))))[:20]
        hit += len(set(order.tolist()) & {r[1] for r in rows})
    assert hit >= 0.9 * 20 * len(got)


def test_search_of_everything_is_exact(spark):
    x = clustered(300, 6, 2, 0.5)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in multi_index.search(df, F.col("vec_id") < 9, k=5, share=1.0).collect()}
    for q in range(9):
        s = (x.astype(float) * x[q].astype(float)).sum(axis=1)
        s[q] = -np.inf
        assert [got[q, n] for n in range(1, 6)] == np.lexsort((np.arange(300), -s))[:5].tolist()


def test_cells_come_in_order_of_summed_distance():
    rng = np.random.default_rng(0)
    u, v = rng.random(7), rng.random(5)
    cells = list(multi_index.cells_in_order(u, v))
    sums = [u[a] + v[b] for a, b in cells]
    assert len(set(cells)) == 35 and sums == sorted(sums)


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(4)
    links = [(i, i + 1) for i in range(300, 420)] + [(500, i) for i in range(501, 700)] + [tuple(map(int, rng.integers(0, 200, 2))) for _ in range(150)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups({x for link in links for x in link}, links)
    assert got == {i: want[i] for a, b in links if a != b for i in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


PAGES = "page_id long, url string, html string, payload_digest string"
FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def test_archives_come_back(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>page {i % 40}</p>" * (1 + i % 7)) for i in range(300)]
    rows += [(1000, "u", FAKE), (1001, "u", "x" + FAKE * 3 + "y"), (1002, None, "WARC/1.1\r\nContent-Length: 99999999\r\n\r\n"), (1003, "u\r\nX: 1 %25", "WARC/1.1\r\n" * 50),
             (1004, "", None), (1005, "", ""), (1006, "é", "é😀\r\n\r\n" * 20000), (1007, "u", "WARC/1.1"), (None, "n", "only null"), (1009, "u", "\r\n"), (5, "again", "<p>page 5</p>" * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows], PAGES)
    folder = str(tmp_path / "archives")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")  # blocks end anywhere, inside the magic, too
        warc.write_archives(df, folder)
        plain = tmp_path / "plain"
        plain.mkdir()
        for p in (tmp_path / "archives").glob("part-*.gz"):
            (plain / p.name.removesuffix(".gz")).write_bytes(gzip.decompress(p.read_bytes()))
        back = warc.read_archives(spark, folder).collect()
        done = warc.resolved(warc.read_archives(spark, folder, payloads=False)).collect()
        in_blocks = warc.read_archives(spark, str(plain)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        data, f = (h or "").encode(), first.get(h or "")
        again = f is not None and f != i
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", f if again else None))
    assert sorted(map(tuple, done), key=str) == sorted(want, key=str)
    texts = {(i, (h or "").encode()) for i, _, h in rows}
    assert all((r["page_id"], r["payload"]) in texts for r in back if r["record_type"] == "response")
    assert {r["url"] for r in back} == {u or "" for _, u, _ in rows}
    assert sorted([tuple(r)[1:] for r in in_blocks], key=str) == sorted([tuple(r)[1:] for r in back], key=str)


def test_small_payloads_are_never_revisits(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", "tiny" if i < 3 else "large enough", "x") for i in range(6)], PAGES)
    warc.write_archives(df, str(tmp_path / "a"), least=6)
    got = {r["page_id"]: r["record_type"] for r in warc.read_archives(spark, str(tmp_path / "a")).collect()}
    assert got == {0: "response", 1: "response", 2: "response", 3: "response", 4: "revisit", 5: "revisit"}


def test_no_pages(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], PAGES), str(tmp_path / "a"))
    assert warc.resolved(warc.read_archives(spark, str(tmp_path / "a"))).collect() == []


def test_broken_chain_keeps_what_it_reaches(spark, tmp_path):
    folder = tmp_path / "a"
    folder.mkdir()
    record = FAKE.encode()
    (folder / "one.warc").write_bytes(record * 2 + b"junk" + record)
    (folder / "two.warc").write_bytes(b"junk" + record)
    got = [(r["file"].rsplit("/", 1)[1], r["start"]) for r in warc.read_archives(spark, str(folder)).collect()]
    assert sorted(got) == [("one.warc", 0), ("one.warc", len(record))]
