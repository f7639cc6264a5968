"""Texts with very many matches or lines, links of secrets against a plain scan, and sketches of the Jaccard join."""

import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from tallyworks.llm import lines, ngram_join, secrets

ACCESS, PART = "AKIA" + "Q7" * 8, "Zk3jf93jKJHSDkjh3298fhKJH"


def test_very_many_matches_in_one_text(spark):
    text = "\n".join(f"token: abcdef{i % 7} user=u{i:05d} {PART}" if i % 5 else ACCESS for i in range(50_000))
    start = time.time()
    got = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert time.time() - start < 90  # with time that grows with the square of the matches it took hours
    names = list(secrets.ORDER)
    assign = re.compile(secrets.BASE["assign"][0])
    want = sorted([(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
                  + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)])
    assert [tuple(x) for x in got["base"]] == want
    linked = [names[x["k"]] for x in got["linked"]]
    assert linked.count("id_name") == 40_000 and linked.count("secret_part") == 40_000


def test_links_as_a_plain_scan(spark):
    rnd = random.Random(12)
    bits = [f"login: bob{i}" for i in range(3)] + [PART, "http://h/x", ACCESS, "password=abcdefgh", "deadbeef" * 4, f"token={PART}", f"{PART}AKIA",
                                                  " words ", ". " * 30, " " * 120, "é😀 " * 40, "\n"]
    texts = [" ".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(250)]
    names = list(secrets.ORDER)
    for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        text, found = texts[r["doc_id"]], []
        for k, (kind, (pattern, group, least)) in enumerate((secrets.BASE | secrets.WEAK).items()):
            found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
        base = [x for x in found if x[1] < 3]
        weak = [x for x in found if x[1] >= 3 and not (names[x[1]] == "secret_part" and any(b[0] < x[2] and x[0] < b[2] for b in base))]
        near = lambda x, role: any(secrets.ROLE[names[y[1]]] == role and abs(y[0] - x[0]) <= 200 for y in base + weak)
        told = {"id": lambda x: near(x, "secret"), "secret": lambda x: near(x, "id") or near(x, "place"),
                "place": lambda x: near(x, "id") and near(x, "secret")}
        assert sorted(tuple(x) for x in r["base"]) == sorted(base)
        assert sorted(tuple(x) for x in r["linked"]) == sorted(x for x in weak if told[secrets.ROLE[names[x[1]]]](x)), text


def test_very_many_lines_in_one_text(spark):
    rnd = random.Random(2)
    shared = [f"shared {i}" for i in range(25_000)]
    rows = []
    for i in range(6):
        mine = shared + [f"own {i} {j}" for j in range(25_000)]
        rnd.shuffle(mine)
        rows.append((i, "\n".join(mine), f"s{i}"))
    start = time.time()
    got = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert time.time() - start < 60
    for i, text, _ in rows:
        kept = [x for x in text.split("\n") if i == 0 or not x.startswith("shared")]
        assert got[i]["kept_text"] == "\n".join(kept) and got[i]["n_lines"] == 50_000 and got[i]["n_removed"] == (25_000 if i else 0)


def test_lines_at_both_ends_and_all_of_them_go(spark):
    rows = [(i, t, f"s{i}") for i, t in enumerate(["a\nb\tc\nd", "a", "a\r\nx\n\ta ", "x\na", "\na\n", "a\nb\tc"])]
    got = {r["doc_id"]: (r["kept_text"], r["n_removed"]) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {0: ("a\nb\tc\nd", 0), 1: ("", 1), 2: ("x", 2), 3: ("x", 1), 4: ("\n", 1), 5: ("b\tc", 1)}


def test_sketches_never_part_similar_sets(spark):
    rnd = np.random.default_rng(5)
    rows, similar = [], []
    for i in range(400):
        n = int(rnd.choice([1, 2, 5, 9, 40, 200, 3000]))
        a = np.unique(rnd.integers(0, 2 ** 63, n, dtype=np.uint64))
        gone = int(n * rnd.choice([0.05, 0.11, 0.19, 0.5]))
        b = np.unique(np.concatenate([a[gone // 2:], rnd.integers(0, 2 ** 63, gone // 2, dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        similar.append(100 * common >= 80 * (len(a) + len(b) - common))
        rows.append((i, len(a), len(b), ngram_join.sketch_of(a, 80, 3).tolist(), ngram_join.sketch_of(b, 80, 3).tolist()))
    ok = ngram_join.may_be_alike(F.col("n"), F.col("m"), F.col("x"), F.col("y"), 80, 3)
    got = spark.createDataFrame(rows, "i int, n long, m long, x array<long>, y array<long>").select("i", ok.alias("ok")).collect()
    assert all(r["ok"] for r in got if similar[r["i"]])
    assert 0 < sum(similar) < 400 and not all(r["ok"] for r in got)  # the sketches do tell some apart


def test_rows_under_one_id_take_one_place(spark):
    from tallyworks.llm import multi_index

    rnd = np.random.default_rng(3)
    rows = [(i, rnd.normal(size=8).tolist()) for i in range(60)]
    rows += [(i, (2 * np.array(rows[0][1]) + 0.01 * j).tolist()) for i in (0, 7, 8) for j in range(15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    runs = [sorted(map(tuple, multi_index.search(d, F.col("vec_id") == 0, share=1.0).collect())) for d in (df, df.orderBy(F.desc("vec_id")).repartition(5))]
    asks = min(v for i, v in rows if i == 0)
    best = {i: max(float(np.dot(asks, v)) for j, v in rows if j == i) for i in range(1, 60)}
    want = sorted(best, key=lambda i: (-best[i], i))[:20]
    assert [r[2] for r in runs[0]] == want and runs[0] == runs[1]
