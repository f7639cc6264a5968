"""Secrets, line dedup, mixing, toxicity and the n-gram join on small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyworks.llm import lines, mixing, ngram_join, secrets, toxicity
from tests.llm.helpers import DOCS, documents, groups, prose

KINDS = {"assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
         "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
         "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)}
ACCESS, WEAK = "AKIA" + "Q7" * 8, "Zk3jf93jKJHSDkjh3298fhKJH"


def base_spans(text):
    return sorted((m.start(), i, m.end()) for i, (p, ok) in enumerate(KINDS.values()) for m in p.finditer(text or "") if ok(m))


def test_secret_spans_as_plain_patterns(spark):
    rnd = random.Random(3)
    bits = ["password", "passwd: ", "Token=", "api_key ", "API_KEY='", "secret", '"', " = ", ":", "abcdef", "a+b/c_d.e=f-", "AKIA", "QWERTY0123456789ABCD",
            "0123456789abcdef01234567", "deadbeef", "é😀", "\n", " ", "x" * 30, "token: ab"]
    texts = [None, "", ACCESS, "password: token: abcdefgh", "hex " + "a" * 5000] + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, ACCESS), (0, None)], "doc_id long, text string")
    got = secrets.scan(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = ACCESS if r["doc_id"] is None else texts[r["doc_id"]]
        assert [tuple(x) for x in r["base"]] == base_spans(text)


def test_weak_parts_are_told_only_together(spark):
    gap = " .,; " * 60  # 300 characters
    cases = {1: f"login: bob {WEAK} http://h/x", 2: f"login: bob {gap} {WEAK}", 3: f"{WEAK} alone", 4: f"http://h/x {ACCESS}",
             5: f"user=carl password=abcdefgh{gap}user=dora", 6: f"{WEAK}{' ' * 150}http://h/x{' ' * 150}login: bob", 7: f"{ACCESS} {WEAK}"}
    names = list(secrets.ORDER)
    found = {r["doc_id"]: sorted(names[x["k"]] for x in r["linked"]) for r in secrets.scan(spark.createDataFrame(list(cases.items()), "doc_id long, text string")).collect()}
    assert found == {1: ["endpoint", "id_name", "secret_part"], 2: [], 3: [], 4: [], 5: ["id_name"], 6: ["endpoint", "secret_part"], 7: ["secret_part"]}


def test_secrets_of_an_empty_table(spark):
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string, base string")).collect() == []


def test_boilerplate_lines_stay_once(spark):
    common, short, near = "This line stands on very many sites of all.", "short", "This line stands on four sites, one too few."
    rows = [(i, f"own line number {i} of this document\n{common}\n{short}", f"s{i % 7}") for i in range(14)]
    rows += [(100 + i, f"{near}\n{common}  ", f"s{i}") for i in range(4)] + [(200, None, "s1"), (201, "", None), (None, common, "s1"), (202, common, None), (202, common, None)]
    got = lines.dedup_lines(documents(spark, rows).withColumnRenamed("lang", "n_removed").withColumn("line", F.lit(1)).withColumn("row_key", F.lit(2)), min_chars=20).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] == 0:
            assert (r["kept_text"], r["n_removed"]) == (r["text"], 0)
        elif r["doc_id"] is not None and r["doc_id"] < 100:
            assert (r["kept_text"], r["n_lines"], r["n_removed"]) == (r["text"].replace(common + "\n", ""), 3, 1)
        elif r["doc_id"] in (200, 201):
            assert (r["kept_text"], r["n_lines"], r["n_removed"]) == (r["text"], int(r["doc_id"] == 201), 0)
        elif r["doc_id"] in (None, 202):
            assert (r["kept_text"], r["n_removed"]) == ("", 1)
        else:
            assert (r["kept_text"], r["n_removed"]) == (near, 1)
    assert lines.dedup_lines(documents(spark, [])).collect() == []


def test_sites_near_the_threshold_are_counted_exactly(spark):
    rows = [(n * 100 + i, f"line that stands on just {n} sites in all", f"s{i}") for n in range(30, 51) for i in range(n)]
    kept = {r["line"]["n"] for r in lines.boilerplate(documents(spark, rows), min_sites=40, lg_k=4).collect()}
    assert kept  # the coarse sketch alone would err by a quarter
    done = lines.dedup_lines(documents(spark, rows), min_sites=40, lg_k=4).groupBy("text").sum("n_removed").collect()
    assert {int(r[0].split()[5]): r[1] for r in done} == {n: n - 1 if n >= 40 else 0 for n in range(30, 51)}


def test_mix_meets_its_targets(spark):
    rnd = random.Random(2)
    rows = [(i, prose(rnd, rnd.choice([1, 5, 40, rnd.randint(1, 300)])), rnd.choice(["a", "b", "b", "b", "c", "d", None])) for i in range(1500)]
    rows += [(5000, None, "a"), (5001, "", "b"), (None, "one two", "c")]
    df = documents(spark, rows).withColumn("n", F.lit(0)).withColumn("words", F.lit("x")).withColumn("target", F.lit("y")).withColumn("of", F.lit(None))
    got = mixing.mix(df).select("doc_id", "source", "size", "source_size", "target", "taken", "copies").collect()
    assert len(got) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    assert all(r["source_size"] == sizes[r["source"]] for r in got)
    # Plain water-filling.
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    capped, total = {}, sum(sizes.values())
    while True:
        level = (total - sum(capped.values())) / sum(w for s, w in weight.items() if s not in capped)
        new = {s: 3 * sizes[s] for s, w in weight.items() if s not in capped and w * level > 3 * sizes[s]}
        if not new:
            break
        capped |= new
    for s in sizes:
        assert target[s] == pytest.approx(capped.get(s, weight[s] * level))
        assert taken[s] == pytest.approx(target[s], rel=0.02)
    again = {r["doc_id"]: r["copies"] for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in got}


def test_mix_of_odd_tables(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    got = mixing.mix(documents(spark, [(1, None, None), (2, "", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2
    only = mixing.mix(documents(spark, [(i, "same words here", "a") for i in range(9)])).collect()
    assert [r["taken"] for r in only] == [3] * 9


def toxic_tables(spark, n=700):
    rnd = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = prose(rnd, rnd.randint(30, 90)).split()
        if bad:
            for _ in range(3):
                words.insert(rnd.randint(0, len(words)), "vilk" + rnd.choice(["ana", "oso", "ez", "ino", "ura", "elle"]))
        docs.append((i, " ".join(words), f"s{i % 3}"))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_separates_what_was_held_out(spark):
    docs, labels = toxic_tables(spark)
    extra = [(9000, None, None), (9001, "", "s1"), (None, docs[0][1], "s1"), (9002, "stra" * 5000, "s1")]
    table = documents(spark, docs + extra).withColumnRenamed("lang", "score")
    marks = spark.createDataFrame(labels + [(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_documents(table, marks).collect()}
    assert len(got) == len(docs) + len(extra)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [(got[i]["predicted"], y) for i, _, y in labels if got[i]["held_out"]]
    assert len(held) > 80 and sum(p == y for p, y in held) >= 0.98 * len(held)
    assert got[9000]["score"] == got[9001]["score"] == got[9002]["score"] < 0.5 and got[9000]["nearest"] == []
    assert got[None]["predicted"] == 1 and len(got[None]["nearest"]) > 0


def test_toxicity_without_labels(spark):
    table, none = documents(spark, [(1, "some text", "a"), (2, None, "a")]), spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.score_documents(table, none).collect()} == {0}
    assert toxicity.score_documents(documents(spark, []), none).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.dictionaries(st.integers(0, 9), st.integers(1, 3), min_size=1, max_size=5), st.integers(0, 1)), min_size=1, max_size=400), st.integers(1, 9))
def test_block_max_search_is_exact(examples, k):
    import numpy as np

    idf = np.linspace(1, 2, 10)
    rows = [(i, sorted(d), [d[t] for t in sorted(d)], y) for i, (d, y) in enumerate(examples)]
    index = toxicity.BlockMaxIndex(idf, rows)
    dense = {i: np.zeros(10) for i, *_ in rows}
    for i, t, n, _ in rows:
        dense[i][t] = index.unit(t, n)
    q = rows[0]
    found, cosines = index.nearest(q[1], q[2], k)
    want = sorted(((round(float(dense[i] @ dense[0]), 9), -i) for i in dense if dense[i] @ dense[0] > 1e-12), reverse=True)[:k]
    assert sorted(((round(float(c), 9), -int(index.ids[r])) for r, c in zip(found, cosines)), reverse=True) == want


def plain_classes(rows, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    pairs = {p for h in holders.values() for p in combinations(sorted(h), 2)}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), g) for i, g in groups(sets, links).items()}


def test_classes_as_all_pairs(spark):
    rnd = random.Random(6)
    passage, rows = prose(rnd, 60), []
    for i in range(60):
        base = prose(rnd, rnd.choice([3, 8, 30, 120, 300])).split()
        for _ in range(rnd.choice([1, 1, 2, 12])):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4, 7])):
                words[rnd.randrange(len(words))] = rnd.choice(["X", "yy", "Zed"])
            rows.append((len(rows), " ".join(words) + ("\n" + passage if rnd.random() < 0.3 else "")))
    rows += [(5000, None), (5001, ""), (5002, " \t"), (5003, "One two"), (5004, "ONE\ntwo"), (5005, "one  TWO "), (5006, "a b c d e f " * 4000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_shingles int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_classes(df).collect()}
    assert got == plain_classes(rows)


def test_a_large_group_of_near_copies(spark):
    rnd = random.Random(8)
    base = prose(rnd, 150).split()
    rows = []
    for i in range(1200):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 2, 3])):
            words[rnd.randrange(len(words))] = f"w{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    rows += [(2000 + i, prose(rnd, 50)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_classes(df).collect()}
    assert got == plain_classes(rows)


def test_classes_with_null_ids_and_repeated_rows(spark):
    text = "one two three four five six"
    df = spark.createDataFrame([(7, text), (7, text), (None, text), (None, None), (3, "else")], "doc_id long, text string")
    got = sorted([tuple(r)[:3] for r in ngram_join.jaccard_classes(df).collect()], key=str)
    assert got == sorted([(7, 2, 7), (7, 2, 7), (None, 2, 7), (None, 0, None), (3, 1, 3)], key=str)
    assert ngram_join.jaccard_classes(df.limit(0)).collect() == []


def test_prefixes_of_similar_sets_meet_under_each_order():
    import numpy as np

    rnd = np.random.default_rng(1)
    for n in (1, 2, 5, 9, 40, 200):
        a = rnd.integers(0, 2 ** 63, n, dtype=np.uint64)
        drop = int(n * 0.19)
        b = np.unique(np.concatenate([a[drop // 2:], rnd.integers(0, 2 ** 63, drop // 2, dtype=np.uint64)]))
        a = np.unique(a)
        common = len(np.intersect1d(a, b))
        assert (100 * common >= 80 * (len(a) + len(b) - common)) == ngram_join.alike(a, b, 80, 4)


def test_digest_of_no_spans():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
    assert DOCS
