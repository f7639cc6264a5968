"""Toxicity searches over whole texts: every word of examples and documents counts."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tallyworks.llm import toxicity
from tests.llm.helpers import documents, prose


def test_nearest_are_those_of_the_whole_text(spark):
    rnd = random.Random(11)
    docs = [(i, prose(rnd, rnd.randint(5, 60)) + (" vilkana" if i % 4 == 0 else "") + (f" only{i}" if i % 3 else ""), "s") for i in range(400)]
    docs += [(1000 + i, " (Only) one" + " odd" * i, "s") for i in range(5)] + [(2000, None, "s"), (2001, " . ", "s")]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_documents(documents(spark, docs), labels).collect()}
    bags = {i: Counter(x for w in (t or "").lower().split() if (x := w.strip(toxicity.EDGE))) for i, t, _ in docs}
    df = Counter(w for b in bags.values() for w in b)
    unit = {}
    for i, b in bags.items():
        v = {w: (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + df[w])) + 1) for w, n in b.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        unit[i] = {w: x / size for w, x in v.items()}
    examples = [i for i in range(400) if not got[i]["held_out"]]
    for i in bags:
        cos = {e: sum(x * unit[e].get(w, 0) for w, x in unit[i].items()) for e in examples}
        want = sorted((e for e in examples if cos[e] > 1e-12), key=lambda e: (-round(cos[e], 9), e))[:15]
        assert np.allclose([cos[e] for e in want], got[i]["cosines"], atol=1e-9), i
        assert len(want) == len(got[i]["nearest"]) and np.allclose([cos[e] for e in got[i]["nearest"]], got[i]["cosines"], atol=1e-9)
    assert got[2000]["score"] == got[2001]["score"] and got[2001]["nearest"] == []


def test_a_copy_of_a_toxic_example_needs_no_marked_term(spark):
    """Each toxic text has its own words, so no term marks the label; near copies are told by their neighbours alone."""
    rnd = random.Random(3)
    docs, labels = [], []
    for g in range(60):
        words = [f"w{g}x{rnd.randrange(10 ** 6)}" for _ in range(40)]
        for c in range(2 if g % 3 == 0 else 8):
            docs.append((len(docs), " ".join(words[:38 + c % 3]), "s"))
            labels.append((docs[-1][0], int(g % 3 == 0)))
    sample = spark.createDataFrame([(i, t, y) for (i, t, _), (_, y) in zip(docs, labels)], "id long, text string, y int")
    assert toxicity.choose_terms(sample, 4096) == []
    got = {r["doc_id"]: r for r in toxicity.score_documents(documents(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [(got[i], y) for i, y in labels if got[i]["held_out"] and got[i]["cosines"] and got[i]["cosines"][0] > 0.5]
    assert sum(y for _, y in held) > 2 and all(r["predicted"] == y for r, y in held)


@pytest.mark.parametrize("k", [1, 7, 500])
def test_search_over_texts_is_exact(k):
    rng = np.random.default_rng(k)
    n, v = 300, 900
    rows = [np.sort(rng.choice(v, rng.integers(1, 60), replace=False, p=(p := 1 / np.arange(2, v + 2)) / p.sum())) for _ in range(n)]
    counts = [rng.integers(1, 5, len(r)) for r in rows]
    idf = np.linspace(1, 5, v)
    index = toxicity.TextIndex(idf, np.arange(n) * 3, np.zeros(n), np.cumsum([0, *map(len, rows)]), np.concatenate(rows), np.concatenate(counts))
    dense = np.zeros((n, v))
    for i, (r, c) in enumerate(zip(rows, counts)):
        dense[i, r] = (1 + np.log(c)) * idf[r]
        dense[i] /= np.linalg.norm(dense[i])
    for i, (found, cosines, _) in enumerate(index.nearest(list(zip(rows, counts)), k, list(range(n)))):
        cos = dense @ dense[i]
        cos[i] = 0
        want = sorted((j for j in range(n) if cos[j] > 1e-12), key=lambda j: (-round(cos[j], 12), j))[:k]
        assert np.allclose(cos[want], cosines, atol=1e-12) and np.allclose(cos[found], cosines, atol=1e-12) and i not in found


def test_the_sums_of_a_search_need_no_room_for_all_its_postings():
    rng = np.random.default_rng(5)
    n, v, each = 3000, 2000, 500
    words = np.concatenate([np.sort(rng.choice(v, each, replace=False)) for _ in range(n)])
    counts = rng.integers(1, 9, len(words))
    index = toxicity.TextIndex(np.ones(v), np.arange(n), np.zeros(n), np.arange(n + 1) * each, words, counts)
    every = [(np.arange(v), np.ones(v, int))]
    next(index.nearest(every, 15))
    tracemalloc.start()
    rows, cosines, _ = next(index.nearest(every, 15))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    unit = (1 + np.log(counts)).reshape(n, each)
    cos = unit.sum(axis=1) / np.linalg.norm(unit, axis=1) / math.sqrt(v)
    assert np.array_equal(rows, np.argsort(-cos)[:15]) and np.allclose(cosines, cos[rows], atol=1e-12)
    assert most < 8e6, most  # over a million postings of eight bytes and more


@pytest.mark.parametrize("chars", [1, 1 << 23])
def test_words_and_terms_of_texts_are_counted_one_by_one(spark, monkeypatch, chars):
    monkeypatch.setattr(toxicity, "CHARS", chars)
    terms = ["the", "abcd*", "abcde*", "abc**", "\u00e9t\u00e9"]
    texts = ["the The, (the) abcdef", None, "", " . ", "abc*de abcd abc", "\u00c9t\u00e9 \u00df \u0130x", "abcde. abcdX? the\u00a0end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    known = toxicity.word_hashes(toxicity.pa.array(["the", "abcd", "abcdx"], toxicity.pa.large_string()))
    got = {r["doc_id"]: r for r in toxicity.term_vectors(docs, terms, spark.sparkContext.broadcast(np.sort(known)), ("doc_id",)).collect()}
    for i, t in enumerate(texts):
        bag = Counter(x for w in (t or "").lower().split() if (x := w.strip(toxicity.EDGE)))
        marks = Counter()
        for w, c in bag.items():
            marks.update({terms.index(x): c for x in toxicity.terms_of(w) if x in terms})
        hashes = dict(zip(toxicity.word_hashes(toxicity.pa.array(list(bag), toxicity.pa.large_string())).tolist(), bag.values()))
        words = {int(np.searchsorted(np.sort(known), h)): c for h, c in hashes.items() if h in known}
        assert list(zip(got[i]["terms"], got[i]["times"])) == sorted(marks.items())
        assert list(zip(got[i]["words"], got[i]["counts"])) == sorted(words.items())
        assert list(zip(got[i]["others"], got[i]["other_counts"])) == sorted((h, c) for h, c in hashes.items() if h not in known)
