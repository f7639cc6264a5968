"""Small tables and plain-Python counterparts for the tests."""

import random

WORDS = [a + b for a in ("ta", "ko", "mi", "ren", "sul", "bo", "quar", "del") for b in ("na", "ri", "vo", "sten", "lu", "k", "ma")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def documents(spark, rows):
    """Rows (doc_id, text, source) as a documents table."""
    return spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows], DOCS)


def groups(ids, links):
    """Least member of each id's group."""
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
