"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over whole texts, votes, calibration.

The labelled examples are a bounded sample. A text is the vector of all its words, with document frequencies over all
documents; its neighbours are exactly the examples nearest by cosine, and they are the evidence. Their labels, weighted
by cosine, give a vote. A second vote comes from the terms that stand for a label (words and beginnings of words), by a
block-max search over the vectors of these terms alone: it opens blocks from the best bound down and stops when no bound
can reach the k-th best cosine any more. The votes that examples get from the others give the weights of the two votes
and the calibration from them to scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import forget, over_texts, query, stored, table
from tallyworks.llm.sketch import SCHEMA, merged, pieces

#: Examples in a block of the index; votes by terms that a task remembers; texts counted at once.
BLOCK, KEPT, SLICE = 64, 10_000, 256
#: Texts searched at once, and common words whose weights are held as a dense matrix.
AT_ONCE, DENSE = 64, 256
#: Examples prepared at once; postings added up at once; blocks of the index opened before the others are judged.
AT_PREPARE, ROOM, FIRST_BLOCKS = 1000, 1 << 17, 8
#: Characters of texts whose words are held at once, beside one longer text.
CHARS = 1 << 23
EDGE = ".,;:!?\"'()[]{}<>*$%&#-_/"


def terms_of(word: str) -> list[str]:
    """The word, and its beginnings of 4, 5 and 6 letters marked by a star."""
    word = word.strip(EDGE)
    if not word:
        return []
    return [word] + [word[:n] + "*" for n in (4, 5, 6) if len(word) >= n]


def fit_sample(docs: DataFrame, labels: DataFrame, held_out: Column, fit_rows: int) -> DataFrame:
    """At most `fit_rows` labelled documents (id, text, y): one of each text, those with the least hash of their id.

    A document labelled twice counts as 1 if any label is 1; null labels and null ids are left out.
    """
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    rows = docs.where(~held_out & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    # Texts stay behind until the rows are chosen; their hashes tell copies apart.
    found = rows.select("doc_id", F.xxhash64("text").alias("t")).join(marks, "doc_id").withColumn("h", F.xxhash64(F.lit("fit"), "doc_id"))
    firsts = found.groupBy("t").agg(F.min(F.struct("h", "doc_id")).alias("x"), F.max("y").alias("y"))
    chosen = firsts.groupBy("x").agg(F.max("y").alias("y")).select("x.h", "x.doc_id", "y").orderBy("h", "doc_id").limit(fit_rows)
    chosen = F.broadcast(stored(chosen.select("doc_id", "y"), "fit"))  # fit_rows rows
    return rows.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("id"), "text", "y")


def choose_terms(sample: DataFrame, max_terms: int, least: float = 25.0, min_docs: int = 3) -> list[str]:
    """The terms that mark label 1 most clearly by chi-squared, at most `max_terms`."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, list[int]] = {}
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                for t in {t for w in set(text.lower().split()) for t in terms_of(w)}:
                    at = seen.setdefault(t, [0, 0])
                    at[y] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
                                              pa.array([v[1] for v in seen.values()], pa.int64())], names=["term", "n0", "n1"])

    both = sample.groupBy("y").agg(F.count("*").alias("n")).collect()
    total = {r["y"]: r["n"] for r in both}
    n0, n1 = total.get(0, 0), total.get(1, 0)
    if not n0 or not n1:
        return []
    counts = sample.select("text", "y").mapInArrow(count, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("a0"), F.sum("n1").alias("a1"))
    n, seen = F.lit(float(n0 + n1)), F.col("a0") + F.col("a1")
    expected = seen * n1 / n
    chi = F.pow(F.col("a1") - expected, 2) / expected + F.pow(F.col("a1") - expected, 2) / (seen * n0 / n)
    return [r["term"] for r in counts.where((seen >= min_docs) & (F.col("a1") > expected)).withColumn("chi", chi)
            .where(F.col("chi") >= least).orderBy(F.desc("chi"), "term").limit(max_terms).select("term").collect()]


def word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits that stand for each word; two of a corpus' words share them with next to no chance."""
    found = map(xxhash.xxh64_intdigest, words.cast(pa.large_binary()).to_numpy(zero_copy_only=False))
    return (np.fromiter(found, np.uint64, len(words)) ^ np.uint64(1 << 63)).view(np.int64)


def vocabulary(sample: DataFrame) -> np.ndarray:
    """The hashes of all words of the sample (fit_rows texts), ascending; a word's number is its place."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = {w.strip(EDGE) for text in b.column("text").to_pylist() for w in text.lower().split()}
            yield pa.RecordBatch.from_arrays([pa.array(word_hashes(pa.array(list(words - {""}), pa.large_string())), pa.int64())], names=["word"])

    return np.sort(sample.select("text").mapInArrow(find, "word long").distinct().toArrow().column("word").to_numpy())


class Terms:
    """The bare words of some texts, by their hashes, and the chosen terms of each."""

    def __init__(self, terms: list[str]) -> None:
        plain = [(t, i) for i, t in enumerate(terms) if not t.endswith("*")]
        started = {n: [(t[:-1], i) for i, t in enumerate(terms) if t.endswith("*") and len(t) == n + 1] for n in (4, 5, 6)}
        #: Letters of a beginning (None: the whole word), the texts to find, and their numbers as terms.
        self.kinds = [(n, pa.array([t for t, _ in of], pa.large_string()), np.array([i for _, i in of], np.int64)) for n, of in ((None, plain), *started.items()) if of]

    def of(self, bare: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places in `bare` and the numbers of the terms there."""
        place, number = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, texts, numbers in self.kinds:
            found = pc.index_in(bare if n is None else pc.utf8_slice_codeunits(bare, 0, n), value_set=texts)
            if n is not None:
                found = pc.if_else(pc.greater_equal(pc.utf8_length(bare), n), found, None)
            at = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            place.append(at)
            number.append(numbers[found.drop_null().to_numpy()])
        return np.concatenate(place), np.concatenate(number)


def summed(rows: np.ndarray, what: np.ndarray, times: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of triples (row, what, times): for each row in turn its different `what`, ascending, and their times added up; how many a row."""
    if not len(rows):
        return what, times, np.zeros(n, np.int64)
    order = np.lexsort((what, rows))
    rows, what, times = rows[order], what[order], times[order]
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (what[1:] != what[:-1])))
    return what[first], np.add.reduceat(times, first), np.bincount(rows[first], minlength=n)


def lists(rows: list, kind: pa.DataType) -> pa.Array:
    """Rows of values as a column, by way of one flat array."""
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([x for r in rows for x in r], kind))


def term_vectors(docs: DataFrame, terms: list[str], words, keys: tuple[str, ...]) -> DataFrame:
    """Key columns, and of each whole text the chosen terms, the words and the words of no example, all with their counts.

    Numbers are ascending. `words` is the broadcast vocabulary; words outside it are given by their 64-bit hash. A task
    holds the words of SLICE texts at a time, looks at each different one once, and remembers none.
    """
    def counted(texts: list, known: Terms) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        cut = [t.lower().split() if t else [] for t in texts]
        whole = pa.array([w for some in cut for w in some], pa.large_string()).dictionary_encode()
        bare = pc.utf8_trim(whole.dictionary, EDGE).dictionary_encode()
        hashes, of = np.unique(word_hashes(bare.dictionary), return_inverse=True)
        # Each text's different words and how often: pairs in one number, in order.
        pair = np.repeat(np.arange(len(cut)), list(map(len, cut))) * max(1, len(hashes)) + of[bare.indices.to_numpy()][whole.indices.to_numpy()]
        pair, times = np.unique(pair, return_counts=True)
        row, word = np.divmod(pair, max(1, len(hashes)))
        if (empty := pc.index(bare.dictionary, "").as_py()) >= 0:
            row, word, times = row[word != of[empty]], word[word != of[empty]], times[word != of[empty]]
        at, number = known.of(bare.dictionary)
        order = np.argsort(of[at], kind="stable")
        at, number = of[at][order], number[order]
        first = np.searchsorted(at, np.arange(len(hashes) + 1))
        many = np.diff(first)[word]
        marked, marks, mark_times = np.repeat(row, many), number[spans(first[word], many)], np.repeat(times, many)
        place = np.searchsorted(words.value, hashes)
        inside = place < len(words.value)
        inside[inside] = words.value[place[inside]] == hashes[inside]
        place, inside, hashes = place[word], inside[word], hashes[word]
        n = len(texts)
        return [summed(marked, marks, mark_times, n), (place[inside], times[inside], np.bincount(row[inside], minlength=n)),
                (hashes[~inside], times[~inside], np.bincount(row[~inside], minlength=n))]

    def make():
        forget()
        known = Terms(terms)

        def work(texts: list) -> dict:
            out, sizes = {}, np.array([len(t or "") for t in texts], np.int64)
            part = (np.cumsum(sizes) - sizes) // CHARS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
            found = [counted(texts[a:z], known) for a, z in zip(cuts, cuts[1:])]
            whole = [[np.concatenate(of) for of in zip(*kind)] for kind in zip(*found)]
            for (name, times, kind), (what, n, many) in zip((("terms", "times", np.int32), ("words", "counts", np.int32), ("others", "other_counts", np.int64)), whole):
                ends = pa.array(np.append(0, np.cumsum(many)).astype(np.int32))
                out[name] = pa.ListArray.from_arrays(ends, pa.array(what.astype(kind)))
                out[times] = pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int32)))
            return out

        return work

    return over_texts(docs, keys, "text", "terms array<int>, times array<int>, words array<int>, counts array<int>, others array<long>, other_counts array<int>", make, at_once=SLICE)


def frequencies(vectors: DataFrame, n_words: int, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each word and of each chosen term, counted over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n_words + n_terms, np.int32)
        for b in batches:
            for name, first in (("words", 0), ("terms", n_words)):
                got = np.bincount(b.column(name).flatten().to_numpy(zero_copy_only=False))
                seen[first:first + len(got)] += got.astype(np.int32)
        for piece, cells in pieces(seen):
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([cells], pa.binary())], names=["piece", "cells"])

    df = merged(vectors.select("words", "terms").mapInArrow(run, SCHEMA), n_words + n_terms, np.int64, np.add, np.int32)
    return df[:n_words], df[n_words:]


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length says, one after the other."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(start - before, length)


def kth_best(values: np.ndarray, k: int) -> float:
    """The k-th largest of more than k values; of fewer 0."""
    if len(values) <= k:
        return 0.0
    if len(some := values[:len(values) // 8]) > 8 * k:  # the k-th best of some of them is no better
        values = values[values >= np.partition(some, len(some) - k)[len(some) - k]]
    return float(np.partition(values, len(values) - k)[len(values) - k])


class Sums:
    """Adds postings up for one search after another, in room that is kept.

    A posting is one number: the row, and in the lower half its weight in whole steps.
    """

    def __init__(self, n: int, most: float) -> None:
        """`n`: the rows, and so the most postings of a word; `most`: the largest weight."""
        self.bits = 16 if n <= 1 << 16 else 32
        self.kind = np.uint32 if self.bits == 16 else np.uint64
        self.mask, self.step = self.kind((1 << self.bits) - 1), max(most, 1e-300) / ((1 << self.bits) - 1)
        self.posts, self.row, self.weight = np.empty(ROOM + n, self.kind), np.empty(ROOM + n, np.int64), np.empty(ROOM + n)

    def posted(self, row: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return row.astype(self.kind) << self.kind(self.bits) | np.rint(weight / self.step).astype(self.kind)

    def add(self, to: np.ndarray, posts: np.ndarray, first: np.ndarray, last: np.ndarray, times: np.ndarray) -> float:
        """To each row (in place) the weights of its postings, those from `first` to `last` of each word, by the word's
        `times`; returns twice the most that a row's sum is off by the steps."""
        many, times = last - first, times * self.step
        runs = list(map(posts.__getitem__, map(slice, first.tolist(), last.tolist())))
        part = (np.cumsum(many) - many) // ROOM
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(runs)]
        for a, z in zip(cuts, cuts[1:]):
            if a < z:
                size = int(many[a:z].sum())
                got, row, sums = self.posts[:size], self.row[:size], self.weight[:size]
                np.concatenate(runs[a:z], out=got)
                np.right_shift(got, self.kind(self.bits), out=row, casting="unsafe")
                np.bitwise_and(got, self.mask, out=got)
                np.multiply(got, np.repeat(times[a:z], many[a:z]), out=sums)
                np.add.at(to, row, sums)
        return float(times.sum())


class TextIndex:
    """Unit TF-IDF vectors of the examples over all their words, and the exact nearest ones of a text.

    All cosines of some texts at once are worked out roughly: the common words by a product of dense matrices in single
    precision, the others by their postings, whose weights are held in steps. The rows that may be among the k nearest
    within the error of that are worked out again in double precision.
    """

    #: More than twice the error of a sum of DENSE products in single precision.
    ERROR = 1e-4

    def __init__(self, idf: np.ndarray, ids: np.ndarray, y: np.ndarray, start: np.ndarray, words: np.ndarray, counts: np.ndarray) -> None:
        """Examples in the order of their ids; `start` says where each one's words and counts begin, and the end."""
        self.idf, self.ids, self.y, self.start = idf, ids, y, start
        #: Words as steps from the one before, and counts: small when packed, as this travels to every executor.
        self.packed = [zlib.compress(x.astype(np.int32).tobytes(), 1) for x in (np.diff(words, prepend=0), counts)]
        self.dense = None

    def prepare(self) -> None:
        """What a search needs besides; made where it is used, in parts, as every worker has to hold it."""
        steps, counts = (np.frombuffer(zlib.decompress(x), np.int32) for x in self.packed)
        self.words, self.packed = np.cumsum(steps, dtype=np.int32), None
        del steps
        n, most = len(self.ids), int(counts.max(initial=1))
        self.logs = 1 + np.log(np.arange(1, most + 1))
        self.counts = counts.astype(np.uint16 if most < 1 << 16 else np.int32)
        del counts
        row, weight, self.norm = np.empty(len(self.words), np.int32), np.empty(len(self.words), np.float32), np.zeros(n)
        # Single precision finds the rows; those found are weighed again in double precision.
        for a in range(0, n, AT_PREPARE):
            z = min(n, a + AT_PREPARE)
            part = slice(self.start[a], self.start[z])
            row[part] = np.repeat(np.arange(a, z, dtype=np.int32), np.diff(self.start[a:z + 1]))
            w = self.logs[self.counts[part] - 1] * self.idf[self.words[part]]
            self.norm[a:z] = np.sqrt(np.bincount(row[part] - a, w ** 2, z - a))
            weight[part] = w / self.norm[row[part]]
        held = np.bincount(self.words, minlength=len(self.idf))
        common = np.argsort(-held, kind="stable")[:DENSE]
        common = common[held[common] * 100 > n]
        self.slot = np.full(len(self.idf), -1, np.int32)
        self.slot[common] = np.arange(len(common))
        self.dense = np.zeros((max(1, len(common)), n), np.float32)
        light = np.ones(len(self.words), bool)
        for a in range(0, n, AT_PREPARE):
            part = slice(self.start[a], self.start[min(n, a + AT_PREPARE)])
            at = self.slot[self.words[part]]
            held_at = np.flatnonzero(at >= 0)
            self.dense[at[held_at], row[part][held_at]] = weight[part][held_at]
            light[part] = at < 0
        row = row[light]
        weight = weight[light]
        words = self.words[light]
        del light
        self.light_start = np.append(0, np.cumsum(np.bincount(words, minlength=len(self.idf))))
        self.sums = Sums(n, float(weight.max(initial=0)))
        self.light = np.empty(len(words), self.sums.kind)
        for a, z in zip(cuts := np.linspace(0, len(self.idf), 17).astype(int), cuts[1:]):  # numbers are hashes in order: even parts
            some = np.flatnonzero((words >= a) & (words < z))
            some = some[np.argsort(words[some], kind="stable")]
            self.light[self.light_start[a]:self.light_start[z]] = self.sums.posted(row[some], weight[some])
        self.of_word, self.asked = np.zeros(len(self.idf)), np.zeros(len(self.idf), bool)

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, but: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """For each text (words, counts): rows and cosines of the k nearest examples with a positive cosine, ties to the smaller
        id, and the squared length of its vector; the cosines are those of a text without other words. `but`: rows left out."""
        if self.dense is None:
            self.prepare()
        for at in range(0, len(texts), AT_ONCE):
            yield from self.some(texts[at:at + AT_ONCE], k, but[at:at + AT_ONCE] if but else None)

    def some(self, texts: list, k: int, but: list[int] | None) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        n, sizes = len(self.ids), [len(t) for t, _ in texts]
        words = np.concatenate([t for t, _ in texts])
        weight = (1 + np.log(np.concatenate([c for _, c in texts]))) * self.idf[words]
        of = np.repeat(np.arange(len(texts)), sizes)
        length = np.bincount(of, weight ** 2, len(texts))
        weight = weight / np.sqrt(length)[of]
        slot = self.slot[words]
        q = np.zeros((len(texts), len(self.dense)), np.float32)
        q[of[slot >= 0], slot[slot >= 0]] = weight[slot >= 0]
        about = q @ self.dense
        ends, rare, near = np.cumsum(sizes), slot < 0, np.empty(n)
        first, last = self.light_start[words], self.light_start[words + 1]
        for i, common in enumerate(about):
            mine = slice(ends[i] - sizes[i], ends[i])
            # One text at a time: its sums stay in the processor's cache.
            near[:] = common
            off = self.ERROR + self.sums.add(near, self.light, first[mine][rare[mine]], last[mine][rare[mine]], weight[mine][rare[mine]])
            if but is not None and but[i] >= 0:
                near[but[i]] = 0
            least = kth_best(near, k) - off if n > k else 0.0
            rows = np.flatnonzero(near >= least) if least > 0 else np.flatnonzero(near > 0)
            cosines = np.zeros(0)
            if len(rows):
                self.of_word[words[mine]], self.asked[words[mine]] = weight[mine], True
                lengths = self.start[rows + 1] - self.start[rows]
                place = spans(self.start[rows], lengths)
                shared = np.flatnonzero(self.asked[self.words[place]])
                place, theirs = place[shared], np.repeat(np.arange(len(rows)), lengths)[shared]
                word = self.words[place]
                own = self.logs[self.counts[place] - 1] * self.idf[word] / self.norm[rows][theirs]
                cosines = np.bincount(theirs, self.of_word[word] * own, len(rows))
                self.of_word[words[mine]], self.asked[words[mine]] = 0, False
                keep = np.lexsort((self.ids[rows], -np.round(cosines, 12)))[:k]
                rows, cosines = rows[keep], cosines[keep]
            yield rows, cosines, float(length[i])


class BlockMaxIndex:
    """Unit TF-IDF vectors of the examples, in blocks, with each term's largest weight in each block."""

    def __init__(self, idf: np.ndarray, rows: list[tuple[int, list[int], list[int], int]]) -> None:
        self.idf = idf
        made = sorted((tuple(t), i, self.unit(t, n), y) for i, t, n, y in rows if t)  # like vectors share blocks
        self.ids = np.array([m[1] for m in made], np.int64)
        self.y = np.array([m[3] for m in made], np.float64)
        self.blocks = -(-len(made) // BLOCK)
        posts = sorted((t, r, w) for r, m in enumerate(made) for t, w in zip(m[0], m[2]))
        self.term = np.array([p[0] for p in posts], np.int64)
        self.row = np.array([p[1] for p in posts], np.int64)
        self.weight = np.array([p[2] for p in posts], np.float64)
        self.start = np.searchsorted(self.term, np.arange(len(idf) + 1))
        # One entry for each (term, block) that has postings, as postings stand in that order.
        code = self.term * max(1, self.blocks) + self.row // BLOCK
        first = np.flatnonzero(np.diff(code, prepend=-1))
        self.block_of, self.block_first = code[first] % max(1, self.blocks), first
        self.block_most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.block_end = np.append(first[1:], len(code))
        self.block_start = np.searchsorted(self.term[first], np.arange(len(idf) + 1)) if len(first) else np.zeros(len(idf) + 1, np.int64)

    def unit(self, terms, times) -> np.ndarray:
        w = (1 + np.log(np.asarray(times, float))) * self.idf[np.asarray(terms, int)]
        size = np.sqrt((w * w).sum())
        return w / size if size > 0 else w

    def nearest(self, terms: list[int], times: list[int], k: int, but: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k nearest examples with a positive cosine; ties to the smaller example id."""
        q, at = self.unit(terms, times), np.asarray(terms, np.int64)
        many = self.block_start[at + 1] - self.block_start[at]
        entry, weight = spans(self.block_start[at], many), np.repeat(q, many)
        block = self.block_of[entry]
        bound = np.bincount(block, weight * self.block_most[entry], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        score = np.zeros(self.blocks * BLOCK)

        opened, worst = order[:FIRST_BLOCKS], 0.0
        rest = order[FIRST_BLOCKS:]
        while len(opened):
            mark = np.zeros(self.blocks, bool)
            mark[opened] = True
            hit = np.flatnonzero(mark[block])
            first = self.block_first[entry[hit]]
            size = self.block_end[entry[hit]] - first
            lists = self.start[at].tolist(), self.start[at + 1].tolist()
            whole = 4 * int(size.sum()) > sum(lists[1]) - sum(lists[0])
            if whole:
                # Most of the lists is asked for: they are read as they stand, which opens every block.
                score[:] = 0
                np.add.at(score, np.concatenate([self.row[a:z] for a, z in zip(*lists)]), np.concatenate([self.weight[a:z] * x for a, z, x in zip(*lists, q)]))
            else:
                post = spans(first, size)
                np.add.at(score, self.row[post], np.repeat(weight[hit], size) * self.weight[post])
            if but is not None:
                score[but] = 0
            # No block whose bound falls short of the k-th best so far holds a nearer one.
            worst = max(worst, kth_best(score.reshape(-1, BLOCK)[opened].ravel(), k))
            opened, rest = rest[:0] if whole else rest[bound[rest] >= worst - 1e-12], rest[:0]
        rows = np.flatnonzero(score >= worst - 1e-11) if worst > 1e-11 else np.flatnonzero(score > 0)
        keep = np.lexsort((self.ids[rows], -np.round(score[rows], 12)))[:k]
        return rows[keep], score[rows[keep]]

    def vote(self, rows: np.ndarray, cosines: np.ndarray, prior: float) -> float:
        """Share of label 1 by squared cosine, drawn a little towards the prior, the less so the nearer they are."""
        w = cosines * cosines
        return float(((w * self.y[rows]).sum() + 0.05 * prior) / (w.sum() + 0.05))


def calibration(votes: np.ndarray, y: np.ndarray, least: int = 30) -> tuple[list[float], list[float]]:
    """Points (vote, score), both growing: pooled shares of label 1 over runs of votes, smoothed, linear in between."""
    order = np.argsort(votes, kind="stable")
    votes, y = votes[order], y[order]
    pools: list[list[float]] = []  # sum of votes, sum of labels, rows
    for part in np.array_split(np.arange(len(y)), max(1, len(y) // least)):
        pools.append([votes[part].sum(), y[part].sum(), len(part)])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            a = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], a)]
    xs, ys = [p[0] / p[2] for p in pools], [(p[1] + 0.5) / (p[2] + 1) for p in pools]
    return [0.0, *xs, 1.0], [ys[0] / 2, *ys, (1 + ys[-1]) / 2]


def pull(weight, label_weight, prior: float):
    """Share of label 1 by squared cosine, drawn a little towards the prior, the less so the nearer the examples are."""
    return (label_weight + 0.05 * prior) / (weight + 0.05)


def log_odds(votes: np.ndarray) -> np.ndarray:
    votes = np.clip(votes, 1e-3, 1 - 1e-3)
    return np.log(votes / (1 - votes))


def blend(votes: np.ndarray, y: np.ndarray, steps: int = 30) -> np.ndarray:
    """Constant and weights of the votes' log odds (a column each): logistic regression by Newton steps, held by a small ridge."""
    x = np.column_stack([np.ones(len(y)), log_odds(votes)])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - w)
        w = w + move
        if np.abs(move).max() < 1e-10:
            break
    return w


class Model:
    """What searching needs; its size is bounded by the sample's rows and their words."""

    def __init__(self, term_idf: np.ndarray, rows: list[tuple], index: TextIndex, k: int) -> None:
        self.k, self.texts = k, index
        self.terms = BlockMaxIndex(term_idf, rows)
        self.term_row = {i: r for r, i in enumerate(self.terms.ids.tolist())}
        self.text_row = {i: r for r, i in enumerate(index.ids.tolist())}
        self.prior = (sum(r[3] for r in rows) + 0.5) / (len(rows) + 1)

    def term_vote(self, terms: list[int], times: list[int], but: int | None = None) -> float:
        """Vote by the chosen terms; a text without any gets the prior."""
        if not terms:
            return self.prior
        return self.terms.vote(*self.terms.nearest(terms, times, self.k, but=self.term_row.get(but)), self.prior)

    def search(self, b: pa.RecordBatch, known: dict, but: list[int] | None = None) -> dict[str, pa.Array]:
        """For each row its vote by chosen terms, nearest examples, their cosines, squared length, and the sums of squared
        cosines of all of them and of those with label 1. `but`: the example to leave out of each search."""
        votes = []
        for i, (t, n) in enumerate(zip(b.column("terms").to_pylist(), b.column("times").to_pylist())):
            q = (tuple(t), tuple(n), but[i] if but else None)
            if q not in known:
                if len(known) > KEPT:
                    known.clear()
                known[q] = self.term_vote(*q)
            votes.append(known[q])
        words, counts = b.column("words"), b.column("counts")
        cut = words.offsets.to_numpy()
        cut = cut - cut[0]
        words, counts = words.flatten().to_numpy(), counts.flatten().to_numpy()
        full = np.flatnonzero(np.diff(cut)) if len(self.texts.ids) else []
        texts = [(words[cut[i]:cut[i + 1]], counts[cut[i]:cut[i + 1]]) for i in full]
        out = [((), (), 0.0, 0.0, 0.0)] * len(votes)
        for i, (rows, cosines, length) in zip(full, self.texts.nearest(texts, self.k, [self.text_row.get(but[i], -1) for i in full] if but else None)):
            w = cosines * cosines
            out[i] = self.texts.ids[rows], cosines, length, float(w.sum()), float((w * self.texts.y[rows]).sum())
        return {"vote": pa.array(votes, pa.float64()), "nearest": lists([o[0] for o in out], pa.int64()), "cosines": lists([o[1] for o in out], pa.float64()),
                **{name: pa.array([o[i] for o in out], pa.float64()) for i, name in ((2, "length"), (3, "near"), (4, "near_1"))}}


FOUND = "vote double, nearest array<long>, cosines array<double>, length double, near double, near_1 double"


def held_out_rows(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no rest; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(True))


def score_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, max_terms: int = 4096, k: int = 15,
                    keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Key columns, `held_out`, `score`, `predicted`, and the evidence: `nearest` example ids with their `cosines`.

    Bounds: the model is fitted on at most `fit_rows` labelled rows that are not held out; it holds all their words, and
    at most `max_terms` terms for the second vote; frequencies are counted over all documents. Every text with a word is
    searched; one that has no word in common with any example, and null and empty texts, have no evidence and two votes
    equal to the prior. Without any labelled row all scores are 0. Ties in cosine go to the smaller example id. Repeated
    rows are scored alike.
    """
    spark = docs.sparkSession
    keys = tuple(dict.fromkeys((*keys, "doc_id")))
    sample = stored(fit_sample(docs, labels, held_out_rows(), fit_rows), "sample")
    if sample.isEmpty():
        none = F.array().cast("array<long>"), F.array().cast("array<double>")
        return docs.select(*keys, held_out_rows().alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                           none[0].alias("nearest"), none[1].alias("cosines"))
    terms = choose_terms(sample, max_terms)
    held = vocabulary(sample)
    n_words, words = len(held), spark.sparkContext.broadcast(held)
    del held  # nor is a broadcast's value asked for here: that would load it once more and keep it
    # The only pass over all texts.
    vectors = stored(term_vectors(docs.withColumn("__row", F.monotonically_increasing_id()), terms, words, (*keys, "__row")), "vectors")
    n_docs = vectors.count()
    word_df, term_df = frequencies(vectors, n_words, len(terms))
    idf, term_idf = np.log((1 + n_docs) / (1 + word_df)) + 1, np.log((1 + n_docs) / (1 + term_df)) + 1
    examples = stored(term_vectors(sample, terms, words, ("id", "y")), "examples").drop("others", "other_counts")
    got = examples.toArrow().sort_by("id").combine_chunks()  # fit_rows rows
    rows = list(zip(*[got.column(c).to_pylist() for c in ("id", "terms", "times", "y")]))
    start = np.cumsum([0, *(got.column("words").combine_chunks().value_lengths().to_pylist())])
    index = TextIndex(idf, got.column("id").to_numpy(), got.column("y").to_numpy().astype(float), start,
                      got.column("words").combine_chunks().flatten().to_numpy(), got.column("counts").combine_chunks().flatten().to_numpy())
    made = Model(term_idf, rows, index, k)
    n_rows, prior, model = len(rows), made.prior, spark.sparkContext.broadcast(made)
    del got, rows, start, index, idf, word_df, made
    pa.default_memory_pool().release_unused()

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in batches:
            made = model.value.search(b, {}, b.column("id").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("y"), *[made[c] for c in ("vote", "near", "near_1")]], names=["y", "vote", "near", "near_1"])

    # The votes of each example by the others: fit_rows rows of four numbers, in an order that does not depend on the tasks.
    parts = max(1, min(n_rows // 500, spark.sparkContext.defaultParallelism))
    own = examples.repartition(parts).mapInArrow(left_out, "y int, vote double, near double, near_1 double").toArrow()
    own = np.column_stack([own.column(c).to_numpy().astype(float) for c in ("y", "vote", "near", "near_1")])
    own = own[np.lexsort(own.T)]
    y, votes = own[:, 0], np.column_stack([own[:, 1], pull(own[:, 2], own[:, 3], prior)])
    weights = blend(votes, y)

    def joint(votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(weights[0] + log_odds(votes) @ weights[1:], -30, 30)))

    points = calibration(joint(votes), y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        known: dict[tuple, float] = {}
        for b in batches:
            made = model.value.search(b, known)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keys) + 1)], *made.values()], names=[*keys, "__row", *made])

    kinds = ", ".join(f"`{k_}` {vectors.schema[k_].dataType.simpleString()}" for k_ in keys)
    found = vectors.drop("others", "other_counts").mapInArrow(run, f"{kinds}, __row long, {FOUND}")
    # The words of no example lengthen a text's vector; they change its cosines, not their order.
    others = vectors.select("__row", F.explode(F.arrays_zip("others", "other_counts")).alias("x")).select("__row", "x.others", "x.other_counts")
    df = others.groupBy("others").agg(F.count("*").alias("df"))
    w = (1 + F.log("other_counts")) * (F.log(F.lit(1.0 + n_docs) / (1 + F.col("df"))) + 1)
    rest = others.join(df, "others").groupBy("__row").agg(F.sum(w * w).alias("rest"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rest, near, near_1, vote = (b.column(c).to_numpy() for c in ("length", "rest", "near", "near_1", "vote"))
            shorter = length / np.maximum(length + rest, 1e-300)  # squared
            votes = np.column_stack([vote, pull(near * shorter, near_1 * shorter, prior)])
            cosines = [[c * f for c in found] for found, f in zip(b.column("cosines").to_pylist(), np.sqrt(shorter).tolist())]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keys))], pa.array(np.interp(joint(votes), *points)), b.column("nearest"), lists(cosines, pa.float64())],
                                             names=[*keys, "score", "nearest", "cosines"])

    whole = found.join(rest, "__row", "left").withColumn("rest", F.coalesce("rest", F.lit(0.0))).drop("__row")
    scored = whole.mapInArrow(score, f"{kinds}, score double, nearest array<long>, cosines array<double>")
    return scored.select(*keys, held_out_rows().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "nearest", "cosines")


@query("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))
