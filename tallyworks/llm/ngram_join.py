"""Documents whose sets of word shingles are alike: exact Jaccard join with prefix filters under several token orders.

Two sets of n1 and n2 tokens that share enough must share a token among the first n - ceil(0.8 n) + 1 of each, under any
order of all tokens. The first order puts rare tokens first (by bucket counts over all documents), so common passages
hardly ever meet in a prefix. Documents that meet there are candidates if they can share as many prefix tokens as their
sizes ask for: up to the end of the prefix that ends first all common tokens are in both prefixes, and the rest of that
set has ceil(0.8 n) - 1 tokens. The prefixes under the other orders must share as many, too. Each node carries a small
sketch of them and of its whole set, bits of odd counts: the bits in which two sketches differ are at least so many
tokens that only one side has. So pairs are cut while they are formed, before any set is read; no similar pair is.

Not all pairs of a large group are made. Equal sets are one node. In some rounds each node is compared with hubs of its
tokens; what is alike is one component then, and afterwards only nodes of different components are paired, the few
outside a token's largest component with the others. So components are exact, and links inside one are not repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import components, kept, query, stored, table
from tallyworks.llm.sketch import SCHEMA, bloom_places, merged, mix, pieces
from tallyworks.operators.groups import attach, sized_groups

#: Rounds in which nodes are compared with hubs before pairs are made: they only save work.
ROUNDS = 2
#: Words of 64 bits in a sketch: of a whole set, and of the prefix under one further order.
SET_WORDS, PREFIX_WORDS = 8, 4
#: Cells of the bucket counts (4 bytes each on the driver, 1 in the tasks), and bits of the Bloom filter.
BUCKETS, BITS = 1 << 22, 1 << 26


#: Bytes that are worked on at once; a longer word makes a longer piece.
STEP = 1 << 19
#: Space, and tab to carriage return.
BLANKS = np.zeros(256, bool)
BLANKS[[32, *range(9, 14)]] = True
#: A 64-bit number for each byte, the same for a letter A-Z and its small one; odd factor and its inverse modulo 2^64.
VALUES = mix(np.arange(256, dtype=np.uint64), 77)
VALUES[65:91] = VALUES[97:123]
FACTOR = 0x9E3779B97F4A7C15


def powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(piece: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words in a piece of bytes; `first` are places where a text begins.

    A word's hash is the sum of its bytes' values times powers of the factor, taken from running sums over the piece.
    """
    up, down = kept(f"powers {len(piece) >> 19}", lambda: tuple(
        powers(f, ((len(piece) >> 19) + 1) << 19) for f in (FACTOR, pow(FACTOR, -1, 1 << 64))))
    blank = BLANKS[piece]
    begins, ends = ~blank, ~blank
    after = blank[:-1].copy()
    edge = first[(first > 0) & (first < len(piece))]
    after[edge - 1] = True  # a text's first byte follows nothing
    begins[1:] &= after
    after = blank[1:].copy()
    after[edge - 1] = True
    ends[:-1] &= after
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    with np.errstate(over="ignore"):
        terms = VALUES[piece] * up[: len(piece)]
        sums = np.cumsum(terms)
        return begins, (sums[ends] - sums[begins] + terms[begins]) * down[begins]


def pieces_of(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A text in pieces that end where a word ends."""
    at = 0
    while at < len(data):
        end = at + STEP
        while end < len(data) and not BLANKS[data[end]]:
            near = np.flatnonzero(BLANKS[data[end:end + STEP]])
            end += int(near[0]) if len(near) else STEP
        yield at, data[at:end]
        at = end


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """For each text (data between bounds) the sorted distinct hashes of all runs of `words` words, A-Z lower-cased; of
    the whole sequence if it has fewer."""
    parts = [(at, *word_hashes(p, bounds[:-1] - at)) for at, p in pieces_of(data)] if len(bounds) == 2 else [
        (0, *word_hashes(data, bounds[:-1]))]
    places = np.concatenate([at + b for at, b, _ in parts]) if parts else np.zeros(0, np.int64)
    h = np.concatenate([x for *_, x in parts]) if parts else np.zeros(0, np.uint64)
    owner = np.searchsorted(bounds, places, side="right") - 1
    n_words = np.bincount(owner, minlength=len(bounds) - 1)
    whole = runs(h, words)[owner[words - 1:] == owner[:len(owner) - words + 1]] if len(h) >= words else np.zeros(0, np.uint64)
    at = word_at = 0
    for n in n_words.tolist():
        if n >= words:
            s = np.sort(whole[at:at + n - words + 1])
            yield s[np.append(True, s[1:] != s[:-1])]
            at += n - words + 1
        else:
            yield runs(h[word_at:word_at + n], n) if n else np.zeros(0, np.uint64)
        word_at += n


def runs(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words."""
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(FACTOR) + h[i:i + n]
    return mix(out, 1)


def sets_of(words: int, column: pa.Array) -> Iterator[np.ndarray]:
    """The sets of a batch's texts (binary); a null text has the empty one."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + STEP, side="right")) - 1)
        yield from shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
        i = j


def least_share(n: int | np.ndarray, percent: int):
    """ceil(percent * n / 100): tokens of a set of n that a similar set must hold."""
    return (percent * n + 99) // 100


def rank(tokens: np.ndarray, order: int, classes: np.ndarray | None = None) -> np.ndarray:
    """Places of tokens in an order: order 0 by class of frequency and then by hash, the others by another hash."""
    if classes is None:
        return mix(tokens, 11 + order)
    return (classes[tokens & np.uint64(len(classes) - 1)].astype(np.uint64) << np.uint64(56)) | (tokens >> np.uint64(8))


def prefix(tokens: np.ndarray, percent: int, order: int, classes: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """The first tokens of a set under an order, and the place of the last of them."""
    n = len(tokens)
    size = n - least_share(n, percent) + 1
    places = rank(tokens, order, classes)
    if size >= n:
        return tokens, int(places.max())
    at = np.argpartition(places, size - 1)
    return tokens[at[:size]], int(places[at[size - 1]])


def odd_bits(tokens: np.ndarray, words: int) -> np.ndarray:
    """Bits of the places on which an odd number of tokens falls."""
    at = mix(tokens, 41) & np.uint64(64 * words - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=64 * words) & 1).astype(bool)).view(np.int64)


def sketch_of(tokens: np.ndarray, percent: int, orders: int) -> np.ndarray:
    """Odd bits of the set, then of its prefix under each further order."""
    if not len(tokens):
        return np.zeros(SET_WORDS + PREFIX_WORDS * (orders - 1), np.int64)
    return np.concatenate([odd_bits(tokens, SET_WORDS),
                           *[odd_bits(prefix(tokens, percent, order)[0], PREFIX_WORDS) for order in range(1, orders)]])


def may_be_alike(n: Column, m: Column, x: Column, y: Column, percent: int, orders: int) -> Column:
    """False only for sets of n and m tokens whose sketches x and y differ in more bits than similar sets can."""
    def apart(start: int, words: int) -> Column:
        return sum_of(F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(start, start + words))

    def least(size: Column) -> Column:
        return F.ceil(size * percent / 100)

    ok = (n + m - apart(0, SET_WORDS)) * (100 + percent) >= 2 * percent * (n + m)
    rest = F.greatest(least(n), least(m)) - 1
    prefixes = n - least(n) + 1 + m - least(m) + 1
    for order in range(1, orders):
        both = prefixes - apart(SET_WORDS + PREFIX_WORDS * (order - 1), PREFIX_WORDS)  # twice the shared tokens at most
        ok = ok & (both >= 2) & ((both + 2 * rest) * (100 + percent) >= 2 * percent * (n + m))
    return ok


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """0 for buckets about as full as the mean, then growing with the logarithm of what they hold above that."""
    mean = max(1.0, counts.mean())
    above = np.maximum(0.0, (counts - mean) / (4 * np.sqrt(mean)))
    return np.minimum(127, np.floor(4 * np.log2(1 + above))).astype(np.uint8)


def sum_of(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def alike(a: np.ndarray, b: np.ndarray, percent: int, orders: int) -> bool:
    """The filters under the further orders, then the sets."""
    n, m = len(a), len(b)
    rest = max(least_share(n, percent), least_share(m, percent)) - 1
    for order in range(1, orders):
        both = len(np.intersect1d(prefix(a, percent, order)[0], prefix(b, percent, order)[0], assume_unique=True))
        if not both or (both + rest) * (100 + percent) < (n + m) * percent:
            return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (n + m - common)


class Join:
    """One run over a table of documents."""

    def __init__(self, docs: DataFrame, text: str, key: str, words: int, percent: int, orders: int) -> None:
        self.percent, self.orders = percent, orders
        self.docs = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("t"))
        self.kind = self.docs.schema["id"].dataType.simpleString()
        self.spark = docs.sparkSession
        self.sets = partial(sets_of, words)

    def summaries(self) -> tuple[DataFrame, np.ndarray]:
        """(id, node, n, sketch) of each document, node being a 64-bit digest of its set, and the bucket counts of all tokens."""
        sets, percent, orders = self.sets, self.percent, self.orders
        schema = f"id {self.kind}, node long, n long, sketch array<long>, piece int, cells binary"
        names = ["id", "node", "n", "sketch", "piece", "cells"]

        def run(batches):
            counts = np.zeros(BUCKETS, np.int64)
            for b in batches:
                nodes, sizes, sketches = [], [], []
                for s in sets(b.column("t")):
                    nodes.append(node_of(s))
                    sizes.append(len(s))
                    sketches.append(sketch_of(s, percent, orders))
                    np.add.at(counts, s & np.uint64(BUCKETS - 1), 1)
                none = pa.nulls(len(nodes))
                width = SET_WORDS + PREFIX_WORDS * (orders - 1)
                flat = np.concatenate(sketches) if sketches else np.zeros(0, np.int64)
                sketch = pa.ListArray.from_arrays(np.arange(len(nodes) + 1, dtype=np.int32) * width, flat)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), sketch,
                                                  none.cast(pa.int32()), none.cast(pa.binary())], names=names)
            for i, cells in pieces(np.minimum(counts, 65535).astype(np.uint16)):
                yield pa.RecordBatch.from_arrays([pa.nulls(1, b.schema.field("id").type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                                                  pa.nulls(1, pa.list_(pa.int64())), pa.array([i], pa.int32()), pa.array([cells], pa.binary())], names=names)

        both = stored(self.docs.mapInArrow(run, schema), "summaries")
        counts = merged(both.where("piece is not null").select("piece", "cells"), BUCKETS, np.int32, np.add, np.uint16)
        return both.where("piece is null").select("id", "node", "n", "sketch"), counts

    def shared_tokens(self, classes: np.ndarray) -> DataFrame:
        """(token, node, n, last): prefix tokens of the first order that several nodes have.

        `last` is the upper half of the place of the node's last prefix token.
        """
        known, percent, sets = self.spark.sparkContext.broadcast(classes), self.percent, self.sets

        def post(batches):
            done = set()  # nodes of this task: copies need not be sent again
            for b in batches:
                tokens, nodes, sizes, ends = [], [], [], []
                for s in sets(b.column("t")):
                    if len(s) and (node := node_of(s)) not in done:
                        done.add(node)
                        p, end = prefix(s, percent, 0, known.value)
                        tokens.append(p)
                        nodes.append(np.full(len(p), node))
                        sizes.append(np.full(len(p), len(s)))
                        ends.append(np.full(len(p), end >> 32))
                if tokens:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(nodes)),
                                                      pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(np.concatenate(ends).astype(np.int32))],
                                                     names=["token", "node", "n", "last"])

        def shared(batches):
            """Sorted by token and node: rows of tokens with at least two nodes."""
            held = None  # the last row, and whether it is known to be shared
            for b in batches:
                token, node, n, last = (b.column(c).to_numpy() for c in ("token", "node", "n", "last"))
                if held is not None:
                    token, node, n, last = (np.append(h, c) for h, c in zip(held, (token, node, n, last)))
                if not len(token):
                    continue
                new = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))
                token, node, n, last = token[new], node[new], n[new], last[new]
                start = np.append(True, token[1:] != token[:-1])
                several = ~start
                several[:-1] |= token[1:] == token[:-1]
                if held is not None and held[4]:
                    several[0] = True
                held = (token[-1], node[-1], n[-1], last[-1], bool(several[-1]))
                out = several[:-1]
                yield rows(*[c[:-1][out] for c in (token, node, n, last)])
            if held is not None and held[4]:
                yield rows(*[np.array([x]) for x in held[:4]])

        def rows(*columns):
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["token", "node", "n", "last"])

        posts = self.docs.mapInArrow(post, "token long, node long, n int, last int").repartition("token").sortWithinPartitions("token", "node")
        return stored(posts.mapInArrow(shared, "token long, node long, n int, last int"), "shared")

    def alike_pairs(self, pairs: DataFrame, summaries: DataFrame) -> DataFrame:
        """The pairs (a, b) of nodes whose sets are alike, read once more from the texts that are needed."""
        pairs = stored(pairs.select("a", "b").distinct(), "pairs")
        if pairs.isEmpty():
            return pairs
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
        # One document of each node; a Bloom filter over them spares the sets of (nearly) all other documents the way.
        chosen = summaries.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("id").alias("id"))
        marks = chosen.select("node", F.xxhash64("id").alias("h")).mapInArrow(fill, SCHEMA)
        known = self.spark.sparkContext.broadcast(merged(marks, BITS // 8, np.uint8, np.bitwise_or, np.uint8))

        read = self.sets

        def emit(batches):
            for b in batches:
                sets = list(read(b.column("t")))
                node = np.array([node_of(s) for s in sets], np.int64)
                wanted = np.flatnonzero(holds(known.value, place_of(node, b.column("h").to_numpy())))
                yield pa.RecordBatch.from_arrays([pa.array(node[wanted]), pa.array([sets[i].tobytes() for i in wanted], pa.binary())],
                                                 names=["node", "tokens"])

        docs = self.docs.select("t", F.xxhash64("id").alias("h"))
        sets = stored(docs.mapInArrow(emit, "node long, tokens binary").dropDuplicates(["node"]), "sets")
        both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b"))
        percent, orders = self.percent, self.orders

        def compare(batches):
            for b in batches:
                keep = [alike(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent, orders)
                        for x, y in zip(b.column("x"), b.column("y"))]
                yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(keep, pa.bool_())), b.column("b").filter(pa.array(keep, pa.bool_()))],
                                                 names=["a", "b"])

        return stored(both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "alike")

    def hub_pairs(self, part: DataFrame, seed: int, first: bool) -> DataFrame:
        """Pairs (a, b) of nodes and likely partners: for each node its best hub under three hash orders.

        A token's hub is the least of its nodes under a hash order; after the first round, of those in the component
        that most of the token's nodes are in, and only for nodes outside it. All joins are by token and linear.
        """
        if first:
            offered = part
        else:
            main = (part.groupBy("token", "part").agg(F.count("*").alias("m")).groupBy("token")
                    .agg(F.count("*").alias("parts"), F.max_by("part", F.struct("m", "part")).alias("main")).where("parts > 1").select("token", "main"))
            part = part.join(main, "token")
            offered = part.where("part = main")
        hubs = offered.groupBy("token").agg(F.array(*[
            F.min(F.struct(F.xxhash64("node", F.lit(seed + i)).alias("h"), F.lit(i).alias("i"), F.col("node").alias("hub"), F.col("n").alias("hub_n")))
            for i in range(3)]).alias("hubs"))
        part = part if first else part.where("part <> main")
        own = F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1
        met = (part.join(hubs, "token").select("node", "n", F.explode("hubs").alias("x")).select("node", "n", "x.i", "x.hub", "x.hub_n")
               .where("node <> hub").groupBy("node", "hub", "n", "hub_n", "i").agg(F.count("*").alias("c"))
               # A quarter of the prefix is a guess that spares comparisons; what it misses comes up in the end.
               .where((F.col("c") * 4 >= own) & (F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * self.percent))
               .groupBy("node", "i").agg(F.max(F.struct("c", "hub")).alias("best")))
        return met.select(F.least("node", "best.hub").alias("a"), F.greatest("node", "best.hub").alias("b"))

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Summaries, and links (a, b) between nodes that connect the same nodes as all links do."""
        summaries, counts = self.summaries()
        shared = self.shared_tokens(frequency_classes(counts))
        # Prefix tokens that no other prefix holds. Of two nodes, the one whose prefix ends first shares none of its own
        # with the other: the tokens up to there are in the other's prefix if they are in the other at all.
        own = F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1
        nodes = shared.groupBy("node", "n").agg(F.count("*").alias("live")).select("node", (F.col("n") - own + F.col("live")).alias("most"))
        part = shared.join(nodes, "node").withColumn("part", F.col("node"))
        links = None
        for round_ in range(ROUNDS):
            found = self.alike_pairs(self.hub_pairs(part, 10 * round_, first=round_ == 0), summaries)
            if found.isEmpty():
                break
            links = found if links is None else links.union(found)
            known = components(links)
            part = (shared.join(nodes, "node").join(known.withColumnRenamed("id", "node"), "node", "left")
                    .select(*shared.columns, "most", F.coalesce("root", "node").alias("part")))
        # Tokens whose nodes are not all in one component yet, with the component that most of them are in.
        several = (part.groupBy("token", "part").agg(F.count("*").alias("m")).groupBy("token")
                   .agg(F.count("*").alias("parts"), F.max_by("part", F.struct("m", "part")).alias("main")).where("parts > 1").select("token", "main"))
        # Nodes of different components can only share such tokens, so they are all that has to be looked at now: how
        # many a node has, the place of each among them, and a bitmap of 256 bits of them all.
        by_node = Window.partitionBy("node")
        bit = F.expr("shiftleft(1L, CAST(pmod(shiftright(xxhash64(token), 8), 64) AS INT))")
        word = F.pmod(F.xxhash64("token"), F.lit(4))
        maps = {f"b{i}": F.coalesce(F.bit_or(F.when(word == i, bit)).over(by_node), F.lit(0).cast("long")) for i in range(4)}
        open_ = part.join(several, "token").withColumns({
            "open": F.count("*").over(by_node), "at": F.row_number().over(by_node.orderBy("token")), **maps})
        sketches = summaries.where("n > 0").select("node", "sketch").dropDuplicates(["node"])
        open_ = stored(open_.join(sketches, "node"), "open")
        few = open_.where("part <> main").select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "part", "last", "most", "open", "at", "sketch", *maps)])
        n, m = F.col("n"), F.col("x_n")
        common = (F.when(F.col("x_last") < F.col("last"), F.col("x_most")).when(F.col("x_last") > F.col("last"), F.col("most"))
                  .otherwise(F.greatest("x_most", "most")))
        # A similar pair has at least `least` such tokens in common. Then the first of them, by any order of tokens, has
        # that many less one behind it in either node; and the bitmaps have that many bits in common, but for tokens
        # that fell on a bit together.
        least = F.greatest(F.lit(1), F.ceil((n + m) * self.percent / (100 + self.percent))
                           - F.greatest(F.ceil(n * self.percent / 100), F.ceil(m * self.percent / 100)) + 1)
        shared_bits = sum_of(F.bit_count(F.col(b).bitwiseAND(F.col(f"x_{b}"))) for b in maps)
        fell = F.least(F.col("open") - sum_of(F.bit_count(b) for b in maps), F.col("x_open") - sum_of(F.bit_count(f"x_{b}") for b in maps))
        cross = few.join(open_, "token").where((F.col("x_part") != F.col("part")) & ((F.col("part") == F.col("main")) | (F.col("x_node") < F.col("node")))
                                              & (F.least(n, m) * 100 >= F.greatest(n, m) * self.percent)
                                              & (common * (100 + self.percent) >= (n + m) * self.percent)
                                              & (F.col("at") <= F.col("open") - least + 1) & (F.col("x_at") <= F.col("x_open") - least + 1)
                                              & (shared_bits + fell >= least)
                                              & may_be_alike(n, m, F.col("sketch"), F.col("x_sketch"), self.percent, self.orders))
        pairs = cross.select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b"))
        last = self.alike_pairs(pairs, summaries)
        return summaries, last if links is None else links.union(last)


def place_of(node: np.ndarray, h: np.ndarray) -> np.ndarray:
    """What stands in the Bloom filter for a document: its node and the hash of its id."""
    return mix(node.view(np.uint64), 3) ^ mix(h.view(np.uint64), 5)


def fill(batches):
    cells = np.zeros(BITS // 8, np.uint8)
    for b in batches:
        for at in bloom_places(place_of(b.column("node").to_numpy(), b.column("h").to_numpy()), BITS):
            np.bitwise_or.at(cells, at >> np.uint64(3), (1 << (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
    for i, c in pieces(cells):
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([c], pa.binary())], names=["piece", "cells"])


def holds(cells: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for at in bloom_places(x, len(cells) * 8):
        out &= (cells[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def node_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def jaccard_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, percent: int = 80, orders: int = 3) -> DataFrame:
    """One row per document: key, `n_shingles`, `component_id` (least key reachable by links), `n_class` (documents in it).

    Links: sets of distinct runs of `words` words (the whole sequence where there are fewer) with at least `percent`
    in 100 of their union in common. A null text is empty; an empty set links with nothing, so such a document is alone
    and component_id is its own key. Rows with equal texts, repeated rows too, are one component. A null key never is
    the least one unless all are null. Tokens and sets are told apart by 64-bit hashes. Other columns are not read.
    """
    summaries, links = Join(docs, text, key, words, percent, orders).links()
    roots = components(links)
    rows = (summaries.where("n > 0").join(roots.withColumnRenamed("id", "node"), "node", "left")
            .select("id", "n", F.coalesce("root", "node").alias("part")))
    # A component may hold a third of all rows: the values of such ones are broadcast, their rows dealt to slots.
    least = sized_groups(rows, ["part"], [F.min("id").alias("component_id"), F.count("*").alias("n_class")])
    found = attach(rows, least, ["part"], "inner", slot_by=["id"]).select("id", "n", "component_id", "n_class")
    alone = summaries.where("n = 0").select("id", "n", F.col("id").alias("component_id"), F.lit(1).cast("long").alias("n_class"))
    return found.union(alone).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", "n_class")


@query("op8_ngram_join")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_classes(table(spark, folder, "documents"))
