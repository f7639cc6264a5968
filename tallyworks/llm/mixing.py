"""Mixing sources to target weights by entropy balancing, in SQL functions only.

Rates of documents stay as close to 1 as they can (in relative entropy) while each source's words meet its target:
rate = exp(tilt * size / mean size of the source), at most 3. The tilt of each source is the root of the convex dual's
gradient, found by Newton steps kept inside a bracket. Rates depend on (source, size) alone, so the steps run over the
table of sizes, one row for each source and size, and never again over documents. Rates are rounded into copies by
running sums over the sizes, so that each source's rounding errors cancel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import n_words, query, stored, table

#: Rows of (source, size) that may be broadcast, some 60 bytes each; more of them are joined by a shuffle.
SMALL = 500_000
#: Rounding offsets that are tried.
OFFSETS = 32


def ranked(df: DataFrame, column: str) -> DataFrame:
    """df and `rank`, from 0 by the column, null last; distinct values. Parts are ranges, no task sees all rows."""
    parts = stored(df.repartitionByRange(F.col(column).asc_nulls_last()).withColumn("part", F.spark_partition_id()), "ranges")
    counts = parts.groupBy("part").agg(F.count("*").alias("n"), F.max(column).alias("top"))
    # One row a range: as many as there are shuffle partitions.
    before = counts.withColumn("before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col(column).asc_nulls_last()))
    return (parts.withColumn("inside", inside).join(before.select("part", "before"), "part")
            .withColumn("rank", F.coalesce("before", F.lit(0)) + F.col("inside") - 1).drop("part", "inside", "before"))


def targets(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """(source, total) rows and `weight`, `target`: shares of all words by weight, at most `most` times the total.

    What a source cannot take is shared by weight among the others, again and again until none is above its limit.
    Two numbers a round come to the driver.
    """
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = stored(ranked(sources, "source").withColumn("weight", cycle), "weights")
    every = rows.agg(F.sum("total")).first()[0] or 0
    limit, level = most * F.col("total"), None
    left, weight = every, rows.agg(F.sum("weight")).first()[0] or 1.0
    while True:
        level_now = left / weight if weight else 0.0
        if level is not None and level_now == level:
            break
        level = level_now
        full = limit < F.col("weight") * level
        got = rows.agg(F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if got[0] is None:
            break
        left, weight = every - got[0], got[1]
    return rows.withColumn("target", F.least(limit, F.col("weight") * level))


def tilts(sizes: DataFrame, goals: DataFrame, most: float, steps: int = 60, within: float = 1e-9) -> DataFrame:
    """goals and `tilt`: the root of sum(n * size * rate(tilt * size / mean)) = target of each source.

    The sum grows with the tilt and is convex below the limit; a Newton step that leaves the bracket is replaced by
    its middle. Every step is one aggregation over the size table.
    """
    facts = sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("docs"))
    state = goals.join(facts, goals["source"].eqNullSafe(facts["source"]), "left").drop(facts["source"])
    mean = F.col("words") / F.col("docs")
    lo, hi = F.lit(-500.0), F.lit(500.0)
    start = F.when(F.col("words") > 0, F.log(F.greatest(F.col("target"), F.lit(1e-12)) / F.col("words"))).otherwise(0.0)
    # Sources without words, and sources at their limit, need no search.
    settled = (F.col("words") == 0) | (F.col("target") >= most * F.col("words") * (1 - 1e-12))
    state = stored(state.withColumn("mean", F.when(F.col("words") > 0, mean).otherwise(1.0)).withColumn("lo", lo).withColumn("hi", hi)
                   .withColumn("done", settled).withColumn("tilt", F.when(settled, F.lit(500.0)).otherwise(start)), "tilts")
    for _ in range(steps):
        open_ = state.where(~F.col("done"))
        x = F.col("size") / F.col("mean")
        free = F.exp(F.col("tilt") * x)
        rate = F.least(free, F.lit(most))
        part = (sizes.where("size > 0").join(open_.select(F.col("source").alias("of"), "tilt", "mean"), F.col("source").eqNullSafe(F.col("of")))
                .groupBy("of").agg(F.sum(F.col("n") * F.col("size") * rate).alias("f"),
                                   F.sum(F.when(free < most, F.col("n") * F.col("size") * x * free).otherwise(0.0)).alias("g")))
        f, g = F.col("f") - F.col("target"), F.col("g")
        lo, hi = F.when(f < 0, F.col("tilt")).otherwise(F.col("lo")), F.when(f >= 0, F.col("tilt")).otherwise(F.col("hi"))
        moved = state.join(part, F.col("source").eqNullSafe(F.col("of")), "left")
        newton = F.col("tilt") - f / g
        inside = (g > 0) & (newton > lo) & (newton < hi)
        next_ = F.when(inside, newton).otherwise((lo + hi) / 2)
        near = (F.abs(f) <= within * F.greatest(F.col("target"), F.lit(1.0))) | (hi - lo < 1e-13)
        go = ~F.col("done") & F.col("f").isNotNull() & ~near
        state = stored(moved.select(*[c for c in state.columns if c not in ("tilt", "lo", "hi", "done")],
                                    F.when(go, lo).otherwise(F.col("lo")).alias("lo"), F.when(go, hi).otherwise(F.col("hi")).alias("hi"),
                                    (F.col("done") | F.col("f").isNull() | near).alias("done"),
                                    F.when(go, next_).otherwise(F.col("tilt")).alias("tilt")), "tilts")
        if state.where(~F.col("done")).isEmpty():
            break
    return state


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
        weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: int = 3) -> DataFrame:
    """The input rows and columns, and size, source_size, target, rate, copies, taken (replaced if present).

    Sources in code point order (null last) weigh as `weights` says, in turn. A document is taken whole `copies` times,
    0 to `most`; taken = copies * size. Words of null texts: 0, and documents without words get no copy of any effect.
    Among documents of one source and size, those with the least hashes of their keys get the odd copies, so reruns
    agree; rows with equal (or null) keys are treated alike.
    """
    made = ["size", "source_size", "target", "rate", "copies", "taken"]
    docs = docs.drop(*[c for c in docs.columns if c in made])
    rows = docs.withColumn("size", n_words(F.col(text)))
    turn = F.xxhash64(F.lit("turn"), F.col(key))
    # Words are counted once for all that follows but the final rows.
    slim = stored(rows.select(F.col(source).alias("of"), F.col("size").alias("words"), turn.alias("h")), "words")
    sizes = stored(slim.groupBy(F.col("of").alias("source"), F.col("words").alias("size")).agg(F.count("*").alias("n")), "sizes")
    goals = targets(sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("total")), weights, float(most))
    found = tilts(sizes, goals.select("source", "total", "target"), float(most))
    state = found.select(F.col("source").alias("of"), "total", "target", "tilt", "mean")
    rates = sizes.join(state, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.least(F.exp(F.col("tilt") * F.col("size") / F.col("mean")), F.lit(float(most))))
    # Running sums of wanted copies by size: first over coarse groups of sizes, then inside each.
    rates = rates.withColumn("rate", rate).withColumn("coarse", F.floor(F.col("size") / 64))
    coarse = rates.groupBy("source", "coarse").agg(F.sum(F.col("n") * F.col("rate")).alias("want"))
    up_to = Window.partitionBy("source").orderBy("coarse").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.withColumn("start", F.coalesce(F.sum("want").over(up_to), F.lit(0.0))).select(F.col("source").alias("of"), F.col("coarse").alias("in"), "start")
    rates = rates.join(coarse, F.col("source").eqNullSafe(F.col("of")) & (F.col("coarse") == F.col("in"))).drop("of", "in")
    inside = Window.partitionBy("source", "coarse").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("start") + F.sum(F.col("n") * F.col("rate")).over(inside)
    rates = rates.withColumn("end", end).withColumn("begin", F.col("end") - F.col("n") * F.col("rate"))
    # A group takes the whole numbers between its two running sums, moved by an offset; they are dealt evenly, each
    # document gets the floor or one more. Of some offsets each source takes the one that comes nearest to its target.
    def group_copies(offset: Column) -> Column:
        whole = F.floor(F.col("end") + offset) - F.floor(F.col("begin") + offset)
        return F.least(whole, F.col("n") * most)

    rates = stored(rates.select("source", "size", "n", "total", "target", "rate", "begin", "end"), "rates")
    tried = rates.select("source", "target", F.explode(F.array(*[F.lit((i + 0.5) / OFFSETS) for i in range(OFFSETS)])).alias("offset"),
                         "size", "n", "begin", "end")
    missed = tried.groupBy("source", "target", "offset").agg(F.abs(F.sum(group_copies(F.col("offset")) * F.col("size")) - F.first("target")).alias("miss"))
    best = missed.groupBy(F.col("source").alias("of")).agg(F.min(F.struct("miss", "offset")).alias("x")).select("of", "x.offset")
    rates = rates.join(best, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("group_copies", group_copies(F.col("offset")))
    rates = stored(rates.select(F.col("source").alias("of"), F.col("size").alias("words"), "n", F.col("total").alias("source_size"),
                                "target", "rate", "group_copies"), "rates")
    # Which documents of a group get one more copy: those whose hash is at most the hash of the last one that does.
    slim = slim.withColumn("range", F.shiftright("h", 54))
    extra = rates.where(F.col("group_copies") % F.col("n") > 0).select(
        F.col("of").alias("o"), F.col("words").alias("w"), (F.col("group_copies") % F.col("n")).alias("extra"))
    # Equal sizes of a source may be a third of all rows: only the one of 1024 hash ranges that holds the last is ranked.
    over = Window.partitionBy("of", "words").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ranges = slim.groupBy("of", "words", "range").agg(F.count("*").alias("m")).withColumn("to", F.sum("m").over(over))
    cut = (ranges.join(extra, F.col("of").eqNullSafe(F.col("o")) & (F.col("words") == F.col("w")))
           .where((F.col("to") >= F.col("extra")) & (F.col("to") - F.col("m") < F.col("extra")))
           .select("o", "w", F.col("range").alias("r"), (F.col("extra") - F.col("to") + F.col("m")).alias("at")))
    ranked_ = slim.join(cut, F.col("of").eqNullSafe(F.col("o")) & (F.col("words") == F.col("w")) & (F.col("range") == F.col("r")))
    place = F.row_number().over(Window.partitionBy("of", "words", "range").orderBy("h"))
    last = ranked_.withColumn("place", place).where(F.col("place") == F.col("at")).select("o", "w", F.col("h").alias("last"))
    plan = stored(rates.join(last, F.col("of").eqNullSafe(F.col("o")) & (F.col("words") == F.col("w")), "left").drop("o", "w"), "plan")
    own = {"of": "__of", "words": "__words", "n": "__n", "group_copies": "__copies", "last": "__last"}
    plan = plan.withColumnsRenamed(own)
    if plan.count() <= SMALL:
        plan = F.broadcast(plan)
    copies = (F.floor(F.col("__copies") / F.col("__n")) + F.when(turn <= F.col("__last"), 1).otherwise(0)).cast("int")
    return (rows.join(plan, F.col(source).eqNullSafe(F.col("__of")) & (F.col("size") == F.col("__words")))
            .withColumn("copies", F.least(copies, F.lit(most))).withColumn("taken", F.col("copies") * F.col("size"))
            .drop(*own.values()))


@query("op6_source_mix")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    done = mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return done.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken", "copies")
