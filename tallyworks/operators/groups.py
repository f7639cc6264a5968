"""Group aggregates and attaching them to detail rows without gathering a group in one task.

A window over a group puts the whole group in one task. Here the group is first reduced with
map-side partial aggregation to one row, and that row is joined back. Groups above HOT_ROWS rows
are joined by broadcast and their detail rows are spread over many tasks; there are at most
(all rows / HOT_ROWS) of them, so the broadcast side is small by construction. All other groups
meet their detail rows in an ordinary shuffle join in which no key exceeds HOT_ROWS rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.nullsafe import sum0, with_keys

HOT_ROWS = 4_000_000
SPREAD = 1024
#: Rows that a task with several sorts or windows takes at most, on average.
TASK_ROWS = 150_000
#: Counters that tell where a key of very many rows can be at all.
COUNTERS = 4096

_ROWS, _HOT, _COLD, _SLOT, _GROUP_SLOT = "_group_rows", "_hot_values", "_cold_values", "_slot", "_group_slot"


def parts_for(rows: DataFrame, task_rows: int = TASK_ROWS) -> int:
    """Partitions for steps that hold their rows in memory: as many as keep a task near `task_rows`, however large the
    input; never fewer than the session's shuffles have. The rows are counted, which reads no column of a table."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // task_rows))


def group_aggregate(df: DataFrame, keys: Sequence[str], values: Sequence[Column]) -> DataFrame:
    """Aggregates per complete key; rows with a missing key part belong to no group."""
    return with_keys(df, keys).groupBy(*keys).agg(*values)


def group_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return group_aggregate(df, keys, [sum0(F.col(m)).alias(m) for m in measures])


def sized_groups(df: DataFrame, keys: Sequence[str], values: Sequence[Column],
                 keep_missing: bool = False) -> DataFrame:
    """Group aggregates together with the row count `attach` needs."""
    base = df if keep_missing else with_keys(df, keys)
    return base.groupBy(*keys).agg(*values, F.count(F.lit(1)).alias(_ROWS))


def crowded(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys of more than `hot_rows` rows, with their number as `_group_rows`; a missing key part is a value like any.

    Rows are counted by a hash of their key first, which moves a few thousand numbers a task and no row. Only the rows
    of counters above `hot_rows` can be of such a key: they alone are counted by key.
    """
    counter = F.pmod(F.xxhash64(*keys), F.lit(COUNTERS)).cast("int").alias("_counter")
    full = rows.groupBy(counter).agg(F.count(F.lit(1)).alias(_ROWS)).filter(F.col(_ROWS) > hot_rows).select("_counter")
    doubtful = rows.select(*keys, counter).join(F.broadcast(full), "_counter", "left_semi")
    return doubtful.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS)).filter(F.col(_ROWS) > hot_rows)


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "left",
           null_safe: bool = False, hot_rows: int = HOT_ROWS, sizes: DataFrame | None = None,
           slot_by: Sequence[str] | None = None, parts: int | None = None) -> DataFrame:
    """Join `groups` to detail rows on `keys`; `how` is left or inner.

    Groups straight from `sized_groups`, one row per key, bring their row counts, and the values of
    hot groups travel in the broadcast. Groups that cost more to work out, or have several rows per
    key, come with `sizes` (keys and `_group_rows`): then only the hot keys are broadcast, and the
    rows and copies of a hot group are dealt to as many slots as it has HOT_ROWS. With `null_safe`, a missing key part
    meets a missing key part; otherwise such rows meet nothing and are dealt to all slots.

    `slot_by` names the columns whose hash deals the rows of a hot group: ones that tell its rows apart. Without it the
    row id is taken, or all columns where there is none, which then must all be read. `parts` (of `parts_for`) deals the
    detail rows to that many tasks.
    """
    if sizes is not None:
        return _attach_by_slots(rows, groups, sizes, keys, how, null_safe, hot_rows, slot_by)
    values = [c for c in groups.columns if c not in keys and c != _ROWS]
    renamed = _renamed(keys)
    packed = F.struct(*[F.col(v) for v in values])
    hot = groups.filter(F.col(_ROWS) > hot_rows).select(*renamed, packed.alias(_HOT))
    # Always 0, yet no literal: that would be folded into the join, which then dealt hot rows by their key alone.
    cold = groups.filter(F.col(_ROWS) <= hot_rows).select(
        *renamed, packed.alias(_COLD), (F.col(_ROWS) > hot_rows).cast("int").alias(_GROUP_SLOT))
    slot = F.pmod(_dealt_by(rows, slot_by), F.lit(SPREAD)).cast("int") + 1
    spread = (
        rows.join(F.broadcast(hot), _match(hot, keys, null_safe), "left")
        .select(*rows.columns, _HOT, F.when(F.col(_HOT).isNotNull() | _unmatched(keys, null_safe), slot).otherwise(F.lit(0)).alias(_SLOT))
    )
    if parts and not null_safe:
        spread = spread.repartition(parts, *keys, _SLOT)
    joined = spread.join(cold, _match(cold, keys, null_safe) & (F.col(_SLOT) == cold[_GROUP_SLOT]), "left")
    found = F.coalesce(F.col(_HOT), F.col(_COLD))
    if how == "inner":
        joined = joined.filter(found.isNotNull())
    return joined.select(*rows.columns, *[found[v].alias(v) for v in values])


def _dealt_by(rows: DataFrame, slot_by: Sequence[str] | None) -> Column:
    return F.xxhash64(*(slot_by or (["row_id"] if "row_id" in rows.columns else rows.columns)))


def _unmatched(keys: Sequence[str], null_safe: bool) -> Column:
    """Rows whose key can meet no group; sent to one place by their key they could be very many."""
    return F.lit(False) if null_safe else reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _renamed(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)]


def _match(side: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(k), side[f"_k_{i}"]) for i, k in enumerate(keys)]
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) if null_safe else l == r for l, r in pairs])


def _attach_by_slots(rows: DataFrame, groups: DataFrame, sizes: DataFrame, keys: Sequence[str], how: str,
                     null_safe: bool, hot_rows: int, slot_by: Sequence[str] | None) -> DataFrame:
    values = [c for c in groups.columns if c not in keys]
    hot = F.broadcast(sizes.filter(F.col(_ROWS) > hot_rows).select(
        *_renamed(keys), F.ceil(F.col(_ROWS) / F.lit(hot_rows)).cast("int").alias("_slots")))
    one = F.coalesce(F.col("_slots"), F.lit(1))
    places = F.when(_unmatched(keys, null_safe), F.lit(SPREAD)).otherwise(one)
    dealt = rows.join(hot, _match(hot, keys, null_safe), "left").select(
        *rows.columns, F.pmod(_dealt_by(rows, slot_by), places).cast("int").alias(_SLOT))
    copies = groups.join(hot, _match(hot, keys, null_safe), "left").select(
        *_renamed(keys), *values, F.explode(F.sequence(F.lit(0), one - 1)).alias(_GROUP_SLOT))
    joined = dealt.join(copies, _match(copies, keys, null_safe) & (F.col(_SLOT) == copies[_GROUP_SLOT]), how)
    return joined.select(*rows.columns, *values)


def attach_group_values(df: DataFrame, keys: Sequence[str], values: Sequence[Column],
                        hot_rows: int = HOT_ROWS) -> DataFrame:
    """Give each row the aggregates of its group; null for rows with a missing key part."""
    return attach(df, sized_groups(df, keys, values), keys, hot_rows=hot_rows)


def prorate(df: DataFrame, keys: Sequence[str], weight: str, amount: str, result: str,
            hot_rows: int = HOT_ROWS) -> DataFrame:
    """`amount` times the row's part of its group's total weight."""
    total = f"_total_{weight}"
    out = attach_group_values(df, keys, [sum0(F.col(weight)).alias(total)], hot_rows)
    return out.withColumn(result, F.try_divide(F.col(weight), F.col(total)) * F.col(amount)).drop(total)
