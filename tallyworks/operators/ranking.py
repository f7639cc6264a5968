"""Ordering, best-per-group, top and bottom lists, record numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.sources.staging import staged


def first_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The values of the first row per key; one partial aggregation, no sort of the group."""
    picked = F.min_by(F.struct(*values), F.struct(*order))
    return df.groupBy(*keys).agg(picked.alias("_v")).select(*keys, *[F.col("_v")[v].alias(v) for v in values])


def nulls_last(name: str) -> list[Column]:
    """Order parts under which a missing value comes after all others."""
    return [F.col(name).isNull(), F.col(name)]


def sort_rows(df: DataFrame, by: Sequence[tuple[str, bool]]) -> DataFrame:
    """Sort by (column, ascending) pairs, missing values last either way."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in by])


def top_and_bottom(df: DataFrame, score: str, tie: str, k: int = 5) -> DataFrame:
    """The k best (best first) and the k worst (worst first), each with its position.

    Both lists read df: it is staged, so what its scores ask for is worked out once.
    """
    df = staged(df, "scored")
    best = df.orderBy(F.col(score).desc(), F.col(tie)).limit(k)
    worst = df.orderBy(F.col(score), F.col(tie).desc()).limit(k)

    def placed(part: DataFrame, label: str, *order: Column) -> DataFrame:
        return part.select(F.lit(label).alias("list"), F.row_number().over(Window.orderBy(*order)).alias("place"), "*")

    return placed(best, "top", F.col(score).desc(), F.col(tie)).unionByName(
        placed(worst, "bottom", F.col(score), F.col(tie).desc()))


def first_in_group(df: DataFrame, group: str, order: Sequence[str], k: int) -> DataFrame:
    """The first k rows of each group; Spark cuts each task's share of a group before the shuffle."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= k)


def number_records(df: DataFrame, key: str, name: str = "record_number", start: int = 1,
                   block: int = 1_000_000) -> DataFrame:
    """Consecutive numbers in the order of a unique whole-number key.

    Rows fall in blocks of `block` consecutive key values, so no task sorts more than `block` rows;
    a block's offset is the row count of the blocks before it.
    """
    slot = F.floor(F.col(key) / F.lit(block)).cast("long")
    blocked = df.withColumn("_block", slot)
    counts = blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(key))
    return (blocked.withColumn("_inside", inside).join(offsets, "_block")
            .withColumn(name, (F.col("_offset") + F.col("_inside") + (start - 1)).cast("long"))
            .select(*df.columns, name))


def number_in_input_order(scan: DataFrame, name: str = "record_number", start: int = 1) -> DataFrame:
    """Consecutive numbers in the order of the input: files by path, then rows as they stand in their file.

    `scan` is a frame as a file reader gives it, without filters. Every task counts along its splits; a split's offset is
    the number of rows in the splits before it (one small row a split), so no row is sorted or shuffled for its number.
    """
    placed = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
                         F.monotonically_increasing_id().alias("_place"))
    splits = placed.groupBy("_file", "_split").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_split", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return placed.join(offsets, ["_file", "_split"]).select(
        *scan.columns, (F.col("_place") - F.col("_first") + F.col("_offset") + start).cast("long").alias(name))
