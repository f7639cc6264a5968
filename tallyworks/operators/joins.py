"""Joins of the costing data: corrections, lookups, prefixes, anti joins, same-grain merges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.nullsafe import same_key
from tallyworks.functions.strings import prefix


def override(df: DataFrame, corrections: DataFrame, on: Sequence[tuple[str, str]],
             replaced: Mapping[str, str], casts: Mapping[str, str] | None = None) -> DataFrame:
    """Left join a correction table; a corrected value, where present, replaces the original.

    `replaced` maps a column of `df` to the correction column; a missing key part matches a
    missing key part.
    """
    casts = casts or {}
    side = corrections.select(
        *[F.col(r).alias(f"_on_{i}") for i, (_, r) in enumerate(on)],
        *[F.col(new).cast(casts[old]).alias(f"_new_{old}") if old in casts else F.col(new).alias(f"_new_{old}")
          for old, new in replaced.items()])
    joined = df.join(side, same_key(df, side, [(l, f"_on_{i}") for i, (l, _) in enumerate(on)]), "left")
    return joined.select(*[
        F.coalesce(F.col(f"_new_{c}"), df[c]).alias(c) if c in replaced else df[c] for c in df.columns])


def last_per_key(dim: DataFrame, keys: Sequence[str], values: Sequence[str], order: Column) -> DataFrame:
    """One row per key: of repeated keys the last in `order` wins."""
    picked = F.max_by(F.struct(*values), order)
    return dim.groupBy(*keys).agg(picked.alias("_v")).select(*keys, *[F.col("_v")[v].alias(v) for v in values])


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], values: Mapping[str, str]) -> DataFrame:
    """Left join of a code table with unique keys; `values` maps result name -> dim column.

    No broadcast is forced: Spark broadcasts when the table is small enough and shuffles when not.
    """
    side = dim.select(*[F.col(r).alias(f"_on_{i}") for i, (_, r) in enumerate(on)],
                      *[F.col(c).alias(name) for name, c in values.items()])
    pairs = [(l, f"_on_{i}") for i, (l, _) in enumerate(on)]
    return df.join(side, same_key(df, side, pairs), "left").drop(*[f"_on_{i}" for i in range(len(on))])


def prefix_lookup(df: DataFrame, text: str, n: int, dim: DataFrame, dim_prefix: str,
                  values: Mapping[str, str], name: str) -> DataFrame:
    """Left join of a table keyed by the first `n` characters of a text column."""
    return lookup(df.withColumn(name, prefix(F.col(text), n)), dim, [(name, dim_prefix)], values)


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` without a partner; a missing key part matches a missing key part."""
    side = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    return left.join(side, same_key(left, side, [(k, f"_r_{k}") for k in keys]), "left_anti")


def merge_same_grain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer merge of frames that each hold one row per key: one union, one shuffle."""
    values = [c for f in frames for c in f.columns if c not in keys]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])


def append_rows(facts: DataFrame, computed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer merge on the row identity: known rows gain columns, unknown rows are added."""
    shared = [c for c in facts.columns if c in computed.columns and c not in keys]
    side = computed.select(*[F.col(c).alias(f"_c_{c}") if c in (*keys, *shared) else F.col(c)
                             for c in computed.columns])
    joined = facts.join(side, same_key(facts, side, [(k, f"_c_{k}") for k in keys]), "full_outer")
    extra = [c for c in computed.columns if c not in facts.columns]
    return joined.select(
        *[F.coalesce(facts[c], F.col(f"_c_{c}")).alias(c) if c in (*keys, *shared) else facts[c]
          for c in facts.columns],
        *[F.col(c) for c in extra])
