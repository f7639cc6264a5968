"""Set operations on whole frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of all rows by column name; a column a frame lacks is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def distinct_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names).distinct()


def common_keys(left: DataFrame, right: DataFrame, name: str, without: Sequence = ()) -> DataFrame:
    """Distinct key values present on both sides, minus some values."""
    both = left.select(name).intersect(right.select(name))
    return both.filter(~F.col(name).isin(*without)) if without else both


def with_partner(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def pair_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows of several frames with the same columns."""
    return stack(frames).distinct()
