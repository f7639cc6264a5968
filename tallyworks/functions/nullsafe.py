"""The null rules of the data model as column expressions.

Missing keys form no group, sums over nothing are zero, tests against a missing value are
"different" and "not in", and a division by zero gives null (never an error or infinity).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_present(names: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose grouping key is complete."""
    return df.filter(all_present(keys))


def not_in(col: Column, values: Sequence) -> Column:
    """True for a missing value as well."""
    return ~F.coalesce(col.isin(*values), F.lit(False))


def differs(col: Column, value) -> Column:
    """True for a missing value as well."""
    return ~col.eqNullSafe(F.lit(value) if not isinstance(value, Column) else value)


def sum0(col: Column) -> Column:
    """Sum that is zero, not null, over only-missing values."""
    return F.coalesce(F.sum(col), F.lit(0.0))


def sum_if_any(condition: Column, value: Column) -> Column:
    """Null where no row meets the condition, else the zero-based sum over those rows."""
    return F.sum(F.when(condition, F.coalesce(value, F.lit(0.0))))


def row_sum(*cols: Column) -> Column:
    """Sum across columns, null only when every one is missing."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    return F.when(F.coalesce(*cols).isNotNull(), total)


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def same_key(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Join condition under which a missing key part equals a missing key part."""
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])
