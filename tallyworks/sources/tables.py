"""All-text tables cast to their types on purpose, column by column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.dates import day_of


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast named columns; `day` takes the date of the first ten characters, the rest stay text."""

    def typed(name: str) -> Column:
        kind = types.get(name)
        if kind is None:
            return F.col(name)
        return (day_of(F.col(name)) if kind == "day" else F.col(name).cast(kind)).alias(name)

    return df.select(*[typed(c) for c in df.columns])
