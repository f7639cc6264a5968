"""Transformed quantities per row and day; rejects and scrap moved to productive days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.nullsafe import sum0
from tallyworks.operators.groups import HOT_ROWS, attach_group_values
from tallyworks.operators.nearest import asof_totals
from tallyworks.plans.costing.classify import is_main


def transformed_quantity(entries: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Done quantity of main-process rows, and its total per order and day on every row."""
    rows = entries.withColumn("qty_transformed", F.when(is_main(), F.col("qty_done")))
    return attach_group_values(rows, ["order_id", "day"],
                               [sum0(F.col("qty_transformed")).alias("day_transformed")], hot_rows)


def rejects_by_productive_day(entries: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rejected and scrap quantities on the productive rows of the day they belong to."""
    return asof_totals(entries, "order_id", "day", is_main() & (F.col("qty_done") > 0),
                       {"day_rejected": "qty_rejected", "day_scrap": "qty_scrap"}, hot_rows)
