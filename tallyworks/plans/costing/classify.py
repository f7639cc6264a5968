"""Main process of an order, second-level process, operation class, group and cost centre."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions.nullsafe import differs
from tallyworks.functions.strings import prefix
from tallyworks.operators.groups import attach, parts_for, sized_groups
from tallyworks.operators.joins import last_per_key, lookup, prefix_lookup
from tallyworks.plans.costing.vocabulary import (EXTERNAL_OPERATION, OPERATION, SET_UP, STANDARD_METHOD,
                                                 SUPPLEMENTARY)


def main_process(entries: DataFrame, processes: DataFrame, gathered: bool = False) -> DataFrame:
    """Process by five-character prefix; per order the process of lowest rank and its first operation.

    The rank is compared as a number, missing ranks last; equal ranks go by process, then row. `gathered` entries lie by
    their order already (`job.classified_entries`) and are not shuffled.
    """
    ranked = prefix_lookup(entries, "op_text", 5, processes, "prefix5",
                           {"process": "process", "process_rank": "rank"}, "prefix5")
    ranked = ranked.withColumn("process_rank", F.col("process_rank").cast("int"))
    order = F.struct(F.col("process_rank").isNull(), F.col("process_rank"), F.col("process").isNull(),
                     F.col("process"), F.col("row_id"))
    best = F.min_by(F.struct("process", "process_rank", "op_text"), order)
    if gathered:
        out = ranked.withColumn("_best", best.over(Window.partitionBy("order_id")))
    else:
        out = attach(ranked, sized_groups(ranked, ["order_id"], [best.alias("_best")]), ["order_id"], parts=parts_for(entries))
    main = F.when(F.col("_best.process").isNotNull(), F.col("_best.op_text"))
    return (out.withColumn("parent_process", F.col("_best.process"))
            .withColumn("parent_rank", F.col("_best.process_rank"))
            .withColumn("main_operation", main).drop("_best"))


def is_main(process: str = "process", parent: str = "parent_process") -> Column:
    return F.coalesce(F.col(process) == F.col(parent), F.lit(False))


def second_level_label() -> Column:
    """Label a row proposes for its order; null where it proposes none."""
    centre, method = F.col("centre"), F.col("method")
    return (F.when(centre == SUPPLEMENTARY, F.lit(SUPPLEMENTARY))
            .when(centre.isNull(), F.lit(None).cast("string"))
            .when(differs(method, STANDARD_METHOD), method)
            .when(is_main(), centre))


def second_level_priority() -> Column:
    return (F.when(F.col("centre") == SUPPLEMENTARY, 1).when(F.col("centre").isNull(), 2)
            .when(differs(F.col("method"), STANDARD_METHOD), 3).when(is_main(), 4).otherwise(5))


def second_level(entries: DataFrame, gathered: bool = False) -> DataFrame:
    """Second-level process of an order: the proposed label of best priority, on all its rows. `gathered`: as for the main process."""
    label = second_level_label()
    best = F.min_by(F.when(label.isNotNull(), label),
                    F.when(label.isNotNull(), F.struct(second_level_priority(), F.col("row_id"))))
    if gathered:
        return entries.withColumn("second_level", best.over(Window.partitionBy("order_id")))
    return attach(entries, sized_groups(entries, ["order_id"], [best.alias("second_level")]), ["order_id"])


def operation_class(entries: DataFrame, specifics: DataFrame) -> DataFrame:
    """Specific process by twelve-character prefix, operation class, parent process filled by the class."""
    out = prefix_lookup(entries, "op_text", 12, specifics, "prefix12", {"specific_process": "specific_process"},
                        "prefix12")
    kind = (F.when(F.col("centre").isNull(), F.lit(EXTERNAL_OPERATION))
            .when(F.col("centre") == SUPPLEMENTARY, F.lit(SUPPLEMENTARY))
            .when(prefix(F.col("specific_process"), 12) == SET_UP, F.lit(SET_UP))
            .otherwise(F.lit(OPERATION)))
    return out.withColumn("op_class", kind).withColumn(
        "parent_process", F.coalesce(F.col("parent_process"), F.col("op_class")))


def with_group(entries: DataFrame, groups: DataFrame, gathered: bool = False) -> DataFrame:
    """Group and mounting order of the order; `gathered` entries have an order and are not shuffled."""
    if gathered:
        side = groups.filter(F.col("order_id").isNotNull()).select("order_id", F.col("group_id").alias("_group"), F.col("mount_order").alias("_mount"))
        return entries.join(side, "order_id", "left").select(*entries.columns, F.col("_group").alias("group_id"), F.col("_mount").alias("mount_order"))
    return lookup(entries, groups, [("order_id", "order_id")], {"group_id": "group_id", "mount_order": "mount_order"})


def with_cost_centre(entries: DataFrame, equivalence: DataFrame, order: Column) -> DataFrame:
    """Cost centre of the work centre; of repeated work centres the last row of the table wins."""
    unique = last_per_key(equivalence, ["centre_code"], ["cost_centre"], order)
    return lookup(entries, unique, [("centre_code", "centre_code")], {"cost_centre": "cost_centre"})
