"""Joins, aggregates, windows, sorts and set operations on the time entries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from suite import bindings as B
from suite.registry import half_up_sql, query, table
from tallyworks.functions.nullsafe import differs, not_in, row_sum, sum0
from tallyworks.functions.numbers import half_up
from tallyworks.functions.strings import prefix
from tallyworks.operators.groups import attach, attach_group_values, group_sum, sized_groups
from tallyworks.operators.joins import prefix_lookup
from tallyworks.operators.ranking import number_in_input_order, number_records, sort_rows
from tallyworks.operators.sets import common_keys, distinct_values, stack, with_partner
from tallyworks.plans.costing import classify, masters
from tallyworks.plans.costing.rates import hours_by_period_centre
from tallyworks.session import shared_folder
from tallyworks.sources.tables import cast_columns


def _text(*names):
    return [F.col(n).cast("string").alias(n) for n in names]


@query("prorate_by_hours", f"""
WITH {B.TE_SQL}
SELECT row_id, order_id, hours, {half_up_sql('hours / nullif(sum(hours) OVER (PARTITION BY order_id), 0)')} AS share,
       {half_up_sql('hours / nullif(sum(hours) OVER (PARTITION BY order_id), 0) * floor(o_totalprice)')} AS amount
FROM te LEFT JOIN orders ON order_id = o_orderkey""")
def prorate_by_hours(spark, folder):
    rows = B.entries(spark, folder).select("row_id", "order_id", "hours")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.floor("o_totalprice").cast("double").alias("order_amount"))
    totals = sized_groups(rows, ["order_id"], [sum0(F.col("hours")).alias("order_hours")])
    share = F.try_divide("hours", "order_hours")
    return attach(rows, totals.join(orders, "order_id", "left"), ["order_id"]).select(
        "row_id", "order_id", "hours", half_up(share, 6).alias("share"),
        half_up(share * F.col("order_amount"), 6).alias("amount"))


@query("typed_load", """
SELECT l_orderkey AS order_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, l_quantity AS hours,
       l_extendedprice AS price, l_returnflag AS flag FROM lineitem""")
def typed_load(spark, folder):
    lines = table(spark, folder, "lineitem")
    text = lines.select(F.col("l_orderkey").cast("string").alias("order_id"),
                        F.col("l_shipdate").cast("string").alias("day"), F.col("l_quantity").cast("string").alias("hours"),
                        F.col("l_extendedprice").cast("string").alias("price"), F.col("l_returnflag").alias("flag"))
    typed = cast_columns(text, {"order_id": "bigint", "day": "day", "hours": "double", "price": "double"})
    return typed.withColumn("day", F.col("day").cast("string"))


CORRECTIONS = """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE concat('OPX-', CAST(o_orderkey AS STRING)) END AS order_ref, CAST(1 + o_custkey % 7 AS STRING) AS old_code,
  CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE CAST(20 + o_custkey % 9 AS STRING) END AS new_code,
  CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE concat('OPERACION NUEVA ', CAST(o_custkey % 5 AS STRING)) END AS new_text,
  CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'CENTRO NUEVO' END AS new_centre FROM orders"""


@query("corrections_operations", f"""
WITH {B.TB_SQL}, cr AS ({CORRECTIONS})
SELECT row_id, CAST(order_id AS VARCHAR) AS order_id, coalesce(right('0' || new_code, 2), op_code) AS op_code,
       coalesce(new_text, op_text) AS op_text, coalesce(new_centre, centre) AS centre
FROM tb LEFT JOIN cr ON CAST(order_id AS VARCHAR) = substr(order_ref, 5) AND op_code = right('0' || old_code, 2)""")
def corrections_operations(spark, folder):
    rows = B.base_entries(spark, folder).select(
        "row_id", F.col("order_id").cast("string").alias("order_id"), "op_code", "op_text", "centre")
    orders = table(spark, folder, "orders")
    corrections = orders.selectExpr(*[
        e.strip() for e in (
            "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE concat('OPX-', CAST(o_orderkey AS STRING)) END AS order_ref", "CAST(1 + o_custkey % 7 AS STRING) AS old_code",
            "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE CAST(20 + o_custkey % 9 AS STRING) END AS new_code",
            "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE concat('OPERACION NUEVA ', CAST(o_custkey % 5 AS STRING)) END AS new_text",
            "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'CENTRO NUEVO' END AS new_centre")])
    return masters.correct_operations(rows, corrections)


MOVEMENT_FIX = """concat(CASE WHEN max(l_linestatus) = 'F' THEN 'INV' ELSE 'OTRO' END, CAST(l_linenumber AS STRING)) AS doc, l_orderkey AS order_id,
  concat('R', CAST(l_orderkey % 7 AS STRING)) AS reference,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(max(l_partkey) AS STRING) END AS new_kg_out,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(max(l_suppkey) AS STRING) END AS new_kg_in,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(min(l_partkey) AS STRING) END AS new_kg,
  CASE WHEN l_linenumber = 1 THEN 'KGS' ELSE NULL END AS new_unit"""


@query("corrections_movements", f"""
WITH {B.MV_SQL}, cr AS (SELECT {MOVEMENT_FIX} FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT order_id, doc, reference, CAST(day AS VARCHAR) AS day, coalesce(CAST(new_kg_out AS DOUBLE), kg_out) AS kg_out,
       coalesce(CAST(new_kg_in AS DOUBLE), kg_in) AS kg_in, coalesce(CAST(new_kg AS DOUBLE), kg) AS kg,
       coalesce(new_unit, unit) AS unit
FROM mv LEFT JOIN cr USING (order_id, doc, reference)""")
def corrections_movements(spark, folder):
    moved = B.movements(spark, folder)
    fixes = (table(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber")
             .agg(F.max("l_partkey").cast("string").alias("hi_part"), F.max("l_suppkey").cast("string").alias("hi_supp"),
                  F.min("l_partkey").cast("string").alias("lo_part"), F.max("l_linestatus").alias("status"))
             .selectExpr("concat(CASE WHEN status = 'F' THEN 'INV' ELSE 'OTRO' END, CAST(l_linenumber AS STRING)) AS doc", "l_orderkey AS order_id",
                         "concat('R', CAST(l_orderkey % 7 AS STRING)) AS reference",
                         "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE hi_part END AS new_kg_out",
                         "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE hi_supp END AS new_kg_in",
                         "CASE WHEN l_linenumber = 5 THEN NULL ELSE lo_part END AS new_kg",
                         "CASE WHEN l_linenumber = 1 THEN 'KGS' ELSE NULL END AS new_unit"))
    return masters.correct_movements(moved, fixes).select(
        "order_id", "doc", "reference", *_text("day"), "kg_out", "kg_in", "kg", "unit")


@query("null_aware_filters", f"""
WITH {B.TE_SQL}
SELECT row_id, centre, method, process, base_hours FROM te
WHERE (centre NOT IN ('CENTRO 1', 'ACTIVIDADES SUPLEMENTARIAS') OR centre IS NULL) AND method IS DISTINCT FROM 'Estandar'
  AND base_hours IS NOT NULL AND qty_rejected <> 0 AND day <= DATE '2000-12-31'
  AND (process <> 'MOLIDO' OR process IS NULL)""")
def null_aware_filters(spark, folder):
    return B.entries(spark, folder).filter(
        not_in(F.col("centre"), ["CENTRO 1", "ACTIVIDADES SUPLEMENTARIAS"]) & differs(F.col("method"), "Estandar")
        & F.col("base_hours").isNotNull() & (F.col("qty_rejected") != 0)
        & (F.col("day") <= F.lit("2000-12-31").cast("date")) & differs(F.col("process"), "MOLIDO")
    ).select("row_id", "centre", "method", "process", "base_hours")


@query("prefix_dimension_join", """
WITH dim AS (SELECT CASE WHEN p_type <> 'PROMO' THEN substr(p_type, 1, 5) END AS prefix5, max(p_type) AS process, CAST(count(*) AS BIGINT) AS rank
             FROM part GROUP BY 1)
SELECT p_partkey AS part, p_type || ' ' || p_name AS op_text, substr(p_type || ' ' || p_name, 1, 5) AS prefix5,
       process, rank FROM part LEFT JOIN dim ON substr(p_type || ' ' || p_name, 1, 5) = prefix5""")
def prefix_dimension_join(spark, folder):
    parts = table(spark, folder, "part")
    dim = (parts.groupBy(F.when(F.col("p_type") != "PROMO", prefix(F.col("p_type"), 5)).alias("prefix5"))
           .agg(F.max("p_type").alias("process"), F.count(F.lit(1)).alias("rank")))
    rows = parts.select(F.col("p_partkey").alias("part"), F.concat("p_type", F.lit(" "), "p_name").alias("op_text"))
    return prefix_lookup(rows, "op_text", 5, dim, "prefix5", {"process": "process", "rank": "rank"}, "prefix5")


@query("group_enrich", f"""
WITH {B.TB_SQL}, gr AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k, 'G' || CAST(o_custkey AS VARCHAR) AS group_id,
  'M' || o_orderstatus AS mount_order FROM orders)
SELECT row_id, order_id, group_id, mount_order FROM tb LEFT JOIN gr ON order_id = k""")
def group_enrich(spark, folder):
    groups = table(spark, folder, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("order_id"), F.concat(F.lit("G"), F.col("o_custkey").cast("string")).alias("group_id"),
        F.concat(F.lit("M"), F.col("o_orderstatus")).alias("mount_order"))
    return classify.with_group(B.base_entries(spark, folder).select("row_id", "order_id"), groups)


@query("cost_centre_lookup", f"""
WITH {B.TB_SQL}, eq AS (SELECT CASE WHEN s_nationkey % 4 <> 3 THEN '0' || CAST(s_suppkey % 6 AS VARCHAR) || '-' || CAST(s_nationkey % 4 AS VARCHAR) END AS k,
    arg_max(CAST(301000 + s_suppkey % 25 AS VARCHAR), s_suppkey) AS cost_centre FROM supplier GROUP BY 1)
SELECT row_id, centre_code, cost_centre FROM tb LEFT JOIN eq ON centre_code = k""")
def cost_centre_lookup(spark, folder):
    table_rows = table(spark, folder, "supplier").selectExpr(
        "CASE WHEN s_nationkey % 4 <> 3 THEN concat('0', CAST(s_suppkey % 6 AS STRING), '-', CAST(s_nationkey % 4 AS STRING)) END AS centre_code",
        "CAST(301000 + s_suppkey % 25 AS STRING) AS cost_centre", "s_suppkey")
    rows = B.base_entries(spark, folder).select("row_id", "centre_code")
    return classify.with_cost_centre(rows, table_rows, F.col("s_suppkey"))


@query("group_sum", f"""
WITH {B.TE_SQL}
SELECT order_id, process, coalesce(sum(hours), 0) AS hours, coalesce(sum(qty_rejected), 0) AS qty_rejected
FROM te WHERE process IS NOT NULL GROUP BY 1, 2""")
def group_sum_query(spark, folder):
    return group_sum(B.entries(spark, folder), ["order_id", "process"], ["hours", "qty_rejected"])


@query("hours_by_period_centre", f"""
WITH {B.TE_SQL}
SELECT period, cost_centre, coalesce(sum(hours), 0) AS hours FROM te WHERE cost_centre IS NOT NULL
GROUP BY 1, 2 HAVING coalesce(sum(hours), 0) <> 0""")
def hours_by_period_centre_query(spark, folder):
    return hours_by_period_centre(B.entries(spark, folder))


@query("distinct_values", f"WITH {B.TE_SQL} SELECT DISTINCT period, process, method FROM te")
def distinct_values_query(spark, folder):
    return distinct_values(B.entries(spark, folder), ["period", "process", "method"])


@query("rowwise_sum_mincount", f"""
WITH {B.TE_SQL}
SELECT row_id, CASE WHEN coalesce(qty_rejected, nullif(qty_scrap, 0), nullif(base_qty, 10)) IS NOT NULL
  THEN coalesce(qty_rejected, 0) + coalesce(nullif(qty_scrap, 0), 0) + coalesce(nullif(base_qty, 10), 0) END AS total FROM te""")
def rowwise_sum_mincount(spark, folder):
    zero, ten = F.lit(0.0), F.lit(10.0)
    return B.entries(spark, folder).select("row_id", row_sum(
        F.col("qty_rejected"), F.nullif(F.col("qty_scrap"), zero), F.nullif(F.col("base_qty"), ten)).alias("total"))


@query("window_total", f"""
WITH {B.TE_SQL}
SELECT row_id, order_id, process, CASE WHEN process IS NOT NULL
  THEN coalesce(sum(qty_rejected) OVER (PARTITION BY order_id, process), 0) END AS total FROM te""")
def window_total(spark, folder):
    rows = B.entries(spark, folder).select("row_id", "order_id", "process", "qty_rejected")
    return attach_group_values(rows, ["order_id", "process"], [sum0(F.col("qty_rejected")).alias("total")]).drop("qty_rejected")


@query("window_min", f"""
WITH {B.TE_SQL}, m AS (SELECT row_id, group_id, day, order_id,
  CASE WHEN group_id IS NOT NULL THEN min(day) OVER (PARTITION BY group_id) END AS first_day FROM te)
SELECT row_id, group_id, CAST(first_day AS VARCHAR) AS first_day,
  CASE WHEN group_id IS NOT NULL THEN min(CASE WHEN day = first_day THEN order_id END) OVER (PARTITION BY group_id) END AS first_order
FROM m""")
def window_min(spark, folder):
    rows = B.entries(spark, folder).select("row_id", "group_id", "day", "order_id")
    first = attach_group_values(rows, ["group_id"], [F.min(F.when(F.col("day").isNotNull(), F.struct("day", "order_id"))).alias("_first")])
    return first.select("row_id", "group_id", F.col("_first.day").cast("string").alias("first_day"),
                        F.col("_first.order_id").alias("first_order"))


@query("union_partials", """
SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS name FROM customer
UNION ALL SELECT s_suppkey, s_nationkey, NULL, s_name FROM supplier""")
def union_partials(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return stack([customers, suppliers])


@query("set_intersect_except", """
WITH k AS (SELECT CASE WHEN c_acctbal < 0 THEN c_nationkey ELSE c_nationkey + 100 END AS nation FROM customer
           INTERSECT SELECT CASE WHEN s_acctbal > 3000 THEN s_nationkey ELSE s_nationkey + 200 END FROM supplier EXCEPT SELECT 7)
SELECT c_custkey AS id, c_nationkey AS nation FROM customer WHERE c_nationkey IN (SELECT nation FROM k)""")
def set_intersect_except(spark, folder):
    # Nations that are to meet nothing are moved out of the way, so all rows take part.
    nation, home = F.col("c_nationkey"), F.col("s_nationkey")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), nation.alias("nation"),
                                                        F.when(F.col("c_acctbal") < 0, nation).otherwise(nation + 100).alias("moved"))
    suppliers = table(spark, folder, "supplier").select(F.when(F.col("s_acctbal") > 3000, home).otherwise(home + 200).alias("nation"))
    keys = common_keys(customers.select(F.col("moved").alias("nation")), suppliers, "nation", [7])
    return with_partner(customers, keys, ["nation"]).select("id", "nation")


@query("record_numbering", """
SELECT c_custkey AS id, c_name AS name, row_number() OVER (ORDER BY c_custkey) AS record_number,
       row_number() OVER (ORDER BY c_custkey) + 1 AS source_row FROM customer""")
def record_numbering(spark, folder):
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return number_records(rows, "id").withColumn("source_row", F.col("record_number") + 1)


@query("input_order_numbering", """
SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey % 5, md5(CAST(c_custkey AS VARCHAR))) AS record_number,
       row_number() OVER (ORDER BY c_custkey % 5, md5(CAST(c_custkey AS VARCHAR))) + 1 AS source_row FROM customer""")
def input_order_numbering(spark, folder):
    """Five files whose rows stand in an order that no key shows, numbered as they stand."""
    path = f"{shared_folder(spark)}/numbered-{uuid.uuid4().hex}"
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 5).cast("int").alias("file"))
    order = F.md5(F.col("id").cast("string"))
    rows.repartition(5, "file").sortWithinPartitions("file", order).write.partitionBy("file").parquet(path)
    numbered = number_in_input_order(spark.read.parquet(path))
    return numbered.select("id", "record_number", (F.col("record_number") + 1).alias("source_row"))


@query("multi_key_sort", f"""
WITH {B.TB_SQL} SELECT order_id, method, row_id, hours FROM tb ORDER BY order_id, method DESC NULLS LAST, row_id""")
def multi_key_sort(spark, folder):
    rows = B.base_entries(spark, folder).select("order_id", "method", "row_id", "hours")
    return sort_rows(rows, [("order_id", True), ("method", False), ("row_id", True)])


@query("main_process", f"""
WITH {B.TB_SQL}, {B.PROCESSES_SQL},
r AS (SELECT tb.*, process, CAST(rank AS INTEGER) AS process_rank FROM tb LEFT JOIN pd ON substr(op_text, 1, 5) = prefix5),
b AS (SELECT order_id, process AS parent_process, process_rank AS parent_rank,
        CASE WHEN process IS NOT NULL THEN op_text END AS main_operation,
        row_number() OVER (PARTITION BY order_id ORDER BY process_rank NULLS LAST, process NULLS LAST, row_id) AS place FROM r)
SELECT row_id, r.order_id, process, parent_process, parent_rank, main_operation
FROM r JOIN b ON r.order_id = b.order_id AND place = 1""")
def main_process(spark, folder):
    return classify.main_process(B.base_entries(spark, folder), B.processes(spark)).select(
        "row_id", "order_id", "process", "parent_process", "parent_rank", "main_operation")


@query("second_level_process", f"""
WITH {B.TE_SQL}, l AS (SELECT row_id, order_id,
  CASE WHEN centre = 'ACTIVIDADES SUPLEMENTARIAS' THEN centre WHEN centre IS NULL THEN NULL
       WHEN method IS DISTINCT FROM 'Estandar' THEN method WHEN parent_process = process THEN centre END AS label,
  CASE WHEN centre = 'ACTIVIDADES SUPLEMENTARIAS' THEN 1 WHEN centre IS NULL THEN 2
       WHEN method IS DISTINCT FROM 'Estandar' THEN 3 WHEN parent_process = process THEN 4 ELSE 5 END AS priority FROM te),
b AS (SELECT order_id, label AS second_level, row_number() OVER (PARTITION BY order_id ORDER BY priority, row_id) AS place
      FROM l WHERE label IS NOT NULL)
SELECT l.row_id, l.order_id, l.priority, second_level FROM l LEFT JOIN b ON l.order_id = b.order_id AND place = 1""")
def second_level_process(spark, folder):
    return classify.second_level(B.entries(spark, folder)).select(
        "row_id", "order_id", classify.second_level_priority().alias("priority"), "second_level")


@query("operation_class", f"""
WITH {B.TB_SQL}, {B.SPECIFICS_SQL},
c AS (SELECT row_id, specific_process, CASE WHEN order_id % 4 = 0 THEN NULL ELSE 'TERMOFORMADO' END AS parent,
  CASE WHEN centre IS NULL THEN 'OPERACION EXTERNA' WHEN centre = 'ACTIVIDADES SUPLEMENTARIAS' THEN centre
       WHEN substr(specific_process, 1, 12) = 'ALISTAMIENTO' THEN 'ALISTAMIENTO' ELSE 'OPERACION' END AS op_class
  FROM tb LEFT JOIN sp ON substr(op_text, 1, 12) = prefix12)
SELECT row_id, specific_process, op_class, coalesce(parent, op_class) AS parent_process FROM c""")
def operation_class(spark, folder):
    rows = B.base_entries(spark, folder).withColumn(
        "parent_process", F.expr("CASE WHEN order_id % 4 = 0 THEN NULL ELSE 'TERMOFORMADO' END"))
    return classify.operation_class(rows, B.specifics(spark)).select(
        "row_id", "specific_process", "op_class", "parent_process")


@query("downtime_enrich", f"""
WITH {B.DT_SQL}, {B.CLASSES_SQL},
r AS (SELECT right('000' || code, 3) AS code, downtime_group, rule, column_1, data_1,
  coalesce(data_2, '') AS data_2, right('00' || data_3, 2) AS data_3 FROM cl),
d AS (SELECT downtime_id, order_id, downtime, CAST(downtime_hours AS DOUBLE) AS downtime_hours,
  right('000' || split_part(downtime, '-', 1), 3) AS code FROM dt)
SELECT downtime_id, order_id, d.code, downtime, downtime_hours, downtime_group, rule, column_1, data_1,
  CASE WHEN r.code IS NULL THEN NULL ELSE data_2 END AS data_2, data_3 FROM d LEFT JOIN r ON d.code = r.code""")
def downtime_enrich(spark, folder):
    rules = masters.downtime_rules(B.downtime_classes(spark))
    return masters.downtime_records(B.downtime(spark, folder), rules).select(
        "downtime_id", "order_id", "code", "downtime", "downtime_hours", "downtime_group", "rule", "column_1", "data_1",
        F.array_join("data_2", "-").alias("data_2"), "data_3")


@query("fault_enrich", """
WITH f AS (SELECT event_id AS fault_id, CASE WHEN event_id % 6 = 5 THEN 'MTS LINEALES-' || event_type
    WHEN event_id % 6 = 4 THEN NULL ELSE 'F' || CAST(event_id % 6 AS VARCHAR) || '-' || event_type END AS fault,
  floor(value) AS fault_qty FROM events),
c AS (SELECT CASE WHEN n_nationkey <> 2 THEN 'F' ELSE 'X' END || CAST(n_nationkey AS VARCHAR) AS fault_code, n_name AS fault_class FROM nation)
SELECT fault_id, fault, fault_qty, split_part(fault, '-', 1) AS fault_code, fault_class
FROM f LEFT JOIN c ON split_part(fault, '-', 1) = c.fault_code WHERE split_part(fault, '-', 1) IS DISTINCT FROM 'MTS LINEALES'""")
def fault_enrich(spark, folder):
    faults = table(spark, folder, "events").selectExpr(
        "event_id AS fault_id",
        "CASE WHEN event_id % 6 = 5 THEN concat('MTS LINEALES-', event_type) WHEN event_id % 6 = 4 THEN NULL"
        " ELSE concat('F', CAST(event_id % 6 AS STRING), '-', event_type) END AS fault",
        "CAST(CAST(floor(value) AS BIGINT) AS STRING) AS fault_qty")
    classes = table(spark, folder, "nation").selectExpr(
        "concat(CASE WHEN n_nationkey <> 2 THEN 'F' ELSE 'X' END, CAST(n_nationkey AS STRING)) AS fault_code", "n_name AS fault", "n_name AS fault_class")
    return masters.fault_records(faults, classes)
