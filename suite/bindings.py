"""The driver tables in the roles of the costing data.

The expressions are plain SQL both engines read, so a role means the same on either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from suite.registry import table, values_sql

# A time entry is a line of an order.
ENTRY_BASE = [
    "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),"
    " CAST(l_suppkey AS STRING), CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS STRING)) AS row_id",
    "l_orderkey AS order_id",
    "concat('0', CAST(l_linenumber AS STRING)) AS op_code",
    "CASE l_suppkey % 10 WHEN 0 THEN 'MONTAJE Y DESMONTAJE DE MOLDE' WHEN 1 THEN 'PUESTA A PUNTO DE EQUIPO'"
    " WHEN 2 THEN 'CAMBIO CORTO DE REFERENCIA' WHEN 3 THEN 'CAMBIO ENTRE OPERACIONES'"
    " WHEN 4 THEN 'EXTRUSION DE LAMINA' WHEN 5 THEN 'EXTRUSION DE LAMINA' WHEN 6 THEN 'TERMOFORMADO DE VASO'"
    " WHEN 7 THEN 'TERMOFORMADO DE VASO' WHEN 8 THEN 'TROQUELADO DE TAPA' ELSE 'MOLIDO DE RETORNO' END AS op_text",
    "CASE WHEN l_suppkey % 17 = 0 THEN NULL WHEN l_suppkey % 13 = 0 THEN 'ACTIVIDADES SUPLEMENTARIAS'"
    " ELSE concat('CENTRO ', CAST(l_suppkey % 6 AS STRING)) END AS centre",
    "concat('0', CAST(l_suppkey % 6 AS STRING), '-', CAST(l_partkey % 4 AS STRING)) AS centre_code",
    "CASE WHEN l_tax = 0.03 THEN NULL WHEN l_returnflag = 'A' THEN 'Alterno' ELSE 'Estandar' END AS method",
    "concat('R', CAST(l_orderkey % 7 AS STRING)) AS reference",
    "CAST(l_shipdate AS DATE) AS day",
    "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING) AS period",
    "l_quantity AS hours",
    "CASE WHEN l_discount = 0.05 THEN NULL WHEN l_tax = 0.02 THEN CAST(-1 - l_partkey % 40 AS DOUBLE)"
    " ELSE CAST(1 + l_partkey % 40 AS DOUBLE) END AS base_hours",
    "abs(CASE WHEN l_discount = 0.05 THEN NULL ELSE CAST(1 + l_partkey % 40 AS DOUBLE) END) AS abs_base_hours",
    "CAST(floor(l_extendedprice / 10) AS DOUBLE) AS qty_done",
    "CASE WHEN l_tax = 0.04 THEN NULL WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS DOUBLE)"
    " ELSE CAST(0 AS DOUBLE) END AS qty_rejected",
    "CAST((1 + l_partkey % 9) * 10 AS DOUBLE) AS base_qty",
    "CAST(l_linenumber % 3 AS DOUBLE) AS qty_scrap",
]
ENTRY_CLASSIFIED = [
    "CASE l_suppkey % 10 WHEN 4 THEN 'EXTRUSION LAMINA' WHEN 5 THEN 'EXTRUSION LAMINA' WHEN 6 THEN 'TERMOFORMADO'"
    " WHEN 7 THEN 'TERMOFORMADO' WHEN 8 THEN 'TROQUELADO' WHEN 9 THEN 'MOLIDO' ELSE NULL END AS process",
    "CASE l_orderkey % 5 WHEN 0 THEN 'EXTRUSION LAMINA' WHEN 1 THEN 'TERMOFORMADO' WHEN 2 THEN 'TROQUELADO'"
    " WHEN 3 THEN 'MOLIDO' ELSE 'IMPRESION' END AS parent_process",
    "substr(CASE l_suppkey % 10 WHEN 0 THEN 'MONTAJE Y DESMONTAJE DE MOLDE' WHEN 1 THEN 'PUESTA A PUNTO DE EQUIPO'"
    " ELSE 'OTRA OPERACION' END, 1, 12) AS prefix12",
    "CASE l_suppkey % 10 WHEN 0 THEN 'ALISTAMIENTO' WHEN 1 THEN 'ALISTAMIENTO' WHEN 2 THEN 'ALISTAMIENTO CORTA DURACION'"
    " WHEN 3 THEN 'ALISTAMIENTO INTEROPERACIONAL' ELSE NULL END AS specific_process",
    "CASE WHEN l_orderkey % 9 = 0 THEN NULL"
    " ELSE concat('G', CAST(CAST(floor(l_orderkey / 4) AS BIGINT) AS STRING)) END AS group_id",
    "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE concat('M', CAST(l_orderkey % 2 AS STRING)) END AS mount_order",
    "CASE WHEN l_suppkey % 19 = 0 THEN NULL ELSE CAST(301000 + l_suppkey % 25 AS STRING) END AS cost_centre",
    "CASE WHEN l_discount = 0.02 THEN NULL ELSE CAST(floor(l_quantity * (l_partkey % 3) / 2) AS DOUBLE) END AS std_hours",
]
# The raw entries of the whole job: some without an order, some without a day.
JOB_ENTRY = [{"order_id": "CASE WHEN l_suppkey % 23 = 11 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS order_id",
              "day": "CASE WHEN l_partkey % 29 = 3 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS day"}.get(e.rsplit(" AS ", 1)[1], e)
             for e in ENTRY_BASE]
# An inventory movement belongs to the main operation of a line's order, up to two days around the line.
MOVEMENT = [
    "l_orderkey AS order_id",
    "concat('INV', CAST(l_linenumber AS STRING)) AS doc",
    "concat('R', CAST(l_orderkey % 7 AS STRING)) AS reference",
    "CAST(l_shipdate AS DATE) + CAST(l_partkey % 5 - 2 AS INT) AS day",
    "CASE l_orderkey % 5 WHEN 0 THEN 'EXTRUSION LAMINA' WHEN 1 THEN 'TERMOFORMADO' WHEN 2 THEN 'TROQUELADO'"
    " WHEN 3 THEN 'MOLIDO' ELSE 'IMPRESION' END AS parent_process",
    "CASE l_orderkey % 5 WHEN 0 THEN 'EXTRUSION DE LAMINA' WHEN 1 THEN 'TERMOFORMADO DE VASO'"
    " WHEN 2 THEN 'TROQUELADO DE TAPA' WHEN 3 THEN 'MOLIDO DE RETORNO'"
    " ELSE CASE WHEN l_orderkey % 2 = 0 THEN 'CAMBIO ENTRE OPERACIONES' ELSE NULL END END AS op_text",
    "CASE l_linenumber % 5 WHEN 0 THEN 'ENTREGA REAL EXTRUSION' WHEN 1 THEN 'ENTREGA REAL KG TERMO TROQ'"
    " WHEN 2 THEN 'NO CONFORME' WHEN 3 THEN 'RETAL' ELSE 'TORTA' END AS movement_class",
    "CASE WHEN l_linestatus = 'O' THEN 'ENTREGAS' ELSE 'CONSUMOS' END AS movement_type",
    "CASE l_suppkey % 4 WHEN 2 THEN 'MCC' WHEN 3 THEN 'MEP' ELSE 'MDC' END AS doc_type",
    "CASE WHEN l_tax = 0.01 THEN 'UND' ELSE 'KGS' END AS unit",
    "CASE WHEN l_tax = 0.07 THEN NULL ELSE CAST(floor(l_extendedprice / 100) AS DOUBLE) END AS kg",
    "CAST(l_quantity AS DOUBLE) AS kg_in",
    "CAST(l_partkey % 50 AS DOUBLE) AS kg_out",
]
# The same movements before they know the process and operation of their order.
JOB_MOVEMENT = ["CAST(l_orderkey AS STRING) AS order_id",
                *[e for e in MOVEMENT if e.rsplit(" AS ", 1)[1] not in ("order_id", "parent_process", "op_text")]]
LEDGER = [
    "o_orderkey AS ledger_id",
    "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING) AS period",
    "concat(CASE WHEN o_custkey % 2 = 0 THEN 'COSTO MOD' ELSE 'COSTO CIF FIJO' END, ' ',"
    " CASE WHEN o_orderstatus = 'F' THEN 'ESTANDAR' ELSE 'REAL' END) AS type_nature",
    "CASE WHEN o_orderpriority = '1-URGENT' AND o_custkey % 2 = 0 THEN 'COSTO MOD HORAS EXTRA' ELSE 'COSTO MOD' END AS labour_type",
    "CAST(301000 + (CASE WHEN o_orderstatus = 'F' THEN o_custkey % 25 ELSE o_custkey % 40 END) AS STRING) AS centre",
    "CASE WHEN o_custkey % 13 = 0 THEN NULL"
    " ELSE concat('CENTRO ', CAST((CASE WHEN o_orderstatus = 'F' THEN o_custkey % 25 ELSE o_custkey % 40 END) AS STRING)) END AS description",
    "CASE WHEN o_orderstatus = 'F' THEN -floor(o_totalprice / 100) ELSE floor(o_totalprice / 100) END * CAST(1 AS DOUBLE) AS balance",
]
DOWNTIME = [
    "event_id AS downtime_id",
    "CAST(floor(event_id / 3) AS BIGINT) AS order_id",
    "concat(CAST(event_id % 9 AS STRING), '-PARO ', event_type) AS downtime",
    "CAST(CAST(floor(value) AS BIGINT) AS STRING) AS downtime_hours",
]

PROCESSES = [("EXTRU", "EXTRUSION LAMINA", "2"), ("TERMO", "TERMOFORMADO", "9"), ("TROQU", "TROQUELADO", "10"),
             ("MOLID", "MOLIDO", "11")]
SPECIFICS = [("MONTAJE Y DE", "ALISTAMIENTO"), ("PUESTA A PUN", "ALISTAMIENTO"),
             ("CAMBIO CORTO", "ALISTAMIENTO CORTA DURACION"), ("CAMBIO ENTRE", "ALISTAMIENTO INTEROPERACIONAL"),
             ("TROQUELADO D", "TROQUELADO PLANO")]
ALLOCATION_RULES = [("301030", "301001", "INCLUIDA"), ("301030", "301002", "INCLUIDA"), ("301031", "301003", "EXCLUIDA"),
                    ("301021", "301005", "INCLUIDA"), ("301021", "301006", "EXCLUIDA"), ("301032", "301099", "INCLUIDA")]
# code, dropped text, group, rule, column_1, data_1, column_2, data_2, column_3, data_3
DOWNTIME_CLASSES = [
    ("1", "a", "MECANICO", "INCLUIDOS", "parent_process", "EXTRUSION LAMINA", "centre2", "00-01-02", None, None),
    ("2", "b", "ELECTRICO", "EXCLUIDOS", "parent_process", "TERMOFORMADO", "centre2", "03-04", None, None),
    ("3", "c", "OPERATIVO", "TODOS", "parent_process", "MOLIDO", None, None, None, None),
    ("4", "d", "MATERIAL", "INCLUIDOS", "parent_process", "TROQUELADO", "centre2", "05", "centre2", "1"),
    ("5", "e", "OTROS", "EXCLUIDOS", "method", "Alterno", "parent_process", "IMPRESION", "centre2", "2"),
    ("6", "f", "TURNO", "TODOS", "method", "Estandar", None, None, None, None),
    ("7", "g", "SIN LISTA", "INCLUIDOS", "parent_process", "IMPRESION", "centre2", None, None, None),
]
CLASS_COLUMNS = "code, downtime, downtime_group, rule, column_1, data_1, column_2, data_2, column_3, data_3"
RULE_NAMES = ["parent_process", "centre2", "method"]


def _rows(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A code table as literal rows: Spark knows their size, so it sends them to the tasks and shuffles no entries for them."""
    names = [c.strip() for c in columns.split(",")]
    return spark.sql(f"WITH {values_sql('given', columns, rows)} SELECT {', '.join(f'CAST({c} AS STRING) AS {c}' for c in names)} FROM given")


def base_entries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*ENTRY_BASE)


def entries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*ENTRY_BASE, *ENTRY_CLASSIFIED)


def rule_entries(spark: SparkSession, folder: str) -> DataFrame:
    return entries(spark, folder).selectExpr("*", "substr(centre_code, 1, 2) AS centre2")


def job_entries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*JOB_ENTRY)


def job_movements(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*JOB_MOVEMENT)


def movements(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*MOVEMENT)


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(*LEDGER)


def downtime(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*DOWNTIME)


def processes(spark: SparkSession) -> DataFrame:
    return _rows(spark, "prefix5, process, rank", PROCESSES)


def specifics(spark: SparkSession) -> DataFrame:
    return _rows(spark, "prefix12, specific_process", SPECIFICS)


def allocation_rules(spark: SparkSession) -> DataFrame:
    return _rows(spark, "original_centre, target_centre, rule", ALLOCATION_RULES)


def downtime_classes(spark: SparkSession) -> DataFrame:
    return _rows(spark, CLASS_COLUMNS, DOWNTIME_CLASSES)


def select_sql(name: str, columns: list[str], source: str) -> str:
    return f"{name} AS (SELECT {', '.join(columns)} FROM {source})"


TB_SQL = select_sql("tb", ENTRY_BASE, "lineitem")
TE_SQL = select_sql("te", [*ENTRY_BASE, *ENTRY_CLASSIFIED], "lineitem")
JB_SQL = select_sql("tb", JOB_ENTRY, "lineitem")
JM_SQL = select_sql("mv0", JOB_MOVEMENT, "lineitem")
MV_SQL = select_sql("mv", MOVEMENT, "lineitem")
LG_SQL = select_sql("lg", LEDGER, "orders")
DT_SQL = select_sql("dt", DOWNTIME, "events")
PROCESSES_SQL = values_sql("pd", "prefix5, process, rank", PROCESSES)
SPECIFICS_SQL = values_sql("sp", "prefix12, specific_process", SPECIFICS)
ALLOCATION_SQL = values_sql("ar", "original_centre, target_centre, rule", ALLOCATION_RULES)
CLASSES_SQL = values_sql("cl", CLASS_COLUMNS, DOWNTIME_CLASSES)
