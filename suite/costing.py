"""Production costing queries."""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import functions as F

from suite import bindings as B
from suite.registry import half_up_sql as H
from suite.registry import query
from suite.relational import CORRECTIONS
from tallyworks.functions.numbers import half_up
from tallyworks.functions.nullsafe import with_keys
from tallyworks.operators.joins import append_rows
from tallyworks.operators.joins import lookup
from tallyworks.operators.sets import stack
from tallyworks.plans.costing import distribute as D
from tallyworks.plans.costing import downtime as T
from tallyworks.plans.costing import fact, job, masters, movements, quantities, rates
from tallyworks.plans.costing import standard_hours as S
from tallyworks.plans.costing.movements import GROUP_KEYS
from tallyworks.sources.staging import staged

KEYS = ", ".join(GROUP_KEYS)
COMPLETE = " AND ".join(f"{k} IS NOT NULL" for k in GROUP_KEYS)
KEY_TEXT = "order_id, reference, CAST(day AS VARCHAR) AS day, parent_process, op_text"


def _key_text():
    return ["order_id", "reference", F.col("day").cast("string").alias("day"), "parent_process", "op_text"]


# Movements

CONDITIONS = {
    "used_extrusion": ("parent_process = 'EXTRUSION LAMINA' AND movement_class = 'ENTREGA REAL EXTRUSION' AND unit = 'KGS'", "-kg"),
    "used_recycled": ("parent_process IN ('DESCONTAMINACION', 'MOLIDO') AND movement_type = 'ENTREGAS'", "kg"),
    "used_other": ("parent_process NOT IN ('DESCONTAMINACION', 'MOLIDO') AND movement_class = 'ENTREGA REAL KG TERMO TROQ'"
                   " AND doc_type IN ('MDC', 'MCC') AND unit = 'KGS'", "-kg"),
    "scrap_shaped": ("parent_process IN ('TERMOFORMADO', 'TROQUELADO') AND movement_class IN ('NO CONFORME', 'RETAL')"
                     " AND doc_type = 'MDC'", "kg"),
    "scrap_other": ("parent_process NOT IN ('TERMOFORMADO', 'TROQUELADO', 'DESCONTAMINACION', 'MOLIDO')"
                    " AND movement_class = 'RETAL' AND doc_type = 'MDC'", "kg"),
    "cake": ("parent_process = 'EXTRUSION LAMINA' AND movement_class = 'TORTA' AND doc_type IN ('MDC', 'MCC', 'MEP')", "kg"),
    "nc_shaped": ("parent_process IN ('TERMOFORMADO', 'TROQUELADO') AND movement_class IN ('NO CONFORME', 'RETAL')"
                  " AND doc_type = 'MDC'", "kg"),
    "nc_other": ("parent_process NOT IN ('TERMOFORMADO', 'TROQUELADO', 'DESCONTAMINACION', 'MOLIDO')"
                 " AND movement_class = 'NO CONFORME' AND doc_type = 'MDC'", "kg"),
}
SEGMENT_CTES = ", ".join(
    f"s_{n} AS (SELECT {KEYS}, coalesce(sum({v}), 0) AS {n} FROM mv WHERE {c} AND {COMPLETE} GROUP BY ALL)"
    for n, (c, v) in CONDITIONS.items())


def _outer(names: list[str]) -> str:
    return f"s_{names[0]}" + "".join(f" FULL JOIN s_{n} USING ({KEYS})" for n in names[1:])


def _min_count(*names: str) -> str:
    return f"CASE WHEN coalesce({', '.join(names)}) IS NOT NULL THEN {' + '.join(f'coalesce({n}, 0)' for n in names)} END"


MEASURE_CTES = f"""{B.MV_SQL}, {SEGMENT_CTES},
used AS (SELECT {KEYS}, {_min_count('used_extrusion', 'used_recycled', 'used_other')} AS kg_used
         FROM {_outer(['used_extrusion', 'used_recycled', 'used_other'])}),
scrap AS (SELECT {KEYS}, {_min_count('scrap_shaped', 'scrap_other')} AS kg_scrap FROM {_outer(['scrap_shaped', 'scrap_other'])}),
nc AS (SELECT {KEYS}, {_min_count('nc_shaped', 'nc_other')} AS kg_nc FROM {_outer(['nc_shaped', 'nc_other'])})"""
QUANTITY_NAMES = ["scrap_shaped", "scrap_other", "used_extrusion", "used_recycled", "used_other", "cake"]


def _segments(spark, folder, names=None):
    return movements.segment_sums(B.movements(spark, folder), names=names)


def _measures(spark, folder):
    return movements.movement_measures(_segments(spark, folder))


@query("movement_segments", f"""
WITH {B.MV_SQL}, {SEGMENT_CTES} SELECT {KEY_TEXT}, {', '.join(CONDITIONS)} FROM {_outer(list(CONDITIONS))}""")
def movement_segments(spark, folder):
    return _segments(spark, folder).select(*_key_text(), *CONDITIONS)


@query("outer_merge_segments", f"""
WITH {MEASURE_CTES} SELECT {KEY_TEXT}, kg_used, kg_scrap, kg_nc
FROM used FULL JOIN scrap USING ({KEYS}) FULL JOIN nc USING ({KEYS})""")
def outer_merge_segments(spark, folder):
    return (_measures(spark, folder).filter(F.coalesce("kg_used", "kg_scrap", "kg_nc").isNotNull())
            .select(*_key_text(), "kg_used", "kg_scrap", "kg_nc"))


TOTALS_CTE = """
done AS (SELECT order_id, parent_process, coalesce(sum(qty_done), 0) AS order_done FROM te
  WHERE (specific_process NOT IN ('ALISTAMIENTO CORTA DURACION', 'ALISTAMIENTO INTEROPERACIONAL', 'ALISTAMIENTO')
         OR specific_process IS NULL) AND process = parent_process GROUP BY ALL),
rejected AS (SELECT order_id, parent_process, coalesce(sum(qty_rejected), 0) AS order_rejected FROM te
  WHERE parent_process IS NOT NULL GROUP BY ALL),
order_used AS (SELECT order_id, parent_process, sum(kg_used) AS order_kg_used FROM used GROUP BY ALL),
order_nc AS (SELECT order_id, parent_process, sum(kg_nc) AS order_kg_nc FROM nc GROUP BY ALL),
tot AS (SELECT order_id, parent_process, order_done, order_rejected, order_kg_used, order_kg_nc FROM done
  FULL JOIN rejected USING (order_id, parent_process) FULL JOIN order_used USING (order_id, parent_process)
  FULL JOIN order_nc USING (order_id, parent_process))"""


@query("order_totals", f"WITH {B.TE_SQL}, {MEASURE_CTES}, {TOTALS_CTE} SELECT * FROM tot")
def order_totals(spark, folder):
    return movements.order_totals(B.entries(spark, folder), _measures(spark, folder))


# Matching by day

@query("unmatched_movements", f"""
WITH {B.TE_SQL}, {B.MV_SQL}, k AS (SELECT DISTINCT {KEYS} FROM mv WHERE {COMPLETE})
SELECT {KEY_TEXT} FROM k WHERE NOT EXISTS (SELECT 1 FROM te WHERE {' AND '.join(f'te.{c} = k.{c}' for c in GROUP_KEYS)})""")
def unmatched_movements(spark, folder):
    keys = with_keys(B.movements(spark, folder), GROUP_KEYS).select(*GROUP_KEYS).distinct()
    return D.unmatched_movements(keys, B.entries(spark, folder)).select(*_key_text())


def _nearest_cte(source: str, mark: str, by_rejects: bool, extra: str = "") -> str:
    """Copies of the entries of the nearest day, by comparing every entry of the place."""
    days = "date_diff('day', m.day, te.day)"
    weighed = f"CASE WHEN qty_rejected >= 0 THEN {days} ELSE {days} * 1000 END" if by_rejects else days
    on = " AND ".join(f"te.{k} = m.{k}" for k in D.PLACE_KEYS)
    missing = " AND ".join(f"x.{k} = m.{k}" for k in GROUP_KEYS)
    keep = ", ".join(f"m.{k}" for k in GROUP_KEYS)
    return f"""near0 AS (SELECT {keep}{extra}, row_id || '_{mark}_' || strftime(m.day, '%Y%m%d') AS row_id, te.day AS entry_day,
    hours, qty_rejected, {weighed} AS d FROM {source} m JOIN te ON {on}
  WHERE NOT EXISTS (SELECT 1 FROM te x WHERE {missing})),
near1 AS (SELECT *, CASE WHEN d < 0 THEN -d ELSE d * 100 END AS cost FROM near0),
near AS (SELECT * FROM near1 QUALIFY cost = min(cost) OVER (PARTITION BY {KEYS}))"""


@query("nearest_date_match", f"""
WITH {B.TE_SQL}, {B.MV_SQL}, k AS (SELECT DISTINCT {KEYS} FROM mv WHERE {COMPLETE}), {_nearest_cte('k', '1', True)}
SELECT row_id, order_id, CAST(day AS VARCHAR) AS day, CAST(entry_day AS VARCHAR) AS entry_day, hours, qty_rejected FROM near""")
def nearest_date_match(spark, folder):
    keys = with_keys(B.movements(spark, folder), GROUP_KEYS).select(*GROUP_KEYS).distinct()
    return D.nearest_entries(keys, B.entries(spark, folder), "1", True).select(
        "row_id", "order_id", F.col("day").cast("string").alias("day"),
        F.col("entry_day").cast("string").alias("entry_day"), "hours", "qty_rejected")


PARTS_CTE = f"""qty AS (SELECT {KEYS}, {', '.join(QUANTITY_NAMES)} FROM {_outer(QUANTITY_NAMES)}),
{_nearest_cte('qty', '0', False)},
both0 AS (SELECT row_id, {KEYS}, entry_day, hours FROM near UNION ALL
  SELECT row_id, {KEYS}, NULL, hours FROM te JOIN (SELECT {KEYS} FROM qty) USING ({KEYS})),
parts AS (SELECT both0.*, {', '.join(QUANTITY_NAMES)}, hours / nullif(sum(hours) OVER (PARTITION BY order_id, day), 0) AS share
  FROM both0 JOIN qty USING ({KEYS}))"""


@query("distribute_segments", f"""
WITH {B.TE_SQL}, {B.MV_SQL}, {SEGMENT_CTES}, {PARTS_CTE}
SELECT row_id, order_id, CAST(day AS VARCHAR) AS day, CAST(entry_day AS VARCHAR) AS entry_day, hours,
       {', '.join(f"{H(f'share * {n}')} AS part_{n}" for n in QUANTITY_NAMES)} FROM parts""")
def distribute_segments(spark, folder):
    moved = _segments(spark, folder, QUANTITY_NAMES)
    return D.distribute_segments(moved, B.entries(spark, folder)).select(
        "row_id", "order_id", F.col("day").cast("string").alias("day"),
        F.col("entry_day").cast("string").alias("entry_day"), "hours",
        *[half_up(F.col(f"part_{n}"), 6).alias(f"part_{n}") for n in QUANTITY_NAMES])


@query("append_synthetic_rows", f"""
WITH {B.TE_SQL}, {B.MV_SQL}, {SEGMENT_CTES}, {PARTS_CTE},
c AS (SELECT row_id, day, order_id, parent_process, share * scrap_shaped AS a, share * scrap_other AS b FROM parts)
SELECT coalesce(te.row_id, c.row_id) AS row_id, CAST(coalesce(te.day, c.day) AS VARCHAR) AS day,
  coalesce(te.order_id, c.order_id) AS order_id, coalesce(te.parent_process, c.parent_process) AS parent_process,
  te.hours, {H('CASE WHEN coalesce(a, b) IS NOT NULL THEN coalesce(a, 0) + coalesce(b, 0) END')} AS kg_scrap
FROM te FULL JOIN c ON te.row_id = c.row_id AND te.day = c.day""")
def append_synthetic_rows(spark, folder):
    rows = B.entries(spark, folder)
    parts = D.distribute_segments(_segments(spark, folder, QUANTITY_NAMES), rows)
    computed = parts.select("row_id", "day", "order_id", "parent_process", "part_scrap_shaped", "part_scrap_other")
    facts = rows.select("row_id", "day", "order_id", "parent_process", "hours")
    a, b = F.col("part_scrap_shaped"), F.col("part_scrap_other")
    scrap = F.when(F.coalesce(a, b).isNotNull(), F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)))
    return append_rows(facts, computed, ["row_id", "day"]).select(
        "row_id", F.col("day").cast("string").alias("day"), "order_id", "parent_process", "hours",
        half_up(scrap, 6).alias("kg_scrap"))


NC_CTE = f"""{_nearest_cte('nc', '1', True)},
own AS (SELECT te.row_id, {', '.join(f'te.{k}' for k in GROUP_KEYS)}, NULL::DATE AS entry_day, hours, qty_rejected,
    CASE WHEN nc.order_id IS NOT NULL THEN hours / nullif(sum(hours) OVER (PARTITION BY {', '.join(f'te.{k}' for k in GROUP_KEYS)}), 0) END AS factor
  FROM te LEFT JOIN nc ON {' AND '.join(f'te.{k} = nc.{k}' for k in GROUP_KEYS)}),
cop AS (SELECT row_id, {KEYS}, entry_day, hours, qty_rejected,
    hours / nullif(sum(hours) OVER (PARTITION BY order_id, day, parent_process, op_text), 0) AS factor FROM near),
al AS (SELECT * FROM own UNION ALL SELECT * FROM cop),
dr AS (SELECT *, coalesce(sum(qty_rejected) OVER (PARTITION BY order_id, day), 0) AS day_rejected FROM al),
wk AS (SELECT row_id, order_id, day, parent_process, reference, op_text, entry_day, hours, factor, day_rejected,
    coalesce(qty_rejected, 0) AS qty_rejected, coalesce(kg_nc, 0) AS kg_nc
  FROM dr FULL JOIN (SELECT order_id, day, parent_process, reference, kg_nc FROM nc) USING (order_id, day, parent_process, reference)),
z AS (SELECT wk.*, coalesce(order_done, 0) AS order_done, coalesce(order_rejected, 0) AS order_rejected,
    coalesce(order_kg_used, 0) AS order_kg_used, coalesce(order_kg_nc, 0) AS order_kg_nc
  FROM wk LEFT JOIN tot USING (order_id, parent_process))"""
SHAPED = "coalesce(parent_process IN ('TERMOFORMADO', 'TROQUELADO'), false)"
UNIT_LOSS = "(order_kg_used - order_kg_nc) / nullif(order_done, 0)"


@query("nonconforming_kg", f"""
WITH {B.TE_SQL}, {MEASURE_CTES}, {TOTALS_CTE}, {NC_CTE}
SELECT row_id, order_id, CAST(day AS VARCHAR) AS day, CAST(entry_day AS VARCHAR) AS entry_day, kg_nc, qty_rejected, day_rejected,
  {H('factor')} AS factor,
  {H(f'''CASE WHEN {SHAPED} THEN CASE WHEN order_done > 0 THEN {UNIT_LOSS} * qty_rejected ELSE 0 END
       WHEN kg_nc > 0 AND day_rejected = 0 THEN kg_nc * factor
       WHEN kg_nc > 0 AND day_rejected > 0 THEN qty_rejected / nullif(day_rejected, 0) * kg_nc END''')} AS nc_kg FROM z""")
def nonconforming_kg(spark, folder):
    return _nonconforming(spark, folder).select(
        "row_id", "order_id", F.col("day").cast("string").alias("day"), F.col("entry_day").cast("string").alias("entry_day"),
        "kg_nc", "qty_rejected", "day_rejected", half_up(F.col("factor"), 6).alias("factor"),
        half_up(F.col("nc_kg"), 6).alias("nc_kg"))


def _nonconforming(spark, folder):
    rows, measures = B.entries(spark, folder), staged(_measures(spark, folder), "measures")
    return D.distribute_nonconforming(movements.nonconforming(measures), rows, movements.order_totals(rows, measures))


@query("fault_factor", f"""
WITH {B.TE_SQL}, {MEASURE_CTES}, {TOTALS_CTE}, {NC_CTE}
SELECT row_id, order_id, CAST(day AS VARCHAR) AS day, order_done, order_rejected, order_kg_used, order_kg_nc,
  {H(f'''CASE WHEN {SHAPED} THEN CASE WHEN order_done > 0 AND order_rejected > 0
           THEN {UNIT_LOSS} * (qty_rejected / nullif(order_rejected, 0)) ELSE 0 END
       WHEN kg_nc > 0 AND day_rejected = 0 THEN 1
       WHEN kg_nc > 0 AND day_rejected > 0 THEN qty_rejected / nullif(day_rejected, 0) END''')} AS fault_factor FROM z""")
def fault_factor(spark, folder):
    return _nonconforming(spark, folder).select(
        "row_id", "order_id", F.col("day").cast("string").alias("day"), "order_done", "order_rejected", "order_kg_used",
        "order_kg_nc", half_up(F.col("fault_factor"), 6).alias("fault_factor"))


# Standard hours

NOT_SET_UP = ("(specific_process NOT IN ('ALISTAMIENTO CORTA DURACION', 'ALISTAMIENTO INTEROPERACIONAL', 'ALISTAMIENTO')"
              " OR specific_process IS NULL)")
OPERATION_CTE = f"""op AS (SELECT * FROM te WHERE {NOT_SET_UP}),
unit AS (SELECT order_id, period, op_text, avg(base_hours) / nullif(avg(base_qty), 0) AS unit_time FROM op GROUP BY ALL),
rej AS (SELECT order_id, period, coalesce(sum(qty_rejected), 0) AS rejected FROM te GROUP BY ALL),
scr AS (SELECT order_id, period, coalesce(sum(qty_scrap), 0) AS scrap FROM te WHERE parent_process = 'EXTRUSION LAMINA' GROUP BY ALL),
dn AS (SELECT order_id, period, coalesce(sum(qty_done), 0) AS done FROM op WHERE process = parent_process GROUP BY ALL),
opg AS (SELECT op.*, done - rejected - coalesce(scrap, 0) AS good_qty, unit_time FROM op
  LEFT JOIN rej USING (order_id, period) LEFT JOIN scr USING (order_id, period) LEFT JOIN dn USING (order_id, period)
  LEFT JOIN unit USING (order_id, period, op_text)),
h_op AS (SELECT row_id, hours / nullif(sum(hours) OVER (PARTITION BY order_id, period, op_text), 0) * (unit_time * good_qty) AS std_hours,
  order_id, period, good_qty FROM opg)"""
MOUNTING_CTE = """mt AS (SELECT *, CASE WHEN group_id IS NOT NULL THEN min(day) OVER (PARTITION BY group_id) END AS first_day,
    sum(hours) OVER (PARTITION BY group_id) AS group_hours FROM te WHERE prefix12 = 'MONTAJE Y DE'),
md AS (SELECT group_id, order_id, mount_order, day, sum(hours) AS real_hours, min(first_day) AS first_day, avg(abs_base_hours) AS base
  FROM mt WHERE group_id IS NOT NULL AND order_id IS NOT NULL AND mount_order IS NOT NULL GROUP BY group_id, order_id, mount_order, day),
mo AS (SELECT *, date_diff('day', first_day, day) AS age,
    min(CASE WHEN day = first_day THEN order_id END) OVER (PARTITION BY group_id) AS first_order FROM md),
me AS (SELECT *, CASE WHEN order_id = first_order AND age = 0 THEN base
    WHEN age > 2 AND real_hours > base * 0.9::DOUBLE THEN base END AS earned FROM mo),
mr AS (SELECT group_id, sum(earned) AS earned_hours, count(order_id) AS mountings FROM me WHERE earned > 0 GROUP BY group_id),
h_mt AS (SELECT row_id, CASE WHEN group_id IS NOT NULL THEN earned_hours * (hours / nullif(group_hours, 0)) END AS std_hours,
  mt.group_id, earned_hours, mountings FROM mt LEFT JOIN mr USING (group_id))"""
TUNING_CTE = """tu AS (SELECT *, sum(hours) OVER (PARTITION BY group_id) AS group_hours,
    avg(abs_base_hours) OVER (PARTITION BY group_id) AS base FROM te WHERE prefix12 = 'PUESTA A PUN'),
h_tu AS (SELECT row_id, CASE WHEN tu.group_id IS NOT NULL THEN base * mountings * (hours / nullif(group_hours, 0)) END AS std_hours,
  group_id FROM tu LEFT JOIN mr USING (group_id))"""
CHANGE_CTE = """cd AS (SELECT *, CASE WHEN group_id IS NOT NULL THEN avg(abs_base_hours) OVER (PARTITION BY group_id, op_text) END AS base_mean,
    CASE WHEN group_id IS NOT NULL THEN sum(hours) OVER (PARTITION BY group_id, op_text) END AS total_hours
  FROM te WHERE specific_process = 'ALISTAMIENTO CORTA DURACION'),
h_cd AS (SELECT row_id, base_mean * (hours / nullif(total_hours, 0)) AS std_hours FROM cd WHERE total_hours >= base_mean * 0.5::DOUBLE),
gq AS (SELECT order_id, period, avg(good_qty) AS good FROM h_op GROUP BY ALL),
io AS (SELECT *, CASE WHEN group_id IS NOT NULL THEN avg(abs_base_hours) OVER (PARTITION BY group_id, op_text) END AS base_mean,
    CASE WHEN group_id IS NOT NULL THEN avg(base_qty) OVER (PARTITION BY group_id, op_text) END AS qty_mean,
    sum(hours) OVER (PARTITION BY order_id, period, op_text) AS total_hours
  FROM te WHERE specific_process = 'ALISTAMIENTO INTEROPERACIONAL'),
h_io AS (SELECT row_id, base_mean * good / nullif(qty_mean, 0) * (hours / nullif(total_hours, 0)) AS std_hours
  FROM io LEFT JOIN gq USING (order_id, period))"""


def _hours(df, *names):
    return df.select("row_id", *names, half_up(F.col("std_hours"), 6).alias("std_hours"))


@query("std_hours_operation", f"WITH {B.TE_SQL}, {OPERATION_CTE} SELECT row_id, {H('std_hours')} AS std_hours FROM h_op")
def std_hours_operation(spark, folder):
    return _hours(S.operation_hours(B.entries(spark, folder)))


@query("std_hours_mounting", f"""
WITH {B.TE_SQL}, {MOUNTING_CTE} SELECT row_id, group_id, earned_hours, mountings, {H('std_hours')} AS std_hours FROM h_mt""")
def std_hours_mounting(spark, folder):
    return _hours(S.mounting_hours(B.entries(spark, folder)), "group_id", "earned_hours", "mountings")


@query("std_hours_setup", f"""
WITH {B.TE_SQL}, {MOUNTING_CTE}, {TUNING_CTE} SELECT row_id, group_id, {H('std_hours')} AS std_hours FROM h_tu""")
def std_hours_setup(spark, folder):
    return _hours(S.tuning_hours(B.entries(spark, folder)), "group_id")


@query("std_hours_changeover", f"""
WITH {B.TE_SQL}, {OPERATION_CTE}, {CHANGE_CTE}
SELECT row_id, 'short' AS rule, {H('std_hours')} AS std_hours FROM h_cd
UNION ALL SELECT row_id, 'inter', {H('std_hours')} FROM h_io""")
def std_hours_changeover(spark, folder):
    rows = B.entries(spark, folder)
    return stack([_hours(S.short_set_up_hours(rows)).withColumn("rule", F.lit("short")),
                  _hours(S.inter_operation_hours(rows)).withColumn("rule", F.lit("inter"))])


@query("std_hours_union", f"""
WITH {B.TE_SQL}, {OPERATION_CTE}, {MOUNTING_CTE}, {TUNING_CTE}, {CHANGE_CTE},
u AS (SELECT row_id, std_hours FROM h_mt UNION SELECT row_id, std_hours FROM h_tu UNION SELECT row_id, std_hours FROM h_cd
      UNION SELECT row_id, std_hours FROM h_io UNION SELECT row_id, std_hours FROM h_op)
SELECT te.row_id, te.order_id, {H('u.std_hours')} AS std_hours FROM te LEFT JOIN u ON te.row_id = u.row_id""")
def std_hours_union(spark, folder):
    rows = B.entries(spark, folder)
    return _hours(S.entries_with_standard_hours(rows, ["order_id"]), "order_id")


# Costs and rates

ALLOCATION_CTE = f"""{B.LG_SQL}, {B.ALLOCATION_SQL},
ls AS (SELECT ledger_id, period, centre, description, regexp_extract(type_nature, '(\\S+)$', 1) AS nature,
    regexp_replace(type_nature, '\\s+\\S+$', '') AS cost_type, labour_type = 'COSTO MOD HORAS EXTRA' AS overtime, balance FROM lg),
so AS (SELECT ledger_id, period, cost_type, centre, description, nature, overtime, -balance AS balance FROM ls WHERE nature = 'ESTANDAR'),
tg AS (SELECT period, cost_type, centre, description, sum(balance) AS base FROM so WHERE centre <> '301021' GROUP BY ALL),
re AS (SELECT * FROM ls WHERE nature = 'REAL'),
kp AS (SELECT * FROM re WHERE EXISTS (SELECT 1 FROM tg WHERE tg.period = re.period AND tg.cost_type = re.cost_type AND tg.centre = re.centre)),
sp AS (SELECT * FROM re WHERE NOT EXISTS (SELECT 1 FROM tg WHERE tg.period = re.period AND tg.cost_type = re.cost_type AND tg.centre = re.centre)),
pr AS (SELECT sp.ledger_id, sp.period, sp.cost_type, tg.centre, tg.description, sp.balance AS original_balance, sp.centre AS original_centre,
    sp.description AS original_description, tg.base, sum(tg.base) OVER (PARTITION BY sp.ledger_id) AS base_total
  FROM sp JOIN tg ON sp.period = tg.period AND sp.cost_type = tg.cost_type
  WHERE CASE WHEN EXISTS (SELECT 1 FROM ar WHERE ar.original_centre = sp.centre AND rule = 'INCLUIDA')
     THEN EXISTS (SELECT 1 FROM ar WHERE ar.original_centre = sp.centre AND rule = 'INCLUIDA' AND target_centre = tg.centre)
     ELSE NOT EXISTS (SELECT 1 FROM ar WHERE ar.original_centre = sp.centre AND rule = 'EXCLUIDA' AND target_centre = tg.centre) END),
ca AS (SELECT ledger_id, period, cost_type, centre, description, balance, nature, CASE WHEN overtime THEN 'COSTO MOD HORAS EXTRA REAL'
      ELSE cost_type || ' ' || nature END AS cost_label, NULL::DOUBLE AS share, NULL::DOUBLE AS original_balance,
      NULL AS original_centre, NULL AS original_description, NULL::DOUBLE AS base, NULL::DOUBLE AS base_total FROM (SELECT * FROM so UNION ALL BY NAME SELECT * FROM kp)
  UNION ALL SELECT ledger_id, period, cost_type, centre, description, base / nullif(base_total, 0) * original_balance, 'REAL', cost_type || ' REAL',
    base / nullif(base_total, 0), original_balance, original_centre, original_description, base, base_total FROM pr)"""


@query("cost_allocation", f"""
WITH {ALLOCATION_CTE} SELECT ledger_id, period, cost_type, centre, description, nature, cost_label, {H('balance')} AS balance, {H('share')} AS share,
  original_balance, original_centre, original_description, base, base_total FROM ca""")
def cost_allocation(spark, folder):
    return _costs(spark, folder).select(
        "ledger_id", "period", "cost_type", "centre", "description", "nature", "cost_label", half_up(F.col("balance"), 6).alias("balance"),
        half_up(F.col("share"), 6).alias("share"), "original_balance", "original_centre", "original_description", "base", "base_total")


def _costs(spark, folder):
    return rates.allocate_costs(B.ledger(spark, folder), B.allocation_rules(spark))


RATES_CTE = f"""{ALLOCATION_CTE},
hp AS (SELECT period, cost_centre, sum(hours) AS hours FROM te WHERE cost_centre IS NOT NULL GROUP BY ALL HAVING sum(hours) <> 0),
rt AS (SELECT ca.period, ca.centre AS cost_centre, cost_label, nature, sum(balance) AS cost, any_value(hp.hours) AS hours,
    sum(balance) / any_value(hp.hours) AS rate
  FROM ca JOIN hp ON ca.period = hp.period AND ca.centre = hp.cost_centre GROUP BY ca.period, ca.centre, cost_label, nature)"""


def _rates(spark, folder):
    return rates.hourly_rates(_costs(spark, folder), rates.hours_by_period_centre(B.entries(spark, folder)))


@query("hourly_rates", f"""
WITH {B.TE_SQL}, {RATES_CTE}
SELECT period, cost_centre, cost_label, nature, {H('cost', 4)} AS cost, hours, {H('rate', 4)} AS rate FROM rt""")
def hourly_rates(spark, folder):
    return _rates(spark, folder).select("period", "cost_centre", "cost_label", "nature", half_up(F.col("cost"), 4).alias("cost"),
                                        "hours", half_up(F.col("rate"), 4).alias("rate"))


REAL_LABELS = ["COSTO CIF FIJO REAL", "COSTO MOD HORAS EXTRA REAL", "COSTO MOD REAL"]
STANDARD_LABELS = ["COSTO CIF FIJO ESTANDAR", "COSTO MOD ESTANDAR"]
PIVOT_SQL = ", ".join(f"sum(CASE WHEN cost_label = '{c}' THEN rate END) AS \"{c}\"" for c in sorted([*REAL_LABELS, *STANDARD_LABELS]))


@query("rate_pivot", f"""
WITH {B.TE_SQL}, {RATES_CTE}, p AS (SELECT period, cost_centre, {PIVOT_SQL} FROM rt GROUP BY ALL)
SELECT period, cost_centre, {', '.join(f'{H(chr(34) + c + chr(34), 4)} AS "{c}"' for c in [*REAL_LABELS, *STANDARD_LABELS])} FROM p""")
def rate_pivot(spark, folder):
    found = _rates(spark, folder)
    labels = rates.cost_labels(B.ledger(spark, folder).transform(_ledger_labels))
    wide = rates.pivot_rates(found, labels)
    return wide.select("period", "cost_centre", *[half_up(F.col(f"`{c}`"), 4).alias(c) for c in labels])


def _ledger_labels(ledger):
    """Labels a ledger can give, read off the ledger itself rather than the allocated rows."""
    plain = rates.ledger_rows(ledger).select("nature", F.concat_ws(" ", "cost_type", "nature").alias("cost_label"))
    extra = rates.ledger_rows(ledger).filter("overtime and nature = 'REAL'").select("nature", F.lit("COSTO MOD HORAS EXTRA REAL").alias("cost_label"))
    return stack([plain, extra])


@query("apply_rates", f"""
WITH {B.TE_SQL}, {RATES_CTE}, p AS (SELECT period, cost_centre, {PIVOT_SQL} FROM rt GROUP BY ALL)
SELECT row_id, te.period, te.cost_centre, {', '.join(f'{H(chr(34) + c + chr(34) + " * hours", 4)} AS "{c}"' for c in REAL_LABELS)},
  {', '.join(f'{H(chr(34) + c + chr(34) + " * std_hours", 4)} AS "{c}"' for c in STANDARD_LABELS)},
  {', '.join(f'{H(chr(34) + c + chr(34) + " * hours", 4)} AS "{c} APLICADO"' for c in STANDARD_LABELS)}
FROM te LEFT JOIN p ON te.period = p.period AND te.cost_centre = p.cost_centre""")
def apply_rates(spark, folder):
    rows = B.entries(spark, folder).select("row_id", "period", "cost_centre", "hours", "std_hours")
    real, standard = rates.split_labels(B.ledger(spark, folder).transform(_ledger_labels))
    wide = rates.pivot_rates(_rates(spark, folder), [*real, *standard])
    out = rates.apply_rates(rows, wide, real, standard)
    cost = [*real, *standard, *[f"{c} APLICADO" for c in standard]]
    return out.select("row_id", "period", "cost_centre", *[half_up(F.col(f"`{c}`"), 4).alias(c) for c in cost])


# Downtime and concepts

def _column_case(rule_column: str) -> str:
    return f"CASE {rule_column} " + " ".join(f"WHEN '{n}' THEN {n}" for n in B.RULE_NAMES) + " END"


TAG_SQL = f"""CASE WHEN rule = 'INCLUIDOS' AND {_column_case('column_1')} = data_1
      AND list_contains(string_split(data_2, '-'), {_column_case('column_2')}) THEN 'IN'
    WHEN rule = 'EXCLUIDOS' AND {_column_case('column_1')} = data_1
      AND NOT coalesce(list_contains(string_split(data_2, '-'), {_column_case('column_2')}), false) THEN 'EX'
    WHEN rule IN ('INCLUIDOS', 'EXCLUIDOS') AND column_3 IS NOT NULL
      AND strpos(right('00' || data_3, 2), {_column_case('column_3')}) > 0 THEN 'CO'
    WHEN rule = 'TODOS' AND {_column_case('column_1')} = data_1 THEN 'TO' END"""


@query("dynamic_rule_filter", f"""
WITH {B.TE_SQL}, {B.CLASSES_SQL}, e AS (SELECT *, substr(centre_code, 1, 2) AS centre2 FROM te)
SELECT row_id, code AS rule_code, {TAG_SQL} AS tag FROM e JOIN cl ON right(op_code, 1) = code WHERE {TAG_SQL} IS NOT NULL""")
def dynamic_rule_filter(spark, folder):
    rules = masters.downtime_rules(B.downtime_classes(spark))
    rows = B.rule_entries(spark, folder).withColumn("code", F.concat(F.lit("0"), "op_code"))
    ruled = lookup(rows, rules, [("code", "code")], {c: c for c in rules.columns if c not in ("code", "downtime")})
    return T.apply_rules(ruled, B.RULE_NAMES).select("row_id", F.right("op_code", F.lit(1)).alias("rule_code"), "tag")


DOWNTIME_CTE = f"""{B.DT_SQL}, {B.CLASSES_SQL},
dr AS (SELECT downtime_id, order_id, downtime, CAST(downtime_hours AS DOUBLE) AS downtime_hours, cl.code AS short_code,
    right('000' || split_part(dt.downtime, '-', 1), 3) AS code, downtime_group, rule, column_1, data_1, column_2, data_2, column_3, data_3
  FROM (SELECT * FROM dt) dt LEFT JOIN (SELECT * EXCLUDE (downtime) FROM cl) cl
    ON right('000' || split_part(dt.downtime, '-', 1), 3) = right('000' || cl.code, 3)),
ti AS (SELECT * EXCLUDE (std_hours), substr(centre_code, 1, 2) AS centre2,
    CASE WHEN std_hours IS NULL AND hours IS NOT NULL THEN 0 ELSE std_hours END AS std_hours FROM te WHERE base_hours IS NOT NULL),
mt0 AS (SELECT ti.*, downtime_id, code, downtime, downtime_group, downtime_hours, {TAG_SQL} AS tag FROM ti JOIN dr USING (order_id)),
mt1 AS (SELECT *, sum(hours) OVER (PARTITION BY order_id, code) AS total_hours FROM mt0 WHERE tag IS NOT NULL),
alc AS (SELECT row_id, order_id, hours, std_hours, cost_centre, downtime_id, code, downtime, downtime_group, tag,
    hours / nullif(total_hours, 0) * downtime_hours AS allocated_hours FROM mt1
  UNION ALL SELECT row_id, order_id, hours, std_hours, cost_centre, NULL, NULL, NULL, NULL, NULL, NULL FROM ti
    WHERE row_id NOT IN (SELECT row_id FROM mt1))"""


def _allocated(spark, folder):
    rules = masters.downtime_rules(B.downtime_classes(spark))
    records = masters.downtime_records(B.downtime(spark, folder), rules)
    return T.allocate_downtime(T.timed_entries(B.rule_entries(spark, folder)), records, B.RULE_NAMES)


@query("downtime_allocation", f"""
WITH {B.TE_SQL}, {DOWNTIME_CTE}
SELECT row_id, order_id, downtime_id, code, downtime, downtime_group, tag, {H('allocated_hours')} AS allocated_hours FROM alc""")
def downtime_allocation(spark, folder):
    return _allocated(spark, folder).select("row_id", "order_id", "downtime_id", "code", "downtime", "downtime_group", "tag",
                                            half_up(F.col("allocated_hours"), 6).alias("allocated_hours"))


@query("concept_decomposition", f"""
WITH {B.TE_SQL}, {DOWNTIME_CTE},
g AS (SELECT row_id, arg_min(hours, coalesce(code, '~') || lpad(coalesce(CAST(downtime_id AS VARCHAR), '0'), 12, '0')) AS h,
    arg_min(std_hours, coalesce(code, '~') || lpad(coalesce(CAST(downtime_id AS VARCHAR), '0'), 12, '0')) AS s,
    arg_min(downtime_group, coalesce(code, '~') || lpad(coalesce(CAST(downtime_id AS VARCHAR), '0'), 12, '0')) AS grp,
    coalesce(sum(allocated_hours), 0) AS d, CAST(any_value(cost_centre) AS BIGINT) % 7 AS rate FROM alc GROUP BY row_id),
c AS (SELECT row_id, 'ESTANDAR' AS downtime_group, '000-HORAS ESTANDAR' AS concept, s AS v FROM g
  UNION ALL SELECT row_id, 'INCREMENTO DE EFICIENCIA', '998-INCREMENTO DE EFICIENCIA O ESTANDAR INCORRECTO', h - s FROM g WHERE h < s OR h - s < d
  UNION ALL SELECT row_id, 'AJUSTES', '997-AJUSTE REGISTRO DE PAROS SUP A LA DIFERENCIA EST VS REAL', -d FROM g WHERE h < s OR h - s < d
  UNION ALL SELECT row_id, 'INEFICIENCIA NO JUSTIFICADA', '999-INEFICIENCIA NO JUSTIFICADA', h - s - d FROM g WHERE NOT (h < s OR h - s < d)
  UNION ALL SELECT row_id, grp, downtime, allocated_hours FROM alc JOIN g USING (row_id) WHERE downtime IS NOT NULL)
SELECT row_id, downtime_group, concept, {H('v')} AS concept_hours, {H('rate * v')} AS "COSTO MOD REAL" FROM c JOIN (SELECT row_id, rate FROM g) USING (row_id)""")
def concept_decomposition(spark, folder):
    rated = _allocated(spark, folder).withColumn("COSTO MOD REAL", (F.col("cost_centre").cast("long") % 7).cast("double"))
    return T.decompose_concepts(rated, ["COSTO MOD REAL"]).select(
        "row_id", "downtime_group", "concept", half_up(F.col("concept_hours"), 6).alias("concept_hours"),
        half_up(F.col("`COSTO MOD REAL`"), 6).alias("COSTO MOD REAL"))


# Quantities

@query("transformed_quantity", f"""
WITH {B.TE_SQL}, t AS (SELECT *, CASE WHEN process = parent_process THEN qty_done END AS qty_transformed FROM te)
SELECT row_id, order_id, CAST(day AS VARCHAR) AS day, qty_transformed,
  coalesce(sum(qty_transformed) OVER (PARTITION BY order_id, day), 0) AS day_transformed FROM t""")
def transformed_quantity(spark, folder):
    return quantities.transformed_quantity(B.entries(spark, folder)).select(
        "row_id", "order_id", F.col("day").cast("string").alias("day"), "qty_transformed", "day_transformed")


@query("asof_reject_assignment", f"""
WITH {B.TE_SQL}, p AS (SELECT *, coalesce(process = parent_process AND qty_done > 0, false) AS productive FROM te),
b AS (SELECT *, coalesce(max(CASE WHEN productive THEN day END) OVER (PARTITION BY order_id ORDER BY day
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), min(CASE WHEN productive THEN day END) OVER (PARTITION BY order_id)) AS bucket FROM p),
s AS (SELECT order_id, bucket, coalesce(sum(qty_rejected), 0) AS r, coalesce(sum(qty_scrap), 0) AS c FROM b GROUP BY ALL)
SELECT row_id, p.order_id, CAST(day AS VARCHAR) AS day, CASE WHEN productive THEN r ELSE 0 END AS day_rejected,
  CASE WHEN productive THEN c ELSE 0 END AS day_scrap
FROM p LEFT JOIN s ON p.order_id = s.order_id AND p.day = s.bucket""")
def asof_reject_assignment(spark, folder):
    return quantities.rejects_by_productive_day(B.entries(spark, folder)).select(
        "row_id", "order_id", F.col("day").cast("string").alias("day"), "day_rejected", "day_scrap")


# The whole job: what is typed in above as classified entries is worked out here from the raw ones.

GROUPS_SQL = """SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS STRING) END AS order_id, concat('G', CAST(o_custkey AS STRING)) AS group_id,
  concat('M', o_orderstatus) AS mount_order FROM orders"""
CENTRES_SQL = """SELECT concat('0', CAST(s_suppkey % 6 AS STRING), '-', CAST(s_nationkey % 4 AS STRING)) AS centre_code,
  CAST(301000 + s_suppkey % 25 AS STRING) AS cost_centre, s_suppkey FROM supplier"""
CLASSIFIED_CTE = f"""{B.TB_SQL}, {B.PROCESSES_SQL}, {B.SPECIFICS_SQL.replace("sp(", "spx(", 1)}, cr AS ({CORRECTIONS}), gr AS ({GROUPS_SQL}), ce AS ({CENTRES_SQL}),
eq AS (SELECT centre_code, arg_max(cost_centre, s_suppkey) AS cost_centre FROM ce GROUP BY 1),
t1 AS (SELECT tb.* EXCLUDE (order_id, op_code, op_text, centre), CAST(order_id AS VARCHAR) AS order_id, coalesce(right('0' || new_code, 2), op_code) AS op_code,
    coalesce(new_text, op_text) AS op_text, coalesce(new_centre, centre) AS centre
  FROM tb LEFT JOIN cr ON CAST(order_id AS VARCHAR) = substr(order_ref, 5) AND op_code = right('0' || old_code, 2)),
pr0 AS (SELECT t1.*, substr(op_text, 1, 12) AS prefix12, process, CAST(rank AS INTEGER) AS process_rank FROM t1 LEFT JOIN pd ON substr(op_text, 1, 5) = pd.prefix5),
mn AS (SELECT order_id, process AS parent0, op_text AS op0, row_number() OVER (PARTITION BY order_id ORDER BY process_rank NULLS LAST, process NULLS LAST, row_id) AS place FROM pr0),
cl0 AS (SELECT pr0.*, parent0, CASE WHEN parent0 IS NOT NULL THEN op0 END AS main_operation, specific_process, CASE WHEN centre IS NULL THEN 'OPERACION EXTERNA' WHEN centre = 'ACTIVIDADES SUPLEMENTARIAS' THEN centre
    WHEN substr(specific_process, 1, 12) = 'ALISTAMIENTO' THEN 'ALISTAMIENTO' ELSE 'OPERACION' END AS op_class
  FROM pr0 JOIN mn ON pr0.order_id = mn.order_id AND place = 1 LEFT JOIN spx ON pr0.prefix12 = spx.prefix12),
te AS (SELECT cl0.*, coalesce(parent0, op_class) AS parent_process, group_id, mount_order, cost_centre
  FROM cl0 LEFT JOIN gr ON cl0.order_id = gr.order_id LEFT JOIN eq ON cl0.centre_code = eq.centre_code)"""
JOB_RATES = f"""{RATES_CTE}, p AS (SELECT period, cost_centre, {PIVOT_SQL} FROM rt GROUP BY ALL)"""


@query("costing_job", f"""
WITH {CLASSIFIED_CTE}, {OPERATION_CTE}, {MOUNTING_CTE}, {TUNING_CTE}, {CHANGE_CTE},
u AS (SELECT row_id, std_hours FROM h_mt UNION SELECT row_id, std_hours FROM h_tu UNION SELECT row_id, std_hours FROM h_cd
      UNION SELECT row_id, std_hours FROM h_io UNION SELECT row_id, std_hours FROM h_op), {JOB_RATES}
SELECT te.row_id, te.order_id, te.process, te.parent_process, te.op_class, te.group_id, te.cost_centre, {H('u.std_hours')} AS std_hours,
  {', '.join(f'{H(chr(34) + c + chr(34) + " * hours", 4)} AS "{c}"' for c in REAL_LABELS)},
  {', '.join(f'{H(chr(34) + c + chr(34) + " * u.std_hours", 4)} AS "{c}"' for c in STANDARD_LABELS)},
  {', '.join(f'{H(chr(34) + c + chr(34) + " * hours", 4)} AS "{c} APLICADO"' for c in STANDARD_LABELS)}
FROM te LEFT JOIN u ON te.row_id = u.row_id LEFT JOIN p ON te.period = p.period AND te.cost_centre = p.cost_centre""")
def costing_job(spark, folder):
    entries = B.base_entries(spark, folder).withColumn("order_id", F.col("order_id").cast("string"))
    out = job.costed_entries(entries, _masters(spark, folder))
    cost = [c for c in out.columns if c.startswith("COSTO ")]
    return _hours(out, "order_id", "process", "parent_process", "op_class", "group_id", "cost_centre",
                  *[half_up(F.col(f"`{c}`"), 4).alias(c) for c in cost])


def _fact_masters(spark, folder):
    """As the whole job's, without the code rows that name no order: keys are unique, and missing ones would all be one key."""
    given = _masters(spark, folder)
    return dataclasses.replace(given, groups=given.groups.filter(F.col("order_id").isNotNull()),
                               corrections=given.corrections.filter(F.col("order_ref").isNotNull()))


def _masters(spark, folder):
    views = {n: B.table(spark, folder, n) for n in ("orders", "supplier")}
    return job.Masters(
        spark.sql(CORRECTIONS.replace("FROM orders", "FROM {orders}"), orders=views["orders"]), B.processes(spark), B.specifics(spark),
        spark.sql(GROUPS_SQL.replace("FROM orders", "FROM {orders}"), orders=views["orders"]),
        spark.sql(CENTRES_SQL.replace("FROM supplier", "FROM {supplier}"), supplier=views["supplier"]), F.col("s_suppkey"),
        B.ledger(spark, folder), B.allocation_rules(spark))


# The fact: raw entries, some without an order or a day, meet movements that take their order's process.

FACT_TE = CLASSIFIED_CTE.replace(B.TB_SQL, B.JB_SQL).replace("FROM pr0 JOIN mn ON", "FROM pr0 LEFT JOIN mn ON")
FACT_SEGMENTS = re.sub(r"\bnear(?=[01]?\b)", "seg_near", PARTS_CTE)
FACT_CTE = f"""{FACT_TE}, {B.JM_SQL},
mains AS (SELECT DISTINCT order_id, parent0 AS parent_process, main_operation AS op_text FROM te WHERE main_operation IS NOT NULL),
mv AS (SELECT mv0.*, parent_process, op_text FROM mv0 LEFT JOIN mains USING (order_id)),
{MEASURE_CTES.removeprefix(B.MV_SQL + ", ")}, {TOTALS_CTE}, {re.sub(r"\bdr\b", "nc_rejected", NC_CTE)}, {FACT_SEGMENTS},
copied AS (SELECT row_id, day FROM near UNION ALL SELECT row_id, day FROM seg_near),
tx AS (SELECT row_id, order_id, group_id, mount_order, day, hours, abs_base_hours, prefix12 FROM te
  UNION ALL SELECT copied.row_id, order_id, group_id, mount_order, copied.day, NULL, NULL, prefix12 FROM copied
    JOIN te ON te.row_id = regexp_replace(copied.row_id, '_[01]_[0-9]+$', '')),
{OPERATION_CTE}, {MOUNTING_CTE.replace("FROM te WHERE", "FROM tx WHERE")}, {TUNING_CTE}, {CHANGE_CTE},
u AS (SELECT row_id, std_hours FROM h_mt UNION SELECT row_id, std_hours FROM h_tu UNION SELECT row_id, std_hours FROM h_cd
      UNION SELECT row_id, std_hours FROM h_io UNION SELECT row_id, std_hours FROM h_op), {JOB_RATES},
kgs AS (SELECT row_id, order_id, parent_process, day, entry_day, {_min_count('share * scrap_other', 'share * scrap_shaped')} AS kg_scrap,
    {_min_count('share * used_extrusion', 'share * used_recycled', 'share * used_other')} AS kg_used, share * cake AS kg_cake FROM parts),
znc AS (SELECT row_id, order_id, parent_process, day, entry_day, CASE WHEN {SHAPED} THEN CASE WHEN order_done > 0 THEN {UNIT_LOSS} * qty_rejected ELSE 0 END
       WHEN kg_nc > 0 AND day_rejected = 0 THEN kg_nc * factor
       WHEN kg_nc > 0 AND day_rejected > 0 THEN qty_rejected / nullif(day_rejected, 0) * kg_nc END AS nc_kg FROM z),
fx AS (SELECT te.row_id, te.order_id, te.parent_process, te.day, NULL AS mark, te.hours, u.std_hours, nc_kg, kg_scrap, kg_used, kg_cake, te.cost_centre, te.base_hours,
    te.centre_code, te.method FROM te LEFT JOIN u ON u.row_id = te.row_id LEFT JOIN znc ON znc.row_id = te.row_id AND znc.entry_day IS NULL
    LEFT JOIN kgs ON kgs.row_id = te.row_id AND kgs.entry_day IS NULL
  UNION ALL SELECT row_id, order_id, parent_process, day, CASE WHEN row_id IS NOT NULL THEN '1' END, NULL, NULL, nc_kg, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM znc
    WHERE row_id IS NULL OR entry_day IS NOT NULL
  UNION ALL SELECT row_id, order_id, parent_process, day, '0', NULL, NULL, NULL, kg_scrap, kg_used, kg_cake, NULL, NULL, NULL, NULL FROM kgs WHERE entry_day IS NOT NULL)"""


@query("costing_fact", f"""
WITH {FACT_CTE}
SELECT row_id, order_id, parent_process, CAST(day AS VARCHAR) AS day, strftime(day, '%Y%m') AS period, mark, fx.hours, {H('std_hours')} AS std_hours,
  {', '.join(f'{H(c)} AS {c}' for c in ('nc_kg', 'kg_scrap', 'kg_used', 'kg_cake'))},
  {', '.join(f'{H(chr(34) + c + chr(34) + " * fx.hours", 4)} AS "{c}"' for c in REAL_LABELS)},
  {', '.join(f'{H(chr(34) + c + chr(34) + " * std_hours", 4)} AS "{c}"' for c in STANDARD_LABELS)},
  {', '.join(f'{H(chr(34) + c + chr(34) + " * fx.hours", 4)} AS "{c} APLICADO"' for c in STANDARD_LABELS)}
FROM fx LEFT JOIN p ON strftime(day, '%Y%m') = p.period AND fx.cost_centre = p.cost_centre""")
def costing_fact(spark, folder):
    out = fact.costing_fact(B.job_entries(spark, folder), B.job_movements(spark, folder), _fact_masters(spark, folder))
    cost = [c for c in out.columns if c.startswith("COSTO ")]
    return out.select("row_id", "order_id", "parent_process", F.col("day").cast("string").alias("day"), "period", "mark", "hours",
                      *[half_up(F.col(c), 6).alias(c) for c in ("std_hours", "nc_kg", "kg_scrap", "kg_used", "kg_cake")],
                      *[half_up(F.col(f"`{c}`"), 4).alias(c) for c in cost])


FACT_DOWNTIME = (DOWNTIME_CTE.replace("substr(centre_code, 1, 2) AS centre2", "substr(centre_code, 1, 2) AS centre2, strftime(day, '%Y%m') AS period")
                 .replace("FROM te WHERE base_hours IS NOT NULL", "FROM fx WHERE mark IS NULL AND row_id IS NOT NULL AND base_hours IS NOT NULL")
                 .replace(B.DT_SQL, B.DT_SQL.replace("CAST(floor(event_id / 3) AS BIGINT) AS order_id", "CAST(CAST(floor(event_id / 3) AS BIGINT) AS VARCHAR) AS order_id")))


@query("costing_concepts", f"""
WITH {FACT_CTE}, {FACT_DOWNTIME},
lk AS (SELECT row_id, day, cost_centre FROM te),
g AS (SELECT row_id, arg_min(hours, coalesce(code, '~') || lpad(coalesce(CAST(downtime_id AS VARCHAR), '0'), 12, '0')) AS h,
    arg_min(std_hours, coalesce(code, '~') || lpad(coalesce(CAST(downtime_id AS VARCHAR), '0'), 12, '0')) AS s,
    arg_min(downtime_group, coalesce(code, '~') || lpad(coalesce(CAST(downtime_id AS VARCHAR), '0'), 12, '0')) AS grp,
    coalesce(sum(allocated_hours), 0) AS d FROM alc GROUP BY row_id),
c AS (SELECT row_id, 'ESTANDAR' AS downtime_group, '000-HORAS ESTANDAR' AS concept, s AS v FROM g
  UNION ALL SELECT row_id, 'INCREMENTO DE EFICIENCIA', '998-INCREMENTO DE EFICIENCIA O ESTANDAR INCORRECTO', h - s FROM g WHERE h < s OR h - s < d
  UNION ALL SELECT row_id, 'AJUSTES', '997-AJUSTE REGISTRO DE PAROS SUP A LA DIFERENCIA EST VS REAL', -d FROM g WHERE h < s OR h - s < d
  UNION ALL SELECT row_id, 'INEFICIENCIA NO JUSTIFICADA', '999-INEFICIENCIA NO JUSTIFICADA', h - s - d FROM g WHERE NOT (h < s OR h - s < d)
  UNION ALL SELECT row_id, grp, downtime, allocated_hours FROM alc JOIN g USING (row_id) WHERE downtime IS NOT NULL)
SELECT c.row_id, downtime_group, concept, {H('v')} AS concept_hours, {', '.join(f'{H(chr(34) + n + chr(34) + " * v", 4)} AS "{n}"' for n in REAL_LABELS)}
FROM c JOIN lk USING (row_id) LEFT JOIN p ON strftime(lk.day, '%Y%m') = p.period AND lk.cost_centre = p.cost_centre""")
def costing_concepts(spark, folder):
    rows = fact.costing_fact(B.job_entries(spark, folder), B.job_movements(spark, folder), _fact_masters(spark, folder), ["base_hours", "centre_code", "method"])
    rules = masters.downtime_rules(B.downtime_classes(spark))
    records = masters.downtime_records(B.downtime(spark, folder).withColumn("order_id", F.col("order_id").cast("string")), rules)
    out = fact.costing_concepts(rows.withColumn("centre2", F.substring("centre_code", 1, 2)), records, B.RULE_NAMES)
    return out.select("row_id", "downtime_group", "concept", half_up(F.col("concept_hours"), 6).alias("concept_hours"),
                      *[half_up(F.col(f"`{c}`"), 4).alias(c) for c in out.columns if c.startswith("COSTO ")])
