"""Fixed-width validation and rendering queries over the customers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from suite.registry import SQL, query, table
from tallyworks.operators.ranking import number_records
from tallyworks.operators.sets import stack
from tallyworks.plans import fixedwidth as X
from tallyworks.plans import matrix as M
from tallyworks.plans.matrix import MATRIX
from tallyworks.session import shared_folder
from tallyworks.sources import sinks

# Customer columns in the roles of the record fields; faults are spread over the customers.
FIELDS = {
    "F_NUMERO_REG": "CAST(c_custkey AS STRING)",
    "F_TIPO_REG": "'201'",
    "F_SUBTIPO_REG": "'0'",
    "F_VERSION_REG": "CASE WHEN c_custkey % 50 = 3 THEN NULL ELSE '2' END",
    "F_CIA": "CASE WHEN c_custkey % 40 = 1 THEN '1234' WHEN c_custkey % 40 = 2 THEN '1A' ELSE CAST(c_nationkey AS STRING) END",
    "F_ACTUALIZA_REG": "'1'",
    "F201_ID_TERCERO": "CAST(800000000 + c_custkey AS STRING)",
    "F201_ID_SUCURSAL": "concat(' ', CAST(c_nationkey AS STRING), ' ')",
    "F201_IND_ESTADO_ACTIVO": "CASE WHEN c_custkey % 60 = 5 THEN ' nan ' ELSE '1' END",
    "F201_DESCRIPCION_SUCURSAL": "CASE WHEN c_custkey % 45 = 7 THEN concat(c_name, ' sucursal con un nombre demasiado largo') ELSE c_name END",
    "F201_ID_MONEDA": "'COP'",
    "F201_IND_CALIFICACION": "CASE c_custkey % 30 WHEN 4 THEN 'D' WHEN 5 THEN 'B' WHEN 6 THEN 'C' ELSE 'A' END",
    "F201_DIAS_GRACIA": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 90 AS STRING) END",
    "F201_CUPO_CREDITO": "CASE c_custkey % 20 WHEN 0 THEN NULL WHEN 1 THEN '+000000000001234.5000' WHEN 2 THEN '1e3' WHEN 3 THEN 'mil'"
                         " WHEN 4 THEN '12345678901234567' ELSE CAST(c_acctbal AS STRING) END",
    "F201_ID_CLIENTE_CORP": "CASE WHEN c_custkey % 9 = 0 THEN CAST(c_custkey AS STRING) ELSE NULL END",
    "F201_ID_SUCURSAL_CORP": "CASE WHEN c_custkey % 18 = 0 THEN '01' ELSE '' END",
    "F201_ID_TIPO_CLI": "substr(c_mktsegment, 1, 4)",
    "F201_PORC_EXCESO_VENTA": "CASE c_custkey % 25 WHEN 0 THEN '12.50' WHEN 1 THEN '7.5' WHEN 2 THEN '-3.25' WHEN 3 THEN 'diez' WHEN 4 THEN '12345.678' ELSE NULL END",
    "F015_CONTACTO": "c_mktsegment",
    "F015_ID_PAIS": "CASE WHEN c_custkey % 7 = 0 THEN '169' ELSE NULL END",
    "F015_ID_DEPTO": "CASE WHEN c_custkey % 14 = 0 THEN '05' WHEN c_custkey % 15 = 0 THEN '11' ELSE NULL END",
    "F015_ID_CIUDAD": "CASE WHEN c_custkey % 28 = 0 THEN '001' ELSE NULL END",
    "F201_FECHA_INGRESO": "CASE WHEN c_custkey % 35 = 8 THEN '2024-1-5' WHEN c_custkey % 35 = 9 THEN '240105' ELSE '20240105' END",
    "f201_valida_cupo_despacho": "'0'",
    "f201_frecuencia_entrega": "CASE WHEN c_custkey % 55 = 10 THEN '1000002' ELSE '1000001' END",
    "f201_id_cia_cliente_corp": "CASE WHEN c_custkey % 27 = 0 OR c_custkey % 22 = 11 THEN '1' ELSE NULL END",
    "f201_ind_valida_cartera_des": "'1'",
}


def customers(spark, folder):
    rows = table(spark, folder, "customer").selectExpr("c_custkey", *[f"{e} AS {n.upper()}" for n, e in FIELDS.items()])
    return number_records(rows, "c_custkey", "row_number", start=2)


def _clean(expr: str) -> str:
    text = f"trim(CAST({expr} AS VARCHAR))"
    return f"CASE WHEN {text} IS NULL OR upper({text}) IN ('NAN', 'NAT', '') THEN '' ELSE {text} END"


CLEAN_CTE = "cu AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) + 1 AS row_number, " + ", ".join(
    f"{_clean(FIELDS[f.name]) if f.name in FIELDS else chr(39) * 2} AS {f.name}" for f in MATRIX) + " FROM customer)"
NUMBER = "regexp_matches({c}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$')"


def _number(c: str) -> str:
    return f"CASE WHEN {NUMBER.format(c=c)} THEN CAST({c} AS DOUBLE) END"


def _zfill(text: str, width: int) -> str:
    return (f"CASE WHEN length({text}) >= {width} THEN {text} WHEN regexp_matches({text}, '^[+-]')"
            f" THEN substr({text}, 1, 1) || lpad(substr({text}, 2), {width - 1}, '0') ELSE lpad({text}, {width}, '0') END")


def _decimal(c: str) -> str:
    return (f"CASE WHEN regexp_matches({c}, '^[0-9]{{1,4}}\\.[0-9]{{2}}$') OR ({_number(c)}) IS NULL THEN {c}"
            f" ELSE printf('%07.2f', {_number(c)}) END")


def _credit(c: str) -> str:
    return (f"CASE WHEN regexp_matches({c}, '^[+-][0-9]{{15}}\\.[0-9]{{4}}$') OR ({_number(c)}) IS NULL THEN {c}"
            f" ELSE CASE WHEN {_number(c)} >= 0 THEN '+' ELSE '-' END || printf('%020.4f', abs({_number(c)})) END")


def _errors_sql(f) -> dict[str, list[tuple[str, str]]]:
    c, filled = f.name, f"{f.name} <> ''"
    out = {"mandatory": [], "dependencies": [], "types": []}
    if f.obligation == "Si":
        out["mandatory"].append((f"{c} = ''", M.MSG_MANDATORY))
    rules = {"F201_ID_CLIENTE_CORP": "f201_id_cia_cliente_corp <> ''", "F201_ID_SUCURSAL_CORP": "f201_id_cia_cliente_corp <> ''",
             "f201_id_cia_cliente_corp": "(F201_ID_CLIENTE_CORP <> '' OR F201_ID_SUCURSAL_CORP <> '')",
             "F015_ID_DEPTO": "F015_ID_PAIS <> ''", "F015_ID_CIUDAD": "F015_ID_DEPTO <> ''"}
    texts = {"F201_ID_CLIENTE_CORP": "Obligatorio porque 'f201_id_cia_cliente_corp' tiene datos.",
             "F201_ID_SUCURSAL_CORP": "Obligatorio porque 'f201_id_cia_cliente_corp' tiene datos.",
             "f201_id_cia_cliente_corp": "Obligatorio si se envía cliente o sucursal corporativa.",
             "F015_ID_DEPTO": "Obligatorio porque existe el campo País.", "F015_ID_CIUDAD": "Obligatorio porque existe el campo Departamento."}
    if c in rules:
        out["dependencies"].append((f"{c} = '' AND {rules[c]}", texts[c]))
    if f.kind != "Cupo":
        out["types"].append((f"{filled} AND length({c}) > {f.width}", f"El tamaño supera el máximo permitido ({f.width})."))
    bad = {"Numérico": ("NOT regexp_matches({c}, '^[0-9]+$')", M.MSG_NUMBER), "Fecha": ("NOT regexp_matches({c}, '^[0-9]{{8}}$')", M.MSG_DAY),
           "Frecuencia": ("NOT regexp_matches({c}, '^[01]{{7}}$')", M.MSG_FREQUENCY),
           "Decimal_4_2": ("NOT regexp_matches({c}, '^[0-9]{{1,4}}\\.[0-9]{{2}}$') AND NOT " + NUMBER, M.MSG_DECIMAL),
           "Cupo": ("NOT regexp_matches({c}, '^[+-][0-9]{{15}}\\.[0-9]{{4}}$') AND NOT " + NUMBER, M.MSG_CREDIT)}
    if f.kind in bad:
        out["types"].append((f"{filled} AND {bad[f.kind][0].format(c=c)}", bad[f.kind][1]))
    if c == "F201_IND_CALIFICACION":
        out["types"].append((f"{filled} AND {c} NOT IN ('A', 'B', 'C')", M.MSG_RATING))
    if f.kind == "Cupo":
        out["types"].append((f"{filled} AND length({_credit(c)}) <> 21", M.MSG_CREDIT_WIDTH))
    return out


def _error_union(*kinds: str) -> str:
    return " UNION ALL ".join(
        "SELECT row_number, '{}' AS field, '{}' AS message FROM cu WHERE {}".format(f.name, m.replace("'", "''"), c)
        for f in MATRIX for k in kinds for c, m in _errors_sql(f)[k])


def _errors(spark, folder, *checks):
    validated = X.validate(customers(spark, folder), "row_number", checks=checks or X.ALL_CHECKS)
    return X.error_report(validated)


@query("layout_validation", f"WITH {CLEAN_CTE} {_error_union('mandatory', 'dependencies', 'types')}")
def layout_validation(spark, folder):
    return _errors(spark, folder)


@query("layout_dependencies", f"WITH {CLEAN_CTE} {_error_union('dependencies')}")
def layout_dependencies(spark, folder):
    return _errors(spark, folder, X.dependency_checks)


@query("layout_types", f"WITH {CLEAN_CTE} {_error_union('types')}")
def layout_types(spark, folder):
    return _errors(spark, folder, X.filled_checks)


def _chunk_sql(f) -> str:
    c = f.name
    text = {"Numérico": _zfill(c, f.width), "Alfanumérico": f"rpad({c}, {f.width}, ' ')", "Fecha": _zfill(c, f.width),
            "Frecuencia": c, "Decimal_4_2": _zfill(f"({_decimal(c)})", f.width), "Cupo": _credit(c)}[f.kind]
    blank = ("0" if f.kind in ("Numérico", "Decimal_4_2", "Cupo") else " ") * f.width
    return f"CASE WHEN {c} = '' THEN '{blank}' ELSE {text} END"


@query("fixed_width_validated", f"""
WITH {CLEAN_CTE}, er AS ({_error_union('mandatory', 'dependencies', 'types')})
SELECT row_number, concat({', '.join(_chunk_sql(f) for f in MATRIX)}) AS line FROM cu WHERE row_number NOT IN (SELECT row_number FROM er)""")
def fixed_width_validated(spark, folder):
    return X.render_validated(X.validate(customers(spark, folder), "row_number"), "row_number")


# A layout measured on the customers: each field as wide as its longest value, with a gap before every third.
MEASURED = [("f_numero_reg", "Numérico", "si", "c_custkey"), ("F_TIPO_REG", "Numérico", "si", "c_nationkey"),
            ("  Descripción ", "Alfanumérico", "si", "c_name"), ("F201_CUPO_CREDITO", "Decimal", "no", "c_acctbal"),
            ("segmento", "Alfanumérico", "dep", "c_mktsegment"), ("pais", "Numérico", "si", "c_nationkey"),
            ("F201_FECHA_INGRESO", "Fecha", "no", "c_name"), ("nota sin tamaño", "Alfanumérico", "no", None)]


def measured_layout(spark, folder):
    """One row per field, its size measured over all customers; the start follows from the sizes before it."""
    widths = table(spark, folder, "customer").agg(
        *[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in ("c_custkey", "c_nationkey", "c_name", "c_acctbal", "c_mktsegment")])
    at, rows = F.lit(1), []
    for i, (name, kind, needed, source) in enumerate(MEASURED):
        size = F.col(source) + (14 if kind == "Decimal" else 0) if source else F.lit(None).cast("int")
        at = at + (2 if i % 3 == 2 else 0)
        rows.append(F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), F.lit(needed).alias("mandatory"),
                             at.cast("string").alias("start"), size.cast("string").alias("size")))
        at = at + F.coalesce(size, F.lit(0))
    return widths.select(F.explode(F.array(*rows)).alias("_f")).select("_f.*")


LAYOUT_CTE = """w AS (SELECT max(length(CAST(c_custkey AS VARCHAR))) AS k, max(length(CAST(c_nationkey AS VARCHAR))) AS n, max(length(c_name)) AS m,
  max(length(CAST(c_acctbal AS VARCHAR))) + 14 AS a, max(length(c_mktsegment)) AS s FROM customer),
ly AS (SELECT 'F_NUMERO_REG' AS name, 'numérico' AS type, 'si' AS mandatory, 1 AS start, k AS size FROM w
  UNION ALL SELECT 'F_TIPO_REG', 'numérico', 'si', 1 + k, n FROM w UNION ALL SELECT 'DESCRIPCION', 'alfanumérico', 'si', 3 + k + n, m FROM w
  UNION ALL SELECT 'F201_CUPO_CREDITO', 'decimal', 'no', 3 + k + n + m, a FROM w UNION ALL SELECT 'SEGMENTO', 'alfanumérico', 'dep', 3 + k + n + m + a, s FROM w
  UNION ALL SELECT 'PAIS', 'numérico', 'si', 5 + k + n + m + a + s, n FROM w UNION ALL SELECT 'F201_FECHA_INGRESO', 'fecha', 'no', 5 + k + n + m + a + s + n, m FROM w)"""


@query("layout_read", f"""
WITH {LAYOUT_CTE} SELECT name, type, mandatory, CAST(start AS INTEGER) AS start, CAST(size AS INTEGER) AS size,
  CAST((SELECT max(start + size - 1) FROM ly) AS INTEGER) AS record_length FROM ly""")
def layout_read(spark, folder):
    return X.with_record_length(X.layout_fields(measured_layout(spark, folder))).drop("label")


PLACED = {"descripcion": "CASE WHEN c_custkey % 12 = 5 THEN '  ' ELSE concat(' ', c_name, ' S.A.') END",
          "f201_cupo_credito": "CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'x' WHEN 2 THEN '-12.34567' ELSE CAST(c_acctbal AS STRING) END",
          "segmento": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END",
          "pais": "CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '-' WHEN 2 THEN concat('-', CAST(c_nationkey AS STRING)) ELSE concat('n. ', CAST(c_nationkey AS STRING)) END",
          "f201_fecha_ingreso": "CASE c_custkey % 3 WHEN 0 THEN '2024-03-15' WHEN 1 THEN NULL ELSE 'sin fecha' END"}


@query("fixed_width_render", f"""
WITH {LAYOUT_CTE},
c0 AS (SELECT c_custkey, {', '.join(f'{e} AS {n}' for n, e in PLACED.items())} FROM customer WHERE c_custkey % 13 <> 0),
cu AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS number, coalesce({_number('f201_cupo_credito')}, 0) AS cupo,
  CASE WHEN regexp_replace(pais, '[^0-9-]', '', 'g') IN ('', '-') THEN '0' ELSE regexp_replace(pais, '[^0-9-]', '', 'g') END AS pd FROM c0)
SELECT number, concat(lpad(CAST(number AS VARCHAR), k::INT, '0'), lpad('201', n::INT, '0'), '  ', rpad(trim(coalesce(descripcion, '')), m::INT, ' '),
    CASE WHEN cupo < 0 THEN '-' ELSE '+' END, right(lpad(split_part(printf('%.4f', abs(cupo)), '.', 1), (a - 6)::INT, '0'), a - 6), '.', split_part(printf('%.4f', abs(cupo)), '.', 2),
    rpad(trim(coalesce(segmento, '')), s::INT, ' '), '  ',
    CASE WHEN coalesce(pais, '') = '' THEN CASE WHEN n <= 4 THEN repeat('0', n) ELSE repeat(' ', n) END
      WHEN starts_with(pd, '-') THEN '-' || lpad(regexp_replace(pd, '^-+', ''), CAST(n - 1 AS INTEGER), '0') ELSE lpad(pd, CAST(n AS INTEGER), '0') END,
    rpad(regexp_replace(coalesce(f201_fecha_ingreso, ''), '[^0-9]', '', 'g'), m::INT, ' ')) AS line,
  concat_ws('; ', CASE WHEN trim(coalesce(descripcion, '')) = '' THEN 'Campo obligatorio vacío: Descripción' END,
    CASE WHEN trim(coalesce(pais, '')) = '' THEN 'Campo obligatorio vacío: pais' END) AS warnings
FROM cu, w""")
def fixed_width_render(spark, folder):
    places = X.read_layout(measured_layout(spark, folder))
    rows = table(spark, folder, "customer").selectExpr("c_custkey", *[f"{e} AS `{n.capitalize()}`" for n, e in PLACED.items()])
    blank = rows.select("c_custkey", *[F.lit(" ").alias(c) for c in rows.columns[1:]])
    filled = stack([rows.filter("c_custkey % 13 <> 0"), blank.filter("c_custkey % 13 = 0")])
    keyed = X.drop_blank_rows(filled, [c for c in filled.columns if c != "c_custkey"])
    numbered = number_records(keyed, "c_custkey", "number")
    return X.render_records(numbered, places, "number").withColumn("warnings", F.array_join("warnings", "; "))


ACCENTED_NAME = {n: e.replace("c_name", "replace(c_name, 'Customer', 'Cuñtóme€')") for n, e in PLACED.items()}


def _accented(sql: str) -> str:
    for n, e in PLACED.items():
        sql = sql.replace(f"{e} AS {n}", f"{ACCENTED_NAME[n]} AS {n}")
    return sql


@query("fixed_width_file", f"""
WITH r AS ({_accented(SQL["fixed_width_render"])}), {LAYOUT_CTE}
SELECT r.number, ly.name, substr(r.line, ly.start::INT, ly.size::INT) AS value FROM r, ly""")
def fixed_width_file(spark, folder):
    """The rendered records written in cp1252, read back by their places."""
    places = X.read_layout(measured_layout(spark, folder))
    rows = table(spark, folder, "customer").selectExpr("c_custkey", *[f"{e} AS `{n.capitalize()}`" for n, e in ACCENTED_NAME.items()])
    numbered = number_records(rows.filter("c_custkey % 13 <> 0"), "c_custkey", "number")
    path = f"{shared_folder(spark)}/fixed-{uuid.uuid4().hex}"
    sinks.write_fixed_width(X.render_records(numbered, places, "number"), path, "cp1252")
    length = max(p.start + p.width - 1 for p in places)
    back = sinks.read_fixed_width(spark, path, [(p.name, p.start, p.width) for p in places], length)
    fields = F.array(*[F.struct(F.lit(p.name).alias("name"), F.col(f"`{p.name}`").alias("value")) for p in places])
    return back.select(F.col("F_NUMERO_REG").cast("long").alias("number"), F.explode(fields).alias("_f")).select("number", "_f.*")
