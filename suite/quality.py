"""File discovery, sniffing, profiling and scoring queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from suite.registry import half_up_sql as H
from suite.registry import query, table
from tallyworks.functions import patterns as P
from tallyworks.functions.numbers import half_up
from tallyworks.operators.ranking import sort_rows, top_and_bottom
from tallyworks.operators.sets import stack
from tallyworks.plans import profiling as PF
from tallyworks.plans import mail_job as MJ
from tallyworks.plans import quality_job as QJ
from tallyworks.plans import report as R
from tallyworks.plans import scoring as SC
from tallyworks.plans.rules import CATEGORIES, CODES, CRITERIA, RULES, TOTAL_WEIGHT
from tallyworks.session import shared_folder
from tallyworks.sources import delimited, messages, sinks, split_records
from tallyworks.sources import files as FL
from tallyworks.sources.staging import staged


def round_sql(expr: str, decimals: int) -> str:
    """Half-even rounding of the exact value."""
    return f"CAST(printf('%.{decimals}f', CAST({expr} AS DOUBLE)) AS DOUBLE)"


def columnar_round_sql(expr: str) -> str:
    return f"round_even(({expr}) * 10.0::DOUBLE, 0) / 10.0::DOUBLE"


# Sources

TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


@query("file_inventory", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '.parquet' AS extension, 'datos' AS kind, count(*) AS rows_found FROM {t}" for t in TABLE_NAMES))
def file_inventory(spark, folder):
    """The folder's files as the inventory lists them, with the rows that are read from each."""
    def owner(path):
        return F.regexp_extract(path, r"([^/]+)\.parquet(/[^/]*)?$", 1)

    listed = FL.file_inventory(spark, folder, data=(".parquet",)).select(owner(F.col("path")).alias("table_name"), "extension", "kind").distinct()
    rows = stack([table(spark, folder, t).select(owner(F.col("_metadata.file_path")).alias("table_name")) for t in TABLE_NAMES])
    return listed.join(rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows_found")), "table_name")


# A file of the group tests: its path ends in a name with dates and separators.
GROUP_FILE = ["page_id", "concat(url, '/', CASE page_id % 5 WHEN 0 THEN 'Ventas 2024-03-15 norte.csv' WHEN 1 THEN"
              " '2023-11.xlsx' WHEN 2 THEN concat('inventario_', CAST(2000 + page_id % 24 AS STRING), '.v2.txt')"
              " WHEN 3 THEN '.oculto' ELSE concat('reporte-final  de   clientes y proveedores ', CAST(page_id AS STRING)) END) AS path",
              "CASE page_id % 4 WHEN 0 THEN '.' WHEN 1 THEN NULL WHEN 2 THEN concat('grupo ', CAST(page_id % 6 AS STRING), '/enero')"
              " ELSE concat('ims\\\\zona', CAST(page_id % 3 AS STRING)) END AS subfolder"]


@query("infer_group", f"""
WITH f AS (SELECT {', '.join(GROUP_FILE).replace(chr(92) * 2, chr(92))} FROM pages),
n AS (SELECT *, replace(coalesce(subfolder, ''), chr(92), '/') AS folder, regexp_extract(path, '[^/]*$') AS name FROM f),
s AS (SELECT *, trim(regexp_replace(CASE WHEN regexp_matches(name, '^.+\\.[^.]*$') THEN regexp_replace(name, '\\.[^.]*$', '') ELSE name END,
  '[\\s_\\-]?[0-9]{{4}}[-_]?[0-9]{{0,2}}[-_]?[0-9]{{0,2}}', '', 'g')) AS bare FROM n)
SELECT page_id, path, CASE WHEN starts_with(folder, 'ims/zona1') THEN 'IMS_UNO'
  WHEN folder NOT IN ('', '.') THEN upper(split_part(folder, '/', 1))
  ELSE coalesce(nullif(substr(upper(regexp_replace(bare, '[\\s_\\-]+', '_', 'g')), 1, 30), ''), 'SIN_GRUPO') END AS "group" FROM s""")
def infer_group(spark, folder):
    files = table(spark, folder, "pages").selectExpr(*GROUP_FILE)
    return files.select("page_id", "path", PF.infer_group(F.col("path"), F.col("subfolder"), [("ims/zona1", "IMS_UNO")])
                        .alias("group"))


BODY = """CASE doc_id % 4 WHEN 0 THEN replace(text, ', ', ';') WHEN 1 THEN replace(text, ' ', '|') WHEN 2 THEN text
 ELSE concat('a,b;c', chr(10), chr(10), '1,2;3', chr(10), text) END"""


@query("sniff_delimited", f"""
WITH b AS (SELECT doc_id, {BODY} AS body FROM documents),
l AS (SELECT doc_id, list_filter(list_slice(string_split_regex(body, '\\r\\n|[\\n\\r]'), 1, 5), lambda x: regexp_matches(x, '\\S')) AS head FROM b),
c AS (SELECT doc_id, head, {', '.join(f"list_transform(head, lambda x: length(x) - length(replace(x, {s}, '')) + 1) AS c{i}" for i, s in enumerate(["','", "chr(9)", "';'", "'|'"]))} FROM l),
k AS (SELECT doc_id, {', '.join(f"CASE WHEN list_min(c{i}) = list_max(c{i}) THEN list_max(c{i}) ELSE 0 END AS k{i}" for i in range(4))} FROM c)
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'latin-1' ELSE 'utf-8' END AS encoding,
  CASE WHEN greatest(k0, k1, k2, k3) = 0 OR k0 >= greatest(k1, k2, k3) THEN ',' WHEN k1 >= greatest(k2, k3) THEN chr(9)
       WHEN k2 >= k3 THEN ';' ELSE '|' END AS separator FROM k""")
def sniff_delimited(spark, folder):
    docs = table(spark, folder, "documents").selectExpr("doc_id", f"{BODY} AS body")
    plain = F.encode("body", "UTF-8")
    content = F.when(F.col("doc_id") % 3 == 0, F.concat(F.unhex(F.lit("E9")), plain)).otherwise(plain)
    return docs.select("doc_id", delimited.encoding_of(content).alias("encoding"),
                       delimited.separator_of(F.col("body")).alias("separator"))


RECORD = """concat(CAST(event_id AS STRING), ',', CASE WHEN event_id % 6 = 0 THEN '"dos, con coma"' WHEN event_id % 6 = 1 THEN 'NA'
  WHEN event_id % 6 = 2 THEN concat('"con ""comillas"', chr(34), chr(34)) ELSE event_type END, CASE WHEN event_id % 10 = 4 THEN ''
  WHEN event_id % 10 = 3 THEN concat(',', CAST(user_id AS STRING), ',de mas') WHEN event_id % 10 = 5 THEN ',null'
  ELSE concat(',', CAST(user_id AS STRING)) END)"""


@query("read_delimited", """
SELECT CAST(event_id AS VARCHAR) AS id, CASE event_id % 6 WHEN 0 THEN 'dos, con coma' WHEN 1 THEN NULL WHEN 2 THEN 'con "comillas"'
  ELSE event_type END AS kind, CASE WHEN event_id % 10 IN (4, 5) THEN NULL ELSE CAST(user_id AS VARCHAR) END AS person
FROM events WHERE event_id % 10 <> 3""")
def read_delimited(spark, folder):
    lines = table(spark, folder, "events").selectExpr(f"{RECORD} AS line")
    return delimited.parse_delimited(lines, "line", ["id", "kind", "person"], ",")


@query("delimited_files", """
SELECT CAST(event_id AS VARCHAR) AS id, CASE event_id % 4 WHEN 0 THEN 'dos, con coma' WHEN 1 THEN NULL WHEN 2 THEN 'con "comillas"' ELSE event_type END AS kind,
  CAST(user_id AS VARCHAR) AS person, 'año' AS note FROM events""")
def delimited_files(spark, folder):
    """Files written by many tasks, each with the header, read back with everything detected."""
    kind = F.expr("CASE event_id % 4 WHEN 0 THEN 'dos, con coma' WHEN 1 THEN 'NA' WHEN 2 THEN 'con \"comillas\"' ELSE event_type END")
    rows = table(spark, folder, "events").select(F.col("event_id").alias("id"), kind.alias("kind"), F.col("user_id").alias("person"), F.lit("año").alias("note"))
    path = f"{shared_folder(spark)}/delimited-{uuid.uuid4().hex}"
    rows.write.options(header="true", sep=";", escape='"').csv(path)
    return delimited.read_delimited(spark, path)


@query("error_split", """
SELECT doc_id, source, CASE WHEN quality IS NULL AND n_chars % 3 = 0 THEN 'error' ELSE 'scored' END AS outcome,
  CASE WHEN quality IS NULL THEN 'sin etiqueta' END AS error FROM documents LEFT JOIN labels USING (doc_id)""")
def error_split(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    files = docs.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left").select(
        "doc_id", "source", F.when(F.col("quality").isNull(), F.lit("sin etiqueta")).alias("error"),
        (F.col("n_chars") % 3).alias("num_sheets"))
    scored, errors = FL.split_errors(files)
    return stack([scored.withColumn("outcome", F.lit("scored")), errors.withColumn("outcome", F.lit("error"))]).drop("num_sheets")


# Attachments of a message: one per line of its text.
@query("attachment_explode", f"""
WITH m AS (SELECT concat('conv-', conv_id, '-', turn) AS message, string_split(text, chr(10)) AS ls, role, conv_id, turn FROM conversations),
a AS (SELECT message, role, conv_id, turn, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM m),
x AS (SELECT *, CASE i % 4 WHEN 0 THEN concat('Datos ', i, '.XLSX') WHEN 1 THEN 'nota' WHEN 2 THEN '' ELSE concat('.oculto', i, '.csv') END AS n FROM a)
SELECT message, concat('/correo/', message) AS path, CASE WHEN role = 'system' THEN '(sin asunto)' ELSE role END AS subject,
  CASE WHEN conv_id % 3 = 0 THEN '?' ELSE concat('u', conv_id, '@correo.example') END AS sender,
  CASE WHEN turn % 2 = 0 THEN '?' ELSE CAST(turn AS VARCHAR) END AS date, coalesce(nullif(n, ''), 'adjunto') AS attachment,
  CASE i % 4 WHEN 0 THEN '.xlsx' WHEN 3 THEN '.csv' ELSE '' END AS extension,
  CASE WHEN strlen(line) > 0 THEN {round_sql('strlen(line) / 1024.0', 1)} END AS size_kb, i % 4 IN (0, 3) AS is_data,
  i % 4 IN (0, 3) AND strlen(line) > 0 AS becomes_input FROM x""")
def attachment_explode(spark, folder):
    chats = table(spark, folder, "conversations")
    message = F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))

    def attachment(line, i):
        number = i.cast("string")
        name = (F.when(i % 4 == 0, F.concat(F.lit("Datos "), number, F.lit(".XLSX"))).when(i % 4 == 1, F.lit("nota"))
                .when(i % 4 == 2, F.lit("")).otherwise(F.concat(F.lit(".oculto"), number, F.lit(".csv"))))
        return F.struct(name.alias("name"), line.cast("binary").alias("data"))

    mails = chats.select(
        message.alias("message"), F.concat(F.lit("/correo/"), message).alias("path"),
        F.when(F.col("role") != "system", F.col("role")).alias("subject"),
        F.when(F.col("conv_id") % 3 != 0, F.concat(F.lit("u"), F.col("conv_id").cast("string"), F.lit("@correo.example"))).alias("sender"),
        F.when(F.col("turn") % 2 != 0, F.col("turn").cast("string")).alias("date"),
        F.transform(F.split("text", "\n"), attachment).alias("attachments"))
    rows = messages.attachment_rows(mails)
    return rows.withColumn("becomes_input", F.col("is_data") & F.col("size_kb").isNotNull())


# Quoted records with breaks inside, written as one folder of files and read back in splits.
SAID = "concat(replace(replace(coalesce(text, ''), '. ', concat('.\"', chr(10), '\"')), ', ', ',\"\",'), CASE doc_id % 5 WHEN 0 THEN '\"' WHEN 1 THEN concat(chr(13), chr(10)) ELSE '' END)"


@query("quoted_files", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(lang, '') AS lang, length({SAID}) AS n_chars, md5({SAID}) AS said FROM documents""")
def quoted_files(spark, folder):
    docs = table(spark, folder, "documents").selectExpr("doc_id", "coalesce(lang, '') AS lang", f"{SAID} AS said")
    quoted = F.concat(F.lit('"'), F.replace("said", F.lit('"'), F.lit('""')), F.lit('"'))
    path = f"{shared_folder(spark)}/quoted-{uuid.uuid4().hex}"
    docs.select(F.concat_ws(",", F.col("doc_id").cast("string"), quoted, "lang")).write.text(path)
    fields = split_records.split_cells(split_records.split_records(spark, path, ",")).select("fields")
    return fields.select(F.col("fields")[0].alias("doc_id"), F.col("fields")[2].alias("lang"), F.length(F.col("fields")[1]).alias("n_chars"),
                         F.md5(F.col("fields")[1]).alias("said"))


# Profiles of a wide table: events as text with gaps, next to typed columns.
PROFILED = [
    "CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS person",
    "CASE WHEN event_id % 7 = 0 THEN 'n/d' WHEN event_id % 50 = 0 THEN NULL ELSE CAST(CAST(floor(value) AS BIGINT) AS STRING) END AS amount_text",
    "CASE WHEN event_id % 10 = 0 THEN '12' WHEN event_id % 50 = 5 THEN NULL ELSE event_type END AS kind_code",
    "nullif(event_type, 'error') AS kind",
    "CASE WHEN event_id % 11 = 0 THEN 'sin fecha' WHEN event_id % 3 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS STRING) END AS day_text",
    "CAST(NULL AS STRING) AS nothing",
    "CASE WHEN value > 100 THEN NULL ELSE value END AS amount",
    "CAST(ts AS DATE) AS day",
    "event_type = 'click' AS clicked",
]
PROFILED_NAMES = ["person", "amount_text", "kind_code", "kind", "day_text", "nothing", "amount", "day", "clicked"]
TEXT_NAMES = ["person", "amount_text", "kind_code", "kind", "day_text", "nothing"]
PROFILED_SQL = f"w AS (SELECT {', '.join(PROFILED)} FROM events)"
NUMBER_SQL = "regexp_matches({c}, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')"


def _profiled(spark, folder):
    return table(spark, folder, "events").selectExpr(*PROFILED)


def _count_numbers(c: str) -> str:
    return f"count(*) FILTER (WHERE {NUMBER_SQL.format(c=c)})" if c in TEXT_NAMES else "0"


def _count_dates(c: str) -> str:
    return f"count(*) FILTER (WHERE TRY_CAST({c} AS DATE) IS NOT NULL)" if c in TEXT_NAMES else "0"


COUNTS_SQL = "cc AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n, count({c}) AS present, {_count_numbers(c)} AS numbers, {_count_dates(c)} AS dates,"
    f" {({'amount': chr(39) + 'numérico' + chr(39), 'day': chr(39) + 'fecha' + chr(39), 'clicked': chr(39) + 'booleano' + chr(39)}).get(c, 'NULL')} AS declared"
    f" FROM w" for c in PROFILED_NAMES) + ")"


@query("profile_nulls", f"""
WITH {PROFILED_SQL}, {COUNTS_SQL} SELECT "column", {columnar_round_sql('(n - present) / n * 100.0::DOUBLE')} AS pct_null FROM cc""")
def profile_nulls(spark, folder):
    return PF.profile_nulls(_profiled(spark, folder))


@query("profile_types", f"""
WITH {PROFILED_SQL}, {COUNTS_SQL} SELECT "column", present, numbers, CASE WHEN present = 0 THEN 'vacío' WHEN declared IS NOT NULL THEN declared
  WHEN numbers > 0 THEN 'mixto' ELSE 'texto' END AS type FROM cc""")
def profile_types(spark, folder):
    return PF.profile_types(_profiled(spark, folder))


@query("infer_types", f"""
WITH {PROFILED_SQL}, {COUNTS_SQL} SELECT "column", present, numbers, CASE WHEN present = 0 THEN 'vacío' WHEN declared IS NOT NULL THEN declared
  WHEN numbers / present > 0.8 THEN 'numérico' WHEN dates / present > 0.8 THEN 'fecha' WHEN numbers > 0 THEN 'mixto' ELSE 'texto' END AS type FROM cc""")
def infer_types(spark, folder):
    return PF.profile_types(_profiled(spark, folder), infer=True)


@query("profile_rows", """
WITH w AS (SELECT nullif(event_type, 'error') AS a, CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN NULL ELSE value END AS b FROM events)
SELECT count(*) AS rows_total, count(*) FILTER (WHERE a IS NOT NULL OR b IS NOT NULL) AS rows_with_data,
  count(*) FILTER (WHERE a IS NULL AND b IS NULL) AS rows_blank FROM w""")
def profile_rows(spark, folder):
    return PF.profile_rows(table(spark, folder, "events").selectExpr(
        "nullif(event_type, 'error') AS a", "CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN NULL ELSE value END AS b"))


@query("profile_names", f"""
WITH n AS (SELECT doc_id, list_concat(string_split_regex(text, '\\s+'), ['Unnamed: 1', ' ', 'año (kg)']) AS names FROM documents)
SELECT doc_id, {round_sql('''len(list_filter(names, lambda x: trim(x) <> '' AND NOT starts_with(x, 'Unnamed')
  AND NOT regexp_matches(x, '[^a-zA-Z0-9áéíóúÁÉÍÓÚñÑüÜ _./()-]'))) / len(names) * 100.0::DOUBLE''', 1)} AS pct_clean FROM n""")
def profile_names(spark, folder):
    names = F.concat(F.split("text", r"\s+"), F.array(*[F.lit(x) for x in ("Unnamed: 1", " ", "año (kg)")]))
    return table(spark, folder, "documents").select("doc_id", PF.clean_percent(names).alias("pct_clean"))


# Cells of a sheet: the lines of a document, cut at ", "; leading, inner and some trailing rows are blank.
CELL_VALUE = """CASE WHEN r < doc_id % 4 OR r % 7 = 6 OR (doc_id % 13 = 0) THEN NULL WHEN c = 1 AND r > doc_id % 4 THEN CASE WHEN r % 11 = 9 THEN 'n/d' ELSE CAST(r * 10 + c AS STRING) END
  WHEN c = 2 AND r % 3 = 2 THEN CAST(r AS STRING) WHEN c = 3 THEN concat('2024-01-', lpad(CAST(1 + r % 28 AS STRING), 2, '0')) ELSE nullif(trim(v), '') END"""
CELLS_ONLY_SQL = f"""lines AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
rws AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS r FROM lines),
prt AS (SELECT doc_id, r, string_split(line, ', ') AS vs FROM rws),
cls0 AS (SELECT doc_id, r, unnest(vs) AS v, unnest(range(len(vs))) AS c FROM prt),
cells AS (SELECT doc_id AS file, 'datos' AS sheet, r AS "row", c AS col, {CELL_VALUE} AS value FROM cls0)"""
POSITIONS_SQL = """pos AS (SELECT file, sheet, min(CASE WHEN value IS NOT NULL THEN "row" END) AS header_row,
    max(CASE WHEN value IS NOT NULL THEN "row" END) AS last_row, max("row") + 1 AS rows_raw, max(col) + 1 AS width FROM cells GROUP BY ALL),
wid AS (SELECT file, sheet, header_row, unnest(range(width)) AS col FROM pos WHERE header_row IS NOT NULL),
nam AS (SELECT wid.file, wid.sheet, wid.col, coalesce(nullif(trim(cells.value), ''), concat('Col_', wid.col)) AS name
  FROM wid LEFT JOIN cells ON cells.file = wid.file AND cells.sheet = wid.sheet AND cells."row" = wid.header_row AND cells.col = wid.col),
hdr AS (SELECT file, sheet, string_agg(name, ' | ' ORDER BY col) AS names FROM nam GROUP BY ALL)"""
CELLS_SQL = f"{CELLS_ONLY_SQL},\n{POSITIONS_SQL}"


def _cells(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("r", "line"))
    parts = lines.select("doc_id", "r", F.posexplode(F.split("line", ", ")).alias("c", "v"))
    return parts.selectExpr("doc_id AS file", "'datos' AS sheet", "CAST(r AS BIGINT) AS row", "CAST(c AS BIGINT) AS col",
                            f"{CELL_VALUE} AS value")


@query("header_detect", f"""
WITH {CELLS_SQL} SELECT pos.file, pos.sheet, header_row, last_row, rows_raw, width, names,
  CAST(coalesce(last_row - header_row, 0) AS BIGINT) AS rows_total, coalesce(last_row - header_row, 0) = 0 AS is_blank
FROM pos LEFT JOIN hdr USING (file, sheet)""")
def header_detect(spark, folder):
    sheets, _ = PF.promote_header(_cells(spark, folder))
    return sheets.withColumn("names", F.array_join("names", " | "))


def _sheet_sql(infer: bool) -> str:
    """From cells and header positions to a profile of each column."""
    return f"""sh AS (SELECT *, coalesce(last_row - header_row, 0) AS rows_total, coalesce(last_row - header_row, 0) = 0 AS is_blank FROM pos),
bod AS (SELECT cells.* FROM cells JOIN sh USING (file, sheet) WHERE "row" > header_row AND "row" <= last_row),
cnt AS (SELECT file, sheet, col, count(value) AS present, count(*) FILTER (WHERE {NUMBER_SQL.format(c='value')}) AS numbers,
  count(*) FILTER (WHERE regexp_matches(value, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')) AS dates FROM bod GROUP BY ALL),
prf AS (SELECT nam.file, nam.sheet, nam.col, name, rows_total, coalesce(present, 0) AS present, coalesce(numbers, 0) AS numbers, coalesce(dates, 0) AS dates
  FROM nam JOIN sh USING (file, sheet) LEFT JOIN cnt ON cnt.file = nam.file AND cnt.sheet = nam.sheet AND cnt.col = nam.col WHERE NOT is_blank),
typ0 AS (SELECT *, CASE WHEN present = 0 THEN 'vacío' {'' if not infer else "WHEN numbers / present > 0.8 THEN 'numérico' WHEN dates / present > 0.8 THEN 'fecha'"}
  WHEN numbers > 0 THEN 'mixto' ELSE 'texto' END AS type FROM prf),
typ1 AS (SELECT *, CASE type WHEN 'numérico' THEN numbers WHEN 'fecha' THEN dates ELSE present END AS remaining FROM typ0),
typ AS (SELECT *, {columnar_round_sql('(rows_total - remaining) / rows_total * 100.0::DOUBLE')} AS pct_null FROM typ1),
fil AS (SELECT bod.file, bod.sheet, count(DISTINCT "row") AS filled FROM bod JOIN typ ON typ.file = bod.file AND typ.sheet = bod.sheet AND typ.col = bod.col
  WHERE value IS NOT NULL AND CASE type WHEN 'numérico' THEN {NUMBER_SQL.format(c='value')}
    WHEN 'fecha' THEN regexp_matches(value, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') ELSE true END GROUP BY ALL),
agg AS (SELECT file, sheet, string_agg(CASE WHEN type = 'mixto' THEN name END, ' | ' ORDER BY col) AS mixed, floor(sum(pct_null) * 10 + 0.5) / 10.0::DOUBLE / count(*) AS mean_null,
  count(*) FILTER (WHERE trim(name) <> '' AND NOT starts_with(name, 'Unnamed')
    AND NOT regexp_matches(name, '[^a-zA-Z0-9áéíóúÁÉÍÓÚñÑüÜ _./()-]')) AS clean, count(*) AS n FROM typ GROUP BY ALL)"""


SHEET_SQL = f"{CELLS_SQL},\n{_sheet_sql(True)}"


@query("sheet_summary", f"""
WITH {SHEET_SQL}
SELECT sh.file, sh.sheet, is_blank, CAST(coalesce(header_row, 0) AS BIGINT) AS header_row, coalesce(header_row, 0) = 0 AS header_in_row1,
  CASE WHEN is_blank THEN 0 ELSE width END AS num_columns, coalesce(filled, 0) AS rows_with_data,
  CASE WHEN is_blank THEN 0 ELSE rows_total - coalesce(filled, 0) END AS rows_blank,
  coalesce({round_sql('clean / n * 100.0::DOUBLE', 1)}, 0) AS pct_clean, coalesce(mixed, '') AS mixed_columns,
  CASE WHEN is_blank THEN '' ELSE substr(names, 1, 500) END AS columns, CASE WHEN is_blank THEN '' ELSE names END AS columns_all, {H('mean_null', 4)} AS mean_null
FROM sh LEFT JOIN hdr USING (file, sheet) LEFT JOIN fil USING (file, sheet) LEFT JOIN agg USING (file, sheet)""")
def sheet_summary(spark, folder):
    sheets, body = PF.promote_header(_cells(spark, folder))
    return PF.sheet_summary(sheets, body).withColumn("mean_null", half_up(F.col("mean_null"), 4))


METRICS_SQL = f"""pc AS (SELECT *, coalesce({round_sql('clean / n * 100.0::DOUBLE', 1)}, 0) AS pct_clean FROM sh LEFT JOIN agg USING (file, sheet)),
tf AS (SELECT file, CAST(count(*) AS INTEGER) AS total_columns, CAST(count(*) FILTER (WHERE type = 'mixto') AS INTEGER) AS mixed,
    floor(sum(pct_null) * 10 + 0.5) / 10.0::DOUBLE / count(*) AS mean_null,
    bool_or(type = 'fecha' AND regexp_matches(lower(name), 'fecha|date|period|mes|month')) AS dated,
    string_agg(name, ' | ' ORDER BY sheet, col) AS names FROM typ GROUP BY file),
sf AS (SELECT file, CAST(count(*) AS INTEGER) AS sheets, CAST(count(*) FILTER (WHERE is_blank) AS INTEGER) AS blank_sheets,
    CAST(count(*) FILTER (WHERE NOT is_blank) AS INTEGER) AS sheets_with_data,
    CAST(count(*) FILTER (WHERE NOT is_blank AND coalesce(header_row, 0) = 0) AS INTEGER) AS header_ok,
    CAST(max(coalesce(header_row, 0)) AS INTEGER) AS leading_blank,
    coalesce(floor(sum(CASE WHEN NOT is_blank THEN pct_clean END) * 10 + 0.5) / 10.0::DOUBLE / nullif(count(*) FILTER (WHERE NOT is_blank), 0), 0) AS mean_clean
  FROM pc GROUP BY file)"""


@query("file_metrics", f"""
WITH {SHEET_SQL},
{METRICS_SQL}
SELECT sf.*, coalesce(total_columns, 0) AS total_columns, coalesce(mixed, 0) AS mixed, {H('mean_null', 4)} AS mean_null,
  coalesce(dated, false) AS has_date_column, coalesce(names, '') AS columns FROM sf LEFT JOIN tf USING (file)""")
def file_metrics(spark, folder):
    sheets, body = PF.promote_header(_cells(spark, folder))
    found = PF.file_metrics(PF.sheet_summary(sheets, body), PF.column_profile(sheets, body))
    return found.withColumn("mean_null", half_up(F.col("mean_null"), 4)).withColumn("columns", F.array_join("columns", " | "))


@query("schema_consistency", f"""
WITH s AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, list(DISTINCT event_type) AS names FROM events GROUP BY ALL),
f AS (SELECT user_id, arg_min(names, day) AS ref FROM s GROUP BY user_id)
SELECT user_id AS "group", count(*) AS sheets, {H('avg(len(list_intersect(names, ref)) / greatest(len(list_distinct(list_concat(names, ref))), 1))')} AS similarity,
  CASE WHEN avg(len(list_intersect(names, ref)) / greatest(len(list_distinct(list_concat(names, ref))), 1)) >= 0.95 THEN 1
       WHEN avg(len(list_intersect(names, ref)) / greatest(len(list_distinct(list_concat(names, ref))), 1)) >= 0.80 THEN 2
       WHEN avg(len(list_intersect(names, ref)) / greatest(len(list_distinct(list_concat(names, ref))), 1)) >= 0.50 THEN 3 ELSE 10 END AS level
FROM s JOIN f USING (user_id) GROUP BY user_id""")
def schema_consistency(spark, folder):
    sheets = (table(spark, folder, "events").groupBy(F.col("user_id").alias("group"), F.to_date("ts").cast("string").alias("day"))
              .agg(F.collect_set("event_type").alias("columns")))
    found = PF.schema_consistency(sheets, "group", ["day"])
    return found.select("group", "sheets", half_up(F.col("similarity"), 6).alias("similarity"),
                        SC.graded(F.col("similarity"), ((0.95, 1), (0.80, 2), (0.50, 3)), 10).alias("level"))


@query("group_membership", """
WITH f AS (SELECT CASE WHEN user_id = 0 THEN concat('E', event_id) ELSE concat('U', user_id) END AS "group", concat('carpeta/', event_type, '/f', lpad(CAST(event_id AS VARCHAR), 9, '0'), '.csv') AS path
  FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY path) AS i FROM f)
SELECT "group", count(*) AS files, count(*) > 1 AS evaluable,
  string_agg(CASE WHEN i <= 15 THEN split_part(path, '/', 3) END, ' | ' ORDER BY path) || CASE WHEN count(*) > 15 THEN '...' ELSE '' END AS names
FROM r GROUP BY "group" """)
def group_membership(spark, folder):
    # Each event of user 0 is a group of its own, so there are groups of one file.
    group = F.expr("CASE WHEN user_id = 0 THEN concat('E', CAST(event_id AS STRING)) ELSE concat('U', CAST(user_id AS STRING)) END")
    files = table(spark, folder, "events").select(group.alias("group"),
                        F.concat(F.lit("carpeta/"), "event_type", F.lit("/f"), F.lpad(F.col("event_id").cast("string"), 9, "0"),
                                 F.lit(".csv")).alias("path"))
    return PF.group_membership(files)


# A file is a document: all words of its text, plus some marked ones, are its column names.
FILE = [
    "doc_id",
    "concat(lang, '/', CAST(doc_id AS STRING)) AS path",
    "CASE doc_id % 6 WHEN 0 THEN concat('venta_2024-0', CAST(1 + doc_id % 9 AS STRING), '_', CAST(doc_id AS STRING), '.csv')"
    " WHEN 1 THEN concat('cliente ', CAST(doc_id AS STRING), '.xlsx') WHEN 2 THEN '2024-03-15.txt' WHEN 3 THEN concat('reporte q2-2024 ', source, '.csv')"
    " WHEN 4 THEN concat('stock', CAST(doc_id AS STRING), '.xls') ELSE concat('doc', CAST(doc_id AS STRING)) END AS name",
    "CASE WHEN doc_id % 7 = 0 THEN 'pedido del customer' WHEN doc_id % 7 = 1 THEN 'hola' ELSE '' END AS subject",
    "CASE WHEN doc_id % 5 = 0 THEN 'ana@example.org' ELSE '' END AS sender",
    "CASE WHEN doc_id % 8 = 0 THEN '2024-01-05' ELSE NULL END AS message_date",
    "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE '2024-01-01 10:00' END AS mtime",
    "CASE WHEN doc_id % 4 = 0 THEN '.' ELSE lang END AS subfolder",
    "CASE WHEN doc_id % 10 = 0 THEN 'SIN_GRUPO' ELSE source END AS grp",
    "CAST(1 + doc_id % 4 AS INT) AS group_files",
    "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(doc_id % 21 AS DOUBLE) / 20 END AS similarity",
    "doc_id % 8 = 0 AS from_mail",
    "concat(text, CASE doc_id % 12 WHEN 0 THEN ' sku_prod fecha' WHEN 1 THEN ' d56 uom' WHEN 2 THEN ' unidad_medida' WHEN 3 THEN ' qty valor usd'"
    " WHEN 4 THEN ' qty cantidad precio monto $' WHEN 5 THEN ' cliente ventas' WHEN 6 THEN ' saldo amount' WHEN 7 THEN ' codprod' ELSE '' END) AS body",
    "doc_id % 9 = 0 AS has_date_column",
    "CAST(doc_id * 7 % 101 AS DOUBLE) AS mean_clean",
    "doc_id % 31 = 0 AS has_password",
    "CASE WHEN doc_id % 11 = 0 THEN 'archivo ilegible' ELSE NULL END AS error",
    "CAST(doc_id % 6 AS INT) AS sheets",
    "CAST(doc_id % 6 AS INT) AS num_sheets",
    "CAST(CASE WHEN doc_id % 2 = 0 THEN doc_id % 6 ELSE floor(doc_id % 6 / 2) END AS INT) AS sheets_with_data",
    "doc_id % 14 = 0 AS has_pivot",
    "doc_id % 21 < 4 AS has_table",
    "CAST(CASE WHEN doc_id % 5 = 1 THEN doc_id % 70 ELSE 0 END AS INT) AS merged",
    "CAST(CASE WHEN doc_id % 4 = 1 THEN doc_id % 8 ELSE 0 END AS INT) AS mixed",
    "CAST(CASE WHEN doc_id % 6 = 5 THEN doc_id % 9 ELSE 0 END AS INT) AS leading_blank",
    "CAST(CASE WHEN doc_id % 2 = 0 THEN doc_id % 6 ELSE floor(doc_id % 6 / 2) END AS INT) - CAST(CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END AS INT) AS header_ok",
    "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE CAST(n_chars % 90 AS DOUBLE) / 3 END AS mean_null",
    "CAST(n_chars % 40 AS INT) AS formulas",
    "CASE WHEN doc_id % 6 = 4 THEN 'xls' ELSE 'csv' END AS format",
    "CASE WHEN doc_id % 8 = 0 THEN 'adjunto' ELSE 'directo' END AS origin",
]


def _files(spark, folder):
    return (table(spark, folder, "documents").selectExpr(*FILE).withColumn("columns", F.split("body", r"\s+"))
            .withColumnRenamed("grp", "group"))


def _any(words) -> str:
    return "(?i)(" + "|".join(words).replace(r"(?!\d)", r"(\D|$)").replace("'", "''") + ")"


def _has(text: str, words) -> str:
    return f"regexp_matches({text}, '{_any(words)}')"


def _one(words) -> str:
    return f"len(list_filter(cols, lambda x: regexp_matches(x, '{_any(words)}'))) > 0"


def _count(words) -> str:
    return f"len(list_filter(cols, lambda x: regexp_matches(x, '{_any(words)}')))"


SQL_PURPOSE = [*P.SALES_WORDS, *P.STOCK_WORDS, *P.PURCHASE_WORDS]
CURRENCY_SQL = _has("concat_ws(' ', name, subject, sender, every, subfolder)", P.CURRENCY_WORDS)
DATED_SQL = _has("name", P.DATE_IN_NAME)
TIDY_SQL = "leading_blank = 0 AND merged = 0 AND mixed = 0 AND header_ok = sheets_with_data"
LEVEL_SQL = {
    "A": f"CASE WHEN {_one(P.DATE_COLUMN)} THEN 0 WHEN {DATED_SQL} THEN 1 WHEN message_date IS NOT NULL THEN 2 WHEN mtime IS NOT NULL THEN 3 ELSE 4 END",
    "B": f"CASE WHEN {_has('every', P.CLIENT_WORDS)} THEN 0 WHEN {_has('name', P.CLIENT_WORDS)} OR {_has('subject', P.CLIENT_WORDS)} THEN 1"
         " WHEN contains(sender, '@') THEN 2 WHEN grp <> 'SIN_GRUPO' THEN 3 ELSE 4 END",
    "C": f"CASE WHEN has_date_column THEN 0 WHEN {_has('every', P.PERIOD_WORDS)} THEN 1 WHEN {DATED_SQL} THEN"
         " CASE WHEN length(regexp_replace(name, '[\\s_\\-]?[0-9]{4}[-_]?[0-9]{0,2}', '', 'g')) < length(name) * 0.6 THEN 3 ELSE 4 END ELSE 5 END",
    "D": "CASE WHEN group_files >= 3 THEN 0 WHEN from_mail THEN 2 ELSE 1 END",
    "E": "CASE WHEN group_files > 1 AND similarity IS NOT NULL THEN CASE WHEN similarity >= 0.95 THEN 1 WHEN similarity >= 0.8 THEN 2"
         " WHEN similarity >= 0.5 THEN 3 ELSE 10 END WHEN mean_clean >= 80 THEN 1 WHEN mean_clean >= 40 THEN 3 ELSE 10 END",
    "F": "CASE WHEN from_mail THEN 2 WHEN subfolder <> '.' THEN 1 ELSE 3 END",
    "G": "CASE WHEN has_password THEN 0 WHEN error IS NOT NULL AND sheets = 0 THEN 10 WHEN error IS NOT NULL THEN 2 ELSE 1 END",
    "H": "CASE WHEN num_sheets = 1 AND sheets_with_data = 1 THEN 0 WHEN sheets_with_data = num_sheets THEN 1 WHEN sheets_with_data < num_sheets THEN 2 ELSE 3 END",
    "I": "CASE WHEN has_pivot AND has_table THEN 3 WHEN has_pivot THEN 2 WHEN has_table THEN 1 WHEN sheets_with_data > 0 THEN 0 ELSE 10 END",
    "J": f"CASE WHEN {TIDY_SQL} THEN CASE WHEN coalesce(mean_null, 0) < 5 THEN 0 ELSE 1 END WHEN leading_blank > 0 AND leading_blank <= 5 THEN 2"
         " WHEN leading_blank > 5 THEN 3 WHEN merged > 20 THEN 4 ELSE 1 END",
    "K": "CASE WHEN merged > 50 OR mixed > 5 THEN 3 WHEN has_pivot THEN 2 WHEN merged > 10 OR mixed > 2 THEN 1 ELSE 0 END",
    "L": f"CASE WHEN {_one(P.OWN_PRODUCT_CODE)} THEN 0 WHEN {_one(P.MAKER_PRODUCT_CODE)} THEN 1 WHEN {_one(P.CLIENT_PRODUCT_CODE)} THEN 2"
         f" WHEN {_has('every', P.PRODUCT_WORDS)} THEN 3 ELSE 4 END",
    "M": f"CASE WHEN {_count(P.UNIT_WORDS)} = 1 THEN 0 WHEN {_count(P.UNIT_WORDS)} > 1 THEN 1 WHEN {_one(P.UNIT_OF_MEASURE)} THEN 2 ELSE 3 END",
    "N": f"CASE WHEN {_has('every', SQL_PURPOSE)} THEN CASE WHEN {_has('concat(name, subject)', SQL_PURPOSE)} THEN 0 ELSE 1 END ELSE 2 END",
    "O": f"CASE WHEN {_count(P.VALUE_WORDS)} = 1 AND {CURRENCY_SQL} THEN 0 WHEN {_count(P.VALUE_WORDS)} > 1 AND {CURRENCY_SQL} THEN 1"
         f" WHEN {_count(P.VALUE_WORDS)} > 0 THEN 2 ELSE 3 END",
}
LEVELS_CTE = f"""fl0 AS (SELECT {', '.join(FILE)} FROM documents),
fl AS (SELECT *, string_split_regex(body, '\\s+') AS cols, array_to_string(string_split_regex(body, '\\s+'), ' ') AS every FROM fl0),
lv AS (SELECT * EXCLUDE (cols, every, body), {', '.join(f'CAST({s} AS INTEGER) AS level_{c}' for c, s in LEVEL_SQL.items())} FROM fl)"""
LEVEL_NAMES = [f"level_{c}" for c in CODES]


def _levels(spark, folder):
    return SC.rule_levels(_files(spark, folder)).drop("columns", "body")


@query("rule_levels", f"WITH {LEVELS_CTE} SELECT path, name, {', '.join(LEVEL_NAMES)} FROM lv")
def rule_levels(spark, folder):
    return _levels(spark, folder).select("path", "name", *LEVEL_NAMES)


def _points_sql(r, level: str) -> str:
    return f"(1.0::DOUBLE - least({level}, {r.max_level}) / {r.max_level}.0::DOUBLE) * {r.weight}.0::DOUBLE / {TOTAL_WEIGHT}.0::DOUBLE * 100.0::DOUBLE"


def _blocked_sql(r, level: str) -> str:
    return f"{level} = 10" if r.ceiling is not None else "false"


CAPS = sorted([r for r in RULES if r.ceiling is not None], key=lambda r: r.ceiling)
# Some levels are taken away, so that rules are weighed up; every eleventh document keeps none.
GAPS = {"B": "doc_id % 5 = 2", "K": "doc_id % 7 = 3"}
GAP_CTE = "gl AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN doc_id % 100 = 7 OR {GAPS.get(c, 'false')} THEN NULL ELSE level_{c} END AS level_{c}" for c in CODES) + ") FROM lv)"
SCORE_TAIL = f"""pt AS (SELECT *, {', '.join(f"CASE WHEN level_{r.code} IS NULL THEN NULL WHEN {_blocked_sql(r, 'level_' + r.code)} THEN 0 ELSE {round_sql(_points_sql(r, 'level_' + r.code), 2)} END AS points_{r.code}" for r in RULES)},
  {' + '.join(f"CASE WHEN level_{r.code} IS NULL THEN 0 ELSE {r.weight} END" for r in RULES)} AS used_weight,
  CASE {' '.join(f'WHEN level_{r.code} = 10 THEN {r.ceiling}' for r in CAPS)} ELSE 100 END AS cap,
  CASE {' '.join(f"WHEN level_{r.code} = 10 THEN '{r.code}'" for r in CAPS)} END AS blocker FROM gl),
sm AS (SELECT *, {H(' + '.join(f'coalesce(points_{c}, 0.0::DOUBLE)' for c in CODES), 2)} AS total FROM pt),
sc0 AS (SELECT *, CASE WHEN used_weight > 0 THEN CAST(least(least({round_sql(f'total * ({TOTAL_WEIGHT}.0::DOUBLE / greatest(used_weight, 1))', 1)}, 100), cap) AS DOUBLE) ELSE 0 END AS score FROM sm),
sc AS (SELECT * EXCLUDE (blocker), CASE WHEN used_weight = 0 THEN '⛔ No evaluable' {' '.join(f"WHEN score >= {b} THEN '{t}'" for b, t in CATEGORIES[:-1])} ELSE '{CATEGORIES[-1][1]}' END AS category,
  CASE WHEN used_weight > 0 THEN blocker END AS blocked_by FROM sc0)"""
SCORE_CTE = f"{LEVELS_CTE}, {GAP_CTE},\n{SCORE_TAIL}"


def _gapped(files):
    return files.withColumns({f"level_{c}": F.expr(
        f"CASE WHEN doc_id % 100 = 7 OR {GAPS.get(c, 'false')} THEN NULL ELSE level_{c} END") for c in CODES})


def _scored(spark, folder):
    return SC.score_files(_gapped(_levels(spark, folder)))


@query("score_rules", f"WITH {SCORE_CTE} SELECT path, {', '.join(f'points_{c}' for c in CODES)}, score, category, blocked_by FROM sc")
def score_rules(spark, folder):
    return _scored(spark, folder).select("path", *[f"points_{c}" for c in CODES], "score", "category", "blocked_by")


# An analyst changed two levels of some files.
OVERRIDES = ["CASE WHEN doc_id % 3 <> 0 THEN concat(lang, '/', CAST(doc_id AS STRING)) END AS path", "CASE WHEN doc_id % 2 = 0 THEN 'E' ELSE 'L' END AS code",
             "CAST(CASE WHEN doc_id % 10 = 4 THEN 10 ELSE doc_id % 4 END AS INT) AS level"]


@query("score_override", f"""
WITH {LEVELS_CTE}, {GAP_CTE}, ov AS (SELECT {', '.join(OVERRIDES)} FROM documents),
us AS (SELECT gl.path, {', '.join(f"coalesce(max(CASE WHEN code = '{c}' THEN level END), any_value(level_{c}), 0) AS u_{c}" for c in CODES)}
  FROM gl LEFT JOIN ov ON gl.path = ov.path GROUP BY gl.path)
SELECT path, {', '.join(f'u_{c} AS used_{c}' for c in CODES)}, least({H(' + '.join(f"CASE WHEN {_blocked_sql(r, 'u_' + r.code)} THEN 0 ELSE {_points_sql(r, 'u_' + r.code)} END" for r in RULES), 1)},
  {', '.join(f'CASE WHEN u_{r.code} = 10 THEN {r.ceiling} ELSE 100 END' for r in CAPS)}) AS override_score FROM us""")
def score_override(spark, folder):
    given = table(spark, folder, "documents").selectExpr(*OVERRIDES)
    return SC.score_with_overrides(_gapped(_levels(spark, folder)), given).select(
        "path", *[f"used_{c}" for c in CODES], "override_score")


RULE_ROWS = ", ".join(
    f"('{r.code}', '{r.description}', {r.weight}, {n}, '{t}', {str(r.ceiling is not None).lower()}, {r.ceiling or 'NULL'}, {str(r.measured).lower()})"
    for r in RULES for n, t in r.levels.items())


@query("rule_reference", f"""
WITH {LEVELS_CTE}, ru(code, rule, weight, level, level_text, blocking, ceiling, measured) AS (VALUES {RULE_ROWS}),
us AS ({' UNION ALL '.join(f"SELECT '{c}' AS code, level_{c} AS level, count(*) AS files FROM lv GROUP BY ALL" for c in CODES)})
SELECT code, rule, weight, level, level_text, blocking, ceiling, measured, coalesce(files, 0) AS files FROM ru LEFT JOIN us USING (code, level)""")
def rule_reference(spark, folder):
    return SC.level_usage(_levels(spark, folder), SC.rule_table(spark))


@query("score_report", f"""
WITH {SCORE_CTE} SELECT path, substr(name, 1, 40) AS name, name AS full_name, grp AS "group", format, origin, {', '.join(LEVEL_NAMES)},
  {', '.join(f"{c in 'ACEGHIJKN'} AS measured_{c}" for c in CODES)}, score, category,
  coalesce(blocked_by, '') AS blocked_by FROM sc""")
def score_report(spark, folder):
    return R.score_report(_scored(spark, folder))


@query("category_distribution", f"""
WITH {SCORE_CTE}, ct(place, category) AS (VALUES {', '.join(f"({i}, '{t}')" for i, t in enumerate([t for _, t in CATEGORIES] + ['⛔ No evaluable']))})
SELECT place, category, (SELECT count(*) FROM sc WHERE sc.category = ct.category) AS files FROM ct""")
def category_distribution(spark, folder):
    return R.category_distribution(_scored(spark, folder))


@query("score_kpis", f"""
WITH {SCORE_CTE} SELECT {round_sql(H('sum(score)', 1) + ' / count(*)', 1)} AS mean_score, max(score) AS best_score, min(score) AS worst_score,
  count(*) AS files FROM sc""")
def score_kpis(spark, folder):
    return R.score_kpis(_scored(spark, folder))


@query("score_by_group", f"""
WITH {SCORE_CTE} SELECT grp AS "group", count(*) AS files, {round_sql(H('sum(score)', 1) + ' / count(*)', 1)} AS mean_score, min(score) AS worst_score,
  max(score) AS best_score FROM sc GROUP BY grp ORDER BY sum(score) / count(*) DESC, grp""")
def score_by_group(spark, folder):
    return R.score_by_group(_scored(spark, folder))


@query("score_ranking", f"""
WITH {SCORE_CTE} SELECT path, score, category FROM sc ORDER BY score DESC, path""")
def score_ranking(spark, folder):
    return sort_rows(_scored(spark, folder).select("path", "score", "category"), [("score", False), ("path", True)])


@query("top_bottom_k", f"""
WITH {SCORE_CTE}, r AS (SELECT path, substr(name, 1, 40) AS name, grp AS "group", format, score, category, coalesce(blocked_by, '') AS blocked_by, row_number() OVER (ORDER BY score DESC, path) AS up,
  row_number() OVER (ORDER BY score, path DESC) AS down FROM sc)
SELECT 'top' AS list, up AS place, path, name, "group", format, score, category, blocked_by FROM r WHERE up <= 5
UNION ALL SELECT 'bottom', down, path, name, "group", format, score, category, blocked_by FROM r WHERE down <= 5""")
def top_bottom_k(spark, folder):
    scored = _scored(spark, folder).select("path", F.left("name", F.lit(40)).alias("name"), "group", "format", "score", "category",
                                          F.coalesce("blocked_by", F.lit("")).alias("blocked_by"))
    return top_and_bottom(scored, "score", "path")


@query("error_listing", f"""
WITH {LEVELS_CTE}, e AS (SELECT path, error, row_number() OVER (ORDER BY path) AS i FROM fl WHERE error IS NOT NULL)
SELECT 'row' AS kind, path, error, NULL::BIGINT AS beyond FROM e WHERE i <= 50 UNION ALL SELECT 'beyond', NULL, NULL, greatest(count(*) - 50, 0) FROM e""")
def error_listing(spark, folder):
    """The first 50 errors as the report lists them, and how many more there are."""
    errors = _files(spark, folder).filter("error IS NOT NULL").select("path", "error")
    first, beyond = R.excerpt(errors, ["path"], 50)
    return stack([first.withColumn("kind", F.lit("row")), beyond.withColumn("kind", F.lit("beyond"))]).select("kind", "path", "error", F.col("beyond").cast("long"))


EIGHT = """doc_id, CAST(doc_id % 6 AS INT) AS sheets, CAST(CASE WHEN doc_id % 4 = 0 THEN doc_id % 6 ELSE floor(doc_id % 6 / 2) END AS INT) AS blank_sheets,
  CAST(doc_id % 6 AS INT) AS num_sheets, CAST(doc_id % 3 AS INT) AS header_raw, CAST(n_chars % 33 AS INT) AS merged,
  CAST(n_chars % 77 AS INT) AS formulas, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE CAST(n_chars % 101 AS DOUBLE) END AS mean_null,
  CAST(n_chars % 9 AS INT) AS mixed, CAST(9 + doc_id % 5 AS INT) AS total_columns, CAST(n_chars % 1000 AS DOUBLE) / 10 AS mean_clean"""


@query("score_eight", f"""
WITH e0 AS (SELECT {EIGHT} FROM documents),
e AS (SELECT *, sheets - blank_sheets AS wd, least(header_raw, sheets - blank_sheets) AS ok, greatest(sheets - blank_sheets, 1) AS m FROM e0),
p AS (SELECT doc_id, {', '.join(f"CASE WHEN wd > 0 THEN CAST(round_even({x}, 0) AS INTEGER) ELSE 0 END AS points_{n}" for n, x in {
    "structure": "20.0::DOUBLE * (ok / m) * (1.0::DOUBLE - least(1.0::DOUBLE, merged / 20.0::DOUBLE) * 0.5::DOUBLE)",
    "no_formulas": "15.0::DOUBLE * (1.0::DOUBLE - least(1.0::DOUBLE, formulas / 50.0::DOUBLE))",
    "few_nulls": "20.0::DOUBLE * greatest(0.0::DOUBLE, 1.0::DOUBLE - coalesce(mean_null, 0) / 100.0::DOUBLE)",
    "same_types": "15.0::DOUBLE * (1.0::DOUBLE - mixed / greatest(total_columns, 1))",
    "clean_names": "10.0::DOUBLE * mean_clean / 100.0::DOUBLE",
    "one_table": "10.0::DOUBLE * (ok / m)",
    "no_blank_sheets": "5.0::DOUBLE * (1.0::DOUBLE - least(1.0::DOUBLE, blank_sheets / greatest(sheets, 1)))",
    "few_sheets": "5.0::DOUBLE * greatest(0.0::DOUBLE, 1.0::DOUBLE - (num_sheets - 1) / 10.0::DOUBLE)"}.items())} FROM e),
t AS (SELECT *, {' + '.join(f'points_{c}' for c in CRITERIA)} AS score FROM p)
SELECT *, CASE WHEN score >= 80 THEN '🟢 Alta' WHEN score >= 55 THEN '🟡 Media' WHEN score >= 30 THEN '🟠 Baja' ELSE '🔴 Muy baja' END AS category FROM t""")
def score_eight(spark, folder):
    files = table(spark, folder, "documents").selectExpr(*[p for p in _split_list(EIGHT)])
    ok = F.least("header_raw", F.col("sheets") - F.col("blank_sheets"))
    scored = SC.score_eight(files.withColumn("header_ok", ok).withColumn("from_first_cell", ok))
    return scored.select("doc_id", *[f"points_{c}" for c in CRITERIA], "score", "category")


def _split_list(text: str) -> list[str]:
    """Items of a select list, cut at the commas outside parentheses."""
    out, depth, item = [], 0, ""
    for ch in text:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(item)
            item = ""
        else:
            item += ch
    return [*out, item]


@query("score_presence", """
SELECT doc_id, CAST(CASE WHEN quality IS NOT NULL THEN 100 ELSE 0 END AS INTEGER) AS score,
  CASE WHEN quality IS NOT NULL THEN '🟢 Alta' ELSE '🔴 Muy baja' END AS category FROM documents LEFT JOIN labels USING (doc_id)""")
def score_presence(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    files = docs.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left")
    return SC.score_presence(files.withColumn("sheets", F.when(F.col("quality").isNotNull(), 1).otherwise(0))).select(
        "doc_id", "score", "category")


@query("report_tables", f"""
WITH {SCORE_CTE}, ct(place, category) AS (VALUES {', '.join(f"({i}, '{t}')" for i, t in enumerate([t for _, t in CATEGORIES] + ['⛔ No evaluable']))})
SELECT 'scoring' AS report, path AS item, CAST(score AS VARCHAR) AS value FROM sc
UNION ALL SELECT 'categorias', category, CAST((SELECT count(*) FROM sc WHERE sc.category = ct.category) AS VARCHAR) FROM ct
UNION ALL SELECT 'grupos', grp, CAST(count(*) AS VARCHAR) FROM sc GROUP BY grp
UNION ALL SELECT 'errores', path, error FROM fl WHERE error IS NOT NULL AND num_sheets = 0""")
def report_tables(spark, folder):
    scored = staged(_scored(spark, folder), "scored")
    _, errors = FL.split_errors(_files(spark, folder))
    tables = {"scoring": R.score_report(scored), "categorias": R.category_distribution(scored), "grupos": R.score_by_group(scored),
              "errores": errors.select("path", "name", "error")}
    paths = sinks.write_report(tables, f"{shared_folder(spark)}/report_tables-{uuid.uuid4().hex}")
    shown = {"scoring": ("path", "score"), "categorias": ("category", "files"), "grupos": ("group", "files"), "errores": ("path", "error")}
    return stack([spark.read.parquet(paths[n]).select(F.lit(n).alias("report"), F.col(item).alias("item"), F.col(value).cast("string").alias("value"))
                  for n, (item, value) in shown.items()])


# The whole job, from contents to scores: a file is a document, its bytes in one of two encodings.
JOB_FILE = [
    "concat('carpeta/', CAST(doc_id AS STRING), '_', lang, CASE doc_id % 3 WHEN 0 THEN ' ventas 2024-03-15.csv' WHEN 1 THEN ' stock.txt' ELSE '.csv' END) AS path",
    "concat(CAST(doc_id AS STRING), '_', lang, CASE doc_id % 3 WHEN 0 THEN ' ventas 2024-03-15.csv' WHEN 1 THEN ' stock.txt' ELSE '.csv' END) AS name",
    "CASE WHEN doc_id % 4 = 0 THEN '.' ELSE source END AS subfolder",
    "CASE WHEN doc_id % 7 = 0 THEN 'pedido del customer' ELSE '' END AS subject",
    "CASE WHEN doc_id % 5 = 0 THEN 'ana@example.org' ELSE '' END AS sender",
    "CASE WHEN doc_id % 8 = 0 THEN '2024-01-05' ELSE NULL END AS message_date",
    "CASE WHEN doc_id % 3 = 0 THEN NULL ELSE '2024-01-01 10:00' END AS mtime",
    "CASE WHEN doc_id % 8 = 0 THEN 'adjunto' ELSE 'directo' END AS origin",
    "CASE WHEN doc_id % 3 = 1 THEN 'txt' ELSE 'csv' END AS format",
]
JOB_BODY = """CASE WHEN doc_id % 29 = 0 THEN '' ELSE concat(CASE doc_id % 5 WHEN 0 THEN concat('fecha;cliente;qty;valor;', lang, chr(10)) WHEN 1 THEN concat('sku,unidades,precio,', lang, chr(10)) ELSE '' END,
  CASE doc_id % 5 WHEN 0 THEN concat('2024-01-05;uno;3;NA;z', chr(10), chr(10), '2024-01-06;dos;x;4;', chr(10), '1;2;3;4;5;6', chr(10)) ELSE '' END, replace(replace(text, '"', ''), ', ', CASE doc_id % 5 WHEN 0 THEN ';' ELSE ',' END)) END"""
SEPARATOR_SQL = f"""l AS (SELECT *, list_filter(list_slice(string_split_regex(body, '\\r\\n|[\\n\\r]'), 1, 5), lambda x: regexp_matches(x, '\\S')) AS head FROM b),
c AS (SELECT *, {', '.join(f"list_transform(head, lambda x: length(x) - length(replace(x, {q}, '')) + 1) AS c{i}" for i, q in enumerate(["','", "chr(9)", "';'", "'|'"]))} FROM l),
k AS (SELECT *, {', '.join(f"CASE WHEN list_min(c{i}) = list_max(c{i}) THEN list_max(c{i}) ELSE 0 END AS k{i}" for i in range(4))} FROM c),
sp AS (SELECT *, CASE WHEN greatest(k0, k1, k2, k3) = 0 OR k0 >= greatest(k1, k2, k3) THEN ',' WHEN k1 >= greatest(k2, k3) THEN chr(9)
       WHEN k2 >= k3 THEN ';' ELSE '|' END AS separator FROM k)"""
MISSING_SQL = ", ".join(f"'{t}'" for t in delimited.MISSING_TEXTS)
JOB_CTE = f"""fi AS (SELECT doc_id, {', '.join(JOB_FILE)}, {JOB_BODY} AS body0 FROM documents),
b AS (SELECT path, CASE WHEN doc_id % 6 = 1 THEN concat(body0, chr(233)) ELSE body0 END AS body FROM fi),
{SEPARATOR_SQL},
rc AS (SELECT path, list_transform(list_filter(string_split_regex(body, '\\r\\n|[\\n\\r]'), lambda x: regexp_matches(x, '\\S')), lambda x: string_split(x, separator)) AS recs FROM sp),
gd AS (SELECT path, list_filter(recs, lambda x: len(x) <= len(recs[1])) AS recs FROM rc),
rw AS (SELECT path, unnest(recs) AS f, unnest(range(len(recs))) AS r FROM gd),
cx AS (SELECT path, r, unnest(f) AS v, unnest(range(len(f))) AS c FROM rw),
cells AS (SELECT path AS file, 'datos' AS sheet, r AS "row", c AS col, CASE WHEN r > 0 AND v IN ({MISSING_SQL}) THEN NULL ELSE v END AS value FROM cx),
{POSITIONS_SQL},
{_sheet_sql(False)},
{METRICS_SQL},
me AS (SELECT sf.*, total_columns, mixed, mean_null, dated, names FROM sf LEFT JOIN tf USING (file)),
nl AS (SELECT file, list(name ORDER BY sheet, col) AS cols FROM typ GROUP BY file),
g0 AS (SELECT fi.*, me.*, nl.cols, me.file IS NULL AS unread, CASE WHEN subfolder <> '.' THEN upper(split_part(subfolder, '/', 1))
    ELSE coalesce(nullif(substr(upper(regexp_replace(trim(regexp_replace(regexp_replace(name, '\\.[^.]*$', ''),
      '[\\s_\\-]?[0-9]{{4}}[-_]?[0-9]{{0,2}}[-_]?[0-9]{{0,2}}', '', 'g')), '[\\s_\\-]+', '_', 'g')), 1, 30), ''), 'SIN_GRUPO') END AS grp
  FROM fi LEFT JOIN me ON me.file = fi.path LEFT JOIN nl ON nl.file = fi.path),
rf AS (SELECT grp, arg_min(cols, path) AS ref FROM g0 WHERE len(cols) > 0 GROUP BY grp),
sm0 AS (SELECT grp, avg(len(list_intersect(cols, ref)) / greatest(len(list_distinct(list_concat(cols, ref))), 1)) AS similarity FROM g0 JOIN rf USING (grp) WHERE len(cols) > 0 GROUP BY grp),
gn AS (SELECT grp, CAST(count(*) AS INTEGER) AS group_files FROM g0 GROUP BY grp),
fl AS (SELECT path, name, subfolder, subject, sender, message_date, mtime, origin, format, g0.grp, group_files, similarity, origin = 'adjunto' AS from_mail,
    coalesce(cols, []) AS cols, coalesce(array_to_string(cols, ' '), '') AS every, coalesce(dated, false) AS has_date_column, coalesce(mean_clean, 0) AS mean_clean,
    false AS has_password, CASE WHEN unread THEN 'sin registros' END AS error, coalesce(sheets, 0) AS sheets, coalesce(sheets, 0) AS num_sheets,
    coalesce(sheets_with_data, 0) AS sheets_with_data, false AS has_pivot, false AS has_table, 0 AS merged, coalesce(mixed, 0) AS mixed,
    coalesce(leading_blank, 0) AS leading_blank, coalesce(header_ok, 0) AS header_ok, mean_null
  FROM g0 JOIN gn USING (grp) LEFT JOIN sm0 USING (grp)),
lv AS (SELECT * EXCLUDE (cols, every), {', '.join(f'CAST({q} AS INTEGER) AS level_{c}' for c, q in LEVEL_SQL.items())} FROM fl),
gl AS (SELECT * FROM lv),
{SCORE_TAIL}"""


@query("quality_job", f"""
WITH {JOB_CTE} SELECT path, grp AS "group", sheets, sheets_with_data, mixed, {H('similarity')} AS similarity, error, {', '.join(LEVEL_NAMES)}, score, category, blocked_by FROM sc""")
def quality_job(spark, folder):
    return _job(spark, folder).select("path", "group", "sheets", "sheets_with_data", "mixed", half_up(F.col("similarity"), 6).alias("similarity"), "error",
                                      *LEVEL_NAMES, "score", "category", "blocked_by")


def _job(spark, folder):
    files = table(spark, folder, "documents").selectExpr("doc_id", *JOB_FILE, f"{JOB_BODY} AS body")
    plain = F.encode("body", "UTF-8")
    # A byte that is no UTF-8 makes a file Latin-1; its other bytes are then read one by one, so such files are plain.
    content = F.when(F.col("doc_id") % 6 == 1, F.encode(F.concat("body", F.lit("é")), "ISO-8859-1")).otherwise(plain)
    return QJ.scored_files(files.withColumn("content", content).drop("body", "doc_id"))


# The mail job: files of a folder together with the data attachments of its messages, errors apart.
MAIL_FILE = [{"subject": "'' AS subject", "sender": "'' AS sender", "message_date": "CAST(NULL AS STRING) AS message_date", "origin": "'directo' AS origin"}.get(
    e.rsplit(" AS ", 1)[1], e) for e in JOB_FILE]
MAIL = {
    "message": "concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING), '.msg')",
    "subfolder": "CASE WHEN conv_id % 2 = 0 THEN '.' ELSE 'correos' END",
    "subject": "CASE WHEN role = 'system' THEN NULL WHEN turn % 3 = 0 THEN '' ELSE concat('pedido ', role) END",
    "sender": "CASE WHEN conv_id % 3 <> 0 THEN concat('u', CAST(conv_id AS STRING), '@correo.example') END",
    "date": "CASE WHEN turn % 2 <> 0 THEN CAST(turn AS STRING) END",
}
# Name and content of a message's attachments; the third is the same in every message.
ATTACHED = [("concat('datos ', CAST(turn AS STRING), ' 2024-01-05.CSV')",
             "CASE WHEN conv_id % 10 = 4 THEN chr(10) ELSE concat('fecha;cliente;valor', chr(10), replace(replace(coalesce(text, ''), '\"', ''), ', ', ';')) END"),
            ("''", "text"), ("'copia.txt'", "concat('sku,cliente', chr(10), '1,2', chr(10))"), ("'vacio.csv'", "''")]
MAIL_SQL = " UNION ALL ".join(
    f"""SELECT NULL AS doc_id, concat('correo/', {MAIL['message']}, '#{i}') AS path, {name} AS name, {MAIL['subfolder']} AS subfolder,
  coalesce(nullif({MAIL['subject']}, ''), '(sin asunto)') AS subject, coalesce({MAIL['sender']}, '?') AS sender, coalesce({MAIL['date']}, '?') AS message_date,
  NULL AS mtime, 'adjunto' AS origin, '{('csv', '', 'txt')[i]}' AS format, {body} AS body0, {MAIL['message']} AS parent_message FROM conversations"""
    for i, (name, body) in enumerate(ATTACHED) if i in (0, 2))
MAIL_CTE = (JOB_CTE.replace(f"fi AS (SELECT doc_id, {', '.join(JOB_FILE)}, {JOB_BODY} AS body0 FROM documents)",
                            f"fi AS (SELECT doc_id, {', '.join(MAIL_FILE)}, {JOB_BODY} AS body0, NULL AS parent_message FROM documents UNION ALL {MAIL_SQL})")
            .replace("gn AS (SELECT grp, CAST(count(*) AS INTEGER) AS group_files FROM g0 GROUP BY grp)",
                     "gn AS (SELECT grp, count(*) FILTER (origin = 'directo') AS direct_files, count(*) FILTER (NOT unread) AS group_results FROM g0 GROUP BY grp)")
            .replace("origin, format, g0.grp, group_files,", "origin, format, parent_message, g0.grp, CASE WHEN origin = 'directo' THEN direct_files ELSE 0 END AS group_files, group_results,")
            .replace(f"CAST({LEVEL_SQL['E']} AS INTEGER)", f"CAST({LEVEL_SQL['E'].replace('group_files', 'group_results')} AS INTEGER)"))


@query("mail_job", f"""
WITH {MAIL_CTE} SELECT 'file' AS kind, path AS input_id, name, parent_message, origin, grp AS "group", sheets, {H('similarity')} AS similarity, NULL AS error,
  {', '.join(LEVEL_NAMES)}, score, category FROM sc WHERE error IS NULL
UNION ALL SELECT 'error', path, name, parent_message, origin, grp, NULL, NULL, error, {', '.join('NULL' for _ in LEVEL_NAMES)}, NULL, NULL FROM sc WHERE error IS NOT NULL""")
def mail_job(spark, folder):
    files = table(spark, folder, "documents").selectExpr("doc_id", *MAIL_FILE, f"{JOB_BODY} AS body")
    content = F.when(F.col("doc_id") % 6 == 1, F.encode(F.concat("body", F.lit("é")), "ISO-8859-1")).otherwise(F.encode("body", "UTF-8"))
    attachments = ", ".join(f"struct({name} AS name, CAST({body} AS BINARY) AS data)" for name, body in ATTACHED)
    mails = table(spark, folder, "conversations").selectExpr(
        *[f"{v} AS {k}" for k, v in MAIL.items()], f"concat('correo/', {MAIL['message']}) AS path", f"array({attachments}) AS attachments")
    scored, errors = MJ.mail_job(files.withColumn("content", content).drop("body", "doc_id"), mails)
    rows = scored.select(F.lit("file").alias("kind"), "input_id", "name", "parent_message", "origin", "group", "sheets", half_up(F.col("similarity"), 6).alias("similarity"),
                         *LEVEL_NAMES, "score", "category")
    return stack([rows, errors.select(F.lit("error").alias("kind"), "input_id", "name", "parent_message", "origin", "group", "error")])
