"""Profiles of tables: header position, row counts, null percentages, column types, name quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.numbers import half_up, is_number, round_exact, round_scaled
from tallyworks.functions.patterns import DATE_COLUMN, FULL_DATE_IN_NAME, is_clean_name, mentions
from tallyworks.functions.strings import joined, strip
from tallyworks.operators.groups import HOT_ROWS, attach
from tallyworks.operators.ranking import first_in_group

SHEET = ["file", "sheet"]

# Type classes, the share above which a text column takes a type, report limits.
EMPTY, NUMERIC, DATE, BOOLEAN, MIXED, TEXT = "vacío", "numérico", "fecha", "booleano", "mixto", "texto"
TYPE_SHARE = 0.8
NAMES_WIDTH, NAMES_SHOWN = 500, 15
NO_GROUP, GROUP_WIDTH = "SIN_GRUPO", 30
MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
CLOCK = r"([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?(Z|[+-]\d{2}:?\d{2}))?)?"
DATE_TEXT = rf"^\s*(\d{{4}}[-/.]\d{{1,2}}[-/.]\d{{1,2}}|\d{{1,2}}[-/.]\d{{1,2}}[-/.]\d{{4}}){CLOCK}\s*$"
NAMED_DATE = (rf"(?i)^\s*(\d{{1,2}}[ -]({MONTHS})[a-z]*\.?,?[ -]\d{{4}}|({MONTHS})[a-z]*\.? \d{{1,2}},? \d{{4}}){CLOCK}\s*$")


def is_date(col: Column) -> Column:
    """Whether a text is a calendar date, with or without a time of day and a zone.

    Year first, month or day first in digits (marks -, / or .), or an English month name before or after the day.
    """
    day = F.split(strip(col), "[ T]")[0]
    iso = F.translate(day, "/.", "--")
    digits = F.coalesce(F.when(iso.rlike(r"^\d{4}-"), iso.try_cast("date")),
                        F.try_to_date(iso, "M-d-yyyy"), F.try_to_date(iso, "d-M-yyyy"))
    low = F.lower(strip(col))
    number = F.regexp_extract(low, r"(?<![\d:])(\d{1,2})(?![\d:])", 1)
    named = F.try_to_date(F.concat_ws("-", F.regexp_extract(low, r"(\d{4})", 1),
                                      F.initcap(F.regexp_extract(low, rf"({MONTHS})", 1)), number), "yyyy-MMM-d")
    return F.coalesce(F.when(col.rlike(DATE_TEXT), digits).when(col.rlike(NAMED_DATE), named).isNotNull(), F.lit(False))


def text_type(present: Column, numbers: Column) -> Column:
    """Class of a text column from its counts: empty, mixed (some value is a number) or text."""
    return (F.when(present == 0, F.lit(EMPTY)).when(numbers > 0, F.lit(MIXED)).otherwise(F.lit(TEXT)))


def inferred_type(present: Column, numbers: Column, dates: Column) -> Column:
    """Class after type inference: numeric, else date, where more than four fifths of the values parse."""
    least_one = F.greatest(present, F.lit(1))
    return (F.when(present == 0, F.lit(EMPTY))
            .when(numbers / least_one > TYPE_SHARE, F.lit(NUMERIC))
            .when(dates / least_one > TYPE_SHARE, F.lit(DATE))
            .otherwise(text_type(present, numbers)))


def _declared_type(spark_type: str) -> str | None:
    if spark_type.split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"):
        return NUMERIC
    if spark_type in ("date", "timestamp", "timestamp_ntz"):
        return DATE
    return BOOLEAN if spark_type == "boolean" else None


def column_counts(df: DataFrame, numbers: bool = True, dates: bool = True) -> DataFrame:
    """Per column: rows, present values, number-like and date-like texts; one pass over the table."""
    declared = dict(df.dtypes)
    zero = F.lit(0).cast("long")

    def counts(name: str) -> Column:
        col = F.col(f"`{name}`")
        text = declared[name] == "string"
        return F.struct(
            F.lit(name).alias("column"), F.lit(_declared_type(declared[name])).cast("string").alias("declared"),
            F.count(F.lit(1)).alias("rows"), F.count(col).alias("present"),
            (F.count_if(is_number(col)) if text and numbers else zero).alias("numbers"),
            (F.count_if(is_date(col)) if text and dates else zero).alias("dates"))

    one_row = df.agg(F.array(*[counts(c) for c in df.columns]).alias("_c"))
    return one_row.select(F.explode("_c").alias("_c")).select("_c.*")


def null_percent(present: Column, rows: Column) -> Column:
    return round_scaled((rows - present) / rows * F.lit(100.0), 1)


def profile_nulls(df: DataFrame) -> DataFrame:
    return column_counts(df, numbers=False, dates=False).select(
        "column", null_percent(F.col("present"), F.col("rows")).alias("pct_null"))


def profile_types(df: DataFrame, infer: bool = False) -> DataFrame:
    """Type class per column; `infer` first applies the four-fifths rule to text columns."""
    counted = column_counts(df, dates=infer)
    present, numbers, dates = F.col("present"), F.col("numbers"), F.col("dates")
    texts = inferred_type(present, numbers, dates) if infer else text_type(present, numbers)
    kind = F.when(present == 0, F.lit(EMPTY)).otherwise(F.coalesce("declared", texts))
    return counted.select("column", "present", "numbers", kind.alias("type"))


def profile_rows(df: DataFrame) -> DataFrame:
    """Rows in all, rows with any value, rows entirely blank."""
    some = F.greatest(*[F.col(f"`{c}`").isNotNull() for c in df.columns], F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("rows_total"), F.count_if(some).alias("rows_with_data"),
                  F.count_if(~some).alias("rows_blank"))


def clean_percent(names: Column) -> Column:
    """Percentage of clean names in a list of column names, one decimal."""
    share = F.size(F.filter(names, is_clean_name)) / F.greatest(F.size(names), F.lit(1)) * F.lit(100.0)
    return round_exact(share, 1)


def header_positions(cells: DataFrame) -> DataFrame:
    """Per sheet: first and last row holding a value, and its width. Cells: file, sheet, row, col, value."""
    has = F.col("value").isNotNull()
    return cells.groupBy(*SHEET).agg(
        F.min(F.when(has, F.col("row"))).alias("header_row"), F.max(F.when(has, F.col("row"))).alias("last_row"),
        (F.max("row") + 1).alias("rows_raw"), (F.max("col") + 1).alias("width"),
        F.count(F.lit(1)).alias("_group_rows"))


def header_names(cells: DataFrame, positions: DataFrame) -> DataFrame:
    """Per sheet the column names: the header row's trimmed texts, `Col_i` where blank."""
    heads = positions.select(*SHEET, F.col("header_row").alias("row"))
    texts = (cells.filter(strip(F.col("value")) != "").join(heads, [*SHEET, "row"], "left_semi")
             .groupBy(*SHEET).agg(F.map_from_entries(F.collect_list(
                 F.struct(F.col("col").cast("int"), strip(F.col("value"))))).alias("_texts")))
    names = F.transform(F.sequence(F.lit(0), (F.col("width") - 1).cast("int")),
                        lambda i: F.coalesce(F.try_element_at("_texts", i),
                                             F.concat(F.lit("Col_"), i.cast("string"))))
    return (positions.filter(F.col("header_row").isNotNull()).join(texts, SHEET, "left")
            .select(*SHEET, names.alias("names")))


def promote_header(cells: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(sheets, data cells): the header row becomes names, rows after the last value are trimmed.

    Sheets: position, names, data rows; a sheet without any value is blank. Data cells carry the
    column name and the row counted from the header.
    """
    positions = header_positions(cells)
    names = header_names(cells, positions)
    rows = F.col("last_row") - F.col("header_row")
    sheets = (positions.join(names, SHEET, "left")
              .withColumn("rows_total", F.coalesce(rows, F.lit(0)).cast("long"))
              .withColumn("is_blank", F.col("rows_total") == 0))
    body = attach(cells, sheets.select(*SHEET, "header_row", "last_row", "names"), SHEET, "inner", hot_rows=hot_rows,
                  sizes=positions.select(*SHEET, "_group_rows"), slot_by=["row", "col"])
    body = (body.filter((F.col("row") > F.col("header_row")) & (F.col("row") <= F.col("last_row")))
            .select(*SHEET, (F.col("row") - F.col("header_row") - 1).alias("row"), "col",
                    F.element_at("names", (F.col("col") + 1).cast("int")).alias("column"), "value"))
    return sheets.drop("_group_rows"), body


def typed_columns(sheets: DataFrame, body: DataFrame, infer: bool = True) -> DataFrame:
    """One row per sheet and column: values present, type class, and values the type leaves.

    Without `infer` (delimited files are read as texts) a column is empty, mixed or text and keeps its values.

    A column that becomes numeric or a date keeps only the values that parse; the others count as missing from then on.
    """
    counted = body.groupBy(*SHEET, "col").agg(
        F.count("value").alias("present"), F.count_if(is_number(F.col("value"))).alias("numbers"),
        F.count_if(is_date(F.col("value"))).alias("dates"))
    listed = sheets.filter(~F.col("is_blank")).select(
        *SHEET, "rows_total", F.posexplode("names").alias("col", "column"))
    zero = F.lit(0).cast("long")
    filled = listed.join(counted, [*SHEET, "col"], "left").withColumns(
        {c: F.coalesce(F.col(c), zero) for c in ("present", "numbers", "dates")})
    present, numbers, dates = F.col("present"), F.col("numbers"), F.col("dates")
    typed = filled.withColumn("type", inferred_type(present, numbers, dates) if infer else text_type(present, numbers))
    left = F.when(F.col("type") == NUMERIC, numbers).when(F.col("type") == DATE, dates).otherwise(present)
    return typed.withColumn("left", left)


def column_profile(sheets: DataFrame, body: DataFrame, infer: bool = True) -> DataFrame:
    """One row per sheet and column: type class after inference and null percentage of the typed column."""
    return typed_columns(sheets, body, infer).select(*SHEET, "col", "column", "type",
                                              null_percent(F.col("left"), F.col("rows_total")).alias("pct_null"))


def rows_with_data(sheets: DataFrame, body: DataFrame, infer: bool = True) -> DataFrame:
    """Per sheet the rows that hold a value once the columns have their types."""
    losing = typed_columns(sheets, body, infer).filter(F.col("left") < F.col("present")).select(
        *SHEET, "col", F.col("type").alias("_type"))
    value = F.col("value")
    stays = F.when(F.col("_type") == NUMERIC, is_number(value)).when(F.col("_type") == DATE, is_date(value)).otherwise(F.lit(True))
    return (body.filter(value.isNotNull()).join(losing, [*SHEET, "col"], "left").filter(stays).select(*SHEET, "row").distinct()
            .groupBy(*SHEET).agg(F.count(F.lit(1)).alias("rows_with_data")))


def sheet_summary(sheets: DataFrame, body: DataFrame, infer: bool = True) -> DataFrame:
    """One row per sheet: blank flag, header position, columns, row counts, clean names, mixed columns."""
    filled = rows_with_data(sheets, body, infer)
    mixed = F.sort_array(F.collect_list(F.when(F.col("type") == MIXED, F.struct("col", "column"))))
    columns = column_profile(sheets, body, infer).groupBy(*SHEET).agg(
        F.transform(mixed, lambda m: m["column"]).alias("_mixed"), (half_up(F.sum("pct_null"), 1) / F.count("pct_null")).alias("mean_null"))
    joined_up = sheets.join(filled, SHEET, "left").join(columns, SHEET, "left")
    data, total = F.coalesce("rows_with_data", F.lit(0)), F.col("rows_total")
    blank, head = F.col("is_blank"), F.coalesce(F.col("header_row"), F.lit(0)).cast("long")
    shown = F.when(~blank, F.col("names"))
    return joined_up.select(
        *SHEET, blank.alias("is_blank"), head.alias("header_row"), (head == 0).alias("header_in_row1"),
        F.coalesce(F.size(shown), F.lit(0)).alias("num_columns"), data.cast("long").alias("rows_with_data"),
        F.when(blank, F.lit(0)).otherwise(total - data).cast("long").alias("rows_blank"),
        F.coalesce(F.when(~blank, clean_percent(F.col("names"))), F.lit(0.0)).alias("pct_clean"),
        F.coalesce(joined(F.col("_mixed")), F.lit("")).alias("mixed_columns"),
        F.coalesce(joined(shown, NAMES_WIDTH), F.lit("")).alias("columns"),
        F.coalesce(joined(shown), F.lit("")).alias("columns_all"), F.col("mean_null"))


def file_metrics(summary: DataFrame, columns: DataFrame) -> DataFrame:
    """One row per file with what the scores ask of its sheets and columns.

    From `sheet_summary` and `column_profile`; means and lists are over sheets with data.
    """
    filled = ~F.col("is_blank")
    sheets = summary.groupBy("file").agg(
        F.count(F.lit(1)).cast("int").alias("sheets"), F.count_if("is_blank").cast("int").alias("blank_sheets"),
        F.count_if(filled).cast("int").alias("sheets_with_data"),
        F.count_if(filled & F.col("header_in_row1")).cast("int").alias("header_ok"),
        F.max("header_row").cast("int").alias("leading_blank"),
        F.coalesce(half_up(F.sum(F.when(filled, F.col("pct_clean"))), 1) / F.count_if(filled), F.lit(0.0)).alias("mean_clean"))
    dated = (F.col("type") == DATE) & mentions("_lower_name", DATE_COLUMN)
    per_file = columns.withColumn("_lower_name", F.lower("column")).groupBy("file").agg(
        F.count(F.lit(1)).cast("int").alias("total_columns"), F.count_if(F.col("type") == MIXED).cast("int").alias("mixed"),
        (half_up(F.sum("pct_null"), 1) / F.count("pct_null")).alias("mean_null"), F.max(dated).alias("has_date_column"),
        F.sort_array(F.collect_list(F.struct("sheet", "col", "column"))).alias("_names"))
    zero = F.lit(0)
    return sheets.join(per_file, "file", "left").select(
        *sheets.columns, F.coalesce("total_columns", zero).alias("total_columns"), F.coalesce("mixed", zero).alias("mixed"),
        "mean_null", F.coalesce("has_date_column", F.lit(False)).alias("has_date_column"),
        F.coalesce(F.transform("_names", lambda n: n["column"]), F.array().cast("array<string>")).alias("columns"))


def infer_group(path: Column, subfolder: Column, prefixes: Sequence[tuple[str, str]] = (), width: int | None = GROUP_WIDTH) -> Column:
    """Group of a file: a listed folder prefix, else its first folder, else its name without dates.

    A group named after a file is cut to `width` characters, so longer names that begin alike are one group; without
    a width they stay apart.
    """
    folder = F.replace(F.coalesce(subfolder, F.lit("")), F.lit("\\"), F.lit("/"))
    name = F.substring_index(F.replace(F.coalesce(path, F.lit("archivo")), F.lit("\\"), F.lit("/")), "/", -1)
    stem = F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")
    bare = strip(F.regexp_replace(stem, FULL_DATE_IN_NAME, ""))
    whole = F.upper(F.regexp_replace(bare, r"[\s_\-]+", "_"))
    plain = whole if width is None else F.left(whole, F.lit(width))
    own = F.when(~folder.isin("", "."), F.upper(F.substring_index(folder, "/", 1))).otherwise(
        F.coalesce(F.nullif(plain, F.lit("")), F.lit(NO_GROUP)))
    out = own
    for prefix, group in reversed(list(prefixes)):
        out = F.when(folder.startswith(prefix), F.lit(group)).otherwise(out)
    return out


def group_membership(files: DataFrame, group: str = "group", path: str = "path") -> DataFrame:
    """Per group: file count, whether it can be compared (more than one file), its first names."""
    counts = files.groupBy(group).agg(F.count(F.lit(1)).alias("files"))
    shown = first_in_group(files.select(group, path), group, [path], NAMES_SHOWN)
    names = shown.groupBy(group).agg(F.sort_array(F.collect_list(path)).alias("_paths"))
    listing = joined(F.transform("_paths", lambda p: F.substring_index(p, "/", -1)))
    more = F.when(F.col("files") > NAMES_SHOWN, F.lit("...")).otherwise(F.lit(""))
    return counts.join(names, group).select(
        group, "files", (F.col("files") > 1).alias("evaluable"), F.concat(listing, more).alias("names"))


def schema_consistency(sheets: DataFrame, group: str, order: Sequence[str], columns: str = "columns",
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per group the mean similarity of each sheet's column set to that of the group's first sheet.

    Equal sets of a group count once, with their number. Common columns are counted by joining the postings (group,
    column) of the sets with those of the reference, so no sheet carries the reference's list.
    """
    reference = sheets.groupBy(group).agg(F.min(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], F.col(columns).alias("_columns")))["_columns"].alias("_reference"))
    wanted = reference.select(group, F.explode(F.array_distinct("_reference")).alias("_column"), F.lit(True).alias("_hit"))
    sizes = reference.select(group, F.size(F.array_distinct("_reference")).alias("_wanted"))
    sets = sheets.groupBy(group, F.array_sort(F.array_distinct(F.col(columns))).alias("_set")).agg(F.count(F.lit(1)).alias("_sheets"))
    sets = sets.withColumns({"_a": F.xxhash64("_set"), "_b": F.xxhash64(F.lit(1), "_set")})
    postings = sets.select(group, "_a", "_b", F.explode("_set").alias("_column"))
    busy = postings.groupBy(group, "_column").agg(F.count(F.lit(1)).alias("_group_rows"))
    hits = attach(postings, wanted, [group, "_column"], "inner", null_safe=True, hot_rows=hot_rows, sizes=busy, slot_by=["_a", "_b"])
    found = hits.groupBy(F.col(group).alias("_group"), F.col("_a").alias("_ha"), F.col("_b").alias("_hb")).agg(F.count(F.lit(1)).alias("_common"))
    met = sets.select(group, "_a", "_b", "_sheets", F.size("_set").alias("_size"))
    met = met.join(found, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_a") == F.col("_ha")) & (F.col("_b") == F.col("_hb")), "left")
    sized = sizes.withColumnRenamed(group, "_of")
    met = met.join(sized, F.col(group).eqNullSafe(F.col("_of")))
    common = F.coalesce("_common", F.lit(0))
    alike = common / F.greatest(F.col("_size") + F.col("_wanted") - common, F.lit(1))
    return met.groupBy(group).agg(F.sum("_sheets").alias("sheets"), (F.sum(alike * F.col("_sheets")) / F.sum("_sheets")).alias("similarity"))
