"""Contents of delimited files to cells: every file with its own encoding and separator, in one distributed pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.sources.delimited import encoding_of, missing_to_null, separator_of

SHEET_NAME = "datos"
# A record runs to a line break outside quotes; an unclosed quote runs to the end of the file. A doubled quote is the end
# of one quoted run and the start of the next, so the loops take whole runs, not characters.
QUOTED = r'"[^"]*+(?:"|$)'
RECORD = rf'((?:[^"\r\n]++|{QUOTED})++)'


def decoded(content: Column) -> Column:
    """Text of a file's bytes in the encoding they show."""
    text = content.cast("string")
    return F.when(encoding_of(content) == "utf-8", text).otherwise(F.decode(content, "ISO-8859-1"))


def records_of(text: Column) -> Column:
    """The records of a text; blank ones are left out."""
    return F.filter(F.regexp_extract_all(text, F.lit(RECORD), F.lit(1)), lambda r: r.rlike(r"\S"))


def fields_of(record: Column, sep: Column) -> Column:
    """The fields of a record without their quotes; separators inside quotes do not count."""
    mark = F.concat(F.lit("["), sep, F.lit("]"))
    field = F.concat(mark, F.lit(r'((?:[^"'), sep, F.lit(rf']++|{QUOTED})*+)'))
    plain = F.regexp_extract_all(F.concat(sep, record), field, F.lit(1))
    return F.transform(plain, lambda v: F.when(v.startswith('"'), F.replace(
        F.regexp_replace(v, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(v))


def file_cells(files: DataFrame, file: str = "path", content: str = "content") -> DataFrame:
    """Cells (file, sheet, row, col, value) of delimited files given as rows of a name and bytes.

    Row 0 is the header. Records with more fields than the header are skipped, shorter ones end early; texts that read
    as missing are null below the header. A file without records has no cells. Nothing is collected: a file is a row,
    its records and then their fields are exploded.
    """
    text = decoded(F.col(content))
    opened = files.select(F.col(file).alias("file"), text.alias("_text"), separator_of(text).alias("_sep"))
    opened = opened.select("file", F.transform(records_of(F.col("_text")), lambda r: fields_of(r, F.col("_sep"))).alias("_rows"))
    width = F.size(F.try_element_at("_rows", F.lit(1)))
    good = opened.select("file", F.posexplode(F.filter("_rows", lambda r: F.size(r) <= width)).alias("_at", "_fields"))
    cells = good.select("file", "_at", F.posexplode("_fields").alias("_col", "_value"))
    return cells.select("file", F.lit(SHEET_NAME).alias("sheet"), F.col("_at").cast("long").alias("row"), F.col("_col").cast("long").alias("col"),
                        F.when(F.col("_at") == 0, F.col("_value")).otherwise(missing_to_null(F.col("_value"))).alias("value"))
