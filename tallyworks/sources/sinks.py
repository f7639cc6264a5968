"""Report tables and fixed-width text files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters that cp1252 has besides ASCII and Latin-1.
CP1252_ONLY = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
ANY_CHARSET = "spark.sql.legacy.javaCharsets"


def write_report(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Each report table under its name in `folder`, replacing an earlier run; returns the paths."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in tables}
    for name, table in tables.items():
        writer = table.write.mode("overwrite")
        (writer.option("header", "true").csv(paths[name]) if fmt == "csv" else writer.format(fmt).save(paths[name]))
    return paths


def write_fixed_width(lines: DataFrame, path: str, encoding: str = "UTF-8", line: str = "line") -> None:
    """Text lines ended by CR LF, in UTF-8 or in cp1252; a character that cp1252 lacks fails the write."""
    if encoding.upper().replace("_", "-") in ("UTF-8", "UTF8"):
        lines.select(line).write.mode("overwrite").option("lineSep", "\r\n").text(path)
        return
    lacking = F.col(line).rlike(rf"[^\x00-\x7F\xA0-\xFF{CP1252_ONLY}]")
    checked = F.when(lacking, F.raise_error(F.concat(F.lit("not in cp1252: "), F.col(line))).cast("string")).otherwise(F.col(line))
    conf = lines.sparkSession.conf
    before = conf.get(ANY_CHARSET, "false")
    conf.set(ANY_CHARSET, "true")
    try:
        (lines.select(checked.alias(line)).write.mode("overwrite")
         .options(encoding="windows-1252", quote="", sep="\x01", lineSep="\r\n", emptyValue="",
                  ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path))
    finally:
        conf.set(ANY_CHARSET, before)


def from_cp1252(content: Column) -> Column:
    """The text of cp1252 bytes."""
    return F.translate(F.decode(content, "ISO-8859-1"), CP1252_ONLY.encode("cp1252").decode("latin-1"), CP1252_ONLY)


def read_fixed_width(spark: SparkSession, path: str, places: Sequence[tuple[str, int, int]], length: int, end: int = 2) -> DataFrame:
    """Positional records as one text column for each (name, start from 1, width), read as they were written in cp1252.

    A file is cut at multiples of the record's bytes (`length` and the line end), wherever its splits lie, and a field by
    its byte place; so a line break inside a field does no harm. A file of another size is refused. Fields keep their blanks.
    """
    size = length + end
    odd = spark.read.format("binaryFile").load(path).select("path", "length").filter(F.col("length") % size != 0).limit(1).collect()
    if odd:
        raise ValueError(f"{odd[0]['path']} has {odd[0]['length']} bytes, no multiple of {size}")
    records = spark.sparkContext.binaryRecords(path, size).map(lambda record: (bytes(record),)).toDF("record binary")
    return records.select(*[from_cp1252(F.substring("record", start, width)).alias(name) for name, start, width in places])
