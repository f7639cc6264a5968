"""Delimited text: encoding and separator detection, all-text parsing with bad rows skipped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Candidate separators in order of preference, lines looked at, texts read as missing.
SEPARATORS = (",", "\t", ";", "|")
SNIFF_LINES = 5
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                 "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"

_RAW = "_raw_record"


def encoding_of(content: Column) -> Column:
    """utf-8 where the whole content is valid UTF-8, else latin-1."""
    return F.when(F.is_valid_utf8(content.cast("string")), F.lit("utf-8")).otherwise(F.lit("latin-1"))


def separator_of(text: Column, lines: int = SNIFF_LINES) -> Column:
    """The separator giving the most fields among those giving every line of the head the same number.

    Equal counts go to the earlier candidate; a text without lines is comma-separated.
    """
    head = F.filter(F.slice(F.split(text, LINE_BREAK, lines + 1), 1, lines), lambda l: l.rlike(r"\S"))

    def option(position: int, sep: str, head_lines: Column) -> Column:
        fields = F.transform(head_lines, lambda l: F.length(l) - F.length(F.replace(l, F.lit(sep), F.lit(""))) + 1)
        return F.struct(F.array_min(fields).alias("least"), F.array_max(fields).alias("fields"),
                        F.lit(-position).alias("rank"), F.lit(sep).alias("sep"))

    def best(head_lines: Column) -> Column:
        options = F.array(*[option(i, s, head_lines) for i, s in enumerate(SEPARATORS)])
        even = F.filter(options, lambda o: o["least"] == o["fields"])
        return F.array_max(F.transform(even, lambda o: F.struct(o["fields"], o["rank"], o["sep"].alias("sep"))))["sep"]

    # The head goes through a one-item list so that it is cut out of the text once.
    return F.coalesce(F.transform(F.array(head), best)[0], F.lit(SEPARATORS[0]))


def missing_to_null(col: Column) -> Column:
    return F.when(~col.isin(*MISSING_TEXTS), col)


def field_count(record: Column, sep: str) -> Column:
    """Fields of a raw record, separators inside quotes not counted."""
    bare = F.regexp_replace(record, r'"([^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])


def _options(sep: str) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW}


def _keep_good(df: DataFrame, names: Sequence[str], sep: str, kept: Sequence[str] = ()) -> DataFrame:
    """Drop records with more fields than the header (shorter ones stay, padded); missing texts to null."""
    good = F.col(_RAW).isNull() | (field_count(F.col(_RAW), sep) <= len(names))
    return df.filter(good).select(*kept, *[missing_to_null(F.col(f"`{n}`")).alias(n) for n in names])


def parse_delimited(lines: DataFrame, text: str, names: Sequence[str], sep: str,
                    kept: Sequence[str] = ()) -> DataFrame:
    """One text record per row to one column per field, all text; blank records are skipped."""
    ddl = ", ".join(f"`{n}` STRING" for n in [*names, _RAW])
    parsed = lines.filter(F.col(text).rlike(r"\S")).withColumn("_p", F.from_csv(text, ddl, _options(sep)))
    return _keep_good(parsed.select(*kept, "_p.*"), names, sep, kept)


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, encoding: str | None = None,
                   quoted_breaks: bool | None = None) -> DataFrame:
    """A delimited file (or folder of files with one header) as an all-text table.

    What is not given is detected: the encoding on the whole content, the separator on the head of
    the file, and whether a quoted field holds a line break (then records are read across lines and
    a file is not split).
    """
    if encoding is None:
        invalid = (spark.read.text(path).filter(~F.is_valid_utf8("value")).limit(1).count())
        encoding = "ISO-8859-1" if invalid else "UTF-8"
    raw = (spark.read.option("encoding", encoding).option("sep", "\x01").option("quote", "")
           .schema("value STRING").csv(path))
    head = [r[0] for r in raw.limit(SNIFF_LINES).collect()]
    if sep is None:
        sep = spark.range(1).select(separator_of(F.lit("\n".join(h or "" for h in head)))).first()[0]
    if quoted_breaks is None:
        quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
        quoted_breaks = bool(raw.filter(quotes % 2 == 1).limit(1).count())
    reader = spark.read.options(**_options(sep), encoding=encoding, header="true", columnPruning="false",
                                multiLine=str(quoted_breaks).lower())
    names = [c.strip() for c in spark.read.options(sep=sep, encoding=encoding, quote='"', escape='"', header="true",
                                                   multiLine=str(quoted_breaks).lower()).csv(path).columns]
    return _keep_good(reader.option("enforceSchema", "true").schema(_schema(names)).csv(path), names, sep)
