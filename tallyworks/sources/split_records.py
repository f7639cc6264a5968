"""Quoted records of large delimited files, read in splits.

Whether a line break ends a record depends on all quotes before it, so a file with quoted breaks cannot be cut blindly.
But a line only maps one of two states at its start (outside or inside a quoted field) to one at its end, and such maps
compose. So every split works out the map of its lines, the maps of a file's splits are composed in order (one small row
a split), and each split then knows the state it starts in, the number of records before it and the record that reaches
into it. Lines that are whole records stay where they are; only the lines of records with breaks inside are put together.

Quotes count as in common delimited files: a field is quoted if it starts with a quote, doubled quotes inside stand for
one, what follows the closing quote belongs to the field as it is, and quotes inside other fields are ordinary characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.sources.delimited import SNIFF_LINES, separator_of
from tallyworks.sources.staging import staged

SPLIT = ["file", "block"]
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'


def _mark(sep: Column) -> Column:
    return F.concat(F.lit("["), sep, F.lit("]"))


def ends_inside(line: Column, sep: Column) -> Column:
    """Whether a line that starts a record ends inside a quoted field."""
    other = F.concat(F.lit("[^"), sep, F.lit("]*+"))
    closed = F.concat(F.lit(f"(?:{_QUOTED}\""), other, F.lit('|[^"'), sep, F.lit("]"), other, F.lit(")?+"))
    return F.regexp_like(line, F.concat(F.lit(r"(?s)\A(?:"), closed, _mark(sep), F.lit(rf")*+{_QUOTED}\z")))


def record_fields(record: Column, sep: Column) -> Column:
    """The fields of a record without their quotes."""
    other = F.concat(F.lit("[^"), sep, F.lit("]*+"))
    pattern = F.concat(F.lit("(?s)"), _mark(sep), F.lit(f"({_QUOTED}(?:\""), other, F.lit(")?+|"), other, F.lit(")"))
    found = F.regexp_extract_all(F.concat(sep, record), pattern, F.lit(1))

    def bare(field: Column) -> Column:
        inner = F.regexp_extract(field, rf'(?s)\A({_QUOTED})"?(.*)\z', 1)
        rest = F.regexp_extract(field, rf'(?s)\A({_QUOTED})"?(.*)\z', 2)
        return F.when(field.startswith('"'), F.concat(F.replace(F.substring(inner, 2, 1 << 30), F.lit('""'), F.lit('"')), rest)).otherwise(field)

    return F.transform(found, bare)


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in their order within a split: (file, block, line, part, utf8, value, tail).

    A line that is no UTF-8 is read as Latin-1. `block` is where the split starts in the file, `line` grows within it, `part` counts the pieces of a line that ends
    with carriage returns alone; `tail` is the line feed that followed.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), F.is_valid_utf8("value").alias("utf8"),
        F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1")).alias("value"))
    pieces = lines.select("file", "block", "line", "utf8", F.size(F.split("value", r"(?<=\r)(?!\z)")).alias("_n"),
                          F.posexplode(F.split("value", r"(?<=\r)(?!\z)")).alias("part", "value"))
    return pieces.select("file", "block", "line", "part", "utf8", "value", F.when(F.col("part") == F.col("_n") - 1, F.lit("\n")).otherwise(F.lit("")).alias("tail"))


def separators(spark: SparkSession, path: str, lines: DataFrame) -> DataFrame:
    """The separator of each file by its first lines; of every split at most as many go on."""
    place = ["block", "line", "part"]
    in_split, in_file = (Window.partitionBy(*keys).orderBy(*place) for keys in (SPLIT, ["file"]))
    first = lines.select("file", *place, "value").withColumn("_at", F.row_number().over(in_split)).filter(F.col("_at") <= SNIFF_LINES)
    first = first.withColumn("_at", F.row_number().over(in_file)).filter(F.col("_at") <= SNIFF_LINES)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*place, "value"))), lambda x: x["value"]), "\n")
    return first.groupBy("file").agg(separator_of(text).alias("sep"))


def split_records(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Records of delimited files in parallel: (file, record, text, sep, whole), record counting from 0 in each file.

    Not given, the separator of each file is detected on its first lines. A file with any line that is no UTF-8 is read
    as Latin-1. Line feeds, carriage returns and both end a line; those inside quotes stay as they are. Blank lines count
    as records, with an empty text. An unclosed quote runs to the end of its file, which then is one record. Lines and
    states are staged while the plan is built.
    """
    lines = physical_lines(spark, path)
    if sep is None:
        lines = staged(lines, "lines")
        lines = lines.join(separators(spark, path, lines), "file")
    else:
        lines = lines.withColumn("sep", F.lit(sep))
    mark = F.coalesce("sep", F.lit(","))
    # From outside, and from inside: as if a quote opened the line.
    maps = lines.withColumns({"_from_out": ends_inside(F.col("value"), mark), "_from_in": ends_inside(F.concat(F.lit('"'), F.col("value")), mark)})
    order = Window.partitionBy(*SPLIT).orderBy("line", "part")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("_from_out") == F.col("_from_in")
    turned = maps.withColumn("_turns", F.sum((F.col("_from_out") & ~F.col("_from_in")).cast("int")).over(so_far))
    # After a line of a fixed end, the state is that end, turned as often as the lines since turn it.
    turned = turned.withColumn("_fixed", F.last(F.when(fixed, F.struct("_from_out", "_turns")), ignorenulls=True).over(before)).withColumn(
        "_before", F.coalesce(F.lag("_turns").over(order), F.lit(0)))
    odd = (F.col("_before") - F.coalesce("_fixed._turns", F.lit(0))) % 2 == 1

    def at_start(state: bool) -> Column:
        from_ = F.coalesce("_fixed._from_out", F.lit(state))
        return F.when(odd, ~from_).otherwise(from_)

    both = turned.withColumns({"in_out": at_start(False), "in_in": at_start(True)})
    for name in ("out", "in"):
        both = both.withColumn(f"starts_{name}", F.sum((~F.col(f"in_{name}")).cast("long")).over(so_far))
        both = both.withColumn(f"ends_{name}", F.when(F.col(f"in_{name}"), F.col("_from_in")).otherwise(F.col("_from_out")))
    kept = staged(both.select(*SPLIT, "line", "part", "value", "tail", "sep", "utf8", *[f"{c}_{n}" for n in ("out", "in") for c in ("in", "starts", "ends")]), "line-states")

    last = F.struct("line", "part")
    blocks = kept.groupBy(*SPLIT).agg(*[F.max_by(f"ends_{n}", last).alias(f"end_{n}") for n in ("out", "in")], *[F.max(f"starts_{n}").alias(f"n_{n}") for n in ("out", "in")],
                                      F.bool_and("utf8").alias("utf8"))
    # A file's splits in order: one row each.
    file_order = Window.partitionBy("file").orderBy("block")
    up_to = file_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips, same = F.col("end_out") & ~F.col("end_in"), F.col("end_out") == F.col("end_in")
    blocks = blocks.withColumn("_turns", F.sum(flips.cast("int")).over(up_to))
    blocks = blocks.withColumn("_fixed", F.last(F.when(same, F.struct("end_out", "_turns")), ignorenulls=True).over(
        file_order.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_before", F.coalesce(F.lag("_turns").over(file_order), F.lit(0)))
    state = F.coalesce("_fixed.end_out", F.lit(False))
    state = F.when((F.col("_before") - F.coalesce("_fixed._turns", F.lit(0))) % 2 == 1, ~state).otherwise(state)
    blocks = blocks.withColumn("_inside", state)
    blocks = blocks.withColumn("_n", F.when(F.col("_inside"), F.col("n_in")).otherwise(F.col("n_out")))
    blocks = blocks.select(*SPLIT, "_inside", (F.sum("_n").over(up_to) - F.col("_n")).alias("_earlier"),
                           F.bool_and("utf8").over(Window.partitionBy("file")).alias("_utf8"))

    # One short row a split: the lines stay where they are.
    met = kept.join(F.broadcast(blocks), SPLIT)
    value = F.when(F.col("_utf8") | ~F.col("utf8"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))

    def chosen(name: str) -> Column:
        return F.when(F.col("_inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))

    rows = met.select("file", (F.col("_earlier") + chosen("starts") - 1).alias("record"), *SPLIT[1:], "line", "part", value.alias("value"), "tail",
                      F.coalesce("sep", F.lit(",")).alias("sep"), chosen("in").alias("_in"), chosen("ends").alias("_ends"))
    alone = rows.filter(~F.col("_in") & ~F.col("_ends")).select("file", "record", F.regexp_replace("value", r"\r\z", "").alias("text"), "sep", F.lit(True).alias("whole"))
    parts = rows.filter(F.col("_in") | F.col("_ends"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "part", F.concat("value", "tail").alias("v")))), lambda x: x["v"]), "")
    together = parts.groupBy("file", "record").agg(joined.alias("_text"), F.first("sep").alias("sep")).select(
        "file", "record", F.regexp_replace("_text", r"(?:\r\n|\n|\r)\z", "").alias("text"), "sep", F.lit(False).alias("whole"))
    return alone.unionByName(together)


def split_cells(records: DataFrame) -> DataFrame:
    """Fields of the records that are not empty: (file, record, fields)."""
    return records.filter(F.length("text") > 0).select("file", "record", record_fields(F.col("text"), F.col("sep")).alias("fields"))
