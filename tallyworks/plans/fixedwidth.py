"""Fixed-width records of customers: validation against the field matrix, and rendering.

The field list is metadata on the driver; each record is checked and rendered by one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import patterns as P
from tallyworks.functions.dates import date_digits
from tallyworks.functions.numbers import NUMBER_TEXT, fixed_decimals, parse_number
from tallyworks.functions.strings import (ACCENTED, PLAIN, clean_value, digits_and_minus, plain_upper, right_pad,
                                          strip, zero_fill)
from tallyworks.plans import matrix as M
from tallyworks.plans.matrix import Field
from tallyworks.sources.sinks import write_fixed_width

# Validation against the matrix. Checks and formats are SQL text, one expression per field of the
# matrix, so that a record of many fields is one short select list.

def text_sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number_sql(c: str) -> str:
    """Double of a number-like text, else null."""
    return f"CASE WHEN {c} RLIKE r'{NUMBER_TEXT}' THEN try_cast(trim({c}) AS DOUBLE) END"


def fixed_sql(number: str, decimals: int) -> str:
    """So many decimals, rounded half-even on the exact value."""
    return f"replace(format_number({number}, {decimals}), ',', '')"


def zero_fill_sql(text: str, width: int) -> str:
    """Zeros up to `width` after a leading sign; longer texts stay whole."""
    return (f"CASE WHEN length({text}) >= {width} THEN {text} WHEN left({text}, 1) IN ('+', '-')"
            f" THEN concat(left({text}, 1), lpad(substr({text}, 2), {width - 1}, '0'))"
            f" ELSE lpad({text}, {width}, '0') END")


def decimal_sql(c: str) -> str:
    """A decimal as given if it has the format, else formatted if it is a number."""
    made = zero_fill_sql(fixed_sql(number_sql(c), 2), 7)
    return f"CASE WHEN {c} RLIKE r'{P.TWO_DECIMALS}' THEN {c} ELSE coalesce({made}, {c}) END"


def credit_sql(c: str) -> str:
    """A credit as given if it has the format, else sign and number if it is one."""
    number = number_sql(c)
    digits = f"lpad({fixed_sql(f'abs({number})', M.CREDIT_DECIMALS)}, {M.CREDIT_WIDTH - 1}, '0')"
    whole = f"length({fixed_sql(f'abs({number})', M.CREDIT_DECIMALS)}) > {M.CREDIT_WIDTH - 1}"
    long = fixed_sql(f"abs({number})", M.CREDIT_DECIMALS)
    made = f"concat(CASE WHEN {number} >= 0 THEN '+' ELSE '-' END, CASE WHEN {whole} THEN {long} ELSE {digits} END)"
    return f"CASE WHEN {c} RLIKE r'{P.SIGNED_CREDIT}' THEN {c} ELSE coalesce({made}, {c}) END"


def missing_columns(df: DataFrame, fields: Sequence[Field] = M.MATRIX) -> list[str]:
    """Mandatory fields without a column, whatever the case of the header."""
    present = {c.strip().lower() for c in df.columns}
    return [f.name for f in fields if f.obligation == M.MANDATORY and f.name.lower() not in present]


def require_columns(df: DataFrame, fields: Sequence[Field] = M.MATRIX) -> DataFrame:
    missing = missing_columns(df, fields)
    if missing:
        raise ValueError("Al Excel le faltan las siguientes columnas obligatorias: " + ", ".join(missing))
    return df


def clean_fields(df: DataFrame, fields: Sequence[Field] = M.MATRIX, kept: Sequence[str] = ()) -> DataFrame:
    """One cleaned text column per field; a field without a column is empty."""
    by_name = {c.strip().lower(): c for c in df.columns}

    def value(f: Field) -> Column:
        source = by_name.get(f.name.lower())
        return (clean_value(F.col(f"`{source}`")) if source else F.lit("")).alias(f.name)

    return df.select(*kept, *[value(f) for f in fields])


def type_checks(f: Field) -> list[tuple[str, str]]:
    """(failure, message) pairs of a filled field; a failure is an SQL condition."""
    c, checks = f"`{f.name}`", []
    if f.kind != M.CREDIT:
        checks.append((f"length({c}) > {f.width}", M.MSG_LENGTH.format(f.width)))
    not_number = f"{number_sql(c)} IS NULL"
    if f.kind == M.NUMBER:
        checks.append((f"NOT {c} RLIKE r'^\\d+$'", M.MSG_NUMBER))
    elif f.name == M.RATING_FIELD:
        checks.append((f"{c} NOT IN {M.RATINGS}", M.MSG_RATING))
    elif f.kind == M.DAY:
        checks.append((f"NOT {c} RLIKE r'{P.EIGHT_DIGITS}'", M.MSG_DAY))
    elif f.kind == M.FREQUENCY:
        checks.append((f"NOT {c} RLIKE r'{P.SEVEN_FLAGS}'", M.MSG_FREQUENCY))
    elif f.kind == M.DECIMAL:
        checks.append((f"NOT {c} RLIKE r'{P.TWO_DECIMALS}' AND {not_number}", M.MSG_DECIMAL))
    elif f.kind == M.CREDIT:
        checks.append((f"NOT {c} RLIKE r'{P.SIGNED_CREDIT}' AND {not_number}", M.MSG_CREDIT))
        checks.append((f"length({credit_sql(c)}) <> {M.CREDIT_WIDTH}", M.MSG_CREDIT_WIDTH))
    return checks


def mandatory_check(f: Field) -> list[tuple[str, str]]:
    return [(f"`{f.name}` = ''", M.MSG_MANDATORY)] if f.obligation == M.MANDATORY else []


def dependency_checks(f: Field) -> list[tuple[str, str]]:
    out = []
    for name, sources, message in M.DEPENDENCIES:
        if name == f.name:
            filled = " OR ".join(f"`{s}` <> ''" for s in sources)
            out.append((f"`{name}` = '' AND ({filled})", message))
    return out


def filled_checks(f: Field) -> list[tuple[str, str]]:
    return [(f"`{f.name}` <> '' AND {bad}", message) for bad, message in type_checks(f)]


Checks = Sequence[Callable[[Field], list[tuple[str, str]]]]
ALL_CHECKS: Checks = (mandatory_check, dependency_checks, filled_checks)


def error_list(fields: Sequence[Field], row_number: str, checks: Checks) -> Column:
    """All failed checks of a cleaned record, in field order."""
    found = [f"CASE WHEN {bad} THEN named_struct('row_number', CAST({row_number} AS BIGINT), 'field', '{f.name}',"
             f" 'message', {text_sql(message)}) END"
             for f in fields for check in checks for bad, message in check(f)]
    return F.expr(f"filter(array({', '.join(found)}), e -> e IS NOT NULL)")


def validate(df: DataFrame, row_number: str, fields: Sequence[Field] = M.MATRIX,
             checks: Checks = ALL_CHECKS) -> DataFrame:
    """Cleaned records with the list of their errors."""
    clean = clean_fields(require_columns(df, fields), fields, [row_number])
    return clean.withColumn("errors", error_list(fields, row_number, checks))


def error_report(validated: DataFrame) -> DataFrame:
    """One row per error: row number, field, message."""
    return validated.select(F.explode("errors").alias("_e")).select("_e.*")


def validated_chunk(f: Field) -> str:
    """SQL text of a valid field as it stands in the record."""
    c = f"`{f.name}`"
    text = {M.NUMBER: zero_fill_sql(c, f.width), M.TEXT: f"rpad({c}, {f.width}, ' ')", M.DAY: zero_fill_sql(c, f.width),
            M.FREQUENCY: c, M.DECIMAL: zero_fill_sql(decimal_sql(c), f.width), M.CREDIT: credit_sql(c)}[f.kind]
    blank = ("0" if f.kind in (M.NUMBER, M.DECIMAL, M.CREDIT) else " ") * f.width
    return f"CASE WHEN {c} = '' THEN '{blank}' ELSE {text} END"


def render_validated(validated: DataFrame, row_number: str, fields: Sequence[Field] = M.MATRIX) -> DataFrame:
    """Lines of the records without errors."""
    line = F.expr(f"concat({', '.join(validated_chunk(f) for f in fields)})")
    return validated.filter(F.size("errors") == 0).select(row_number, line.alias("line"))


def export_validated(df: DataFrame, row_number: str, path: str, fields: Sequence[Field] = M.MATRIX) -> DataFrame:
    """Write the text only if no record has an error; returns the error report either way."""
    validated = validate(df, row_number, fields)
    errors = error_report(validated)
    if errors.isEmpty():
        write_fixed_width(render_validated(validated, row_number, fields).orderBy(row_number), path)
    return errors


# Layout-driven export

class Place(NamedTuple):
    name: str
    label: str
    kind: str
    mandatory: bool
    start: int
    width: int


def layout_fields(layout: DataFrame) -> DataFrame:
    """Field rows of a layout table: those with a name and whole-number start and size.

    Layout: name, type, mandatory, start, size.
    """
    start, size = parse_number(F.col("start").cast("string")), parse_number(F.col("size").cast("string"))
    label = strip(F.col("name"))
    return (layout.select(plain_upper(F.col("name")).alias("name"), label.alias("label"),
                          F.lower(strip(F.coalesce("type", F.lit("")))).alias("type"),
                          F.lower(strip(F.coalesce("mandatory", F.lit("")))).alias("mandatory"),
                          start.cast("int").alias("start"), size.cast("int").alias("size"))
            .filter((F.col("label") != "") & F.col("start").isNotNull() & F.col("size").isNotNull()))


def with_record_length(fields: DataFrame) -> DataFrame:
    """The fields with the length of the whole record; a layout is one short list."""
    whole = fields.agg(F.collect_list(F.struct(*fields.columns)).alias("_fields"),
                       F.max(F.col("start") + F.col("size") - 1).alias("record_length"))
    return whole.select(F.explode("_fields").alias("_f"), "record_length").select("_f.*", "record_length")


def read_layout(layout: DataFrame) -> list[Place]:
    """The layout on the driver (one item per field of the record), in order of position."""
    rows = layout_fields(layout).collect()
    return sorted((Place(r["name"], r["label"], r["type"], r["mandatory"] == "si", r["start"], r["size"])
                   for r in rows), key=lambda p: p.start)


def signed_decimal(value: Column, width: int) -> Column:
    """Sign, zero-filled whole part cut from the left, point, four decimals; not a number counts as 0."""
    number = F.coalesce(parse_number(value), F.lit(0.0))
    text = fixed_decimals(F.abs(number), M.CREDIT_DECIMALS)
    whole = width - 2 - M.CREDIT_DECIMALS
    return F.concat(F.when(number < 0, F.lit("-")).otherwise(F.lit("+")),
                    F.right(zero_fill(F.substring_index(text, ".", 1), whole), F.lit(whole)),
                    F.lit("."), F.substring_index(text, ".", -1))


def percentage(value: Column, width: int) -> Column:
    """Zero-filled whole part cut from the left, point, two decimals; not a number counts as 0."""
    text = fixed_decimals(F.coalesce(parse_number(value), F.lit(0.0)), M.PERCENT_DECIMALS)
    whole = width - 1 - M.PERCENT_DECIMALS
    return F.concat(F.right(zero_fill(F.substring_index(text, ".", 1), whole), F.lit(whole)), F.lit("."),
                    F.substring_index(text, ".", -1))


def plain_number(value: Column, width: int) -> Column:
    """Digits and minus signs, sign first, zero-filled, cut on the right; empty gives zeros if short, else blanks."""
    kept = digits_and_minus(value)
    kept = F.when(kept.isin("", "-"), F.lit("0")).otherwise(kept)
    bare = F.regexp_replace(kept, "^-+", "")
    text = F.when(kept.startswith("-"), F.concat(F.lit("-"), F.lpad(bare, width - 1, "0"))).otherwise(
        F.lpad(bare, width, "0"))
    blank = ("0" if width <= M.SHORT_NUMBER else " ") * width
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit(blank)).otherwise(text)


def plain_text(value: Column, width: int) -> Column:
    return right_pad(strip(F.coalesce(value, F.lit(""))), width)


def place_format(place: Place) -> Callable[[Column, int], Column]:
    if place.name in M.SIGNED_FIELDS:
        return signed_decimal
    if place.name in M.PERCENT_FIELDS:
        return percentage
    if place.name in M.DATE_FIELDS:
        return date_digits
    return plain_number if place.kind.startswith("num") else plain_text


def drop_blank_rows(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Without the rows in which every column (of `names`, else of all) is missing or blank."""
    return df.filter(F.greatest(*[F.coalesce(strip(F.col(f"`{c}`").cast("string")) != "", F.lit(False))
                                  for c in names or df.columns], F.lit(False)))


def _place_values(df: DataFrame, places: Sequence[Place], number: str) -> dict[str, Column]:
    by_name = {_plain_name(c): c for c in df.columns}

    def value(p: Place) -> Column:
        if p.name == M.RECORD_NUMBER_FIELD:
            return F.col(number).cast("string")
        if p.name in M.CONSTANT_FIELDS:
            return F.lit(M.CONSTANT_FIELDS[p.name])
        return F.col(f"`{by_name[p.name]}`").cast("string") if p.name in by_name else F.lit(None).cast("string")

    return {p.name: value(p) for p in places}


def _plain_name(name: str) -> str:
    return name.strip().upper().translate(str.maketrans(ACCENTED, PLAIN)).encode("ascii", "ignore").decode()


def render_records(df: DataFrame, places: Sequence[Place], number: str) -> DataFrame:
    """Each record as one line of the layout's length, with the names of its empty mandatory fields.

    Fields stand at their positions in a blank line; where they overlap the later one wins.
    """
    values = _place_values(df, places, number)
    length = max(p.start + p.width - 1 for p in places)
    ordered = sorted(places, key=lambda p: p.start)
    texts = [right_pad(place_format(p)(values[p.name], p.width), p.width) for p in ordered]
    apart = all(a.start + a.width <= b.start for a, b in zip(ordered, ordered[1:]))
    if apart:
        pieces, at = [], 1
        for p, text in zip(ordered, texts):
            if p.start > at:
                pieces.append(F.lit(" " * (p.start - at)))
            pieces.append(text)
            at = p.start + p.width
        line = F.concat(*pieces)
    else:
        line = F.lit(" " * length)
        for p, text in zip(ordered, texts):
            line = F.overlay(line, text, F.lit(p.start), F.lit(p.width))
    empty = [F.when(F.coalesce(strip(values[p.name]), F.lit("")) == "", F.lit(M.MSG_EMPTY_WARNING + p.label))
             for p in ordered if p.mandatory]
    warnings = F.array(*empty) if empty else F.array().cast("array<string>")
    return df.select(number, line.alias("line"), F.filter(warnings, lambda w: w.isNotNull()).alias("warnings"))
