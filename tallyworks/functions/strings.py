"""Text expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper-case Latin letters with marks (up to U+024F and U+1E00-U+1EFF) and the plain letters they decompose to.
_MARKED = {c: b for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)])
           if c.isupper() and (b := unicodedata.normalize("NFKD", c)[0]) != c and b.isascii()}
ACCENTED, PLAIN = "".join(_MARKED), "".join(_MARKED.values())

# Texts that stand for "no value" in customer rows, upper-cased.
BLANK_WORDS = ("NAN", "NAT", "")


WHITESPACE = " \t\n\r\x0b\x0c"


def strip(col: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(col, F.lit(WHITESPACE))


def prefix(col: Column, n: int) -> Column:
    return F.left(col, F.lit(n))


def drop_prefix(col: Column, n: int) -> Column:
    return F.substring(col, n + 1, 2147483647)


def pad_code(col: Column, width: int) -> Column:
    """Last `width` characters after prefixing zeros; a missing code stays missing."""
    return F.right(F.concat(F.lit("0" * width), col), F.lit(width))


def before(col: Column, mark: str) -> Column:
    return F.substring_index(col, mark, 1)


def words(col: Column) -> Column:
    return F.split(strip(col), r"\s+")


def last_word(col: Column) -> Column:
    return F.element_at(words(col), -1)


def all_but_last_word(col: Column) -> Column:
    w = words(col)
    return F.array_join(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), " ")


def plain_upper(col: Column) -> Column:
    """Field-name form: trimmed, upper case, letters without marks, nothing outside ASCII."""
    plain = F.translate(F.upper(strip(F.coalesce(col, F.lit("")))), ACCENTED, PLAIN)
    return F.regexp_replace(plain, r"[^\x00-\x7F]", "")


def clean_value(col: Column) -> Column:
    """Trimmed text; missing, blank and the not-a-value words become the empty text."""
    text = strip(col.cast("string"))
    return F.when(col.isNull() | F.upper(text).isin(*BLANK_WORDS), F.lit("")).otherwise(text)


def right_pad(col: Column, width: int) -> Column:
    """Left-justified and cut to `width`."""
    return F.rpad(col, width, " ")


def zero_fill(col: Column, width: int) -> Column:
    """Zeros up to `width`, after a leading sign; longer texts stay whole."""
    signed = col.rlike(r"^[+-]")
    body = F.when(signed, F.substring(col, 2, 2147483647)).otherwise(col)
    sign = F.when(signed, F.left(col, F.lit(1))).otherwise(F.lit(""))
    room = F.lit(width) - F.length(sign)
    fill = F.repeat(F.lit("0"), F.greatest(room - F.length(body), F.lit(0)))
    return F.concat(sign, fill, body)


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col, r"[^0-9]", "")


def digits_and_minus(col: Column) -> Column:
    return F.regexp_replace(col, r"[^0-9\-]", "")


def joined(col: Column, limit: int | None = None) -> Column:
    """List as text, cut where the report column is cut."""
    text = F.array_join(col, " | ")
    return F.left(text, F.lit(limit)) if limit else text
