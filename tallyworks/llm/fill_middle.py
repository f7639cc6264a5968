"""Fill-in-the-middle: documents cut at two unit borders and put together in another order, in column operations.

Units are runs of ASCII letters and every other single character. Within a batch all texts become lists of units, which
are flattened next to the row they come from. Each unit's ordinal in its row tells its role (prefix, middle or suffix);
the units of a role are filtered, made into lists again and joined, row by row, without a Python loop over texts.

The texts are worked on as UTF-8 bytes: the byte FF, which no text holds, separates the units.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import query, table

#: A unit as a pattern over bytes (letters, or one character with the bytes that continue it), and the marks.
UNIT = rb"([A-Za-z]+|[\x00-\x40\x5B-\x60\x7B-\x7F]|[\xC0-\xFF][\x80-\xBF]*)"
CUT = b"\xff"
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes of texts that are worked on at once; a longer text is worked on by itself.
BYTES = 4 << 20


def remainder(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def pieces(first: pa.Array, last: pa.Array, n: pa.Array, units: pa.ListArray) -> list[pa.Array]:
    """Prefix, middle and suffix of each row: its units before first, before last, and the rest."""
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    start = pc.cast(units.offsets.slice(0, len(units)), pa.int64())
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(pc.subtract(start, start[0]), parent))
    before_first, before_last = pc.less(ordinal, pc.take(first, parent)), pc.less(ordinal, pc.take(last, parent))
    out = []
    for role, counts in ((before_first, first), (pc.and_not(before_last, before_first), pc.subtract(last, first)), (pc.invert(before_last), pc.add(pc.subtract(n, last), 1))):
        # The suffix also gets the empty unit after the last separator.
        ends = pc.cast(pc.cumulative_sum(counts), pa.int32())
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        out.append(pc.binary_join(pa.ListArray.from_arrays(offsets, pc.filter(flat, role)), b""))
    return out


def transformed(texts: pa.Array, hashes: list[pa.Array], plain_from: int, spm_below: int) -> list[pa.Array]:
    """Number of units, form, lengths of prefix and middle in characters, and the output of each text."""
    texts = pc.fill_null(texts, "").cast(pa.binary())
    units = pc.split_pattern(pc.replace_substring_regex(texts, pattern=UNIT, replacement=rb"\1" + CUT), pattern=CUT)
    n = pc.cast(pc.subtract(pc.list_value_length(units), 1), pa.int64())
    a, b = (remainder(h, pc.add(n, 1)) for h in hashes[:2])
    prefix, middle, suffix = pieces(pc.min_element_wise(a, b), pc.max_element_wise(a, b), n, units)
    hundred = pa.array([100] * len(texts), pa.int64())
    plain = pc.or_(pc.or_(pc.equal(n, 0), pc.match_substring_regex(texts, pattern="<[PSM]>")), pc.greater_equal(remainder(hashes[2], hundred), plain_from))
    spm = pc.less(remainder(hashes[3], hundred), spm_below)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))

    def put(*parts: pa.Array | bytes) -> pa.Array:
        return pc.binary_join_element_wise(*[pa.scalar(p, pa.binary()) if isinstance(p, bytes) else p for p in parts], pa.scalar(b"", pa.binary()))

    output = pc.if_else(plain, texts, pc.if_else(spm, put(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle), put(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))
    none = pa.scalar(None, pa.int64())
    lengths = [pc.if_else(plain, none, pc.cast(pc.utf8_length(p.cast(pa.string())), pa.int64())) for p in (prefix, middle)]
    return [n, form, *lengths, output.cast(pa.string())]


def fill_middle(docs: DataFrame, seed: str = "1:", key: str = "doc_id", text: str = "text", plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """Key, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output of each whole text.

    Four numbers are the first 8-digit groups of the hex sha256 of seed and key. The first two cut the text, the third
    leaves the share from plain_from of 100 as it is, the fourth makes the share below spm_below begin with the suffix.
    Empty texts and those that hold a mark stay plain. A null text counts as empty, a null key as an empty one. Equal
    keys are cut alike where the texts are; rows are never merged; an empty table gives an empty one; other columns are
    not read.
    """
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("t"), *numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.cumulative_sum(pc.cast(pc.fill_null(pc.binary_length(batch.column("t")), 0), pa.int64())).to_pylist()
            start = 0
            while start < batch.num_rows:
                end, used = start + 1, sizes[start - 1] if start else 0
                while end < batch.num_rows and sizes[end] - used <= BYTES:
                    end += 1
                b = batch.slice(start, end - start)
                made = transformed(b.column("t"), [b.column(f"h{i}") for i in range(4)], plain_from, spm_below)
                yield pa.RecordBatch.from_arrays([b.column("key"), *made], names=["key", "n", "form", "prefix_chars", "middle_chars", "output"])
                start = end

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("key", key)


def restored(output: F.Column, form: F.Column) -> F.Column:
    """The text an output was made of. A mark stands once, at its place: texts that hold one are plain."""
    part = F.split(output, "<[PSM]>", -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)


SQL_FORM = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
places AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
         WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:least(a, b)], ''), '') AS p, coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS m,
    coalesce(array_to_string(u[greatest(a, b) + 1:], ''), '') AS s FROM places)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""


@query("op13_fill_middle", SQL_FORM)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_middle(table(spark, folder, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
