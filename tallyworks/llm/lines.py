"""Removal of boilerplate lines by the number of distinct sites that carry them, in SQL functions only.

Sketches of the sites, one per line hash, are merged by aggregation; a hot line costs one row a task. Lines whose
estimate is clearly below or above the threshold are settled by it; the ones near it get exact distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import query, stored, table


#: The outer characters that lines are compared without.
BLANKS = " \t\r"


def line_key(line: Column, blanks: str = BLANKS) -> Column:
    """What equal lines share: a 64-bit hash of the line without the outer characters of `blanks`, and its length."""
    bare = F.trim(line, F.lit(blanks))
    return F.struct(F.xxhash64(bare).alias("h"), F.length(bare).alias("n"))


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", key: str = "doc_id", min_sites: int = 5,
                min_chars: int = 1, lg_k: int = 12, blanks: str = BLANKS) -> DataFrame:
    """Lines of at least `min_chars` on at least `min_sites` distinct sites: (line key, first: least key of a carrier).

    A null site counts as one more site. The sketch's relative error is about 1.04 / sqrt(2 ** lg_k); estimates within
    five times that of the threshold (and at least one) are replaced by exact counts.
    """
    place = F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("null"))
    lines = (docs.select(F.col(key).alias("id"), place.alias("site"), F.explode(F.split(F.col(text), "\n")).alias("line"))
             .select("id", "site", line_key(F.col("line"), blanks).alias("line")).where(F.col("line.n") >= min_chars))
    seen = lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"), F.count("*").alias("n"),
                                     F.min("id").alias("first"))
    around = max(1.0, min_sites * 5 * 1.04 / 2 ** (lg_k / 2))
    # A line on s sites stands at least s times, so rarer lines need no estimate.
    judged = stored(seen.where(F.col("n") >= min_sites)
                    .select("line", "first", F.hll_sketch_estimate("sketch").alias("about"))
                    .where(F.col("about") > min_sites - around), "line-sites")
    near = judged.where(F.col("about") < min_sites + around).select("line")
    exact = (lines.join(near, "line", "left_semi").groupBy("line", "site").agg(F.lit(1).alias("one"))
             .groupBy("line").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites).select("line"))
    return judged.where(F.col("about") >= min_sites + around).select("line", "first").union(
        judged.join(exact, "line", "left_semi").select("line", "first"))


def without_lines(lines: Column, gone: Column) -> Column:
    """The lines but for those at the places `gone`, joined again: slices between neighbouring places, each read once."""
    # The lambda variable x holds both arrays, so that they are worked out once a row.
    both = F.array(F.struct(lines.alias("l"), F.sort_array(F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))).alias("g")))
    return F.transform(both, lambda x: F.array_join(F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(x["g"]) - 1),
        lambda k: F.slice(x["l"], x["g"][k - 1] + 2, x["g"][k] - x["g"][k - 1] - 1))), "\n"))[0]


def dedup_lines(docs: DataFrame, text: str = "text", site: str = "source", key: str = "doc_id", min_sites: int = 5,
                min_chars: int = 1, lg_k: int = 12, blanks: str = BLANKS) -> DataFrame:
    """The input rows and columns, and `kept_text`, `n_lines`, `n_removed` (replaced if present).

    Boilerplate lines stay in the document with the least key that carries them and go from all others, so nothing is
    lost from the corpus. Lines are cut at newline characters only and compared without the outer characters of `blanks`.
    Null texts stay null with 0 lines; empty texts have one empty line. Rows with the same key and text are treated alike; a row with a null key never is the first one,
    and lines that only such rows carry stay.
    """
    cold = {"kept_text", "n_lines", "n_removed"}
    docs = docs.drop(*[c for c in docs.columns if c in cold])
    drop = boilerplate(docs, text, site, key, min_sites, min_chars, lg_k, blanks)
    mine = F.struct(F.col(key).alias("id"), F.xxhash64(text).alias("h"), F.length(text).alias("n"))
    lines = F.transform(F.split(F.col(text), "\n"), lambda v, i: F.struct(i.alias("at"), line_key(v, blanks).alias("line")))
    # The row's key is worked out below the explode: above it the whole text would be hashed again for each line.
    at = (docs.select(mine.alias("row_key"), F.filter(lines, lambda x: x["line"]["n"] >= min_chars).alias("ls"))
          .select("row_key", F.explode("ls").alias("x")).select("row_key", "x.at", "x.line"))
    gone = (at.join(drop.where(F.col("first").isNotNull()), "line")
            .where(~F.col("row_key.id").eqNullSafe(F.col("first")))
            .groupBy(F.col("row_key").alias("__of")).agg(F.collect_set("at").alias("__gone")))
    rows = docs.withColumn("__row_key", mine)
    rows = rows.join(gone, F.col("__row_key").eqNullSafe(F.col("__of")), "left").drop("__row_key", "__of")
    kept = without_lines(F.split(F.col(text), "\n"), F.col("__gone"))
    n_lines = F.coalesce(F.when(F.col(text).isNotNull(), F.size(F.split(F.col(text), "\n"))), F.lit(0))
    return (rows.withColumn("kept_text", F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept))
            .withColumn("n_lines", n_lines.cast("long"))
            .withColumn("n_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long")).drop("__gone"))


@query("op4_line_dedup", """
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents),
b AS (SELECT trim(line, ' ' || chr(9) || chr(13)) AS line, min(doc_id) AS first FROM l WHERE length(trim(line, ' ' || chr(9) || chr(13))) >= 1 GROUP BY 1
      HAVING count(DISTINCT coalesce('s' || source, 'null')) >= 5),
d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
u AS (SELECT doc_id, text, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM d),
k AS (SELECT u.doc_id, count(*) AS n_lines, count(b.line) AS n_removed,
      coalesce(string_agg(u.line, chr(10) ORDER BY pos) FILTER (WHERE b.line IS NULL), '') AS kept
      FROM u LEFT JOIN b ON trim(u.line, ' ' || chr(9) || chr(13)) = b.line AND u.doc_id IS DISTINCT FROM b.first GROUP BY u.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       length(k.kept) AS kept_chars, sha256(k.kept) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id IS NOT DISTINCT FROM k.doc_id
""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    done = dedup_lines(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return done.select("doc_id", "n_lines", "n_removed", F.length("kept_text").cast("long").alias("kept_chars"),
                       F.sha2("kept_text", 256).alias("kept_sha256"))
