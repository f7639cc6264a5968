"""Secret scans with multipart linking, in SQL functions only.

Base spans are found by patterns. Weak candidates (a user name, an unspecific secret, an endpoint) say little alone;
they are reported when complementary parts stand within one scope, a stretch of `scope` code points. The interval join
does not pair parts: starts are put into bins as wide as the scope, each (text, bin, role) is reduced to its first and
last part, and a candidate looks at its own bin and the two beside it. That is exact, and linear in the parts even
where one text holds thousands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import query, stored, table

#: The kinds in their order, each with its pattern, the group that must be long enough and its length.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}+", 0, 24),
}
#: The method's own kinds. The first word says which part of a credential a candidate is.
WEAK = {
    "id_name": (r"""(?i)\b(?:user(?:name)?|login|client_?id|account|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", 0, 1),
    "secret_part": (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}+={0,2}", 0, 20),
    "endpoint": (r"""(?i)\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+""", 0, 1),
}
ORDER = {k: i for i, k in enumerate([*BASE, *WEAK])}
#: The part of a credential that a kind is.
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "id_name": "id", "secret_part": "secret", "endpoint": "place"}
SPAN = "array<struct<s:int,k:int,e:int>>"
#: Matches whose places are summed up together.
BLOCK = 64


def placed(pieces: Column) -> Column:
    """Starts and ends of matches: running sums of gaps g and matches m, by blocks of BLOCK and then over the blocks.

    An array grows by copying it; so no array grows beyond a block, or the number of blocks.
    """
    none = F.lit([]).cast("array<struct<s:int,e:int,p:int>>")

    def in_block(block: Column) -> Column:
        return F.aggregate(block, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda a, x: F.struct(
            (a["at"] + x["g"] + x["m"]).alias("at"),
            F.concat(a["out"], F.array(F.struct((a["at"] + x["g"]).alias("s"), (a["at"] + x["g"] + x["m"]).alias("e"), x["p"].alias("p")))).alias("out")))

    def over_blocks(blocks: Column) -> Column:
        offsets = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.lit([]).cast("array<int>").alias("out")), lambda a, x: F.struct(
            (a["at"] + x["at"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        return F.flatten(F.zip_with(blocks, offsets, lambda x, o: F.transform(x["out"], lambda y: F.struct(
            (y["s"] + o).alias("s"), (y["e"] + o).alias("e"), y["p"].alias("p")))))

    # Lambda variables hold the arrays, so that they are worked out once a row.
    blocks = F.transform(F.array(pieces), lambda a: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int")), lambda i: in_block(F.slice(a, i * BLOCK + 1, F.lit(BLOCK)))))
    return F.flatten(F.transform(blocks, over_blocks))


def spans(text: Column, kind: str) -> Column:
    """Leftmost non-overlapping matches of a kind: start and end in code points, failing ones dropped.

    The gaps between matches come from a split by the same pattern; starts are running sums of gaps and matches.
    """
    pattern, group, least = (BASE | WEAK)[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.zip_with(F.zip_with(F.split(text, pattern, -1), found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m"))),
                        parts, lambda x, p: F.struct(x["g"].alias("g"), x["m"].alias("m"), F.length(p).alias("p")))
    # The last gap has no match after it; its m is null.
    run = placed(F.filter(pieces, lambda x: x["m"].isNotNull()))
    made = F.transform(F.filter(run, lambda x: x["p"] >= least),
                       lambda x: F.struct(x["s"].alias("s"), F.lit(ORDER[kind]).alias("k"), x["e"].alias("e")))
    return F.when(F.regexp_like(text, F.lit(pattern)), made).otherwise(F.lit([]).cast(SPAN))


def listed(found: Column) -> Column:
    """kind:start:end of spans by start, then kind, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in ORDER])
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",), scope: int = 200) -> DataFrame:
    """Key columns, `base` and `linked`: arrays of (s start, k kind number, e end) of each whole text.

    base: matches of the three base kinds. linked: weak candidates whose complements start within `scope` code points:
    a name needs a secret, a weak secret needs an identifier or a place, a place needs an identifier and a secret.
    Weak secrets that overlap a base match are not candidates, they are reported already. Null texts count as empty.
    Repeated rows and null keys stay rows of their own. Other columns of the input are not read.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], value.alias("t"))
    rows = rows.select("*", *[spans(F.col("t"), k).alias(k) for k in ORDER])
    base = F.array_sort(F.concat(*BASE))
    weak = F.concat(*WEAK)
    rows = rows.select(*[f"k{i}" for i in range(len(keys))], F.monotonically_increasing_id().alias("row"), base.alias("base"), weak.alias("weak"))
    # Written once: the patterns run once, and the row numbers cannot change between the branches below.
    rows = stored(rows, "secrets")
    roles = F.array(*[F.lit(ROLE[k]) for k in ORDER])
    parts = (rows.where(F.size("weak") > 0)
             .select("row", F.explode(F.concat("base", "weak")).alias("x"))
             .select("row", F.floor(F.col("x.s") / scope).alias("bin"), F.col("x.s").alias("s"), F.col("x.k").alias("k"),
                     F.col("x.e").alias("e"), F.element_at(roles, F.col("x.k") + 1).alias("role")))
    # A weak secret overlaps a base match if, of those that start before its end, one ends after its start.
    unsure = F.col("k") == ORDER["secret_part"]
    before = Window.partitionBy("row").orderBy(F.when(unsure, F.col("e")).otherwise(F.col("s")), ~unsure).rowsBetween(Window.unboundedPreceding, 0)
    parts = (parts.withColumn("told", F.max(F.when(F.col("k") < len(BASE), F.col("e"))).over(before))
             .where(~unsure | F.col("told").isNull() | (F.col("told") <= F.col("s"))).drop("told"))
    ends = parts.groupBy("row", "bin").agg(*[f(F.when(F.col("role") == r, F.col("s"))).alias(f"{n}_{r}")
                                            for r in ("id", "secret", "place") for n, f in (("first", F.min), ("last", F.max))])
    # Each bin's ends are sent to the bins that look at it.
    near = ends.select("row", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"),
                       F.col("bin").alias("of"), *[c for c in ends.columns if "_" in c])
    weak_only = parts.where(F.col("k") >= len(BASE))
    s = F.col("s")
    close = {r: F.coalesce(F.max(F.when(F.col("of") == F.col("bin"), F.col(f"first_{r}").isNotNull())
                                 .when(F.col("of") < F.col("bin"), s - F.col(f"last_{r}") <= scope)
                                 .otherwise(F.col(f"first_{r}") - s <= scope)), F.lit(False)) for r in ("id", "secret", "place")}
    told = (weak_only.join(near, ["row", "bin"]).groupBy("row", "s", "k", "e", "role").agg(*[c.alias(r) for r, c in close.items()])
            .where(F.expr("CASE role WHEN 'id' THEN secret WHEN 'secret' THEN id OR place ELSE id AND secret END"))
            .groupBy("row").agg(F.collect_list(F.struct("s", "k", "e")).alias("linked")))
    out = rows.join(told, "row", "left")
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "base",
                      F.coalesce("linked", F.lit([]).cast(SPAN)).alias("linked"))


@query("op2_secret_links")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(table(spark, folder, "documents"))
    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == ORDER[kind])).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, BASE), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                        listed(F.concat("base", "linked")).alias("spans"), F.size("linked").cast("long").alias("n_linked"))
