"""Scalar functions over the driver tables, one query per family."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.quality import _any, columnar_round_sql, round_sql
from suite.registry import half_up_sql as H
from suite.registry import query, table
from tallyworks.functions import arrays as A
from tallyworks.functions import dates as D
from tallyworks.functions import numbers as N
from tallyworks.functions import patterns as P
from tallyworks.functions import strings as S
from tallyworks.functions.nullsafe import safe_div

TEXTS = ["c_custkey", "concat('  Ñandú é', lower(c_name), CASE WHEN c_custkey % 5 = 0 THEN '' ELSE ' sur/ESTE' END, ' ') AS t",
         "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 1200 AS STRING) END AS code",
         "concat(CAST(c_custkey % 30 AS STRING), '-', c_mktsegment, '-x') AS pair",
         "CASE c_custkey % 6 WHEN 0 THEN ' NaN ' WHEN 1 THEN 'nat' WHEN 2 THEN '  ' WHEN 3 THEN NULL ELSE c_name END AS v",
         "concat(CASE WHEN c_custkey % 3 = 0 THEN '-' WHEN c_custkey % 3 = 1 THEN '+' ELSE '' END, CAST(c_custkey AS STRING)) AS num"]


@query("scalar_strings", f"""
WITH x AS (SELECT {', '.join(TEXTS)} FROM customer)
SELECT c_custkey AS id, left(t, 5) AS first5, substr(t, 5) AS from5, right('000' || code, 3) AS code3, split_part(pair, '-', 1) AS head,
  regexp_extract(trim(t), '(\\S+)$', 1) AS last_word, regexp_replace(trim(t), '\\s+\\S+$', '') AS other_words, t || ' ' || code AS both_parts,
  strip_accents(upper(trim(t))) AS plain, lower(trim(t)) AS small,
  CASE WHEN v IS NULL OR upper(trim(v)) IN ('NAN', 'NAT', '') THEN '' ELSE trim(v) END AS cleaned,
  CASE WHEN length(num) >= 4 THEN num WHEN regexp_matches(num, '^[+-]') THEN substr(num, 1, 1) || lpad(substr(num, 2), 3, '0') ELSE lpad(num, 4, '0') END AS filled,
  rpad(pair, 8, ' ') AS padded, regexp_replace(pair, '[^0-9]', '', 'g') AS digits, regexp_replace(pair, '[^0-9-]', '', 'g') AS signed,
  substr(array_to_string([pair, num, 'fin'], ' | '), 1, 12) AS listed FROM x""")
def scalar_strings(spark, folder):
    t, code, pair, v, num = (F.col(c) for c in ("t", "code", "pair", "v", "num"))
    return table(spark, folder, "customer").selectExpr(*TEXTS).select(
        F.col("c_custkey").alias("id"), S.prefix(t, 5).alias("first5"), S.drop_prefix(t, 4).alias("from5"),
        S.pad_code(code, 3).alias("code3"), S.before(pair, "-").alias("head"), S.last_word(t).alias("last_word"),
        S.all_but_last_word(t).alias("other_words"), F.concat(t, F.lit(" "), code).alias("both_parts"),
        S.plain_upper(t).alias("plain"), F.lower(S.strip(t)).alias("small"), S.clean_value(v).alias("cleaned"),
        S.zero_fill(num, 4).alias("filled"), S.right_pad(pair, 8).alias("padded"), S.digits_only(pair).alias("digits"),
        S.digits_and_minus(pair).alias("signed"), S.joined(F.array(pair, num, F.lit("fin")), 12).alias("listed"))


@query("scalar_dates", """
SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, strftime(o_orderdate, '%Y%m') AS period,
  strftime(o_orderdate, '%Y%m%d') AS stamp, CAST(date_diff('day', DATE '1996-02-29', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
  CASE WHEN o_orderkey % 4 = 0 THEN '          ' ELSE rpad(strftime(o_orderdate, '%d%m%Y'), 10, ' ') END AS digits FROM orders""")
def scalar_dates(spark, folder):
    written = F.when(F.col("o_orderkey") % 4 != 0, F.date_format("o_orderdate", " dd/MM/yyyy"))
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), D.day_of(F.col("o_orderdate").cast("string")).alias("d"), written.alias("w"))
    day = F.col("d")
    return rows.select("id", day.cast("string").alias("day"), D.period(day).alias("period"), D.day_stamp(day).alias("stamp"),
                       D.days_between(day, F.lit("1996-02-29").cast("date")).alias("days"),
                       D.date_digits(F.col("w"), 10).alias("digits"))


MATH = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice AS price", "l_quantity - 25 AS q", "l_discount AS d",
        "CASE l_partkey % 7 WHEN 0 THEN '1e3' WHEN 1 THEN ' 12.5 ' WHEN 2 THEN '1d' WHEN 3 THEN 'x' WHEN 4 THEN '-.5' WHEN 5 THEN NULL ELSE '+7.' END AS n"]


@query("scalar_math", f"""
WITH x AS (SELECT {', '.join(MATH)} FROM lineitem)
SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp, abs(q) AS size, -q AS flipped, price / nullif(q, 0) AS ratio,
  {round_sql('price / 7', 2)} AS exact2, {round_sql('price / 40', 1)} AS exact1, {columnar_round_sql('price / 40')} AS scaled1,
  {H('price / 7', 3)} AS up3, printf('%.4f', q / 3) AS fixed4, least(1.0::DOUBLE, abs(q) / 20.0::DOUBLE) AS capped,
  greatest(0.0::DOUBLE, 1.0::DOUBLE - abs(q) / 20.0::DOUBLE) AS floored,
  CASE l_partkey % 7 WHEN 0 THEN 1000.0::DOUBLE WHEN 1 THEN 12.5 WHEN 4 THEN -0.5 WHEN 6 THEN 7.0 END AS parsed FROM x""")
def scalar_math(spark, folder):
    price, q = F.col("price"), F.col("q")
    one = F.lit(1.0)
    return table(spark, folder, "lineitem").selectExpr(*MATH).select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"), F.abs(q).alias("size"), (-q).alias("flipped"), safe_div(price, q).alias("ratio"),
        N.round_exact(price / 7, 2).alias("exact2"), N.round_exact(price / 40, 1).alias("exact1"),
        N.round_scaled(price / 40, 1).alias("scaled1"), N.half_up(price / 7, 3).alias("up3"),
        N.fixed_decimals(q / 3, 4).alias("fixed4"), N.capped_share(F.abs(q), 20).alias("capped"),
        N.not_below_zero(one - F.abs(q) / F.lit(20.0)).alias("floored"), N.parse_number(F.col("n")).alias("parsed"))


@query("scalar_arrays", f"""
WITH x AS (SELECT p_partkey, p_type, p_brand, p_size, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_name END AS p_name,
  CASE p_partkey % 4 WHEN 0 THEN 'p_type' WHEN 1 THEN 'p_brand' WHEN 2 THEN NULL ELSE 'otra' END AS wanted,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE concat('PROMO-', p_type, '-', p_size) END AS listed FROM part)
SELECT p_partkey AS id, CASE WHEN listed IS NULL THEN 0 ELSE 3 END AS items, coalesce(list_contains(string_split(listed, '-'), p_type), false) AS has_type,
  coalesce(strpos(p_name, 'ring') > 0, false) AS has_ring, CASE wanted WHEN 'p_type' THEN p_type WHEN 'p_brand' THEN p_brand END AS picked,
  {H('(p_size + p_partkey % 10 + 1) / 3.0::DOUBLE')} AS mean,
  {H("CASE WHEN listed IS NULL THEN 0 WHEN p_type = 'PROMO' THEN 0.5 ELSE 2 / 3.0::DOUBLE END")} AS alike FROM x""")
def scalar_arrays(spark, folder):
    rows = table(spark, folder, "part").selectExpr(
        "p_partkey", "p_type", "p_brand", "p_size", "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_name END AS p_name",
        "CASE p_partkey % 4 WHEN 0 THEN 'p_type' WHEN 1 THEN 'p_brand' WHEN 2 THEN NULL ELSE 'otra' END AS wanted",
        "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE concat('PROMO-', p_type, '-', CAST(p_size AS STRING)) END AS listed")
    items = A.split_list(F.col("listed"))
    sizes = F.array(F.col("p_size").cast("double"), (F.col("p_partkey") % 10).cast("double"), F.lit(1.0))
    # The list holds PROMO, the type and the size; compared with PROMO and the type.
    alike = A.similarity(items, F.array(F.lit("PROMO"), F.col("p_type")))
    return rows.select(
        F.col("p_partkey").alias("id"), F.size(items).alias("items"), A.contains(items, F.col("p_type")).alias("has_type"),
        A.part_of(F.lit("ring"), F.col("p_name")).alias("has_ring"),
        A.value_named(A.value_map(["p_type", "p_brand"]), F.col("wanted")).alias("picked"),
        N.half_up(A.mean_of(sizes), 6).alias("mean"), N.half_up(alike, 6).alias("alike"))


WORD_LISTS = {"client": P.CLIENT_WORDS, "sales": P.SALES_WORDS, "stock": P.STOCK_WORDS, "purchase": P.PURCHASE_WORDS,
              "period": P.PERIOD_WORDS, "unit": P.UNIT_WORDS, "amount": P.VALUE_WORDS, "product": P.PRODUCT_WORDS,
              "currency": P.CURRENCY_WORDS, "dated": P.DATE_IN_NAME, "password": P.PASSWORD_WORDS}
NAMED = ["page_id", "concat(url, CASE page_id % 9 WHEN 0 THEN '_2024-03-15' WHEN 1 THEN ' Q3-2023' WHEN 2 THEN ' 2024-05' WHEN 3 THEN ' 2024-0512'"
         " WHEN 4 THEN ' Factura AÑO' WHEN 5 THEN ' Sold_To (uds) $' WHEN 6 THEN ' STOCK contraseña' WHEN 7 THEN 'Unnamed' ELSE ' iqvia' END) AS n",
         "CASE page_id % 5 WHEN 0 THEN 'Unnamed: 3' WHEN 1 THEN ' ' WHEN 2 THEN 'año (kg)' WHEN 3 THEN 'qty*' ELSE url END AS c",
         "CASE page_id % 8 WHEN 0 THEN '20240315' WHEN 1 THEN '1000001' WHEN 2 THEN '12.50' WHEN 3 THEN '-000000000000012.5000'"
         " WHEN 4 THEN '2024031' WHEN 5 THEN '1000002' WHEN 6 THEN '12345.50' ELSE '12.5000' END AS f"]


@query("scalar_patterns", f"""
WITH x AS (SELECT {', '.join(NAMED)} FROM pages)
SELECT page_id AS id, {', '.join(f"regexp_matches(n, '{_any(w)}') AS {k}" for k, w in WORD_LISTS.items())},
  trim(c) <> '' AND NOT starts_with(c, 'Unnamed') AND NOT regexp_matches(c, '[^a-zA-Z0-9áéíóúÁÉÍÓÚñÑüÜ _./()-]') AS clean,
  regexp_matches(f, '^[0-9]{{8}}$') AS day8, regexp_matches(f, '^[01]{{7}}$') AS flags7, regexp_matches(f, '^[0-9]{{1,4}}\\.[0-9]{{2}}$') AS dec2,
  regexp_matches(f, '^[+-][0-9]{{15}}\\.[0-9]{{4}}$') AS credit FROM x""")
def scalar_patterns(spark, folder):
    rows = table(spark, folder, "pages").selectExpr(*NAMED).withColumn("low", F.lower("n"))
    return rows.select(
        F.col("page_id").alias("id"), *[P.mentions("low", w).alias(k) for k, w in WORD_LISTS.items()],
        P.is_clean_name(F.col("c")).alias("clean"), F.col("f").rlike(P.EIGHT_DIGITS).alias("day8"),
        F.col("f").rlike(P.SEVEN_FLAGS).alias("flags7"), F.col("f").rlike(P.TWO_DECIMALS).alias("dec2"),
        F.col("f").rlike(P.SIGNED_CREDIT).alias("credit"))
