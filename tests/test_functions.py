"""Scalar functions against plain Python."""

import random

import numpy as np
from pyspark.sql import functions as F

from tallyworks.functions import arrays as A
from tallyworks.functions import dates as D
from tallyworks.functions import nullsafe as NS
from tallyworks.functions import numbers as N
from tallyworks.functions import patterns as P
from tallyworks.functions import strings as S


def one(spark, expr, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("r")).first()[0]


def test_exact_rounding_is_pythons(spark):
    rng = random.Random(7)
    values = [rng.uniform(-1000, 1000) for _ in range(500)] + [i / 8 for i in range(-400, 400)] + [
        i / 20 for i in range(400)] + [2.675, 1.005, 0.05, 4.35, -0.001]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(
        "x", N.round_exact(F.col("x"), 1).alias("one"), N.round_exact(F.col("x"), 2).alias("two"),
        N.fixed_decimals(F.col("x"), 4).alias("text"), N.round_scaled(F.col("x"), 1).alias("scaled")).collect()
    for r in rows:
        assert r.one == round(r.x, 1) and r.two == round(r.x, 2)
        assert r.text == f"{r.x:.4f}" and r.scaled == float(np.round(r.x, 1))


def test_zero_fill_is_pythons(spark):
    for text in ["5", "-5", "+12", "", "123456", "-", "a1"]:
        assert one(spark, S.zero_fill(F.col("x"), 4), text) == text.zfill(4)


def test_number_texts(spark):
    got = {t: one(spark, N.parse_number(F.col("x")), t) for t in ["1e3", " 12 ", "1d", "0x1", ".5", "7.", "", "-", "nan", "1,5"]}
    assert got == {"1e3": 1000.0, " 12 ": 12.0, "1d": None, "0x1": None, ".5": 0.5, "7.": 7.0, "": None, "-": None,
                   "nan": None, "1,5": None}
    assert one(spark, N.is_number(F.col("x")), "inf") is True


def test_texts(spark):
    assert one(spark, S.plain_upper(F.col("x")), "  año Pingüino €x ") == "ANO PINGUINO X"
    assert one(spark, S.clean_value(F.col("x")), " NaT ") == "" and one(spark, S.clean_value(F.col("x"))) == ""
    assert one(spark, S.pad_code(F.col("x"), 3), "7") == "007" and one(spark, S.pad_code(F.col("x"), 3), "12345") == "345"
    assert one(spark, S.pad_code(F.col("x"), 3)) is None
    assert one(spark, S.all_but_last_word(F.col("x")), "solo") == "" and one(spark, S.last_word(F.col("x")), "a  b\tc") == "c"
    assert one(spark, D.date_digits(F.col("x"), 8), "2024-01-05 10:00") == "20240105"


def test_missing_values_are_different_and_not_in(spark):
    assert one(spark, NS.not_in(F.col("x"), ["a"])) is True and one(spark, NS.not_in(F.col("x"), ["a"]), "a") is False
    assert one(spark, NS.differs(F.col("x"), "a")) is True and one(spark, NS.differs(F.col("x"), "a"), "a") is False


def test_sums_over_nothing(spark):
    df = spark.createDataFrame([("a", None, None), ("a", None, 1.0), (None, 5.0, 1.0)], "k string, v double, w double")
    assert df.filter("k = 'a'").agg(NS.sum0(F.col("v"))).first()[0] == 0.0
    assert df.agg(NS.sum_if_any(F.col("k") == "z", F.col("w"))).first()[0] is None
    assert df.filter("k = 'a'").agg(NS.sum_if_any(F.col("k") == "a", F.col("v"))).first()[0] == 0.0
    got = [r[0] for r in df.select(NS.row_sum(F.col("v"), F.col("w"))).collect()]
    assert got == [None, 1.0, 6.0]


def test_division_by_zero_is_null(spark):
    assert one(spark, NS.safe_div(F.col("x"), F.lit(0.0)), 1.0, "double") is None


def test_lists(spark):
    assert one(spark, A.split_list(F.col("x"))) == []
    assert one(spark, A.contains(A.split_list(F.col("x")), F.lit("nan"))) is False
    assert one(spark, A.similarity(F.split("x", ","), F.array(F.lit("a"), F.lit("b"))), "a,c") == 1 / 3
    assert one(spark, A.similarity(F.array().cast("array<string>"), F.array().cast("array<string>"))) == 0.0


def test_keywords(spark):
    assert one(spark, P.mentions("x", P.STOCK_WORDS), "mi on_hand") is True and one(spark, P.mentions("x", P.STOCK_WORDS)) is False
    assert one(spark, P.mentions("x", P.CURRENCY_WORDS), "total $") is True
    assert one(spark, P.mentions("x", P.SALES_WORDS), "sell out") is True
    assert one(spark, P.date_in_name("x"), "v2024-0512") is False and one(spark, P.date_in_name("x"), "v2024-05.csv") is True
    for name, clean in [("Año (kg)", True), ("Unnamed: 0", False), ("", False), ("a*b", False), ("a.b/c-d_e", True)]:
        assert one(spark, P.is_clean_name(F.col("x")), name) is clean
    names = spark.createDataFrame([(["qty", "unidades", "x"],)], "n array<string>")
    assert names.select(P.count_mentions("n", P.UNIT_WORDS)).first()[0] == 2
