"""Scores of files: rule levels, weighted score with ceilings, overrides, eight criteria, presence.

Everything a file needs is on its own row, so scoring is one projection without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import patterns as P
from tallyworks.functions.numbers import capped_share, half_up, not_below_zero, round_exact
from tallyworks.plans.profiling import NO_GROUP
from tallyworks.plans.rules import (CATEGORIES, CLEAN_LEVELS, CODES, CRITERIA, EIGHT_CATEGORIES, NOT_EVALUABLE,
                                    RULES, SIMILARITY_LEVELS, TOTAL_WEIGHT, UNUSABLE)

PURPOSE_WORDS = [*P.SALES_WORDS, *P.STOCK_WORDS, *P.PURCHASE_WORDS]


def _first(*cases: tuple[Column, int], otherwise: int) -> Column:
    out = F
    for condition, level in cases:
        out = out.when(F.coalesce(condition, F.lit(False)), F.lit(level))
    return out.otherwise(F.lit(otherwise))


def graded(value: Column, grades: Sequence[tuple[float, int | str]], otherwise: int | str) -> Column:
    """First grade whose bound the value reaches."""
    out = F
    for bound, grade in grades:
        out = out.when(value >= F.lit(bound), F.lit(grade))
    return out.otherwise(F.lit(otherwise))


def _given(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) != ""


def lowered_texts() -> dict[str, Column]:
    """The texts of a file row in the form the patterns are tried on."""
    names, subject = P.joined_names(F.col("columns")), F.coalesce("subject", F.lit(""))
    return {
        "_names": names,
        "_name": F.lower("name"),
        "_about": F.lower(F.concat_ws(P.NAME_MARK, "name", subject)),
        "_title": F.lower(F.concat("name", subject)),
        "_context": F.concat_ws(" ", F.lower(F.concat_ws(" ", "name", "subject", "sender")), names, F.lower("subfolder")),
        "_name_list": F.split(names, P.NAME_MARK),
    }


def text_features() -> dict[str, Column]:
    """What the rules ask of the lowered texts, each pattern tried once per file."""
    rest = F.length(F.regexp_replace("name", P.LONG_DATE_IN_NAME, ""))
    return {
        "_date_column": P.mentions("_names", P.DATE_COLUMN),
        "_dated_name": P.date_in_name("_name"),
        "_mostly_date": rest < F.length("name") * F.lit(0.6),
        "_client_column": P.mentions("_names", P.CLIENT_WORDS),
        "_client_name": P.mentions("_about", P.CLIENT_WORDS),
        "_period_column": P.mentions("_names", P.PERIOD_WORDS),
        "_own_code": P.mentions("_names", P.OWN_PRODUCT_CODE),
        "_maker_code": P.mentions("_names", P.MAKER_PRODUCT_CODE),
        "_client_code": P.mentions("_names", P.CLIENT_PRODUCT_CODE),
        "_product_column": P.mentions("_names", P.PRODUCT_WORDS),
        "_units": P.count_mentions("_name_list", P.UNIT_WORDS),
        "_unit_of_measure": P.mentions("_names", P.UNIT_OF_MEASURE),
        "_purpose_column": P.mentions("_names", PURPOSE_WORDS),
        "_purpose_name": P.mentions("_title", PURPOSE_WORDS),
        "_values": P.count_mentions("_name_list", P.VALUE_WORDS),
        "_currency": P.mentions("_context", P.CURRENCY_WORDS),
    }


def level_columns(compared: str = "group_files") -> dict[str, Column]:
    """Level of each rule from a file row and its text features; the first case that holds counts.

    `compared` is the column with the number of files of the group whose columns were compared.
    """
    merged, mixed, blank = F.col("merged"), F.col("mixed"), F.col("leading_blank")
    pivot, table = F.col("has_pivot"), F.col("has_table")
    with_data, n_sheets = F.col("sheets_with_data"), F.col("num_sheets")
    units, values, currency = F.col("_units"), F.col("_values"), F.col("_currency")
    dated, purpose = F.col("_dated_name"), F.col("_purpose_column")
    tidy = (blank == 0) & (merged == 0) & (mixed == 0) & (F.col("header_ok") == with_data)
    clean_level = graded(F.coalesce("mean_clean", F.lit(0.0)), CLEAN_LEVELS, UNUSABLE)
    return {
        "A": _first((F.col("_date_column"), 0), (dated, 1), (_given("message_date"), 2), (_given("mtime"), 3),
                    otherwise=4),
        "B": _first((F.col("_client_column"), 0), (F.col("_client_name"), 1), (F.col("sender").contains("@"), 2),
                    (F.col("group") != NO_GROUP, 3), otherwise=4),
        "C": _first((F.col("has_date_column"), 0), (F.col("_period_column"), 1), (dated & F.col("_mostly_date"), 3),
                    (dated, 4), otherwise=5),
        "D": _first((F.col("group_files") >= 3, 0), (F.col("from_mail"), 2), otherwise=1),
        "E": F.when((F.col(compared) > 1) & F.col("similarity").isNotNull(),
                    graded(F.col("similarity"), SIMILARITY_LEVELS, UNUSABLE)).otherwise(clean_level),
        "F": _first((F.col("from_mail"), 2), (F.col("subfolder") != ".", 1), otherwise=3),
        "G": _first((F.col("has_password"), 0), (_given("error") & (F.col("sheets") == 0), 10), (_given("error"), 2),
                    otherwise=1),
        "H": _first(((n_sheets == 1) & (with_data == 1), 0), (with_data == n_sheets, 1), (with_data < n_sheets, 2),
                    otherwise=3),
        "I": _first((pivot & table, 3), (pivot, 2), (table, 1), (with_data > 0, 0), otherwise=10),
        "J": _first((tidy & (F.coalesce("mean_null", F.lit(0.0)) < 5), 0), (tidy, 1), ((blank > 0) & (blank <= 5), 2),
                    (blank > 5, 3), (merged > 20, 4), otherwise=1),
        "K": _first(((merged > 50) | (mixed > 5), 3), (pivot, 2), ((merged > 10) | (mixed > 2), 1), otherwise=0),
        "L": _first((F.col("_own_code"), 0), (F.col("_maker_code"), 1), (F.col("_client_code"), 2),
                    (F.col("_product_column"), 3), otherwise=4),
        "M": _first((units == 1, 0), (units > 1, 1), (F.col("_unit_of_measure"), 2), otherwise=3),
        "N": _first((purpose & F.col("_purpose_name"), 0), (purpose, 1), otherwise=2),
        "O": _first(((values == 1) & currency, 0), ((values > 1) & currency, 1), (values > 0, 2), otherwise=3),
    }


def rule_levels(files: DataFrame, compared: str = "group_files") -> DataFrame:
    """The file rows with one level column per rule.

    Columns used: name, subject, sender, message_date, mtime, subfolder, group, group_files,
    similarity, from_mail, columns (array), has_date_column, mean_clean, has_password, error,
    sheets, num_sheets, sheets_with_data, has_pivot, has_table, merged, mixed, leading_blank,
    header_ok, mean_null.
    """
    texts, features = lowered_texts(), text_features()
    levels = {f"level_{c}": level.cast("int") for c, level in level_columns(compared).items()}
    return (files.withColumns(texts).withColumns(features).drop(*texts)
            .withColumns(levels).drop(*features))


def _remaining(level: Column, max_level: int) -> Column:
    return F.lit(1.0) - F.least(level, F.lit(max_level)) / F.lit(float(max_level))


def _points(level: Column, weight: int, max_level: int) -> Column:
    return _remaining(level, max_level) * F.lit(float(weight)) / F.lit(float(TOTAL_WEIGHT)) * F.lit(100.0)


def _blocked(level: Column, ceiling: int | None) -> Column:
    return F.lit(False) if ceiling is None else F.coalesce(level == UNUSABLE, F.lit(False))


def score_files(files: DataFrame) -> DataFrame:
    """Points per rule, score, category and blocking rule from the level columns.

    Points are rounded to two decimals and their sum is held to two decimals as well; rules without a level are left out
    and the rest weighed up. A blocking rule at the unusable level gives no points and caps the score;
    the rule with the lowest cap is reported.
    """
    level = {r.code: F.col(f"level_{r.code}") for r in RULES}
    points = {f"points_{r.code}": F.when(level[r.code].isNotNull(), F.when(
        _blocked(level[r.code], r.ceiling), F.lit(0.0)).otherwise(
        round_exact(_points(level[r.code], r.weight, r.max_level), 2))) for r in RULES}
    scored = files.withColumns(points)
    total = half_up(reduce(lambda a, b: a + b, [F.coalesce(F.col(p), F.lit(0.0)) for p in points]), 2)
    weight = reduce(lambda a, b: a + b, [
        F.when(level[r.code].isNotNull(), F.lit(r.weight)).otherwise(F.lit(0)) for r in RULES])
    caps = sorted([r for r in RULES if r.ceiling is not None], key=lambda r: r.ceiling)
    blocker, cap = F, F
    for r in caps:
        blocker = blocker.when(_blocked(level[r.code], r.ceiling), F.lit(r.code))
        cap = cap.when(_blocked(level[r.code], r.ceiling), F.lit(float(r.ceiling)))
    evaluable = F.col("_weight") > 0
    base = F.least(round_exact(F.col("_total") * (F.lit(float(TOTAL_WEIGHT)) / F.greatest(F.col("_weight"), F.lit(1))),
                               1), F.lit(100.0))
    return (scored.withColumns({"_total": total, "_weight": weight})
            .withColumn("score", F.when(evaluable, F.least(base, cap.otherwise(F.lit(100.0)))).otherwise(F.lit(0.0)))
            .withColumn("category", F.when(evaluable, graded(F.col("score"), CATEGORIES[:-1], CATEGORIES[-1][1]))
                        .otherwise(F.lit(NOT_EVALUABLE)))
            .withColumn("blocked_by", F.when(evaluable, blocker.otherwise(F.lit(None).cast("string"))))
            .drop("_total", "_weight"))


def score_with_overrides(files: DataFrame, overrides: DataFrame, key: str = "path") -> DataFrame:
    """Score of the levels an analyst set where set, else the detected ones, else zero.

    `overrides` holds (key, code, level). Points are not rounded on the way, rules are not weighed
    up, and the sum is rounded once.
    """
    wide = overrides.groupBy(key).pivot("code", list(CODES)).agg(F.max("level"))
    wide = wide.select(key, *[F.col(c).alias(f"set_{c}") for c in CODES])
    used = files.join(wide, key, "left").withColumns(
        {f"used_{c}": F.coalesce(F.col(f"set_{c}"), F.col(f"level_{c}"), F.lit(0)) for c in CODES})
    parts, caps = [], [F.lit(100.0)]
    for r in RULES:
        level = F.col(f"used_{r.code}")
        blocked = _blocked(level, r.ceiling)
        parts.append(F.when(blocked, F.lit(0.0)).otherwise(_points(level, r.weight, r.max_level)))
        if r.ceiling is not None:
            caps.append(F.when(blocked, F.lit(float(r.ceiling))).otherwise(F.lit(100.0)))
    total = half_up(reduce(lambda a, b: a + b, parts), 1)
    return (used.withColumn("override_score", F.least(total, F.least(*caps)))
            .drop(*[f"set_{c}" for c in CODES]))


def rule_table(spark: SparkSession) -> DataFrame:
    """The rules as rows: one per rule and level."""
    rows = [(r.code, r.description, r.weight, level, text, r.ceiling is not None, r.ceiling, r.measured)
            for r in RULES for level, text in sorted(r.levels.items())]
    return spark.createDataFrame(rows, "code string, rule string, weight int, level int, level_text string, "
                                       "blocking boolean, ceiling int, measured boolean")


def long_levels(files: DataFrame, key: str = "path") -> DataFrame:
    """(key, code, level) rows of the level columns."""
    stack = ", ".join(f"'{c}', level_{c}" for c in CODES)
    return files.selectExpr(key, f"stack({len(CODES)}, {stack}) AS (code, level)")


def level_usage(files: DataFrame, rules: DataFrame) -> DataFrame:
    """The rule table with the number of files at each level, levels without files included."""
    used = long_levels(files).groupBy("code", "level").agg(F.count(F.lit(1)).alias("files"))
    return rules.join(used, ["code", "level"], "left").withColumn("files", F.coalesce("files", F.lit(0)))


def score_eight(files: DataFrame) -> DataFrame:
    """Eight weighted criteria, each rounded half-even to a whole number, their total and category.

    Columns used: sheets, blank_sheets, num_sheets, header_ok, from_first_cell, merged, formulas,
    mean_null, mixed, total_columns, mean_clean. A file without a sheet with data scores zero.
    """
    one = F.lit(1.0)
    with_data = F.col("sheets") - F.col("blank_sheets")
    least_one = F.greatest(with_data, F.lit(1))
    w = {c: F.lit(float(v)) for c, v in CRITERIA.items()}
    exact = {
        "structure": w["structure"] * (F.col("header_ok") / least_one) * (one - capped_share(F.col("merged"), 20) * 0.5),
        "no_formulas": w["no_formulas"] * (one - capped_share(F.col("formulas"), 50)),
        "few_nulls": w["few_nulls"] * not_below_zero(one - F.coalesce("mean_null", F.lit(0.0)) / F.lit(100.0)),
        "same_types": w["same_types"] * (one - F.col("mixed") / F.greatest(F.col("total_columns"), F.lit(1))),
        "clean_names": w["clean_names"] * F.col("mean_clean") / F.lit(100.0),
        "one_table": w["one_table"] * (F.col("from_first_cell") / least_one),
        "no_blank_sheets": w["no_blank_sheets"] * (one - F.least(one, F.col("blank_sheets") / F.greatest(
            F.col("sheets"), F.lit(1)))),
        "few_sheets": w["few_sheets"] * not_below_zero(one - (F.col("num_sheets") - 1) / F.lit(10.0)),
    }
    scored = files.withColumns({f"points_{c}": F.when(with_data > 0, F.rint(v).cast("int")).otherwise(F.lit(0))
                                for c, v in exact.items()})
    total = reduce(lambda a, b: a + b, [F.col(f"points_{c}") for c in CRITERIA])
    return scored.withColumn("score", total).withColumn(
        "category", graded(F.col("score"), EIGHT_CATEGORIES[:-1], EIGHT_CATEGORIES[-1][1]))


def score_presence(files: DataFrame) -> DataFrame:
    """Full score where a file has any sheet, else zero."""
    full = sum(CRITERIA.values())
    scored = files.withColumn("score", F.when(F.col("sheets") > 0, F.lit(full)).otherwise(F.lit(0)))
    return scored.withColumn("category", graded(F.col("score"), EIGHT_CATEGORIES[:-1], EIGHT_CATEGORIES[-1][1]))
