"""Report tables of the file scoring: key figures, categories, groups, rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.numbers import half_up, round_exact
from tallyworks.plans.rules import CATEGORIES, CODES, NOT_EVALUABLE, RULES

# Fixed value: width of a file name in the rankings.
NAME_WIDTH = 40


def total_score(score: str) -> Column:
    """Sum of one-decimal scores, freed of what adding doubles in another order would change."""
    return half_up(F.sum(score), 1)


def mean_score(score: str) -> Column:
    return round_exact(total_score(score) / F.greatest(F.count(F.lit(1)), F.lit(1)), 1)


def score_kpis(scores: DataFrame, score: str = "score") -> DataFrame:
    """Mean, best and worst score and file count; zeros for no file."""
    zero = F.lit(0.0)
    return scores.agg(F.coalesce(mean_score(score), zero).alias("mean_score"),
                      F.coalesce(F.max(score), zero).alias("best_score"),
                      F.coalesce(F.min(score), zero).alias("worst_score"), F.count(F.lit(1)).alias("files"))


def category_distribution(scores: DataFrame, categories: Sequence[str] = (*(c for _, c in CATEGORIES), NOT_EVALUABLE)) -> DataFrame:
    """Files per category, every category listed."""
    counts = scores.groupBy("category").agg(F.count(F.lit(1)).alias("files"))
    listed = scores.sparkSession.createDataFrame(list(enumerate(categories)), "place int, category string")
    return listed.join(counts, "category", "left").select("place", "category", F.coalesce("files", F.lit(0)).alias("files"))


def score_by_group(scores: DataFrame, group: str = "group", score: str = "score") -> DataFrame:
    """Per group: files, mean, least and greatest score; best mean first."""
    return (scores.groupBy(group)
            .agg(F.count(F.lit(1)).alias("files"), mean_score(score).alias("mean_score"),
                 F.min(score).alias("worst_score"), F.max(score).alias("best_score"),
                 (total_score(score) / F.count(F.lit(1))).alias("_exact"))
            .orderBy(F.col("_exact").desc(), group).drop("_exact"))


def score_report(scored: DataFrame, name_width: int = NAME_WIDTH) -> DataFrame:
    """The report row of a file: identity, levels and whether each is measured or an estimate, score, category, block."""
    return scored.select("path", F.left("name", F.lit(name_width)).alias("name"), F.col("name").alias("full_name"), "group", "format", "origin",
                         *[f"level_{c}" for c in CODES], *[F.lit(r.measured).alias(f"measured_{r.code}") for r in RULES], "score", "category",
                         F.coalesce("blocked_by", F.lit("")).alias("blocked_by"))


def excerpt(rows: DataFrame, order: Sequence[str], k: int = 50) -> tuple[DataFrame, DataFrame]:
    """The first k rows of a listing, and one row with the number of rows beyond them."""
    beyond = rows.agg(F.greatest(F.count(F.lit(1)) - k, F.lit(0)).alias("beyond"))
    return rows.orderBy(*order).limit(k), beyond
