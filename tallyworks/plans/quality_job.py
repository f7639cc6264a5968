"""The file quality job from file contents to scores: cells, profile, file facts, groups, levels, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.groups import attach, sized_groups
from tallyworks.plans import profiling as PF
from tallyworks.plans import scoring as SC
from tallyworks.sources.cells import file_cells
from tallyworks.sources.staging import staged

UNREADABLE = "sin registros"


def file_facts(files: DataFrame, prefixes: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """What the rules ask of each file, worked out from its contents.

    `files` holds path, name, subfolder, subject, sender, message_date, mtime, origin ('directo' or 'adjunto'), format
    and content (bytes of a delimited file). A file without any record counts as unreadable. Workbook features that
    delimited files cannot have (formulas, merges, tables, pivots, passwords) are absent.
    """
    metrics = content_metrics(files, "path")
    known = with_metrics(files.drop("content"), metrics, "path").withColumn("group", PF.infer_group(F.col("path"), F.col("subfolder"), prefixes))
    facts = staged(known, "facts")
    alike = PF.schema_consistency(facts.filter(F.size("columns") > 0), "group", ["path"]).select("group", "similarity")
    groups = sized_groups(facts, ["group"], [F.count(F.lit(1)).cast("int").alias("group_files")]).join(alike, "group", "left")
    return attach(facts, groups, ["group"], slot_by=["path"])


def content_metrics(contents: DataFrame, key: str) -> DataFrame:
    """What the rules ask of each content, by its key; contents without any record have no row."""
    cells = staged(file_cells(contents, key), "cells")
    sheets, body = PF.promote_header(cells)
    sheets, body = staged(sheets, "sheets"), staged(body, "body")
    metrics = PF.file_metrics(PF.sheet_summary(sheets, body, infer=False), PF.column_profile(sheets, body, infer=False))
    return metrics.withColumnRenamed("file", key)


def with_metrics(files: DataFrame, metrics: DataFrame, key: str) -> DataFrame:
    """Files with the metrics of their content; a file without metrics is unreadable, workbook features are absent."""
    known = files.join(metrics, key, "left")
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in
              ("sheets", "sheets_with_data", "blank_sheets", "header_ok", "leading_blank", "total_columns", "mixed")}
    absent = {"merged": F.lit(0), "formulas": F.lit(0), "has_pivot": F.lit(False), "has_table": F.lit(False), "has_password": F.lit(False)}
    return known.withColumns({
        **counts, **absent, "error": F.when(F.col("sheets").isNull(), F.lit(UNREADABLE)), "num_sheets": counts["sheets"],
        "mean_clean": F.coalesce("mean_clean", F.lit(0.0)), "has_date_column": F.coalesce("has_date_column", F.lit(False)),
        "columns": F.coalesce("columns", F.array().cast("array<string>")), "from_mail": F.col("origin") == "adjunto"})


def scored_files(files: DataFrame, prefixes: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """File facts, the fifteen levels, points, score, category and blocking rule of every file."""
    return SC.score_files(SC.rule_levels(file_facts(files, prefixes)))
