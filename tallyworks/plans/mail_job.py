"""The quality job over a folder's files and the data attachments of its messages.

Contents are addressed by their hash: however many messages and paths hold a content, it is parsed and profiled once,
and its facts fan out to all of them. Each input keeps its lineage: its id, its message, and the hash of its content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.groups import attach, sized_groups
from tallyworks.operators.sets import stack
from tallyworks.plans import profiling as PF
from tallyworks.plans import scoring as SC
from tallyworks.plans.quality_job import content_metrics, with_metrics
from tallyworks.sources.files import split_errors
from tallyworks.sources.messages import attachment_contents
from tallyworks.sources.staging import staged


def all_inputs(files: DataFrame, messages: DataFrame) -> DataFrame:
    """Direct files and data attachments as rows of one kind, each with `input_id` and `content_id`.

    Copies of one file differ by their path, attachments by their message's path and their place in it.
    """
    direct = files.withColumn("input_id", F.col("path")).withColumn("parent_message", F.lit(None).cast("string"))
    inputs = stack([direct, attachment_contents(messages)])
    return inputs.withColumn("content_id", F.sha2(F.coalesce("content", F.lit(b"")), 256))


def mail_job(files: DataFrame, messages: DataFrame, prefixes: Sequence[tuple[str, str]] = ()) -> tuple[DataFrame, DataFrame]:
    """(scored inputs, inputs that could not be read).

    `files` is as for the quality job, `messages` holds message, path, subfolder, subject, sender, date and attachments.
    A group's direct files, readable or not, count for rule D (an attachment has none); the group's readable inputs of
    both kinds are compared for rule E, the first by its id being the reference. Cells, facts and inputs are staged while
    the plan is built.
    """
    inputs = all_inputs(files, messages)
    contents = inputs.groupBy("content_id").agg(F.first("content").alias("content"))
    metrics = content_metrics(contents, "content_id")
    known = with_metrics(inputs.drop("content"), metrics, "content_id")
    known = staged(known.withColumn("group", PF.infer_group(F.col("name"), F.col("subfolder"), prefixes)), "inputs")
    results, errors = split_errors(known)
    alike = PF.schema_consistency(results.filter(F.size("columns") > 0), "group", ["input_id"]).select("group", "similarity")
    counts = sized_groups(known, ["group"], [F.count_if(F.col("origin") == "directo").cast("int").alias("direct_files"),
                                             F.count_if(F.col("error").isNull()).cast("int").alias("group_results")]).join(alike, "group", "left")
    grouped = attach(results, counts, ["group"], slot_by=["input_id"])
    grouped = grouped.withColumn("group_files", F.when(F.col("origin") == "directo", F.col("direct_files")).otherwise(F.lit(0)))
    return SC.score_files(SC.rule_levels(grouped, compared="group_results")), errors
