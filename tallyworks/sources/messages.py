"""Attachments of messages as rows; data attachments become inputs of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.sources.files import DATA_EXTENSIONS, extension, size_kb

# What stands in for a missing subject, sender, date or attachment name.
NO_SUBJECT, NO_SENDER, NO_DATE, NO_NAME = "(sin asunto)", "?", "?", "adjunto"


def attachment_rows(messages: DataFrame, data: Sequence[str] = DATA_EXTENSIONS) -> DataFrame:
    """One row per attachment of `attachments: array<struct<name, data>>`.

    Size in KB (null without content), extension, and whether it is a data file.
    """
    rows = messages.select("message", "path", "subject", "sender", "date", F.explode("attachments").alias("_a"))
    name = F.coalesce(F.nullif(F.col("_a.name"), F.lit("")), F.lit(NO_NAME))
    n_bytes = F.octet_length(F.col("_a.data"))
    return rows.select(
        "message", "path", F.coalesce(F.nullif(F.col("subject"), F.lit("")), F.lit(NO_SUBJECT)).alias("subject"),
        F.coalesce(F.nullif(F.col("sender"), F.lit("")), F.lit(NO_SENDER)).alias("sender"),
        F.coalesce(F.col("date").cast("string"), F.lit(NO_DATE)).alias("date"),
        name.alias("attachment"), extension(name).alias("extension"),
        F.when(n_bytes > 0, size_kb(n_bytes)).alias("size_kb"),
        extension(name).isin(*data).alias("is_data"))


def attachment_inputs(attachments: DataFrame) -> DataFrame:
    """Data attachments with content as files of origin `adjunto` under their message."""
    return attachments.filter(F.col("is_data") & F.col("size_kb").isNotNull()).select(
        F.lit("(en correo)").alias("path"), F.col("attachment").alias("name"), "extension", "size_kb",
        F.lit("adjunto").alias("origin"), F.col("message").alias("parent_message"), "subject", "sender",
        F.col("date").alias("message_date"))


def attachment_contents(messages: DataFrame, data: Sequence[str] = DATA_EXTENSIONS) -> DataFrame:
    """Data attachments with content as inputs of their own: what `attachment_inputs` lists, with bytes and lineage.

    `messages` also holds `subfolder`. `input_id` names the message's path and the attachment's place in it.
    """
    rows = messages.select("message", "path", "subfolder", "subject", "sender", "date", F.posexplode("attachments").alias("_at", "_a"))
    name = F.coalesce(F.nullif(F.col("_a.name"), F.lit("")), F.lit(NO_NAME))
    taken = rows.filter(extension(name).isin(*data) & (F.octet_length("_a.data") > 0))
    return taken.select(
        F.concat("path", F.lit("#"), F.col("_at").cast("string")).alias("input_id"), F.lit("(en correo)").alias("path"), name.alias("name"), "subfolder",
        F.coalesce(F.nullif(F.col("subject"), F.lit("")), F.lit(NO_SUBJECT)).alias("subject"),
        F.coalesce(F.nullif(F.col("sender"), F.lit("")), F.lit(NO_SENDER)).alias("sender"),
        F.coalesce(F.col("date").cast("string"), F.lit(NO_DATE)).alias("message_date"), F.lit(None).cast("string").alias("mtime"),
        F.lit("adjunto").alias("origin"), F.col("message").alias("parent_message"), F.ltrim(extension(name), F.lit(".")).alias("format"),
        F.col("_a.data").alias("content"))
