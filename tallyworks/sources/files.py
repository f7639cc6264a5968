"""File inventory: names, kinds, sizes and times without reading contents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.numbers import round_exact

# Extensions of data files and of messages, and the mark of a lock file.
DATA_EXTENSIONS = (".xls", ".xlsx", ".xlsm", ".xlsb", ".csv", ".txt")
MAIL_EXTENSIONS = (".msg",)
LOCK_PREFIX = "~$"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(name: Column) -> Column:
    """Lower-case extension with its dot; empty for a name without one or starting with its only dot."""
    return F.lower(F.regexp_extract(name, r"^\.*[^.].*?(\.[^.]*)$", 1))


def kind_of(ext: Column, data: Sequence[str] = DATA_EXTENSIONS, mail: Sequence[str] = MAIL_EXTENSIONS) -> Column:
    return F.when(ext.isin(*data), F.lit("datos")).when(ext.isin(*mail), F.lit("correo"))


def size_kb(n_bytes: Column) -> Column:
    return round_exact(n_bytes / F.lit(1024.0), 1)


def file_inventory(spark: SparkSession, root: str, data: Sequence[str] = DATA_EXTENSIONS,
                   mail: Sequence[str] = MAIL_EXTENSIONS) -> DataFrame:
    """One row per known file below `root`: path, name, subfolder, extension, kind, size_kb, mtime."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
              .select("path", "modificationTime", "length"))
    top = root.rstrip("/")
    local = F.regexp_replace(F.col("path"), r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//[^/]*)?", "")
    top_path = F.regexp_replace(F.lit(top), r"^[a-zA-Z][a-zA-Z0-9+.\-]*:(//[^/]*)?", "")
    inside = F.substring(local, F.length(top_path) + 2, F.length(local))
    folder = F.regexp_replace(inside, r"/?[^/]*$", "")
    name = base_name(F.col("path"))
    return (listed.select(
        "path", name.alias("name"), F.when(folder == "", F.lit(".")).otherwise(folder).alias("subfolder"),
        extension(name).alias("extension"), size_kb(F.col("length")).alias("size_kb"),
        F.date_format("modificationTime", "yyyy-MM-dd HH:mm").alias("mtime"))
        .withColumn("kind", kind_of(F.col("extension"), data, mail))
        .filter(~F.col("name").startswith(LOCK_PREFIX) & F.col("kind").isNotNull()))


def split_errors(files: DataFrame, error: str = "error", sheets: str = "num_sheets") -> tuple[DataFrame, DataFrame]:
    """(scored, errors): an error without any sheet is unreadable, an error with sheets is still scored."""
    unreadable = F.col(error).isNotNull() & (F.coalesce(F.col(sheets), F.lit(0)) == 0)
    return files.filter(~unreadable), files.filter(unreadable)
