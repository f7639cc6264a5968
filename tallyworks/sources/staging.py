"""Tables written in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tallyworks.session import shared_folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written once and read back: branches that read it do not work it out again, and a lost executor loses nothing.

    The table stays in the folder until its owner clears it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """df written once in hash buckets of keys: joins and groups on the keys read it without shuffling it again.

    By default as many buckets as the session's shuffles have partitions, so that the other side of a join is dealt to
    them. The table lies in the shared folder under a name of its own in the session's catalogue.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    label = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{label}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(label))
    return spark.table(label)
