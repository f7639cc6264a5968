"""Session settings used by the tests, the bench and stand-alone runs.

The operators never build a session: they use the one their input frames belong to.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from functools import cache

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "tallyworks", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benches; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TALLYWORKS_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        # Without it every column expression records its call site, which takes longer than small queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    """One folder for the process; it goes when the process ends."""
    folder = tempfile.mkdtemp(prefix="tallyworks-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Only where that is unset (a local test run) a folder of this machine stands in.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()
