"""Session defaults, table loading and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster the submitter provides the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("periodica")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        # Call sites of column expressions are only used in error texts and slow plan building down.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="periodica-")


def work_dir(spark: SparkSession, label: str) -> str:
    """New folder for one run's written tables, on the storage all executors share.

    The cluster names that storage in ``spark.checkpoint.dir``. A machine-local folder is only
    made when the setting is missing and the session itself is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/periodica/{label}-{uuid.uuid4().hex}"
