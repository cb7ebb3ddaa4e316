"""Session options for local runs, and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "tillstream") -> SparkSession:
    """A session for tests and the local benchmark. Clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in OPTIONS.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="tillstream-")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder of the cluster.

    Only a session without ``spark.checkpoint.dir`` (a test) gets a local one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/tillstream/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table that several branches read, in the shared folder.

    It survives lost executors and is computed once. The folder is left to the
    retention of the checkpoint folder.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
