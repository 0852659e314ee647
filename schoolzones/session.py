"""Session defaults and the shared place for tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "schoolzones", **extra) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cpus if cpus != "*" else 8),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder inside ``spark.checkpoint.dir``, which all executors must share.

    Only a purely local session (one process) gets a folder of its own where none is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="schoolzones-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/schoolzones-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a table in the application's folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def fixed(df: DataFrame) -> DataFrame:
    """Store ``df`` as Parquet and read it back, so that every reader and every retry sees the same rows.

    Readers take only the columns they need.
    """
    path = scratch_path(df.sparkSession, "fixed")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has stored; no DataFrame that reads it may be used after."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
