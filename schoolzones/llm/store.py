"""Steps stored in the folder that all executors share, so that lineage ends there."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a one-process session without one gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's folder there."""
    return f"{_own(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete what this application has stored; no DataFrame that reads it may be used after."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: later steps reread it instead of computing it again."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
