"""Scans and sinks; tables that are written more than once are in versions.py."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only these columns are read from the files."""
    return spark.read.parquet(path).select(*[F.col(f"`{c}`") for c in columns])


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header and a given schema (no inference pass over the data)."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files with a header, written in parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_new(df: DataFrame, path: str) -> DataFrame:
    """Create a table; an existing one is an error."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def lookup_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A short fixed table."""
    return spark.createDataFrame(list(rows), list(columns))


def points_from_lonlat(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Rows that have both coordinates (NULL and NaN are missing)."""
    present = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.filter(present(lon) & present(lat))
