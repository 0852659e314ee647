"""Projection and cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that become equal are an error."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names collide in lower case: {sorted(names)}")
    return df.toDF(*names)


def rename_select(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns under their new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def add_if_absent(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column unless it exists already."""
    return df if name in df.columns else df.withColumn(name, value)


def lower_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.lower(F.col(c)) for c in columns})


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def numbers_or_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text.number_or_zero(F.col(f"`{c}`")) for c in columns})


def scale(df: DataFrame, columns: Sequence[str], factor: float) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.lit(factor) for c in columns})


def label_from(df: DataFrame, column: str, mapping: Mapping[str, str], out: str) -> DataFrame:
    """Look a class up in a short fixed mapping; unknown classes are NULL."""
    pairs = [F.lit(v) for item in mapping.items() for v in item]
    return df.withColumn(out, F.try_element_at(F.create_map(*pairs), F.col(column)))
