"""Set operations and wide-to-long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def concat(*frames: DataFrame) -> DataFrame:
    """Stack by column name; absent columns are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def missing_keys(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``df`` that ``other`` lacks."""
    return df.select(key).distinct().join(other.select(key), key, "left_anti")


def unpivot_groups(
    df: DataFrame, groups: Mapping[str, Sequence[str]], label: str, values: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per group: its label and its columns under common names; one pass over ``df``."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias(label),
                *[F.col(c).cast("double").alias(v) for c, v in zip(columns, values)],
            )
            for name, columns in groups.items()
        ]
    )
    return df.select(*keep, F.inline(rows))


def absent_rows(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The new rows whose key is not present; the first of equal new keys by value wins. NULL is a key like others."""
    rest = [c for c in new.columns if c != key]
    one = new.groupBy(key).agg(F.min(F.struct(*rest) if rest else F.struct(F.lit(0))).alias("_r"))
    known = existing.select(F.col(key).alias("_known"))
    fresh = one.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    return fresh.select(key, *[F.col("_r")[c].alias(c) for c in rest])


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Add the new rows whose key is not present; the first of equal new keys by value wins."""
    return existing.unionByName(absent_rows(existing, new, key))


def update_columns(target: DataFrame, metrics: DataFrame, key: str) -> DataFrame:
    """Write metric columns into the rows with the same key; other rows keep theirs.

    A matched row takes the new value even when that is NULL.
    """
    names = [c for c in metrics.columns if c != key]
    side = metrics.select(key, *[F.col(c).alias(f"_new_{c}") for c in names], F.lit(True).alias("_hit"))
    joined = target.join(side, key, "left")
    for c in names:
        old = F.col(c) if c in target.columns else F.lit(None)
        joined = joined.withColumn(c, F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(old))
    return joined.drop("_hit", *[f"_new_{c}" for c in names])
