"""Equi joins and what is built from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def keys_equal(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """All keys equal, NULL equal to NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def null_safe_anti(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not in ``other``; NULL keys match each other."""
    return df.join(other, keys_equal(df, other, keys), "left_anti")


def outer_enrich(base: DataFrame, detail: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows of a full outer join in which ``base`` brings the keys only.

    Matched rows are the detail rows themselves, so only the base keys without detail have
    to be looked for: distinct keys against distinct keys, with no fan-out and no wide join.
    NULL keys match each other.
    """
    keys = list(keys)
    missing = null_safe_anti(base.select(*keys).distinct(), detail.select(*keys).distinct(), keys)
    return detail.distinct().unionByName(missing, allowMissingColumns=True)


def delete_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Remove all rows whose key is listed; rows with a NULL key stay."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def not_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """SQL ``NOT IN``: a NULL in the list, or a NULL key against a non-empty list, gives no row.

    One small row says whether the list has a NULL and whether it has rows; the rest is an
    anti join, which unlike the null-aware join can be spread over the cluster.
    """
    listed = ids.select(F.col(key).alias("_id"))
    facts = listed.agg(F.count(F.lit(1)).alias("rows"), F.count("_id").alias("present")).first()
    if facts["rows"] > facts["present"]:
        return df.filter(F.lit(False))
    if facts["rows"]:
        df = df.filter(F.col(key).isNotNull())
    return df.join(listed.distinct(), F.col(key) == F.col("_id"), "left_anti")


def append_missing(base: DataFrame, kept: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Add the base rows whose key was lost, with default values in the computed columns."""
    lost = base.join(kept.select(key).distinct(), key, "left_anti")
    filled = lost.withColumns(
        {c: F.lit(v).cast(kept.schema[c].dataType) for c, v in defaults.items()}
    )
    return kept.unionByName(filled, allowMissingColumns=True)


def membership_flag(df: DataFrame, ids: DataFrame, key: str, out: str) -> DataFrame:
    """1 if the key is listed, else 0."""
    listed = ids.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(out, F.lit(1))
    return df.join(listed, key, "left").fillna(0, subset=[out])


def lookup_update(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, value: str) -> DataFrame:
    """Take ``value`` from a table with one row per key; NULL where there is none.

    Spark broadcasts the lookup by its own size check.
    """
    side = lookup.select(F.col(lookup_key).alias("_key"), F.col(value).alias(value))
    return df.drop(value).join(side, F.col(key) == F.col("_key"), "left").drop("_key")


def single_match_update(df: DataFrame, other: DataFrame, key: str, other_key: str, value: str) -> DataFrame:
    """Take ``value`` from any matching row without fan-out: the smallest non-NULL one."""
    one = other.groupBy(F.col(other_key).alias("_key")).agg(F.min(value).alias(value))
    return df.drop(value).join(one.filter("_key is not null"), F.col(key) == F.col("_key"), "left").drop("_key")


def outer_chain(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer join of per-key tables."""
    return reduce(lambda a, b: a.join(b, key, "full"), frames)
