"""Distinct counts and quantiles from stored sketches, for callers that ask for them; the exact forms are elsewhere.

A sketch of each key and day is stored once. Sketches of any days merge into that of all their rows without the rows, so
a longer span costs one small row per key and day. A day that comes again replaces what is stored of it.

The errors don't depend on the data's size. Distinct counts (HyperLogLog with 2^LG_SLOTS slots) have a relative standard
error of 1.04 / sqrt(2^LG_SLOTS), 0.8 percent. Quantiles (KLL with parameter KLL_K) have the rank asked for within
RANK_ERROR, 0.7 percent of the rows, in at least 99 of 100 cases; a few hundred values are kept exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import versions

LG_SLOTS, KLL_K = 14, 400
DISTINCT_ERROR, RANK_ERROR = 1.04 / 2 ** (LG_SLOTS / 2), 0.007


def daily(df: DataFrame, keys: Sequence[str], day: str, distinct: str | None = None, value: str | None = None) -> DataFrame:
    """(keys, day, n, distinct sketch, value sketch) with a row for each key and day; NULL and NaN values are left out."""
    number = F.col(value).cast("double") if value else F.lit(None).cast("double")
    number = F.when(~F.isnan(number), number)
    seen = F.col(distinct) if distinct else F.lit(None).cast("long")
    return df.groupBy(*keys, F.col(day).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(seen, LG_SLOTS).alias("distinct_sketch"),
        F.kll_sketch_agg_double(number, KLL_K).alias("value_sketch"),
    )


def store(sketches: DataFrame, path: str, tries: int = versions.TRIES) -> versions.Version:
    """Put these days' sketches in the place of what is stored of the same days; other days stay untouched."""
    spark = sketches.sparkSession
    parted = sketches.withColumn("part", F.coalesce(F.col("day").cast("string"), F.lit("none")))
    days = {r["part"] for r in parted.select("part").distinct().collect()}  # one name per day
    for _ in range(tries):
        try:
            return versions.replace_parts(parted, path, "part", lambda p: p in days, versions.version(spark, path))
        except versions.Conflict:
            continue
    raise versions.Conflict(f"{path}: {tries} other commits came first")


def between(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """The stored sketches of the days from ``first`` to ``last`` (YYYY-MM-DD, inclusive); only their files are read."""
    found = versions.version(spark, path)
    if found is None:
        raise versions.NoSuchVersion(f"{path} has no version")
    return versions.read_parts(spark, path, lambda day: first <= day <= last, found).drop("part")


def distinct_counts(sketches: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Estimated distinct values per key over all the given sketches."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias(out))


def quantiles(sketches: DataFrame, keys: Sequence[str], shares: Sequence[float], out: str = "q") -> DataFrame:
    """Values near the given ranks per key, as an array; NULL for a key without values. No interpolation."""
    whole = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("value_sketch").alias("_all"))
    picks = [F.kll_sketch_get_quantile_double("_all", F.lit(float(s))) for s in shares]
    some = F.kll_sketch_get_n_double("_all") > 0
    return whole.select(*keys, F.when(some, F.array(*picks)).alias(out))
