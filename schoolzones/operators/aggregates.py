"""Group aggregates. All are partial-then-final, so a heavy key costs one partial row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify, constants as K, text


def group_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Sums under new names; NULL and NaN are skipped, a group without a value gives 0."""
    kinds = dict(df.dtypes)

    def value(c: str) -> Column:
        column = F.col(f"`{c}`")
        return text.no_nan(column) if kinds[c] in ("double", "float") else column

    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(value(c)), F.lit(0)).alias(out) for c, out in sums.items()])


def distinct_count(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(column).alias(out))


def none_valid(df: DataFrame, keys: Sequence[str], valid: Column, out: str) -> DataFrame:
    """1 for groups without a valid row; rows with a NULL key are left out."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(
        (~F.bool_or(F.coalesce(valid, F.lit(False)))).cast("int").alias(out)
    )


def extra_teacher_rows(df: DataFrame, school: str, certificate: str, valid: Column, out: str) -> DataFrame:
    """Per row: 1 if no row of the same school and certificate is valid (NULL certificate: 1).

    The groups are unique on one side, so a heavy key is a skewed join that Spark splits.
    """
    groups = none_valid(df, [school, certificate], valid, out)
    return df.join(groups, [school, certificate], "left").fillna(1, subset=[out])


def extra_teacher_schools(df: DataFrame, school: str, certificate: str, valid: Column) -> DataFrame:
    """Per school: whether any row is of an extra teacher. Needs no join back to the rows."""
    ok = F.coalesce(valid, F.lit(False)) & F.col(certificate).isNotNull()
    groups = df.groupBy(school, certificate).agg((~F.bool_or(ok)).cast("int").alias("_extra"))
    return (
        groups.groupBy(school)
        .agg(F.max("_extra").alias("extra_teacher_count"))
        .withColumn("has_extra_teacher", F.when(F.col("extra_teacher_count") == 1, "Yes").otherwise("No"))
    )


def teaching_mode(df: DataFrame, school: str, teacher: str) -> DataFrame:
    """Both / Virtual / In Person / Unknown from the teacher names of a school."""
    virtual = text.is_virtual_older(teacher)
    return df.groupBy(school).agg(
        F.when(F.bool_or(virtual) & F.bool_or(~virtual & F.col(teacher).isNotNull()), "Both")
        .when(F.bool_or(virtual), "Virtual")
        .when(F.bool_or(F.col(teacher).isNotNull()), "In Person")
        .otherwise("Unknown")
        .alias("classification")
    )


def value_counts(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(out)).orderBy(column)


def category_counts(ri: Column | str) -> list[Column]:
    """Counts of the three categories of a representation index."""
    category = classify.ri_category(ri)
    return [
        F.count_if(category == "Overrepresented").alias("overrepresentation"),
        F.count_if(category == "Parity").alias("parity"),
        F.count_if(category == "Underrepresented").alias("underrepresentation"),
    ]


def category_counts_by(df: DataFrame, group: str, ri: str, within: Sequence[str] = ()) -> DataFrame:
    """Category counts per group and a Total row, which also counts rows without a group; all that ``within`` keys."""
    within = [F.col(c) for c in within]
    return (
        df.groupingSets([[*within, F.col(group)], within], *within, F.col(group))
        .agg(F.grouping(group).alias("_total"), *category_counts(ri))
        .filter((F.col("_total") == 1) | F.col(group).isNotNull())
        .withColumn(group, F.when(F.col("_total") == 1, "Total").otherwise(F.col(group)))
        .drop("_total")
    )


def class_counts(df: DataFrame, column: str, labels: Sequence[str], out: str = "n") -> DataFrame:
    """Rows per listed class, zero for the classes that do not occur.

    The counts are per class, so the join sees one short row per class on both sides.
    """
    counts = df.filter(F.col(column).isin(*labels)).groupBy(column).agg(F.count(F.lit(1)).alias(out))
    legend = df.sparkSession.createDataFrame([(x,) for x in dict.fromkeys(labels)], [column])
    return legend.join(counts, column, "left").fillna(0, subset=[out])


def ratio_of_sums(columns: Sequence[str], denominator: str, prefix: str = "", factor: float = 1.0) -> list[Column]:
    """``sum(c) / sum(denominator)``; each sum skips NULL and NaN on its own, 0 below gives NULL."""
    number = lambda c: text.no_nan(F.col(c).cast("double"))
    total = F.sum(number(denominator))
    return [
        (F.try_divide(F.coalesce(F.sum(number(c)), F.lit(0.0)), total) * factor).alias(prefix + c)
        for c in columns
    ]


def weighted_mean(value: str, weight: str) -> Column:
    """Over rows that have both; NULL for a zero weight."""
    v, w = text.no_nan(F.col(value).cast("double")), text.no_nan(F.col(weight).cast("double"))
    both = v.isNotNull() & w.isNotNull()
    return F.try_divide(F.sum(F.when(both, v * w)), F.sum(F.when(both, w)))


def weighted_mean_std(df: DataFrame, key: str, value: str, weight: str, mean: str, std: str) -> DataFrame:
    """Weighted mean and population deviation, in two passes to keep all digits.

    Both go over the weights per key and value, which ``df`` is read for once.
    """
    rows = df.select(
        key, F.col(value).cast("double").alias("_v"), F.col(weight).cast("double").alias("_w")
    ).dropna()
    rows = rows.groupBy(key, "_v").agg(F.sum("_w").alias("_w"))
    means = rows.groupBy(key).agg(weighted_mean("_v", "_w").alias(mean))
    off = F.col("_v") - F.col(mean)
    return (
        rows.join(means, key)
        .groupBy(key)
        .agg(
            F.first(mean).alias(mean),
            F.sqrt(F.try_divide(F.sum(F.col("_w") * off * off), F.sum("_w"))).alias(std),
        )
    )


def harmonic_mean_distance(distance: str, populations: Sequence[str], suffix: str) -> list[Column]:
    """``sum(p) / sum(p / d)`` per population.

    People at distance 0 make the sum below infinite, hence the mean 0; an empty row at
    distance 0 is skipped; a zero sum below gives NULL.
    """
    d = text.no_nan(F.col(distance).cast("double"))
    out = []
    for name in populations:
        p = text.no_nan(F.col(name).cast("double"))
        at_zero = F.coalesce(F.bool_or((d == 0) & (p > 0)), F.lit(False))
        mean = F.try_divide(F.coalesce(F.sum(p), F.lit(0.0)), F.sum(F.when(d != 0, p / F.nullif(d, F.lit(0.0)))))
        out.append(F.when(at_zero, F.lit(0.0)).otherwise(mean).alias(f"{name}{suffix}"))
    return out


def padded_extent(df: DataFrame, x: str, y: str, padding: float = K.EXTENT_PADDING) -> DataFrame:
    """Bounds of all points, widened by a share of the width and height."""
    box = df.agg(
        F.min(x).alias("min_x"), F.min(y).alias("min_y"), F.max(x).alias("max_x"), F.max(y).alias("max_y")
    )
    wide = (F.col("max_x") - F.col("min_x")) * padding
    high = (F.col("max_y") - F.col("min_y")) * padding
    return box.select(
        (F.col("min_x") - wide).alias("min_x"),
        (F.col("min_y") - high).alias("min_y"),
        (F.col("max_x") + wide).alias("max_x"),
        (F.col("max_y") + high).alias("max_y"),
    )
