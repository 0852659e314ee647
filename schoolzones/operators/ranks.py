"""Ordered operators: first per key, running sums, quantiles, weighted median.

None of them sorts a whole group in one task. Running sums cut a heavy key into blocks along its order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import classify
from ..session import fixed


BLOCK_ROWS = 2_000_000  # rows of a key that are sorted at once


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest order columns per key, NULL last.

    A minimum of structs: each task passes on one row per key.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [F.struct(F.col(c).isNull(), F.col(c)).alias(f"_o{i}") for i, c in enumerate(order)]
    best = F.min(F.struct(*ranked, F.struct(*rest).alias("_row")))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b._row.*").select(*df.columns)


def _blocks(df: DataFrame, keys: list[str], order: list[str], block_rows: int) -> DataFrame:
    """(keys, _bounds): where the keys with more than ``block_rows`` rows are cut, as order structs.

    At most one key and two bounds for each ``block_rows`` rows. Bounds are taken from a sample of the key's rows; they
    are stored, so whatever they are, every row belongs to one block.
    """
    per_block = 16  # sampled rows
    renamed = [F.col(k).alias(f"_k_{k}") for k in keys]
    rows, blocks = F.col("_of_rows"), F.col("_of_blocks")
    heavy = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_of_rows")).filter(rows > block_rows)
    heavy = fixed(heavy.select(*renamed, "_of_rows", F.ceil(rows / block_rows).alias("_of_blocks")))
    sampled = df.join(F.broadcast(heavy), _same(keys)).filter(F.rand(7) < per_block * blocks / rows)
    at = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    seen = sampled.groupBy(*keys).agg(F.sort_array(F.collect_list(at)).alias("_seen"), F.max(blocks).alias("_of_blocks"))
    cut = F.transform(
        F.sequence(F.lit(1), blocks), lambda i: F.get("_seen", F.floor(i * F.size("_seen") / blocks).cast("int"))
    )
    return fixed(seen.select(*renamed, F.array_distinct(F.array_compact(cut)).alias("_bounds")))


def _same(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return same


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: str,
    out: str,
    total: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running sum of ``weight`` within ``keys`` in ``order``, and optionally the key's total.

    ``order`` should identify a row within its key; a row without weight adds nothing. A key of more than ``block_rows``
    rows is cut into blocks along its order. Rows are dealt out once, by key and block; where a block begins, the sums of
    the key's earlier blocks are added. What is broadcast for that, the bounds and sums of heavy keys' blocks, has a few
    values for each ``block_rows`` rows of the input.
    """
    names, keys, order = df.columns, list(keys), list(order)
    if not keys:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    df = fixed(df)  # read by several passes, which must see the same rows
    cut, offsets = df.withColumn("_block", F.lit(0)), None
    if df.count() > block_rows:  # else no key has so many
        bounds = _blocks(df, keys, order, block_rows)
        most = bounds.agg(F.max(F.size("_bounds"))).first()[0]
        if most:
            cut, offsets = _cut(df, bounds, most, keys, order, weight)
    block = Window.partitionBy(*keys, "_block")
    upto = block.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.withColumn("_within", F.sum(weight).over(upto))
    if total:
        summed = summed.withColumn("_everyone", F.sum(weight).over(block))
    so_far, whole = F.col("_within"), F.col("_everyone")
    if offsets:
        summed = summed.join(F.broadcast(offsets), _same(keys) & (F.col("_block") == F.col("_b")), "left")
        so_far = F.coalesce(F.col("_before") + so_far, "_before", so_far)
        whole = F.when(F.col("_b").isNull(), whole).otherwise(F.col("_whole"))
    return summed.select(*names, so_far.alias(out), *([whole.alias(total)] if total else []))


def _cut(
    df: DataFrame, bounds: DataFrame, most: int, keys: list[str], order: list[str], weight: str
) -> tuple[DataFrame, DataFrame]:
    """``df`` with each row's ``_block``, found by halving among its key's bounds; and the sums before each block."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    me = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    at = lambda i: F.get("_bounds", i - 1)
    passed = F.aggregate(steps, F.lit(0), lambda n, step: F.when(at(n + step) <= me, n + step).otherwise(n))
    met = df.join(F.broadcast(bounds), _same(keys), "left")
    met = met.withColumn("_block", F.when(F.col("_bounds").isNull(), 0).otherwise(passed))

    sums = met.filter(F.col("_bounds").isNotNull()).groupBy(*keys, "_block").agg(F.sum(weight).alias("_sum"))
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_block").alias("_b"),
        F.sum("_sum").over(earlier).alias("_before"),
        F.sum("_sum").over(per_key).alias("_whole"),
    )
    return met.select(*df.columns, "_block"), fixed(offsets)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], out: str = "q") -> DataFrame:
    """Exact quantiles per key as an array, linear between neighbouring values.

    Equal values are counted first; the value at rank i is the one whose running count
    passes i. NULL and NaN are left out.
    """
    v = F.col("_v")
    counted = (
        df.select(*keys, F.col(value).cast("double").alias("_v"))
        .filter(v.isNotNull() & ~F.isnan(v))
        .groupBy(*keys, "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = running_sum(counted, keys, ["_v"], "_n", "_upto", "_all")

    def at(rank):
        return F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank), v))

    picks, values = [], []
    for i, share in enumerate(shares):
        rank = F.lit(float(share)) * (F.col("_all") - 1)
        picks += [
            at(F.floor(rank)).alias(f"_lo{i}"),
            at(F.ceil(rank)).alias(f"_hi{i}"),
            F.max(rank - F.floor(rank)).alias(f"_t{i}"),
        ]
        values.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_t{i}"))
    picked = ranked.groupBy(*keys).agg(*picks)
    return picked.select(*keys, F.array(*values).alias(out))


def quantile_bins(df: DataFrame, column: str, bins: int, out: str) -> DataFrame:
    """Number of the equal-count bin, right-closed, equal edges merged, NULL stays NULL.

    The few edges are read first and written into the expression, so binning needs no join.
    """
    found = quantiles(df, [], column, [i / bins for i in range(bins + 1)]).first()
    edges = sorted({e for e in (found["q"] if found else []) if e is not None})
    if len(edges) < 2:
        return df.withColumn(out, F.lit(None).cast("int"))
    return df.withColumn(out, classify.cut_bins(column, edges, include_lowest=True))


def weighted_median(df: DataFrame, key: str, value: str, weight: str, row_id: str, out: str) -> DataFrame:
    """Interpolated weighted median per key; equal values are ordered by ``row_id``.

    The running weight crosses half the total at the upper row; the lower row is the last one
    at or below half. Rows of one value are merged first: if both lie in one value, that value
    is the median; otherwise the upper row is the first of its value by ``row_id`` and the
    lower one ends the value before, so the merged weights and the first weight suffice.
    No row at or below half gives NULL.
    """
    rows = df.select(
        key,
        F.col(value).cast("double").alias("_v"),
        F.col(weight).cast("double").alias("_w"),
        F.col(row_id).alias("_id"),
    ).dropna(subset=[key, "_v", "_w"])
    merged = rows.groupBy(key, "_v").agg(
        F.sum("_w").alias("_sum"), F.min(F.struct("_id", "_w"))["_w"].alias("_first")
    )
    ranked = running_sum(merged, [key], ["_v"], "_sum", "_upto", "_all")
    half, before = F.col("_all") / 2, F.col("_upto") - F.col("_sum")
    crossing = (F.col("_upto") > half) & (before <= half)
    found = ranked.groupBy(key).agg(
        F.max(F.when(F.col("_upto") <= half, F.col("_v"))).alias("_low"),
        F.max(F.when(crossing, F.col("_v"))).alias("_high"),
        F.max(F.when(crossing, half - before)).alias("_short"),
        F.max(F.when(crossing, F.col("_first"))).alias("_first"),
    )
    within = F.col("_first") <= F.col("_short")
    between = F.col("_low") + F.try_divide(F.col("_short"), F.col("_first")) * (F.col("_high") - F.col("_low"))
    return found.select(key, F.when(within, F.col("_high")).otherwise(between).alias(out))


#: Bins are half a kernel width wide and have so many moments; kernels end 9 widths from the bin's centre.
MOMENTS, REACH = 14, 9.0


def density(df: DataFrame, keys: Sequence[str], value: str, bandwidth: float, points: int) -> DataFrame:
    """Gaussian density on an even grid over each key's data range, highest point 1.

    The kernel width h is ``bandwidth`` sample deviations. A key with a single distinct value
    has one grid point of density 1. Rows without key or value are left out.

    Values are not met with grid points one by one. With t the distance of a grid point from a bin's centre and s that of
    a value, both in widths, exp(-(t - s)^2 / 2) = exp(-t^2 / 2) * sum of t^j / j! * (s^j * exp(-s^2 / 2)), so a bin
    needs the sums of the last factor only, for j below MOMENTS. With bins half a width wide, a kernel of height 1 is
    off by at most 1e-14, what is left out beyond REACH included. So the work is that of one aggregate over the values
    plus, for each bin with values, the grid points in reach.
    """
    v = F.col("_v")
    rows = fixed(
        df.select(*keys, F.col(value).cast("double").alias("_v")).filter(v.isNotNull() & ~F.isnan(v)).dropna()
    )
    stats = fixed(
        rows.groupBy(*keys).agg(
            F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), (F.stddev_samp("_v") * bandwidth).alias("_h")
        )
    )
    named = stats.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_lo", "_hi", "_h")
    half = F.col("_h") / 2
    placed = (
        rows.join(named.filter("_lo < _hi and _h > 0"), _same(keys))
        .withColumn("_bin", F.floor((v - F.col("_lo")) / half))
        .withColumn("_s", (v - F.col("_lo") - (F.col("_bin") + 0.5) * half) / F.col("_h"))
    )
    power, moments = F.exp(-F.col("_s") * F.col("_s") / 2), []
    for j in range(MOMENTS):
        moments.append(F.sum(power).alias(f"_m{j}"))
        power = power * F.col("_s") / (j + 1)
    binned = placed.groupBy(*keys, "_bin", "_lo", "_hi", "_h").agg(*moments)

    step = (F.col("_hi") - F.col("_lo")) / (points - 1)
    centre = (F.col("_bin") + 0.5) * half  # from the least value
    first = F.greatest(F.ceil((centre - REACH * F.col("_h")) / step), F.lit(0))
    last = F.least(F.floor((centre + REACH * F.col("_h")) / step), F.lit(points - 1))
    near = binned.withColumn("grid_no", F.explode(F.when(first <= last, F.sequence(first, last))))
    grid_x = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("grid_no") / (points - 1)
    near = near.withColumn("_t", (grid_x - F.col("_lo") - centre) / F.col("_h"))
    series = F.lit(0.0)
    for j in reversed(range(MOMENTS)):
        series = series * F.col("_t") + F.col(f"_m{j}")
    near = near.select(
        *keys, F.col("grid_no").cast("int").alias("grid_no"), grid_x.alias("grid_x"), (F.exp(-F.col("_t") * F.col("_t") / 2) * series).alias("_d")
    )
    grid = F.when(F.col("_lo") == F.col("_hi"), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.lit(points - 1))
    )
    alone = F.when(F.col("_lo") == F.col("_hi"), 1.0).otherwise(0.0)
    empty = stats.withColumn("grid_no", F.explode(grid)).select(*keys, "grid_no", grid_x.alias("grid_x"), alone.alias("_d"))
    curve = empty.union(near).groupBy(*keys, "grid_no", "grid_x").agg(F.sum("_d").alias("_d"))
    peak = F.max("_d").over(Window.partitionBy(*keys))  # at most `points` rows per key
    return curve.withColumn("density", F.col("_d") / peak).drop("_d")
