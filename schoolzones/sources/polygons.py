"""Stored polygon tables that a box reads in parts.

Each polygon gets the bounding box of its outer ring in four plain columns, and the table is sorted along a Hilbert curve
through the boxes' centres. Polygons that lie near each other then lie in the same row groups, whose Parquet statistics
of the four columns cover small regions. A box asks for these columns first, so Spark's scan skips the row groups (and
pages) that it does not touch; the exact test of a polygon against the box runs on what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import geo

SIDES = ("min_x", "min_y", "max_x", "max_y")
CURVE_BITS = 16  # cells each way of the curve: 2^16


def box_columns(rings: str) -> list[str]:
    return [f"{rings}_{side}" for side in SIDES]


def with_box(df: DataFrame, rings: str = "rings") -> DataFrame:
    """``df`` with the bounding box of each polygon; NULL where there is no point."""
    box = geo.envelope(f"get({rings}, 0)")
    return df.withColumn("_box", box).select(
        *df.columns, *[F.col("_box")[side].alias(name) for side, name in zip(SIDES, box_columns(rings))]
    )


def _curve(x: Column, y: Column) -> Column:
    """Place on the Hilbert curve of a point in the unit square: quadrant by quadrant, turned as the curve turns."""
    cells = 1 << CURVE_BITS
    whole = lambda c: F.least(F.floor(c * cells), F.lit(cells - 1)).cast("long")
    start = F.struct(whole(x).alias("x"), whole(y).alias("y"), F.lit(0).cast("long").alias("at"))
    halves = F.array(*[F.lit(1 << b).cast("long") for b in reversed(range(CURVE_BITS))])

    def step(s: Column, half: Column) -> Column:
        right, upper = s.x.bitwiseAND(half) != 0, s.y.bitwiseAND(half) != 0
        quadrant = F.when(right, F.when(upper, 2).otherwise(3)).otherwise(F.when(upper, 1).otherwise(0))
        flip = lambda c: F.when(right & ~upper, cells - 1 - c).otherwise(c)
        return F.struct(
            F.when(upper, s.x).otherwise(flip(s.y)).alias("x"),
            F.when(upper, s.y).otherwise(flip(s.x)).alias("y"),
            (s.at + half * half * quadrant).alias("at"),
        )

    return F.aggregate(halves, start, step, lambda s: s.at)


def clustered(df: DataFrame, rings: str = "rings", parts: int | None = None) -> DataFrame:
    """``df`` with box columns, dealt out and sorted along the curve, for any Parquet writer to store as it is.

    ``parts`` is the number of files, by default the shuffle partitions. Polygons without a point come first.
    ``df`` is read three times: for the extent, for the ranges, and to write.
    """
    min_x, min_y, max_x, max_y = box_columns(rings)
    boxed = with_box(df, rings)
    x, y = (F.col(min_x) + F.col(max_x)) / 2, (F.col(min_y) + F.col(max_y)) / 2
    west, south, east, north = boxed.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if west is None:
        return boxed
    share = lambda c, low, high: (c - F.lit(low)) / F.lit(max(high - low, 1e-300))
    placed = boxed.withColumn("_at", _curve(share(x, west, east), share(y, south, north)))
    return placed.repartitionByRange(parts, "_at").sortWithinPartitions("_at").drop("_at")


def write_polygons(
    df: DataFrame, path: str, rings: str = "rings", parts: int | None = None, group_bytes: int = 16 << 20
) -> None:
    """Make a polygon table; an existing one is an error. ``group_bytes`` is the size of its row groups."""
    clustered(df, rings, parts).write.option("parquet.block.size", group_bytes).parquet(path)


def touching(df: DataFrame, box: tuple[float, float, float, float], rings: str = "rings") -> DataFrame:
    """Polygons that meet the box (west, south, east, north), border included.

    With box columns, as stored tables have them, only polygons whose bounding box meets it are tested or even read.
    """
    if set(box_columns(rings)) <= set(df.columns):
        (west, south, east, north), (min_x, min_y, max_x, max_y) = map(float, box), map(F.col, box_columns(rings))
        df = df.filter((min_x <= east) & (max_x >= west) & (min_y <= north) & (max_y >= south))
    return df.filter(geo.polygon_hits_box(rings, box))


def read_polygons(
    spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, rings: str = "rings"
) -> DataFrame:
    """A stored polygon table, or the part of it that meets a box."""
    table = spark.read.parquet(path)
    return touching(table, box, rings) if box else table
