"""A stored assignment of zones to schools that follows changes of the schools without a full run.

The zones lie in square cells, and these in areas; both are numbered by the zones' extent. Stored with the assignment are,
for each cell, the circle that holds its zones, the furthest that one of them has to its school, and whether one of them
is outside every school's radius; and which schools serve which cells. When schools change, only these cells open again:

* those that a removed or changed school served,
* those that a new or changed school may be nearer to than the furthest zone has it,
* those with a zone outside every radius that the new or changed school's radius may reach.

A zone in any other cell keeps its school: that one is as it was, and no new one beats it. Zones of open cells get their
school anew among all schools. Everything is one versioned table in parts by area (sources/versions.py), so only areas
with open cells are read and written, and a reader sees the zones, cells and schools of one version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import classify
from ..operators import spatial
from ..session import fixed
from ..sources import versions

SCHOOL = "unique_school_id"
ZONES_AN_AREA = 100_000  # on average; an area is what is read and written as a whole
MOST_AREA_BITS = 7  # areas each way, as a power of two; an area has 32 by 32 cells

_PLACE = [SCHOOL, "school_x", "school_y", "buffer_distance"]
_SCHEMA = (
    "part string, kind string, area int, cell long, geoid string, x double, y double, unique_school_id string, "
    "school_x double, school_y double, buffer_distance double, distance double, "
    "centre_x double, centre_y double, span double, most double, loose boolean"
)
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]


def _shaped(kind: str, df: DataFrame) -> DataFrame:
    """Rows of one kind in the table's columns."""
    kinds = dict(c.split() for c in _SCHEMA.split(", "))
    area = F.coalesce(F.col("area").cast("string"), F.lit("none")) if "area" in df.columns else F.lit("all")
    df = df.withColumn("kind", F.lit(kind)).withColumn("part", F.concat(F.lit(f"{kind}-"), area))
    return df.select(
        *[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in _NAMES]
    )


def _located(zones: DataFrame, area_bits: int) -> DataFrame:
    """Zones with their cell and area; NULL without a finite place."""
    cell_bits = area_bits + 5
    finite = F.col("x").between(-1e300, 1e300) & F.col("y").between(-1e300, 1e300)
    west, south, east, north = zones.filter(finite).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    if west is None:
        return zones.withColumn("cell", F.lit(None).cast("long")).withColumn("area", F.lit(None).cast("int"))
    side = max(east - west, north - south, 1e-300) / (1 << cell_bits)

    def number(c: str, least: float) -> Column:
        return F.least(F.floor((F.col(c) - F.lit(least)) / F.lit(side)), F.lit((1 << cell_bits) - 1)).cast("long")

    i, j = number("x", west), number("y", south)
    cell = F.when(finite, F.shiftleft(i, cell_bits) + j)
    area = F.when(finite, F.shiftleft(F.shiftright(i, 5), area_bits) + F.shiftright(j, 5)).cast("int")
    return zones.withColumn("cell", cell).withColumn("area", area)


def _assigned(zones: DataFrame, schools: DataFrame) -> DataFrame:
    sided = schools.withColumn("_radius", classify.miles_to_metres("buffer_distance"))
    spots = zones.select("geoid", "x", "y", "area", "cell")
    return spatial.nearest_join(spots, sided, "geoid", SCHOOL, reach="_radius").drop("_radius")


def _summed(zones: DataFrame) -> DataFrame:
    """What is stored about cells: their circles and bounds, and the schools that serve them."""
    placed = zones.filter(F.col("cell").isNotNull())
    own = F.coalesce(F.col("distance") <= classify.miles_to_metres("buffer_distance"), F.lit(False))
    boxed = placed.groupBy("area", "cell").agg(
        *[f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("x", "y")],
        F.max(F.coalesce("distance", F.lit(float("inf")))).alias("most"),
        F.bool_or(~own).alias("loose"),
    )
    half = lambda c: (F.col(f"max_{c}") - F.col(f"min_{c}")) / 2
    cells = boxed.select(
        "area", "cell", "most", "loose",
        (F.col("min_x") + half("x")).alias("centre_x"), (F.col("min_y") + half("y")).alias("centre_y"),
        (F.hypot(half("x"), half("y")) * (1 + 1e-9) + 1e-6).alias("span"),
    )
    served = placed.filter(F.col(SCHOOL).isNotNull()).select("area", "cell", SCHOOL).distinct()
    return _shaped("cell", cells).union(_shaped("served", served))


def _write(zones: DataFrame, schools: DataFrame, path: str, gone, base: versions.Version | None) -> versions.Version:
    """Zones by area and cell, so that a crowded area has many tasks and a task few areas."""
    parts = int(zones.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _shaped("zone", zones).union(_summed(zones)).union(_shaped("school", schools.select(*_PLACE)))
    return versions.replace_parts(rows.repartitionByRange(parts, "part", "cell"), path, "part", gone, base)


def _read(spark: SparkSession, path: str, of: versions.Version, *prefixes: str) -> DataFrame:
    return versions.read_parts(spark, path, lambda part: part.startswith(prefixes), of)


def build(zones: DataFrame, schools: DataFrame, path: str, area_bits: int | None = None) -> versions.Version:
    """Assign all zones (geoid, x, y) and store the result as a new table, in 2^area_bits areas each way."""
    zones = fixed(zones.select("geoid", "x", "y"))
    if area_bits is None:
        area_bits = min(max(1, zones.count() // ZONES_AN_AREA).bit_length() // 2, MOST_AREA_BITS)
    zones = _located(zones, area_bits)
    return _write(fixed(_assigned(zones, schools.select(*_PLACE))), schools, path, lambda _: True, None)


def _last(spark: SparkSession, path: str) -> versions.Version:
    found = versions.version(spark, path)
    if found is None:
        raise versions.NoSuchVersion(f"{path} has no version")
    return found


def assignment(spark: SparkSession, path: str) -> DataFrame:
    """The stored assignment: geoid, school and distance; zones that no school can serve have NULLs."""
    return _read(spark, path, _last(spark, path), "zone-").select("geoid", *_PLACE, "distance")


def opened(cells: DataFrame, served: DataFrame, gone: DataFrame, come: DataFrame) -> DataFrame:
    """(area, cell) of the cells that changes of the schools may touch."""
    radius = F.coalesce(classify.miles_to_metres("buffer_distance"), F.lit(-1.0))
    place = come.select(F.col("school_x").alias("n_x"), F.col("school_y").alias("n_y"), radius.alias("_radius"))
    circles = cells.select("area", "cell", "centre_x", "centre_y", (F.col("span") + F.col("most")).alias("_reach"))
    nearer = spatial.distance_join(
        place.select("n_x", "n_y"), circles, ("n_x", "n_y"), ("centre_x", "centre_y"), "_reach", "_d"
    )
    widest = cells.agg(F.max("span")).first()[0] or 0.0
    wide = place.filter("_radius >= 0").withColumn("_radius", F.col("_radius") + F.lit(widest))
    loose = cells.filter("loose").select("area", "cell", "centre_x", "centre_y")
    reached = spatial.distance_join(loose, wide, ("centre_x", "centre_y"), ("n_x", "n_y"), "_radius", "_d")
    lost = served.join(gone.select(SCHOOL).distinct(), SCHOOL, "left_semi")
    names = ["area", "cell"]
    return lost.select(*names).union(nearer.select(*names)).union(reached.select(*names)).distinct()


def refresh(schools: DataFrame, path: str) -> versions.Version:
    """Bring the stored assignment to these schools; the same rows as a full run with them.

    Another writer's version in between is a Conflict; nothing is lost by trying again.
    """
    spark = schools.sparkSession
    base = _last(spark, path)
    before = _read(spark, path, base, "school-").select(*_PLACE)
    after = fixed(schools.select(*_PLACE))
    gone, come = fixed(before.subtract(after)), fixed(after.subtract(before))
    cells = fixed(_read(spark, path, base, "cell-"))
    open_ = fixed(opened(cells, _read(spark, path, base, "served-").select("area", "cell", SCHOOL), gone, come))
    areas = [r["area"] for r in open_.select("area").distinct().collect()]  # at most 4^MOST_AREA_BITS
    if not areas and gone.isEmpty() and come.isEmpty():
        return base
    touched = {f"{kind}-{a}" for kind in ("zone", "cell", "served") for a in areas}
    zones = versions.read_parts(spark, path, lambda part: part in touched and part.startswith("zone-"), base)
    zones = zones.select("geoid", "x", "y", "area", "cell", *_PLACE, "distance")
    marked = open_.select(F.col("area").alias("_a"), F.col("cell").alias("_c"))
    is_open = (F.col("area") == F.col("_a")) & (F.col("cell") == F.col("_c"))
    again = _assigned(zones.join(marked, is_open, "left_semi"), after)
    kept = zones.join(marked, is_open, "left_anti")
    return _write(
        fixed(kept.unionByName(again)), after, path, lambda part: part in touched or part.startswith("school-"), base
    )
