"""Zones to schools, and what the zones of a school say about it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify, constants as K, geo, text
from ..operators import aggregates, ranks, reshape, spatial
from ..session import fixed

SCHOOL = "unique_school_id"


def zone_centroids(zones: DataFrame, rings: str = "rings") -> DataFrame:
    """Zone id and the centroid of its polygon, in metres."""
    return zones.select("geoid", geo.polygon_centroid(rings).alias("_c")).select(
        "geoid", F.col("_c.x").alias("x"), F.col("_c.y").alias("y")
    )


def within_buffer(zones: DataFrame, schools: DataFrame) -> DataFrame:
    """All zone and school pairs inside the school's buffer, with their distance."""
    sided = schools.select(
        SCHOOL, "school_x", "school_y", "buffer_distance",
        classify.miles_to_metres("buffer_distance").alias("_radius"),
    )
    return spatial.distance_join(zones, sided, radius="_radius").drop("_radius")


def assign_zones(zones: DataFrame, schools: DataFrame) -> DataFrame:
    """Each zone to one school: the nearest whose buffer holds it, else the nearest of all.

    Equal distances go to the smallest school id. ``zones`` has geoid, x, y.
    """
    spots = zones.select("geoid", "x", "y")
    places = schools.select(SCHOOL, "school_x", "school_y", "buffer_distance")
    sided = places.withColumn("_radius", classify.miles_to_metres("buffer_distance"))
    return spatial.nearest_join(spots, sided, "geoid", SCHOOL, reach="_radius").drop("_radius")


def coverage(assignment: DataFrame, zones: DataFrame, schools: DataFrame) -> DataFrame:
    """Checks of an assignment as one row of counts; a row without a school assigns nothing.

    One pass over each input: what an assignment row says about its zone and its school is counted together with the
    lists of zones and schools, per id.
    """
    says = lambda kind, key, listed: F.struct(
        F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), F.lit(listed).alias("listed"), F.lit(1 - listed).alias("met")
    )
    met = assignment.filter(F.col(SCHOOL).isNotNull()).select(
        F.inline(F.array(says("zone", "geoid", 0), says("school", SCHOOL, 0)))
    )
    lists = [df.select(says(kind, key, 1).alias("s")).select("s.*") for df, kind, key in ((zones, "zone", "geoid"), (schools, "school", SCHOOL))]
    each = met.unionAll(lists[0]).unionAll(lists[1]).groupBy("kind", "id").agg(
        F.sum("listed").alias("listed"), F.sum("met").alias("met")
    )
    zone = F.col("kind") == "zone"
    lacking = (F.col("listed") > 0) & ((F.col("met") == 0) | F.col("id").isNull())
    total = lambda c: F.coalesce(F.sum(F.when(zone, F.col(c))), F.lit(0))
    return each.agg(
        total("met").alias("assigned_zones"),
        F.count_if(zone & (F.col("met") > 1)).alias("zones_assigned_twice"),
        total("listed").alias("total_zones"),
        F.count_if(zone & lacking).alias("unassigned_zones"),
        F.count_if(~zone & lacking).alias("schools_without_zone"),
    )


def zones_per_school(assignment: DataFrame, schools: DataFrame) -> DataFrame:
    """Zones of each school in ascending order; schools without a zone show 0."""
    counts = assignment.groupBy(SCHOOL).agg(F.count(F.lit(1)).alias("assigned_cbg_count"))
    return (
        schools.select(SCHOOL).distinct().join(counts, SCHOOL, "left")
        .fillna(0, subset=["assigned_cbg_count"])
        .orderBy("assigned_cbg_count", SCHOOL)
    )


def catchment_metrics(assignment: DataFrame, census: DataFrame) -> DataFrame:
    """Shares in percent, mean income and harmonic mean distances per school: one aggregate."""
    groups = list(K.POPULATION_GROUPS.values())
    zones = assignment.select(SCHOOL, "geoid", "distance").join(census, "geoid")
    return zones.filter(F.col(SCHOOL).isNotNull()).groupBy(SCHOOL).agg(
        *aggregates.ratio_of_sums(K.SHARE_METRICS, "total_population", "weighted_avg_", 100.0),
        aggregates.weighted_mean("percapita_income_total", "total_population").alias(
            "total_pop_weighted_avg_income"
        ),
        *aggregates.harmonic_mean_distance("distance", groups, "_population_avg_distance"),
    )


def school_metrics(schools: DataFrame, representation: DataFrame, metrics: DataFrame) -> DataFrame:
    """Schools with their representation index and catchment metrics."""
    ri = [f"ri_{race.lower()}" for race in K.RACES]
    return schools.join(representation.select(SCHOOL, *ri), SCHOOL, "left").join(metrics, SCHOOL, "left")


def _number(df: DataFrame, column: str) -> Column:
    """A double; only text has to be parsed."""
    is_text = dict(df.dtypes)[column] == "string"
    return text.no_nan(text.to_number(column) if is_text else F.col(column).cast("double"))


def income_statistics(assignment: DataFrame, census: DataFrame) -> DataFrame:
    """Weighted median, mean and deviation of the zones' income per school."""
    zones = (
        assignment.select(SCHOOL, "geoid")
        .join(census.select("geoid", "total_population", "median_income"), "geoid")
        .select(
            SCHOOL,
            "geoid",
            _number(census, "total_population").alias("total_population"),
            _number(census, "median_income").alias("median_income"),
        )
        .dropna()
    )
    zones = fixed(zones)  # read by several passes below
    median = ranks.weighted_median(
        zones, SCHOOL, "median_income", "total_population", "geoid", "weighted_median_income"
    )
    spread = aggregates.weighted_mean_std(
        zones, SCHOOL, "median_income", "total_population", "avg_median_income", "stddev_median_income"
    )
    return median.join(spread, SCHOOL)


def write_back(schools: DataFrame, statistics: DataFrame) -> DataFrame:
    """School table with the statistics filled in; schools without any keep their values."""
    return reshape.update_columns(schools, statistics, SCHOOL)
