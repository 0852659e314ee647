"""Tables behind the figures: classified schools, binned zones, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import classify, constants as K, geo, text
from ..operators import aggregates, clean, filters, ranks, reshape
from ..sources.tables import points_from_lonlat

SCHOOL = "unique_school_id"

# How each school layer colours its index: (group, ranges, colour of everything else).
DISPARITY_LAYERS = {
    "female": (K.RI_FEMALE_RANGES, None),
    "asian": (K.RI_ASIAN_RANGES, K.RI_ASIAN_OTHERWISE),
    "hispanic": (K.RI_HISPANIC_RANGES, None),
    "white": (classify.touching_ranges(K.RI_WHITE_EDGES, K.SEVEN_COLOURS), None),
    "black": (K.RI_BLACK_RANGES, None),
}
REGIONAL_BLACK = (classify.touching_ranges(K.RI_BLACK_EDGES, K.SEVEN_COLOURS), None)

# Regional underlays: metric -> (bins, whether it is a share of the population).
REGIONAL_LAYERS = {
    "black_alone_non_hispanic": (K.BLACK_RATIO_BINS, True),
    "median_household_income": (K.INCOME_BINS, False),
    "edu_hs_or_more": (K.EDUCATION_BINS, False),
    "households_with_subscription": (K.INTERNET_BINS, False),
}


def _mapped(df: DataFrame) -> DataFrame:
    x, y = geo.mercator_xy("lon", "lat")
    return df.withColumn("x_3857", x).withColumn("y_3857", y)


def modality_layer(schools: DataFrame, representation: DataFrame, code: str = "logic_class") -> DataFrame:
    """Schools with their modality, its label and colour."""
    rows = schools.select(SCHOOL, "lon", "lat").join(representation.select(SCHOOL, code), SCHOOL)
    placed = filters.drop_missing(rows, ["lat", "lon"]).filter(F.col(code).isNotNull())
    out = placed.withColumn("modality", classify.modality_class(code))
    known = [(name, label, colour) for _, name, label, colour in K.MODALITIES] + [K.NO_MODALITY]
    out = clean.label_from(out, "modality", {n: label for n, label, _ in known}, "label")
    out = clean.label_from(out, "modality", {n: colour for n, _, colour in known}, "colour")
    return _mapped(out)


def marker_layer(
    schools: DataFrame, representation: DataFrame, prefixes=None, code: str = "logic_class"
) -> DataFrame:
    """Schools with the marker for modality and extra teachers; codes not shown are ``Other``."""
    rows = schools.select(SCHOOL, "lon", "lat").join(representation.select(SCHOOL, code), SCHOOL)
    placed = filters.drop_missing(rows, ["lat", "lon"]).filter(F.col(code).isNotNull())
    out = placed.withColumn("marker", classify.modality_marker(code, prefixes))
    out = clean.label_from(out, "marker", {m: label for _, _, m, label, _, _ in K.MARKERS}, "label")
    out = clean.label_from(out, "marker", {m: colour for *_, m, _, _, colour in K.MARKERS}, "colour")
    return _mapped(out)


def modality_legend(layer: DataFrame) -> DataFrame:
    names = [name for _, name, _, _ in K.MODALITIES] + [K.NO_MODALITY[0]]
    return aggregates.class_counts(layer, "modality", names, "schools")


def marker_legend(layer: DataFrame, prefixes=None) -> DataFrame:
    names = [m for p, _, m, *_ in K.MARKERS if prefixes is None or p in prefixes]
    return aggregates.class_counts(layer, "marker", names, "schools")


def disparity_layer(schools: DataFrame, representation: DataFrame, group: str, box=None) -> DataFrame:
    """Schools coloured by the range of their index; schools without a colour are left out.

    With ``box`` only schools inside it, coloured by the regional ranges.
    """
    ranges, otherwise = REGIONAL_BLACK if box and group == "black" else DISPARITY_LAYERS[group]
    rows = points_from_lonlat(schools.select(SCHOOL, "lon", "lat"), "lon", "lat")
    if box:
        rows = filters.points_in_box(rows, "lon", "lat", box)
    out = rows.join(representation.select(SCHOOL, F.col(f"ri_{group}").alias("ri")), SCHOOL)
    out = out.withColumn("colour", classify.range_bins("ri", ranges, otherwise))
    return _mapped(filters.classified(out, "colour"))


def disparity_legend(layer: DataFrame, group: str, box=None) -> DataFrame:
    ranges, otherwise = REGIONAL_BLACK if box and group == "black" else DISPARITY_LAYERS[group]
    colours = [c for *_, c in ranges] + ([otherwise] if otherwise else [])
    return aggregates.class_counts(layer, "colour", colours, "schools")


def quintile_underlay(zones: DataFrame, census: DataFrame, group: str) -> DataFrame:
    """Zones with the share of a population group and its quintile (NULL without census data)."""
    shares = census.select(
        text.zfill("geoid", 12).alias("geoid"),
        classify.population_ratio(F.col(group).cast("double"), F.col("total_population").cast("double")).alias("ratio"),
    )
    joined = zones.withColumn("geoid", text.zfill("geoid", 12)).join(shares, "geoid", "left")
    return ranks.quantile_bins(joined, "ratio", K.QUANTILE_BINS, "ratio_class")


def regional_underlay(zones: DataFrame, census: DataFrame, metric: str, box=K.REGION_BOX) -> DataFrame:
    """Zones whose polygon (lon/lat rings) meets the box, with the fixed bin of a metric."""
    (edges, lowest), is_share = REGIONAL_LAYERS[metric]
    value = text.to_number(metric)
    if is_share:
        value = classify.population_ratio(value, text.to_number("total_population"))
    values = census.select(text.zfill("geoid", 12).alias("geoid"), value.alias("value"))
    near = filters.polygons_in_box(zones.withColumn("geoid", text.zfill("geoid", 12)), "rings", box)
    return near.join(values, "geoid", "left").withColumn(
        "value_class", classify.cut_bins("value", edges, lowest)
    )


def representation_rows(metrics: DataFrame) -> DataFrame:
    """One row per school, plotted metric and race with its index and metric value."""
    groups = {}
    for metric, source in K.DISTRIBUTION_METRICS.items():
        for race in K.RACES:
            column = source[race] if isinstance(source, dict) else source
            groups[f"{metric}|{race}"] = (f"ri_{race.lower()}", column)
    rows = reshape.unpivot_groups(metrics, groups, "_group", ["ri", "value"], [SCHOOL, "locale"])
    rows = rows.withColumn("metric", F.split_part("_group", F.lit("|"), F.lit(1))).withColumn(
        "race", F.split_part("_group", F.lit("|"), F.lit(2))
    )
    return (
        filters.drop_missing(rows, ["ri", "value", "locale"])
        .withColumn("representation", classify.ri_category("ri"))
        .select("metric", "race", "locale", SCHOOL, "ri", "value", "representation")
    )


def race_rows(metrics: DataFrame) -> DataFrame:
    groups = {race: (f"ri_{race.lower()}",) for race in K.RACES}
    return filters.drop_missing(
        reshape.unpivot_groups(metrics, groups, "race", ["ri"], [SCHOOL, "locale"]), ["ri"]
    )


def counts_by_race(metrics: DataFrame) -> DataFrame:
    """Schools over, at and under parity per race (those with an index and a locale)."""
    rows = filters.drop_missing(race_rows(metrics), ["locale"])
    return rows.groupBy("race").agg(*aggregates.category_counts("ri"))


def counts_by_locale(metrics: DataFrame) -> DataFrame:
    """The same per locale, added up over the races."""
    rows = race_rows(metrics).filter(F.col("locale").isNotNull())
    return rows.groupBy("locale").agg(*aggregates.category_counts("ri"))


def distribution_quartiles(rows: DataFrame, by: str) -> DataFrame:
    """Quartiles of the metric per group and side of parity."""
    sided = filters.classified(rows, "representation", besides="Parity")
    q = ranks.quantiles(sided, ["metric", by, "representation"], "value", [0.25, 0.5, 0.75])
    return q.select(
        "metric", by, "representation",
        *[F.col("q")[i].alias(f"q{i + 1}") for i in range(3)],
    )


def distribution_density(rows: DataFrame, by: str) -> DataFrame:
    """Density curve of the metric per group and side of parity."""
    sided = filters.classified(rows, "representation", besides="Parity")
    return ranks.density(
        sided, ["metric", by, "representation"], "value", K.DENSITY_BANDWIDTH, K.DENSITY_GRID
    )
