import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from schoolzones.operators import spatial
from schoolzones.plans import catchment

WIDTH = 1e5


def points(seed, zones, schools, crowd):
    rng = np.random.default_rng(seed)
    z = pd.DataFrame({"geoid": [f"z{i:05d}" for i in range(zones)], "x": rng.uniform(0, WIDTH, zones), "y": rng.uniform(0, WIDTH, zones)})
    s = pd.DataFrame(
        {
            "unique_school_id": [f"s{i:05d}" for i in range(schools)],
            "school_x": rng.uniform(0, WIDTH, schools),
            "school_y": rng.uniform(0, WIDTH, schools),
            "buffer_distance": rng.choice([1.0, 3.0, 7.0, 18.0, np.nan], schools),
        }
    )
    if crowd:  # a third of both sides in one spot, some schools at equal coordinates
        z.loc[: zones // 3, ["x", "y"]] = rng.normal(0.9 * WIDTH, 30, (zones // 3 + 1, 2))
        s.loc[: schools // 3, ["school_x", "school_y"]] = rng.normal(0.9 * WIDTH, 30, (schools // 3 + 1, 2))
        s.loc[schools - 3 :, ["school_x", "school_y"]] = 0.5 * WIDTH
    s.loc[schools // 2, "school_x"] = np.nan
    return z, s


def frame(spark, pdf):
    df = spark.createDataFrame(pdf)
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def distances(z, s):
    d = np.hypot(z.x.values[:, None] - s.school_x.values[None], z.y.values[:, None] - s.school_y.values[None])
    return np.where(np.isnan(d), np.inf, d)


def brute_force(z, s):
    d = distances(z, s)
    radius = s.buffer_distance.fillna(-1).values[None] * 1609.34
    inside = np.where(d <= radius, d, np.inf)
    pick = np.where(np.isfinite(inside.min(1)), inside.argmin(1), d.argmin(1))
    return s.unique_school_id.values[pick], d[np.arange(len(z)), pick]


def check_assignment(spark, z, s):
    out = catchment.assign_zones(frame(spark, z), frame(spark, s)).toPandas()
    assert sorted(out.geoid) == sorted(z.geoid)
    ids, d = brute_force(z, s)
    out = out.set_index("geoid").loc[z.geoid]
    assert list(out.unique_school_id) == list(ids)
    assert out.distance.values == pytest.approx(d)


@pytest.mark.parametrize("crowd", [False, True])
def test_assignment_equals_brute_force(spark, crowd):
    check_assignment(spark, *points(1, 400, 60, crowd))


def test_a_third_of_both_sides_in_one_spot(spark):
    check_assignment(spark, *points(2, 3000, 900, True))


def test_spots_within_spots(spark):
    """Crowds at very different scales: each goes down as far as it must, nothing else does."""
    z, s = points(5, 1500, 600, True)
    z.loc[:400, ["x", "y"]] = 1e4 + np.random.default_rng(8).normal(0, 1e-3, (401, 2))
    s.loc[:200, ["school_x", "school_y"]] = 1e4 + np.random.default_rng(9).normal(0, 1e-3, (201, 2))
    z.loc[400:420, ["x", "y"]] = 7e6
    check_assignment(spark, z, s)


def test_equal_places(spark):
    z, s = points(6, 500, 300, False)
    z[["x", "y"]] = 5.0
    s[["school_x", "school_y"]] = 5.0
    check_assignment(spark, z, s)


def test_assignment_with_a_hundred_radii(spark):
    z, s = points(3, 800, 400, True)
    s["buffer_distance"] = np.random.default_rng(1).permutation(np.linspace(0.05, 20, 100).repeat(4))
    s.loc[5, "buffer_distance"] = np.nan
    s.loc[7, "buffer_distance"] = 0.0
    check_assignment(spark, z, s)


@pytest.mark.parametrize("own", [False, True])
def test_pairs_grow_with_the_spots_alone(spark, own):
    """Four times the places, with their radii mixed: a spot still meets but the few around it."""
    met = []
    for n in (1500, 6000):
        z, s = points(12, n, n, False)
        places = frame(spark, s.dropna()).selectExpr(
            "school_x as _rx", "school_y as _ry", "unique_school_id as _id",
            f"explode(array(named_struct('c', 'all', 'r', double('Infinity')){", named_struct('c', 'own', 'r', buffer_distance * 1609.34)" * own})) as _c",
        ).selectExpr("_c.c as _class", "_c.r as _reach", "_rx", "_ry", "_id")
        spots = frame(spark, z).selectExpr("geoid as _left", "x as _x", "y as _y")
        met.append(spatial._nearest_pairs(spots, places).count() / n)
    assert max(met) < 40 and met[1] < 1.5 * met[0]


def test_left_rows_of_one_file_go_to_many_tasks(spark, tmp_path, monkeypatch):
    """What reads the left rows again, with all they meet, is dealt out however the input lies in files."""
    z, s = points(14, 3000, 300, False)
    frame(spark, z).coalesce(1).write.parquet(str(tmp_path / "zones"))
    stored, fixed = [], spatial.fixed
    monkeypatch.setattr(spatial, "fixed", lambda df: stored.append(fixed(df)) or stored[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task again
    try:
        catchment.assign_zones(spark.read.parquet(str(tmp_path / "zones")), frame(spark, s))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    left_rows = [df for df in stored if {"geoid", "_left"} & set(df.columns)]
    assert len(left_rows) >= 2
    for df in left_rows:
        each = df.groupBy(F.input_file_name()).count()
        most, rows = each.agg(F.max("count"), F.sum("count")).first()
        assert most < 0.5 * rows


def test_dense_places_with_mixed_radii(spark):
    check_assignment(spark, *points(13, 5000, 2500, True))


def test_infinite_values(spark):
    inf = float("inf")
    zones = spark.createDataFrame(
        [("a", 0.0, 0.0), ("b", inf, 0.0), ("c", float("nan"), 1.0), ("d", 1e6, 0.0)], "z string, x double, y double"
    )
    schools = spark.createDataFrame(
        [("far", 2e6, 0.0, inf), ("near", 1.0, 0.0, 0.5), ("no", inf, 0.0, 9.0), ("nan", 0.0, 0.0, float("nan"))],
        "s string, school_x double, school_y double, radius_m double",
    )
    pairs = spatial.distance_join(zones, schools).select("z", "s").collect()
    assert sorted(map(tuple, pairs)) == [("a", "far"), ("d", "far")]
    own = spatial.nearest_join(zones, schools, "z", "s", reach="radius_m").collect()
    assert {(r.z, r.s) for r in own} == {("a", "far"), ("b", None), ("c", None), ("d", "far")}
    any_ = spatial.nearest_join(zones, schools, "z", "s").collect()
    assert {(r.z, r.s) for r in any_} == {("a", "nan"), ("b", None), ("c", None), ("d", "near")}


def test_distance_join_equals_brute_force(spark):
    z, s = points(4, 300, 80, True)
    s["radius_m"] = s.buffer_distance * 1609.34
    out = spatial.distance_join(frame(spark, z), frame(spark, s)).select("geoid", "unique_school_id").collect()
    d = distances(z, s)
    rows, cols = np.where(d <= s.radius_m.fillna(-1).values[None])
    assert len(out) == len(rows)
    assert set(map(tuple, out)) == {(z.geoid[i], s.unique_school_id[j]) for i, j in zip(rows, cols)}


def test_distance_join_rim(spark):
    zones = spark.createDataFrame(
        [("on", 3.0, 4.0), ("out", 3.0, 4.0000001), ("none", None, 1.0), ("at", 0.0, 0.0)], "z string, x double, y double"
    )
    schools = spark.createDataFrame(
        [("a", 0.0, 0.0, 5.0), ("b", 0.0, 0.0, None), ("c", None, 0.0, 5.0), ("d", 0.0, 0.0, 0.0), ("e", 0.0, 0.0, -1.0)],
        "s string, school_x double, school_y double, radius_m double",
    )
    out = spatial.distance_join(zones, schools).select("z", "s").collect()
    assert sorted(map(tuple, out)) == [("at", "a"), ("at", "d"), ("on", "a")]


def test_nearest_ties_nulls_and_no_schools(spark):
    zones = spark.createDataFrame([("t", 0.0, 0.0), ("n", None, 0.0)], "z string, x double, y double")
    schools = spark.createDataFrame(
        [("b", 1.0, 0.0), ("a", -1.0, 0.0), ("c", 0.0, 1.0), ("x", None, None)], "s string, school_x double, school_y double"
    )
    out = {r.z: (r.s, r.distance) for r in spatial.nearest_join(zones, schools, "z", "s").collect()}
    assert out == {"t": ("a", 1.0), "n": (None, None)}
    none = spatial.nearest_join(zones, schools.filter("false"), "z", "s").collect()
    assert {(r.z, r.s) for r in none} == {("t", None), ("n", None)}


def test_coverage_and_counts(spark):
    zones = spark.createDataFrame([("z1",), ("z2",), ("z3",)], "geoid string")
    schools = spark.createDataFrame([("s1",), ("s2",)], "unique_school_id string")
    rows = [("z1", "s1"), ("z2", "s1"), ("z2", "s1"), ("z3", None)]
    assignment = spark.createDataFrame(rows, "geoid string, unique_school_id string")
    row = catchment.coverage(assignment, zones, schools).first().asDict()
    assert row == {
        "assigned_zones": 3, "zones_assigned_twice": 1, "total_zones": 3, "unassigned_zones": 1, "schools_without_zone": 1,
    }
    counts = catchment.zones_per_school(assignment, schools).collect()
    assert list(map(tuple, counts)) == [("s2", 0), ("s1", 3)]
    assert catchment.coverage(assignment.limit(0), zones, schools).first()["unassigned_zones"] == 3
