import numpy as np
import pandas as pd
import pytest

from schoolzones.plans import catchment, upkeep
from schoolzones.session import scratch_path
from schoolzones.sources import versions

MILE = 1609.34


@pytest.fixture(scope="module")
def zones(spark):
    rng = np.random.default_rng(1)
    x, y = np.concatenate((rng.random((900, 2)) * 300_000, 150_000 + rng.normal(0, 3000, (300, 2)))).T
    rows = [(f"z{i:05d}", float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    rows += [("zz1", None, 1.0), ("zz2", float("nan"), 2.0), ("zz3", 5.0, float("inf"))]
    return spark.createDataFrame(rows, "geoid string, x double, y double")


def schools_of(rng, n):
    x, y = np.concatenate((rng.random((n - 15, 2)) * 300_000, 150_000 + rng.normal(0, 3000, (15, 2)))).T
    return pd.DataFrame(
        {
            "unique_school_id": [f"s{i:04d}" for i in range(n)],
            "school_x": x, "school_y": y,
            "buffer_distance": rng.choice([1.0, 3.0, 7.0, 18.0, np.nan], n),
        }
    )


def frame(spark, schools):
    rows = [(a, float(x), float(y), None if pd.isna(b) else float(b)) for a, x, y, b in schools.itertuples(index=False)]
    return spark.createDataFrame(rows, "unique_school_id string, school_x double, school_y double, buffer_distance double")


def rows_of(df):
    return sorted(map(tuple, df.select("geoid", "unique_school_id", "buffer_distance", "distance").collect()), key=str)


CHANGES = {
    "a tenth": lambda s, rng: pd.concat(
        [
            s.drop(range(0, 4)).assign(school_x=lambda d: np.where(d.index % 17 == 5, d.school_x + 9000, d.school_x)),
            schools_of(rng, 19).tail(3).assign(unique_school_id=["n1", "n2", "n3"]),
        ]
    ),
    "a radius grows": lambda s, rng: s.assign(buffer_distance=np.where(s.index == 7, 60.0, s.buffer_distance)),
    "none left": lambda s, rng: s.head(0),
}


@pytest.mark.parametrize("change", CHANGES)
def test_refresh_equals_a_full_run(spark, zones, change):
    rng = np.random.default_rng(8)
    before = schools_of(rng, 80)
    after = CHANGES[change](before, rng)
    path = scratch_path(spark, "upkeep")
    first = upkeep.build(zones, frame(spark, before), path, 2)
    second = upkeep.refresh(frame(spark, after), path)
    want = rows_of(catchment.assign_zones(zones, frame(spark, after)))
    assert rows_of(upkeep.assignment(spark, path)) == want and len(want) == 1203
    zone_parts = lambda v: {x for x in v.folders if versions.part_of(x).startswith("zone-")}
    kept = zone_parts(first) & zone_parts(second)
    if change == "none left":
        assert all(r[1] is None for r in want) and not upkeep._read(spark, path, second, "served-").count()
        upkeep.refresh(frame(spark, before), path)  # and back again
        assert rows_of(upkeep.assignment(spark, path)) == rows_of(catchment.assign_zones(zones, frame(spark, before)))
    else:
        assert len(kept) > len(zone_parts(first)) * (0.2 if change == "a tenth" else 0.6)  # neither read nor written
        fresh = versions.read_parts(spark, path, lambda p: p.startswith("zone-"), first)
        assert fresh.count() == 1203  # the version before is still there


def test_nothing_changed(spark, zones):
    schools = frame(spark, schools_of(np.random.default_rng(8), 40))
    path = scratch_path(spark, "upkeep")
    first = upkeep.build(zones, schools, path)
    assert upkeep.refresh(schools, path) == first and versions.versions(spark, path) == [0]


def test_two_refreshes_that_meet(spark, zones, monkeypatch):
    rng = np.random.default_rng(8)
    schools = schools_of(rng, 40)
    path = scratch_path(spark, "upkeep")
    upkeep.build(zones, frame(spark, schools), path)
    commit, beaten = versions._commit, []

    def late(*args):
        if not beaten:
            beaten.append(1)
            upkeep.refresh(frame(spark, schools.tail(30)), path)
        return commit(*args)

    monkeypatch.setattr(versions, "_commit", late)
    with pytest.raises(versions.Conflict):
        upkeep.refresh(frame(spark, schools.head(30)), path)
    upkeep.refresh(frame(spark, schools.head(30)), path)
    want = rows_of(catchment.assign_zones(zones, frame(spark, schools.head(30))))
    assert rows_of(upkeep.assignment(spark, path)) == want


def test_no_zones(spark, zones):
    schools = frame(spark, schools_of(np.random.default_rng(8), 20))
    path = scratch_path(spark, "upkeep")
    upkeep.build(zones.limit(0), schools, path)
    upkeep.refresh(schools.limit(3), path)
    assert upkeep.assignment(spark, path).count() == 0
