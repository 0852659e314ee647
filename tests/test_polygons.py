import numpy as np
import pytest
from pyspark.sql import functions as F

from schoolzones.session import scratch_path
from schoolzones.sources import polygons

BOX = (3.0, 3.0, 4.5, 4.0)


@pytest.fixture(scope="module")
def table(spark):
    """Squares all over a 10 by 10 region, in random order; some with a hole, one without points, one round everything."""
    rng = np.random.default_rng(2)
    rows = []
    for i, (x, y) in enumerate((rng.random((4000, 2)) * 10).tolist()):
        square = lambda a, b, s: [(a, b), (a + s, b), (a + s, b + s), (a, b + s), (a, b)]
        rows.append((i, [square(x, y, 0.05)] + ([square(x + 0.01, y + 0.01, 0.02)] if i % 3 == 0 else [])))
    rows += [(4000, []), (4001, None), (4002, [[(-1.0, -1.0), (11.0, -1.0), (11.0, 11.0), (-1.0, 11.0), (-1.0, -1.0)]])]
    schema = "id int, rings array<array<struct<x: double, y: double>>>"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def stored(spark, table):
    path = scratch_path(spark, "polygons")
    polygons.write_polygons(table, path, parts=40)
    return path


def scanned_rows(df):
    """Rows that the scan of a plan has given on."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_stored_rows_are_the_same(spark, table, stored):
    back = polygons.read_polygons(spark, stored)
    assert sorted(back.select("id", "rings").collect(), key=str) == sorted(table.collect(), key=str)
    assert back.filter("rings_min_x is null").count() == 2


def test_a_box_reads_few_row_groups(spark, table, stored):
    want = ids(polygons.touching(table, BOX))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        near = polygons.read_polygons(spark, stored, BOX)
        assert ids(near) == want and 4002 in want and len(want) < 120
        chosen = near.select("id", "rings")
        chosen.collect()
        assert scanned_rows(chosen) < 4003 / 5  # whole files fell away
        nowhere = polygons.read_polygons(spark, stored, (50, 50, 60, 60)).select("id")
        assert ids(nowhere) == []
        everything = polygons.read_polygons(spark, stored, (-5, -5, 20, 20)).select("id")
        assert len(ids(everything)) == 4001
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_neighbours_on_the_curve_are_neighbours(spark):
    """Each step of the curve through a grid goes to the next cell."""
    n = 32
    points = spark.range(n * n).selectExpr("id", f"(id % {n} + 0.5) / {n} as x", f"(floor(id / {n}) + 0.5) / {n} as y")
    rows = points.select("x", "y", polygons._curve(F.col("x"), F.col("y")).alias("at")).orderBy("at").collect()
    steps = [abs(a.x - b.x) * n + abs(a.y - b.y) * n for a, b in zip(rows, rows[1:])]
    assert len({r["at"] for r in rows}) == n * n and max(steps) == pytest.approx(1)


def test_empty_table(spark, table):
    path = scratch_path(spark, "polygons")
    polygons.write_polygons(table.filter("id >= 4000 and id < 4002"), path)
    assert polygons.read_polygons(spark, path, BOX).count() == 0 and polygons.read_polygons(spark, path).count() == 2
