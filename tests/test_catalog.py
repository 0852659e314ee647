"""The catalog against the driver's smallest tables, and the shape of its plans."""

import math
import os
import re

import pytest

import __spark_entry__ as driver
from schoolzones.catalog import base
from schoolzones.catalog.base import TABLES, Tables
from schoolzones.functions import geo

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")

# A spread over all groups; the driver compares every query.
SAMPLE = """
s8_insert_if_absent p5_to_number p13_grade_tokens f1_grade_span f2_name_patterns j4_outer_join_distinct j8_not_in
j13_single_match_update a3_none_valid a6_category_counts a10_weighted_deviation a12_weighted_median a21_quartiles
a22_density w2_running_weight w5_quantile_bins c3_disproportion_index c7_school_logic g4_polygon_centroid
g7_clip_lines g9_polygon_hits_box l1_approved_schools l3_zone_assignment l6_school_representation l14_income_statistics
""".split()


def inventory():
    ids = {"s": 11, "p": 20, "f": 11, "j": 16, "a": 22, "w": 7, "u": 5, "r": 3, "c": 16, "g": 10, "l": 15}
    return [f"{letter}{i}" for letter, n in ids.items() for i in range(1, n + 1)]


def test_every_operator_has_a_query_and_a_check():
    queries, checks = driver.queries(), driver.oracle_sql()
    assert set(base.QUERIES) <= set(queries) and set(base.ORACLE) <= set(checks)
    assert set(base.QUERIES) == set(base.ORACLE)
    streams = {"st1", "st2"}  # runs over arriving files, of several ids each
    assert {name.split("_")[0] for name in base.QUERIES} == set(inventory()) | streams


def plain(value):
    if isinstance(value, float):
        assert not math.isnan(value)
        return round(value, 6) + 0.0
    return value


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_check(spark, duck, name):
    df = driver.queries()[name](spark, FOLDER)
    result = duck.execute(driver.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = sorted((tuple(plain(v) for v in row) for row in result.fetchall()), key=str)
    got = sorted((tuple(plain(v) for v in row) for row in df.select(*names).collect()), key=str)
    assert got == expected


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_pushed(spark):
    t = Tables(spark, FOLDER)
    text = plan(driver.queries()["s2_projected_scan"](spark, FOLDER))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in text
    text = plan(driver.queries()["f7_equality"](spark, FOLDER))
    assert "EqualTo(c_nationkey,13)" in text and "c_name" not in text
    assert t.b_school.count() > 0


@pytest.mark.parametrize("name", ["j14_distance_join", "j15_nearest_join", "j4_outer_join_distinct", "l3_zone_assignment", "l6_school_representation"])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(driver.queries()[name](spark, FOLDER))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|MapInPandas", text)


def test_stateless_functions_take_a_stream(spark):
    """Column functions and filters work on a streaming frame unchanged."""
    schema = spark.read.parquet(f"{FOLDER}/customer.parquet").schema
    stream = spark.readStream.schema(schema).parquet(FOLDER)
    x, y = geo.mercator_xy("c_acctbal", "c_acctbal")
    assert stream.select(x, y).filter(geo.in_box("c_acctbal", "c_acctbal", (0, 0, 1, 1))).isStreaming


def test_polygons_are_made_in_many_tasks(spark):
    """Zones of one file are dealt out before their polygons are built and measured."""
    from pyspark.sql import functions as F

    from schoolzones.catalog.shapes import zone_polygons

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task again
    try:
        tasks = zone_polygons(Tables(spark, FOLDER)).groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 1
