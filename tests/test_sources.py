import pytest
from pyspark.errors import AnalysisException

from schoolzones.session import fixed, scratch_path
from schoolzones.sources import edge, tables


def test_csv_round_trip(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, "a, b", 0.5), (2, None, None)], "i int, t string, d double")
    tables.write_csv(df, path)
    assert sorted(map(tuple, tables.read_csv(spark, path, df.schema).collect())) == [(1, "a, b", 0.5), (2, None, None)]


def test_create(spark):
    path = scratch_path(spark, "table")
    tables.write_new(spark.range(3), path)
    with pytest.raises(AnalysisException):
        tables.write_new(spark.range(3), path)


def test_fixed_rows_do_not_change(spark):
    df = fixed(spark.range(100).selectExpr("rand() as r"))
    assert df.collect() == df.collect()


def test_headings(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Race: Asian", "extra", "Total Student Count"])
    assert edge.inside(df, edge.ENROLMENT).columns == ["asian", "extra", "total_enrollment"]


def test_points_need_both_coordinates(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, None)], "lon double, lat double")
    assert tables.points_from_lonlat(df, "lon", "lat").count() == 1


def test_points_without_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 2.0), (1.0, float("nan"))], "lon double, lat double")
    assert tables.points_from_lonlat(df, "lon", "lat").count() == 1


def test_fixed_reads_only_what_is_asked_for(spark):
    df = fixed(spark.range(10).selectExpr("id", "id * 2 as twice", "array(id) as many"))
    plan = df.select("twice")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<twice:bigint>" in plan
