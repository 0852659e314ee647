import pandas as pd
import pytest
from pyspark.sql import functions as F

from schoolzones.operators import joins, reshape


def ids(df, column="id"):
    return sorted((r[column] for r in df.collect()), key=lambda v: (v is None, v))


def test_outer_enrich_is_a_distinct_outer_merge(spark):
    keys = ["s", "n", "t"]
    base = [("a", "1", "x"), ("a", "1", "x"), ("a", None, "y"), ("b", "2", "x"), ("c", None, None)]
    detail = [("a", "1", "x", 5), ("a", "1", "x", 5), ("a", "1", "x", 6), ("a", None, "y", 7), ("d", "9", "z", None)]
    schema = "s string, n string, t string"
    out = joins.outer_enrich(
        spark.createDataFrame(base, schema), spark.createDataFrame(detail, schema + ", cert int"), keys
    )
    expected = pd.merge(
        pd.DataFrame(base, columns=keys), pd.DataFrame(detail, columns=[*keys, "cert"]), on=keys, how="outer"
    ).drop_duplicates()
    def plain(rows):
        return sorted((tuple(None if pd.isna(v) else v for v in r) for r in rows), key=str)

    assert plain(out.collect()) == plain(expected.itertuples(index=False))


def test_delete_in_keeps_null_ids(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    assert ids(joins.delete_in(df, df.filter("id = 'a'"), "id")) == ["b", None]


def test_not_in_follows_sql(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    def listed(*values):
        return spark.createDataFrame([(v,) for v in values], "id string")

    df.createOrReplaceTempView("asked")
    for values in ([], ["a"], ["a", None], [None]):
        listed(*values).createOrReplaceTempView("listed")
        expected = ids(spark.sql("select id from asked where id not in (select id from listed)"))
        assert ids(joins.not_in(df, listed(*values), "id")) == expected, values


def test_append_missing(spark):
    base = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    kept = spark.createDataFrame([("a", 3, 0.5)], "id string, n int, ri double")
    out = joins.append_missing(base, kept, "id", {"n": 0, "ri": None}).collect()
    assert sorted(map(tuple, out)) == [("a", 3, 0.5), ("b", 0, None), ("b", 0, None)]


def test_membership_and_lookups(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    flagged = joins.membership_flag(df, spark.createDataFrame([("a",), ("a",), (None,)], "id string"), "id", "f")
    assert sorted(map(tuple, flagged.collect()), key=str) == [("a", 1), ("b", 0), (None, 0)]
    lookup = spark.createDataFrame([("a", 1.0)], "k string, radius double")
    out = joins.lookup_update(df, lookup, "id", "k", "radius").collect()
    assert sorted(map(tuple, out), key=str) == [("a", 1.0), ("b", None), (None, None)]


def test_single_match_has_no_fan_out(spark):
    schools = spark.createDataFrame([(601,), (602,), (None,)], "system_id int")
    codes = spark.createDataFrame([(601, 23), (601, 11), (603, 5), (None, 9)], "d int, code int")
    out = joins.single_match_update(schools, codes, "system_id", "d", "code").collect()
    assert sorted(map(tuple, out), key=str) == [(601, 11), (602, None), (None, None)]


def test_outer_chain(spark):
    a = spark.createDataFrame([(1, "a")], "k int, a string")
    b = spark.createDataFrame([(2, "b")], "k int, b string")
    c = spark.createDataFrame([(2, "c"), (3, "c")], "k int, c string")
    rows = sorted(map(tuple, joins.outer_chain([a, b, c], "k").collect()))
    assert rows == [(1, "a", None, None), (2, None, "b", "c"), (3, None, None, "c")]


def test_insert_update_unpivot_concat(spark):
    old = spark.createDataFrame([("City", 9.0)], "k string, v double")
    new = spark.createDataFrame([("City", 1.0), ("Town", 7.0), ("Town", 8.0)], "k string, v double")
    assert sorted(map(tuple, reshape.insert_if_absent(old, new, "k").collect())) == [("City", 9.0), ("Town", 7.0)]

    target = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "k string, v double")
    metrics = spark.createDataFrame([("a", 5.0), ("b", None)], "k string, v double")
    assert sorted(map(tuple, reshape.update_columns(target, metrics, "k").collect())) == [("a", 5.0), ("b", None), ("c", 3.0)]

    wide = spark.createDataFrame([(1, 0.1, 5.0, None)], "id int, ra double, m double, rb double")
    long = reshape.unpivot_groups(wide, {"A": ("ra", "m"), "B": ("rb", "m")}, "race", ["ri", "value"], ["id"])
    assert sorted(map(tuple, long.collect())) == [(1, "A", 0.1, 5.0), (1, "B", None, 5.0)]
    assert reshape.concat(old, new.withColumn("x", F.lit(1))).columns == ["k", "v", "x"]
