"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..functions import classify, constants as K
from ..plans import schools as school_plans
from ..session import scratch_path
from ..sources import tables as T, typed_csv, versions
from .base import query


@query("s1_table_scan", "select * from supplier")
def _(t):
    return T.load_table(t.spark, t.path("supplier"))


@query("s2_projected_scan", "select l_suppkey, l_quantity from lineitem")
def _(t):
    return T.load_columns(t.spark, t.path("lineitem"), ["l_suppkey", "l_quantity"])


@query(
    "s3_point_scan",
    """
    select s.unique_school_id, round(s.lon, 9) as lon, round(s.lat, 9) as lat, e.total_enrollment
    from b_school s join b_enrolment e on s.school_id = e.school_id
    where s.lon is not null and s.lat is not null
    """,
)
def _(t):
    points = T.points_from_lonlat(t.b_school, "lon", "lat")
    return points.join(t.b_enrolment.select("school_id", "total_enrollment"), "school_id").select(
        "unique_school_id", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"), "total_enrollment"
    )


@query(
    "s4_polygon_scan",
    """
    select geoid, round(lon, 7) as first_x, round(lat, 7) as first_y,
        case when zone_no % 40 = 17 then 3 when zone_no % 3 = 1 then 7 else 5 end as outer_points,
        case when zone_no % 40 <> 17 and zone_no % 3 = 2 then 1 else 0 end as holes
    from b_zone
    """,
)
def _(t):
    from .shapes import stored_polygons

    outer = F.get("rings", F.lit(0))
    return stored_polygons(t).select(
        "geoid",
        F.round(F.get(outer, F.lit(0))["x"], 7).alias("first_x"),
        F.round(F.get(outer, F.lit(0))["y"], 7).alias("first_y"),
        F.size(outer).alias("outer_points"),
        (F.size("rings") - 1).alias("holes"),
    )


@query("s5_csv_read", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def _(t):
    path = scratch_path(t.spark, "csv")
    T.write_csv(t.supplier, path)
    schema = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    return T.read_csv(t.spark, path, schema)


def _mixed_csv(t):
    """Suppliers as CSV lines: some with too few or too many fields, some with a word for a number."""
    key = F.col("s_suppkey")
    balance = F.when(key % 50 == 9, "unknown").when(key % 7 == 2, "NA").otherwise(F.format_string("%.2f", "s_acctbal"))
    opened = F.when(key % 9 != 0, F.concat(F.lit("2024-0"), (key % 9).cast("string"), F.lit("-11"))).otherwise("")
    fields = [key.cast("string"), F.concat(F.lit('"'), "s_name", F.lit(', Ltd"')), balance, opened, (key % 2 == 0).cast("string")]
    line = (
        F.when(key % 20 == 13, F.concat_ws(",", *fields[:3]))
        .when(key % 20 == 17, F.concat_ws(",", *fields, F.lit("more")))
        .otherwise(F.concat_ws(",", *fields))
    )
    path = scratch_path(t.spark, "mixed")
    lines = t.supplier.select(line.alias("key,name,balance,opened,even"))
    lines.write.options(header=True, sep="\u0001", quote="", escapeQuotes=False).csv(path)
    return path


_BALANCE = "case when s_suppkey % 7 <> 2 then round(s_acctbal, 2) end"
_OPENED = "case when s_suppkey % 9 <> 0 then make_date(2024, cast(s_suppkey % 9 as int), 11) end"


@query(
    "s5_inferred_csv",
    f"""
    select s_suppkey as key, s_name || ', Ltd' as name, {_BALANCE} as balance, {_OPENED} as opened, s_suppkey % 2 = 0 as even
    from supplier where s_suppkey % 20 not in (13, 17) and s_suppkey % 50 <> 9
    """,
)
def _(t):
    return typed_csv.scan(t.spark, _mixed_csv(t), tolerance=0.1).rows


@query(
    "s5_quarantined_rows",
    """
    select case when s_suppkey % 20 in (13, 17) then 'fields' else 'value' end as reason,
        case when s_suppkey % 20 not in (13, 17) then 'balance' end as "column", count(*) as n
    from supplier where s_suppkey % 20 in (13, 17) or s_suppkey % 50 = 9 group by 1, 2
    """,
)
def _(t):
    found = typed_csv.scan(t.spark, _mixed_csv(t), tolerance=0.1).quarantined
    return found.groupBy("reason", "column").agg(F.count(F.lit(1)).alias("n"))


@query("s6_replace_table", "select s_suppkey, s_nationkey from supplier")
def _(t):
    path = scratch_path(t.spark, "replaced")
    versions.replace(t.nation, path)
    versions.replace(t.supplier.select("s_suppkey", "s_nationkey"), path)
    return versions.read(t.spark, path)


@query("s7_create_table", "select c_custkey, c_nationkey, true as second_refused from customer")
def _(t):
    path = scratch_path(t.spark, "created")
    stored = T.write_new(t.customer.select("c_custkey", "c_nationkey"), path)
    try:
        T.write_new(t.customer, path)
        refused = False
    except AnalysisException:
        refused = True
    return stored.withColumn("second_refused", F.lit(refused))


@query(
    "s8_insert_if_absent",
    """
    select c_nationkey as k, 'old' as origin, max(c_acctbal) as v from customer where c_nationkey % 2 = 0 group by 1
    union all
    select s_nationkey, 'new', min(s_acctbal) from supplier
    where s_nationkey not in (select c_nationkey from customer where c_nationkey % 2 = 0) group by 1
    """,
)
def _(t):
    old = t.customer.filter("c_nationkey % 2 = 0").groupBy(F.col("c_nationkey").alias("k")).agg(
        F.lit("old").alias("origin"), F.max("c_acctbal").alias("v")
    )
    new = t.supplier.select(F.col("s_nationkey").alias("k"), F.lit("new").alias("origin"), F.col("s_acctbal").alias("v"))
    path = scratch_path(t.spark, "inserted")
    versions.create(old, path)
    versions.insert_absent(new, path, "k")
    return versions.read(t.spark, path)


@query("s9_csv_export", "select geoid, total_population, edu_hs_or_more from b_census")
def _(t):
    path = scratch_path(t.spark, "exported")
    T.write_csv(t.b_census.select("geoid", "total_population", "edu_hs_or_more"), path)
    return T.read_csv(t.spark, path, "geoid string, total_population long, edu_hs_or_more long")


@query(
    "s10_write_back",
    """
    select s_suppkey, case when l.l_suppkey is not null then l.q else -1.0 end as quantity,
        case when l.l_suppkey is not null then l.n else 0 end as lines
    from supplier left join (
        select l_suppkey, sum(l_quantity) as q, count(*) as n from lineitem where l_suppkey % 3 <> 0 group by 1
    ) l on s_suppkey = l_suppkey
    """,
)
def _(t):
    target = t.supplier.select("s_suppkey", F.lit(-1.0).alias("quantity"), F.lit(0).cast("long").alias("lines"))
    metrics = t.lineitem.filter("l_suppkey % 3 <> 0").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("lines")
    )
    path = scratch_path(t.spark, "updated")
    versions.create(target, path)
    versions.update(metrics, path, "s_suppkey")
    return versions.read(t.spark, path)


@query(
    "s11_lookup_table",
    """
    select s.unique_school_id, b.column1 as buffer_distance
    from b_school s left join (values ('City', 1.0::double), ('Suburb', 3.0), ('Town', 7.0), ('Rural', 18.0)) b(column0, column1)
    on b.column0 = case when locale_code between 11 and 19 then 'City' when locale_code between 21 and 29 then 'Suburb'
        when locale_code between 31 and 39 then 'Town' when locale_code between 41 and 49 then 'Rural' end
    """,
)
def _(t):
    located = t.b_school.withColumn("locale", classify.locale_class("locale_code"))
    buffers = T.lookup_table(t.spark, K.BUFFER_MILES, ["locale_type", "buffer_distance"])
    return school_plans.add_buffer(located, buffers).select("unique_school_id", "buffer_distance")
