"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, constants as K, geo, text
from ..operators import aggregates, joins, ranks, spatial
from ..plans import courses as course_plans, schools as school_plans
from .base import CHECKS, query
from .rows import _APPROVED


def conic_sql(lon: str, lat: str) -> tuple[str, str]:
    """The projection as SQL text for the checking engine."""
    n, g, rho0, lon0 = geo.conic_constants()
    phi = f"radians({lat})"
    e2 = K.GRS80_F * (2 - K.GRS80_F)
    parts = [
        f"{1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256!r} * {phi}",
        f"- {3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024!r} * sin(2 * {phi})",
        f"+ {15 * e2**2 / 256 + 45 * e2**3 / 1024!r} * sin(4 * {phi})",
        f"- {35 * e2**3 / 3072!r} * sin(6 * {phi})",
    ]
    rho = f"({K.GRS80_A * g!r}::double - {K.GRS80_A!r}::double * ({' '.join(parts)}))"
    theta = f"({n!r}::double * (radians({lon}) - ({lon0!r}::double)))"
    return f"{rho} * sin({theta})", f"{rho0!r}::double - {rho} * cos({theta})"


_X, _Y = conic_sql("lon", "lat")
CHECKS["o_place"] = f"""
    select unique_school_id, {_X} as school_x, {_Y} as school_y,
        case when locale_code between 11 and 19 then 1.0 when locale_code between 21 and 29 then 3.0
            when locale_code between 31 and 39 then 7.0 when locale_code between 41 and 49 then 18.0 end::double
            as buffer_distance
    from b_school"""
# Some zones have no place.
_PLACED = "zone_no % 97 <> 13"
CHECKS["o_spot"] = f"""
    select geoid, zone_no, case when {_PLACED} then {_X} end as x, case when {_PLACED} then {_Y} end as y from b_zone"""
CHECKS["o_pair"] = """
    select geoid, case when x is not null then unique_school_id end as unique_school_id,
        case when x is not null then buffer_distance end as buffer_distance,
        sqrt((x - school_x) * (x - school_x) + (y - school_y) * (y - school_y)) as distance
    from o_spot cross join o_place where school_x is not null"""


def places(t):
    """Schools in metres with their buffer."""
    x, y = geo.conic_xy("lon", "lat")
    located = t.b_school.withColumn("locale", classify.locale_class("locale_code"))
    return school_plans.add_buffer(located, school_plans.default_buffers(t.spark)).select(
        "unique_school_id", "locale", "lon", "lat", x.alias("school_x"), y.alias("school_y"), "buffer_distance"
    )


def spots(t):
    """Zones in metres, some without a place."""
    x, y = (F.when(F.expr(_PLACED), c) for c in geo.conic_xy("lon", "lat"))
    return t.b_zone.select("geoid", x.alias("x"), y.alias("y"))


@query(
    "j1_left_join",
    """
    select o_orderkey, o_custkey, c_name, c_mktsegment from orders
    left join (select * from customer where c_mktsegment <> 'BUILDING') on o_custkey = c_custkey
    """,
)
def _(t):
    customers = t.customer.filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    return t.orders.select("o_orderkey", "o_custkey").join(customers, "o_custkey", "left")


@query(
    "j2_left_join_other_names",
    "select z.geoid as zone, c.total_population from b_zone z left join (select lpad(geoid, 12, '0') as geoid, total_population from b_census where total_population > 100) c on z.geoid = c.geoid",
)
def _(t):
    census = t.b_census.filter("total_population > 100").select(
        text.zfill("geoid", 12).alias("geoid"), "total_population"
    )
    zones = t.b_zone.select(F.col("geoid").alias("zone"))
    return zones.join(census, zones.zone == census.geoid, "left").select("zone", "total_population")


@query(
    "j3_inner_join",
    "select l_orderkey, l_linenumber, o_custkey, o_orderpriority from lineitem join orders on l_orderkey = o_orderkey",
)
def _(t):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    return t.lineitem.select("l_orderkey", "l_linenumber").join(orders, "l_orderkey")


_KEYED = "lpad(cast(system_id as varchar), 4, '0') || case when school_id < 1000 then lpad(cast(school_id as varchar), 4, '0') else cast(school_id as varchar) end as unique_school_id"
CHECKS["o_roster"] = f"""
    select {_KEYED}, course_number, lower(course_title) as course_title,
        case when certificate_id not in ('n/a', 'N/A', '.', '') then cast(certificate_id as bigint) end as certificate_id,
        lower(teacher_last_name) as teacher_last_name,
        coalesce(lower(teacher_last_name) in ('software-based instruction', 'gavs virtual teacher', 'virtual school (non-gavs)')
            or contains(lower(teacher_last_name), 'de:'), false) as is_virtual
    from b_roster"""
CHECKS["o_course"] = f"select {_KEYED}, course_number, lower(course_title) as course_title, takers, asian, black, white, hispanic, female, male from b_course"
CHECKS["o_course_merge"] = """
    select distinct coalesce(c.unique_school_id, r.unique_school_id) as unique_school_id,
        coalesce(c.course_number, r.course_number) as course_number,
        coalesce(c.course_title, r.course_title) as course_title,
        r.certificate_id, r.teacher_last_name, r.is_virtual
    from (select distinct unique_school_id, course_number, course_title from o_course) c
    full join o_roster r on c.unique_school_id = r.unique_school_id
        and c.course_number is not distinct from r.course_number
        and c.course_title is not distinct from r.course_title"""


@query("j4_outer_join_distinct", "select * from o_course_merge")
def _(t):
    return joins.outer_enrich(
        course_plans.clean_courses(t.b_course), course_plans.clean_roster(t.b_roster), course_plans.COURSE_KEYS
    )


@query(
    "j5_outer_chain",
    """
    select coalesce(a.k, b.k, c.k) as k, a.n as customers, b.n as suppliers, c.n as lines
    from (select c_nationkey as k, count(*) as n from customer where c_nationkey % 3 <> 0 group by 1) a
    full join (select s_nationkey as k, count(*) as n from supplier where s_nationkey % 2 = 0 group by 1) b on a.k = b.k
    full join (select cast(l_suppkey % 30 as int) as k, count(*) as n from lineitem group by 1) c on coalesce(a.k, b.k) = c.k
    """,
)
def _(t):
    def count(df, key, name):
        return df.groupBy(F.expr(key).cast("int").alias("k")).agg(F.count(F.lit(1)).alias(name))

    return joins.outer_chain(
        [
            count(t.customer.filter("c_nationkey % 3 <> 0"), "c_nationkey", "customers"),
            count(t.supplier.filter("s_nationkey % 2 = 0"), "s_nationkey", "suppliers"),
            count(t.lineitem, "l_suppkey % 30", "lines"),
        ],
        "k",
    )


@query(
    "j6_combined_aggregates",
    "select unique_school_id, round(avg(income), 4) as mean, round(stddev_pop(income), 4) as deviation, max(income) as highest from b_member where income is not null group by 1",
)
def _(t):
    return t.b_member.filter("income is not null").groupBy("unique_school_id").agg(
        F.round(F.avg("income"), 4).alias("mean"),
        F.round(F.stddev_pop("income"), 4).alias("deviation"),
        F.max("income").alias("highest"),
    )


@query(
    "j7_delete_in",
    "select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0)",
)
def _(t):
    bad = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.delete_in(t.orders.select("o_orderkey", "o_custkey"), bad, "o_custkey")


@query(
    "j8_not_in",
    """
    select geoid, 'known ids' as listed from b_member where geoid not in (select geoid from b_member where income > 5000)
    union all
    select geoid, 'a missing id' from b_member where geoid not in (select case when income > 9000 then geoid end from b_member)
    """,
)
def _(t):
    zones = t.b_member.select("geoid")
    known = joins.not_in(zones, t.b_member.filter("income > 5000"), "geoid")
    holed = joins.not_in(zones, t.b_member.select(F.expr("case when income > 9000 then geoid end").alias("geoid")), "geoid")
    return known.withColumn("listed", F.lit("known ids")).unionByName(holed.withColumn("listed", F.lit("a missing id")))


@query(
    "j9_append_missing",
    """
    select c_custkey, n, 'kept' as origin from (select o_custkey as c_custkey, count(*) as n from orders where o_orderstatus = 'P' group by 1)
    union all
    select c_custkey, 0, null from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')
    """,
)
def _(t):
    kept = t.orders.filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.lit("kept").alias("origin")
    )
    return joins.append_missing(t.customer.select("c_custkey"), kept, "c_custkey", {"n": 0})


@query(
    "j10_membership_flag",
    "select s_suppkey, case when s_suppkey in (select l_suppkey from lineitem where l_discount = 0.1 and l_quantity > 48) then 1 else 0 end as listed from supplier",
)
def _(t):
    ids = t.lineitem.filter("l_discount = 0.1e0 and l_quantity > 48").select(F.col("l_suppkey").alias("s_suppkey"))
    return joins.membership_flag(t.supplier.select("s_suppkey"), ids, "s_suppkey", "listed")


@query(
    "j11_semi_join",
    "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_totalprice > 400000)",
)
def _(t):
    big = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("j12_lookup_update", "select unique_school_id, buffer_distance from o_place")
def _(t):
    return places(t).select("unique_school_id", "buffer_distance")


CHECKS["o_located"] = """
    select s.*, d.locale_code as district_code from (select * exclude (locale_code) from b_school) s
    left join (
        select try_cast(split_part(state_district_id, '-', 2) as int) as k, min(locale_code) as locale_code
        from b_district group by 1
    ) d on s.system_id = d.k"""


@query("j13_single_match_update", "select unique_school_id, district_code as locale_code from o_located")
def _(t):
    return school_plans.add_locale(t.b_school.drop("locale_code"), t.b_district).select("unique_school_id", "locale_code")


@query(
    "j14_distance_join",
    "select geoid, unique_school_id, round(distance, 3) as distance from o_pair where distance <= buffer_distance * 1609.34",
)
def _(t):
    schools = places(t).withColumn("radius_m", classify.miles_to_metres("buffer_distance"))
    pairs = spatial.distance_join(spots(t), schools.select("unique_school_id", "school_x", "school_y", "radius_m"))
    return pairs.select("geoid", "unique_school_id", F.round("distance", 3).alias("distance"))


@query(
    "j15_nearest_join",
    """
    select geoid, unique_school_id, round(distance, 3) as distance from o_pair
    qualify row_number() over (partition by geoid order by distance, unique_school_id) = 1
    """,
)
def _(t):
    schools = places(t).select("unique_school_id", "school_x", "school_y")
    nearest = spatial.nearest_join(spots(t), schools, "geoid", "unique_school_id")
    return nearest.select("geoid", "unique_school_id", F.round("distance", 3).alias("distance"))


CHECKS["o_teacher_group"] = f"""
    select unique_school_id, certificate_id, bool_or(course_title in ({_APPROVED})) as valid
    from o_roster where certificate_id is not null group by 1, 2"""


@query(
    "j16_row_lookup",
    """
    select r.unique_school_id, r.certificate_id, r.course_title, case when g.valid then 0 else 1 end as extra, count(*) as n
    from o_roster r left join o_teacher_group g
        on r.unique_school_id = g.unique_school_id and r.certificate_id = g.certificate_id
    group by 1, 2, 3, 4
    """,
)
def _(t):
    rows = course_plans.clean_roster(t.b_roster)
    valid = F.col("course_title").isin(*K.APPROVED_TITLES)
    flagged = aggregates.extra_teacher_rows(rows, "unique_school_id", "certificate_id", valid, "extra")
    return flagged.groupBy("unique_school_id", "certificate_id", "course_title", "extra").agg(
        F.count(F.lit(1)).alias("n")
    )
