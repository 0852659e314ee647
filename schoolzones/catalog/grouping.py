"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, constants as K, geo
from ..operators import aggregates, ranks, sketches
from ..plans import courses as course_plans, layers
from ..session import fixed, scratch_path
from .base import CHECKS, query
from .joining import _APPROVED
from .shapes import zone_polygons

SCHOOL = "unique_school_id"


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


CHECKS["o_cs"] = f"""
    select unique_school_id, coalesce(sum(takers), 0)::bigint as cs_enrollment, {', '.join(
        f'coalesce(sum({g}), 0)::bigint as cs_{g}' for g in K.DEMOGRAPHICS)}
    from o_course where course_title in ({_APPROVED}) group by 1"""


@query("a1_group_sums", "select * from o_cs")
def _(t):
    return course_plans.cs_totals(course_plans.clean_courses(t.b_course))


@query("a2_distinct_count", "select unique_school_id, count(distinct certificate_id) as certified_teachers from o_roster group by 1")
def _(t):
    return aggregates.distinct_count(course_plans.clean_roster(t.b_roster), [SCHOOL], "certificate_id", "certified_teachers")


@query("a3_none_valid", "select unique_school_id, certificate_id, case when valid then 0 else 1 end as extra from o_teacher_group")
def _(t):
    rows = course_plans.clean_roster(t.b_roster)
    return aggregates.none_valid(rows, [SCHOOL, "certificate_id"], F.col("course_title").isin(*K.APPROVED_TITLES), "extra")


@query(
    "a4_extra_teacher_schools",
    f"""
    select unique_school_id, max(extra) as extra_teacher_count,
        case when max(extra) = 1 then 'Yes' else 'No' end as has_extra_teacher
    from (select unique_school_id, certificate_id,
            case when certificate_id is not null and bool_or(course_title in ({_APPROVED})) then 0 else 1 end as extra
        from o_roster group by 1, 2)
    group by 1
    """,
)
def _(t):
    valid = F.col("course_title").isin(*K.APPROVED_TITLES)
    return aggregates.extra_teacher_schools(course_plans.clean_roster(t.b_roster), SCHOOL, "certificate_id", valid)


@query("a5_value_counts", "select l_returnflag, count(*) as n from lineitem group by 1")
def _(t):
    return aggregates.value_counts(t.lineitem, "l_returnflag")


@query(
    "a6_category_counts",
    """
    select locale, count(case when ri > 0.05 then 1 end) as overrepresentation,
        count(case when ri <= 0.05 and ri >= -0.05 then 1 end) as parity,
        count(case when ri < -0.05 then 1 end) as underrepresentation
    from (select case when l_partkey % 17 = 0 then null else l_returnflag end as locale,
            case when l_partkey % 13 = 0 then null else round(l_discount - l_tax, 4) end as ri from lineitem)
    where locale is not null group by 1
    union all
    select 'Total', count(case when ri > 0.05 then 1 end), count(case when ri <= 0.05 and ri >= -0.05 then 1 end),
        count(case when ri < -0.05 then 1 end)
    from (select case when l_partkey % 13 = 0 then null else round(l_discount - l_tax, 4) end as ri from lineitem)
    """,
)
def _(t):
    rows = t.lineitem.select(
        F.expr("case when l_partkey % 17 <> 0 then l_returnflag end").alias("locale"),
        F.expr("case when l_partkey % 13 <> 0 then round(l_discount - l_tax, 4) end").alias("ri"),
    )
    return aggregates.category_counts_by(rows, "locale", "ri")


@query(
    "a7_ratio_of_sums",
    """
    select unique_school_id, round(coalesce(sum(white), 0) / nullif(sum(pop), 0) * 100, 6) as white,
        round(coalesce(sum(hispanic), 0) / nullif(sum(pop), 0) * 100, 6) as hispanic
    from b_member group by 1
    """,
)
def _(t):
    ratios = aggregates.ratio_of_sums(["white", "hispanic"], "pop", factor=100.0)
    return _rounded(t.b_member.groupBy(SCHOOL).agg(*ratios), 6, "white", "hispanic")


_MEAN = "sum(pop * income) filter (where pop is not null and income is not null) / nullif(sum(pop) filter (where income is not null), 0)"


@query("a8_weighted_mean", f"select unique_school_id, round({_MEAN}, 6) as mean from b_member group by 1")
def _(t):
    return t.b_member.groupBy(SCHOOL).agg(F.round(aggregates.weighted_mean("income", "pop"), 6).alias("mean"))


CHECKS["o_spread"] = """
    select m.unique_school_id, max(mean) as mean, sqrt(sum(pop * (income - mean) * (income - mean)) / nullif(sum(pop), 0)) as deviation
    from b_member m join (
        select unique_school_id, sum(pop * income) / nullif(sum(pop), 0) as mean from b_member where income is not null group by 1
    ) a on m.unique_school_id = a.unique_school_id
    where income is not null group by 1"""


@query("a9_average_by_weight", "select unique_school_id, round(mean, 6) as mean from o_spread")
def _(t):
    df = aggregates.weighted_mean_std(t.b_member, SCHOOL, "income", "pop", "mean", "deviation")
    return df.select(SCHOOL, F.round("mean", 6).alias("mean"))


@query("a10_weighted_deviation", "select unique_school_id, round(deviation, 6) as deviation from o_spread")
def _(t):
    df = aggregates.weighted_mean_std(t.b_member, SCHOOL, "income", "pop", "mean", "deviation")
    return df.select(SCHOOL, F.round("deviation", 6).alias("deviation"))


def harmonic_sql(pop: str, distance: str = "distance") -> str:
    return (
        f"case when coalesce(bool_or({distance} = 0 and {pop} > 0), false) then 0 else "
        f"coalesce(sum({pop}), 0) / nullif(sum({pop} / nullif({distance}, 0)), 0) end"
    )


@query(
    "a11_harmonic_distance",
    f"select unique_school_id, round({harmonic_sql('white')}, 6) as white_mean, round({harmonic_sql('hispanic')}, 6) as hispanic_mean from b_member group by 1",
)
def _(t):
    means = aggregates.harmonic_mean_distance("distance", ["white", "hispanic"], "_mean")
    return _rounded(t.b_member.groupBy(SCHOOL).agg(*means), 6, "white_mean", "hispanic_mean")


CHECKS["o_running"] = """
    select *, sum(pop) over (partition by unique_school_id order by income, geoid
            rows between unbounded preceding and current row) as upto,
        sum(pop) over (partition by unique_school_id) as everyone
    from b_member where income is not null"""
CHECKS["o_median"] = """
    select unique_school_id, lo + (half - lo_at) / (hi_at - lo_at) * (hi - lo) as median from (
        select unique_school_id, max(everyone) / 2 as half,
            arg_max(income, (upto, income, geoid)) filter (where upto <= everyone / 2) as lo,
            max(upto) filter (where upto <= everyone / 2) as lo_at,
            arg_min(income, (upto, income, geoid)) filter (where upto > everyone / 2) as hi,
            min(upto) filter (where upto > everyone / 2) as hi_at
        from o_running group by 1)"""


@query("a12_weighted_median", "select unique_school_id, round(median, 6) as median from o_median")
def _(t):
    return _rounded(ranks.weighted_median(t.b_member, SCHOOL, "income", "pop", "geoid", "median"), 6, "median")


@query(
    "j6_weighted_statistics",
    """
    select m.unique_school_id, round(median, 6) as median, round(s.mean, 6) as mean, round(deviation, 6) as deviation
    from o_median m join o_spread s on m.unique_school_id = s.unique_school_id
    """,
)
def _(t):
    rows = fixed(t.b_member.select(SCHOOL, "geoid", "income", "pop").dropna())
    median = ranks.weighted_median(rows, SCHOOL, "income", "pop", "geoid", "median")
    spread = aggregates.weighted_mean_std(rows, SCHOOL, "income", "pop", "mean", "deviation")
    return _rounded(median.join(spread, SCHOOL), 6, "median", "mean", "deviation")


@query(
    "a13_counts",
    "select count(*) as total_zones, count(income) as with_income, count(*) filter (where pop = 0) as empty_zones from b_member",
)
def _(t):
    return t.b_member.agg(
        F.count(F.lit(1)).alias("total_zones"),
        F.count("income").alias("with_income"),
        F.count_if(F.col("pop") == 0).alias("empty_zones"),
    )


@query("a14_ordered_group_count", "select unique_school_id, count(*) as assigned_cbg_count from b_member group by 1")
def _(t):
    return t.b_member.groupBy(SCHOOL).agg(F.count(F.lit(1)).alias("assigned_cbg_count")).orderBy(
        "assigned_cbg_count", SCHOOL
    )


@query("a15_group_max", "select l_suppkey, max(l_quantity) as most from lineitem group by 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.max("l_quantity").alias("most"))


CHECKS["o_mode"] = """
    select school_id, case when bool_or(virtual) and bool_or(not virtual) then 'Both' when bool_or(virtual) then 'Virtual'
        when bool_or(not virtual) then 'In Person' else 'Unknown' end as classification
    from (select school_id, starts_with(teacher_last_name, 'DE:') or teacher_last_name in
            ('GAVS Virtual Teacher', 'Virtual School (Non-GAVS)', 'Software-Based Instruction') as virtual from b_roster)
    group by 1"""


@query("a16_teaching_mode", "select * from o_mode")
def _(t):
    return aggregates.teaching_mode(t.b_roster, "school_id", "teacher_last_name")


@query(
    "a17_class_counts",
    "select c.locale, count(s.unique_school_id) as schools from (values ('City'), ('Suburb'), ('Town'), ('Rural'), ('Island')) c(locale) "
    "left join (select *, case when locale_code between 11 and 19 then 'City' when locale_code between 21 and 29 then 'Suburb' "
    "when locale_code between 31 and 39 then 'Town' when locale_code between 41 and 49 then 'Rural' end as l from b_school) s on s.l = c.locale group by 1",
)
def _(t):
    rows = t.b_school.withColumn("locale", classify.locale_class("locale_code"))
    return aggregates.class_counts(rows, "locale", ["City", "Suburb", "Town", "Rural", "Island"], "schools")


# Schools with four indices, a locale and a metric, straight from the suppliers.
_RI = {"white": (31, 40), "black": (17, 41), "asian": (13, 43), "hispanic": (7, 47)}
_RI_SQL = ", ".join(
    f"case when s_suppkey % 11 = {i} then null else ((s_suppkey * {a}) % {b}) / 100e0 - 0.2e0 end as ri_{g}"
    for i, (g, (a, b)) in enumerate(_RI.items())
)
CHECKS["o_indexed"] = f"""
    select s_suppkey as school, case when s_nationkey % 7 = 6 then null else 'L' || (s_nationkey % 4) end as locale,
        s_acctbal as metric, {_RI_SQL} from supplier"""
CHECKS["o_indexed_long"] = " union all ".join(
    f"select school, locale, metric, '{r}' as race, ri_{r.lower()} as ri from o_indexed where ri_{r.lower()} is not null"
    for r in K.RACES
)


def indexed_schools(t):
    return t.sql(
        f"select s_suppkey as unique_school_id, case when s_nationkey % 7 <> 6 then 'L' || (s_nationkey % 4) end as locale, "
        f"s_acctbal as metric, {_RI_SQL} from {{supplier}}"
    )


def sided_rows(t):
    """Long rows with a metric and a side of parity."""
    rows = layers.race_rows(indexed_schools(t)).join(
        t.supplier.select(F.col("s_suppkey").alias(SCHOOL), F.col("s_acctbal").alias("metric")), SCHOOL
    )
    return rows.withColumn("representation", classify.ri_category("ri")).filter("representation <> 'Parity'")


_SIDES = """count(case when ri > 0.05 then 1 end) as overrepresentation,
    count(case when ri <= 0.05 and ri >= -0.05 then 1 end) as parity,
    count(case when ri < -0.05 then 1 end) as underrepresentation"""


@query("a18_counts_by_race", f"select race, {_SIDES} from o_indexed_long where locale is not null group by 1")
def _(t):
    return layers.counts_by_race(indexed_schools(t))


@query("a19_counts_by_locale", f"select locale, {_SIDES} from o_indexed_long where locale is not null group by 1")
def _(t):
    return layers.counts_by_locale(indexed_schools(t))


@query(
    "a20_padded_extent",
    """
    select round(min_x - 0.05 * (max_x - min_x), 6) as min_x, round(min_y - 0.05 * (max_y - min_y), 6) as min_y,
        round(max_x + 0.05 * (max_x - min_x), 6) as max_x, round(max_y + 0.05 * (max_y - min_y), 6) as max_y
    from (select min(x0) as min_x, min(y0) as min_y, max(x1) as max_x, max(y1) as max_y from o_box)
    """,
)
def _(t):
    corners = zone_polygons(t).select(F.explode(F.get("rings", F.lit(0))).alias("p")).select("p.x", "p.y")
    return _rounded(aggregates.padded_extent(corners, "x", "y"), 6, "min_x", "min_y", "max_x", "max_y")


CHECKS["o_sided"] = """
    select *, case when ri > 0.05 then 'Overrepresented' when ri < -0.05 then 'Underrepresented' end as representation
    from o_indexed_long where ri > 0.05 or ri < -0.05"""


@query(
    "a21_quartiles",
    "select race, representation, " + ", ".join(
        f"round(quantile_cont(metric, {q}), 6) as q{i + 1}" for i, q in enumerate((0.25, 0.5, 0.75))
    ) + " from o_sided group by 1, 2",
)
def _(t):
    q = ranks.quantiles(sided_rows(t), ["race", "representation"], "metric", [0.25, 0.5, 0.75])
    return q.select("race", "representation", *[F.round(F.col("q")[i], 6).alias(f"q{i + 1}") for i in range(3)])


@query(
    "a22_density",
    """
    , stats as (select race, representation, min(metric) as lo, max(metric) as hi, stddev_samp(metric) * 0.2 as h from o_sided group by 1, 2),
    grid as (select *, lo + (hi - lo) * grid_no / 99 as grid_x from stats, range(0, 100) r(grid_no)),
    curve as (
        select g.race, g.representation, grid_no, grid_x, sum(exp(-0.5 * ((grid_x - metric) / h) * ((grid_x - metric) / h))) as d
        from grid g join o_sided s on g.race = s.race and g.representation = s.representation group by 1, 2, 3, 4)
    select race, representation, grid_no::int as grid_no, round(grid_x, 5) as grid_x,
        round(d / max(d) over (partition by race, representation), 6) as density
    from curve
    """,
)
def _(t):
    curve = ranks.density(sided_rows(t), ["race", "representation"], "metric", K.DENSITY_BANDWIDTH, K.DENSITY_GRID)
    return _rounded(_rounded(curve, 5, "grid_x"), 6, "density")


# --- Estimates from stored sketches ------------------------------------------------------------------------------


def _monthly_sketches(t):
    """Sketches of each supplier and month, stored in two goes, the second of which brings some months again."""
    path = scratch_path(t.spark, "sketches")
    rows = t.lineitem.withColumn("month", F.trunc("l_shipdate", "month"))
    early = rows.filter("l_shipdate < '1995-07-01'").filter("l_linenumber <> 2 or month < '1995-01-01'")
    sketches.store(sketches.daily(early, ["l_suppkey"], "month", "l_partkey", "l_extendedprice"), path)
    late = rows.filter("month >= '1995-01-01'")
    sketches.store(sketches.daily(late, ["l_suppkey"], "month", "l_partkey", "l_extendedprice"), path)
    return sketches.between(t.spark, path, "1990-01-01", "2099-12-31")


@query(
    "a2_mergeable_distinct_count",
    "select l_suppkey, count(distinct l_partkey) as parts, true as close from lineitem group by 1",
)
def _(t):
    """Exact counts, and whether the estimates from stored sketches are within five standard errors."""
    guess = sketches.distinct_counts(_monthly_sketches(t), ["l_suppkey"], "guess")
    exact = aggregates.distinct_count(t.lineitem, ["l_suppkey"], "l_partkey", "parts")
    off = F.abs(F.col("guess") - F.col("parts"))
    return exact.join(guess, "l_suppkey").select(
        "l_suppkey", "parts", (off <= F.greatest(F.lit(1.0), 5 * sketches.DISTINCT_ERROR * F.col("parts"))).alias("close")
    )


@query(
    "a21_mergeable_quartiles",
    "select l_suppkey, count(*) as n, true as close from lineitem group by 1",
)
def _(t):
    """Rows, and whether the ranks of the estimated quartiles are within three rank errors."""
    guess = sketches.quantiles(_monthly_sketches(t), ["l_suppkey"], [0.25, 0.5, 0.75])
    met = t.lineitem.join(guess, "l_suppkey")
    upto = [F.count_if(F.col("l_extendedprice") <= F.col("q")[i]).alias(f"upto{i}") for i in range(3)]
    below = [F.count_if(F.col("l_extendedprice") < F.col("q")[i]).alias(f"below{i}") for i in range(3)]
    ranks_of = met.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), *upto, *below)
    room = 3 * sketches.RANK_ERROR * F.col("n") + 1
    close = F.lit(True)
    for i, share in enumerate((0.25, 0.5, 0.75)):
        at = F.col("n") * share
        close = close & (F.col(f"upto{i}") >= at - room) & (F.col(f"below{i}") <= at + room)
    return ranks_of.select("l_suppkey", "n", close.alias("close"))
