"""Projection and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K, text
from ..operators import clean
from .base import query

# Texts that do and do not read as numbers, next to the balances themselves.
_TEXTS = """
    select c_custkey, case c_custkey % 10
        when 0 then '1e3' when 1 then ' 7 ' when 2 then '12d' when 3 then '1,000' when 4 then 'TFS'
        when 5 then '-5.5' when 6 then '.5' when 7 then null else cast(c_custkey as string) end as raw
    from {customer}
"""
_TEXTS_SQL = _TEXTS.replace("{customer}", "customer")
_NUMBER_SQL = r"""case when regexp_full_match(trim(raw), '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?')
    then try_cast(trim(raw) as double) end"""


@query(
    "p1_composite_key",
    "select c_custkey, lpad(cast(c_nationkey as varchar), 4, '0') || lpad(cast(c_custkey * 7 as varchar), 4, '0') as id from customer",
)
def _(t):
    return t.customer.select("c_custkey", text.composite_key("c_nationkey", F.col("c_custkey") * 7).alias("id"))


@query(
    "p2_zfill_key",
    """
    select c_custkey, lpad(cast(c_nationkey as varchar), 4, '0') ||
        case when length(cast(c_custkey * 7 as varchar)) < 4 then lpad(cast(c_custkey * 7 as varchar), 4, '0')
        else cast(c_custkey * 7 as varchar) end as id
    from customer
    """,
)
def _(t):
    return t.customer.select("c_custkey", text.zfill_key("c_nationkey", F.col("c_custkey") * 7).alias("id"))


@query("p3_zone_id", "select c_custkey, lpad(cast(c_custkey as varchar), 12, '0') as geoid from customer")
def _(t):
    return t.customer.select("c_custkey", text.zfill("c_custkey", 12).alias("geoid"))


@query(
    "p4_marker_to_null",
    """
    select school_id, count(*) as n, count(case when certificate_id not in ('n/a', 'N/A', '.', '') then 1 end) as present
    from b_roster group by 1
    """,
)
def _(t):
    return t.b_roster.groupBy("school_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(text.null_if_in("certificate_id")).alias("present")
    )


@query(
    "p5_to_number",
    f"select c_custkey, {_NUMBER_SQL} as number, "
    f"case when floor({_NUMBER_SQL}) = {_NUMBER_SQL} then cast({_NUMBER_SQL} as bigint) end as whole from ({_TEXTS_SQL})",
)
def _(t):
    return t.sql(_TEXTS).select(
        "c_custkey", text.to_number("raw").alias("number"), text.to_whole_number("raw", strict=False).alias("whole")
    )


@query(
    "p6_number_or_zero",
    "select school_id, coalesce(try_cast(female as double), 0) as female, coalesce(try_cast(male as double), 0) as male from b_enrolment",
)
def _(t):
    return clean.numbers_or_zero(t.b_enrolment.select("school_id", "female", "male"), ["female", "male"])


@query(
    "p7_fill_zero",
    """
    select s_suppkey, coalesce(q, 0) as quantity from supplier
    left join (select l_suppkey, sum(l_quantity) as q from lineitem where l_suppkey % 4 = 1 group by 1) on s_suppkey = l_suppkey
    """,
)
def _(t):
    sums = t.lineitem.filter("l_suppkey % 4 = 1").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.sum("l_quantity").alias("quantity")
    )
    return clean.fill_zero(t.supplier.select("s_suppkey").join(sums, "s_suppkey", "left"), ["quantity"])


@query(
    "p8_zero_divisor_to_null",
    "select geoid, round(white / nullif(pop, 0), 6) as share from b_member",
)
def _(t):
    return t.b_member.select(
        "geoid", F.round(F.col("white") / F.nullif(F.col("pop"), F.lit(0.0)), 6).alias("share")
    )


@query(
    "p9_lower_text",
    "select lower(course_title) as course_title, lower(teacher_last_name) as teacher_last_name, count(*) as n from b_roster group by 1, 2",
)
def _(t):
    return (
        clean.lower_text(t.b_roster, "course_title", "teacher_last_name")
        .groupBy("course_title", "teacher_last_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("p10_lower_column_names", "select n_nationkey, n_name, n_regionkey from nation")
def _(t):
    nation = t.nation
    return clean.lower_columns(nation.toDF(*[c.upper() for c in nation.columns]))


@query("p11_rename_select", "select s_suppkey as school, s_name as name from supplier")
def _(t):
    return clean.rename_select(t.supplier, {"s_suppkey": "school", "s_name": "name"})


@query(
    "p12_split_part",
    "select state_district_id, split_part(state_district_id, '-', 2) as district, count(*) as n from b_district group by 1, 2",
)
def _(t):
    return (
        t.b_district.select("state_district_id", text.second_part("state_district_id").alias("district"))
        .groupBy("state_district_id", "district")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "p13_grade_tokens",
    """
    select school_id, len(tokens) as n_tokens, array_to_string(tokens, '|') as tokens from (
        select school_id, regexp_split_to_array(replace(replace(grade_range, 'PK', '0'), 'KK', '0.5'), '[,-]') as tokens
        from b_enrolment where grade_range is not null)
    """,
)
def _(t):
    rows = t.b_enrolment.filter("grade_range is not null").select("school_id", text.grade_tokens("grade_range").alias("g"))
    return rows.select("school_id", F.size("g").cast("long").alias("n_tokens"), F.array_join("g", "|").alias("tokens"))


@query("p14_add_if_absent", "select s_suppkey, s_nationkey, s_suppkey * 2 as added from supplier")
def _(t):
    base = t.supplier.select("s_suppkey", "s_nationkey")
    once = clean.add_if_absent(base, "added", F.col("s_suppkey") * 2)
    return clean.add_if_absent(once, "added", F.lit(-1).cast("long"))


@query("p15_drop_columns", "select s_suppkey, s_acctbal from supplier")
def _(t):
    return t.supplier.drop("s_name", "s_nationkey")


@query(
    "p16_flags_to_code",
    """
    select code, count(*) as n from (
        select case when l_returnflag = 'R' then '1' else '0' end || case when l_linestatus = 'F' then '1' else '0' end ||
            case when l_quantity > 25 then '1' else '0' end as code
        from lineitem) group by 1
    """,
)
def _(t):
    flags = [
        text.as_flag(F.col("l_returnflag") == "R"),
        text.as_flag(F.col("l_linestatus") == "F"),
        text.as_flag(F.col("l_quantity") > 25),
    ]
    return t.lineitem.select(text.flags_to_code(*flags).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("p17_round_half_even", "select c_custkey, round_even(c_custkey / 2000e0, 3) as rounded from customer")
def _(t):
    return t.customer.select("c_custkey", text.round_half_even(F.col("c_custkey") / F.lit(2000.0), 3).alias("rounded"))


@query("p18_scale", "select l_orderkey, l_linenumber, round(l_discount * 100, 6) as l_discount from lineitem")
def _(t):
    rows = clean.scale(t.lineitem.select("l_orderkey", "l_linenumber", "l_discount"), ["l_discount"], 100.0)
    return rows.withColumn("l_discount", F.round("l_discount", 6))


@query("p19_tag_rows", "select s_suppkey, 'White' as race from supplier")
def _(t):
    return t.supplier.select("s_suppkey", F.lit("White").alias("race"))


@query(
    "p20_label_from_map",
    """
    select unique_school_id, case when locale_code between 11 and 19 then 1.0 when locale_code between 21 and 29 then 3.0
        when locale_code between 31 and 39 then 7.0 when locale_code between 41 and 49 then 18.0 end::double as radius
    from b_school
    """,
)
def _(t):
    from ..functions.classify import locale_class

    rows = t.b_school.select("unique_school_id", locale_class("locale_code").alias("locale"))
    return clean.label_from(rows, "locale", dict(K.BUFFER_MILES), "radius").drop("locale")
