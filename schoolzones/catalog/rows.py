"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, constants as K, text
from ..operators import filters
from .base import CHECKS, query
from .cleaning import _NUMBER_SQL

CHECKS["o_grades"] = """
    select school_id, grade_range, unnest(regexp_split_to_array(
        replace(replace(grade_range, 'PK', '0'), 'KK', '0.5'), '[,-]')) as token
    from b_enrolment"""
CHECKS["o_high_school"] = """
    select school_id from o_grades where regexp_full_match(token, '[0-9.]+')
    group by 1 having count(case when try_cast(token as double) < 9 then 1 end) = 0
        and count(case when try_cast(token as double) between 9 and 12 then 1 end) > 0"""
_SCHOOL_PATTERNS = ", ".join(f"'{p}'" for p in K.SCHOOL_NAME_PATTERNS)
_SYSTEM_PATTERNS = ", ".join(f"'{p}'" for p in K.SYSTEM_NAME_PATTERNS)
CHECKS["o_alternative"] = f"""
    select school_id from b_enrolment
    where len(list_filter([{_SCHOOL_PATTERNS}], lambda p: school_name ilike p)) > 0
        or len(list_filter([{_SYSTEM_PATTERNS}], lambda p: system_name ilike p)) > 0"""


@query("f1_grade_span", "select school_id, grade_range from b_enrolment where school_id in (select school_id from o_high_school)")
def _(t):
    return filters.filter_grade_span(t.b_enrolment, "grade_range").select("school_id", "grade_range")


@query("f2_name_patterns", "select school_id, school_name, system_name from b_enrolment where school_id in (select school_id from o_alternative)")
def _(t):
    names = {"school_name": K.SCHOOL_NAME_PATTERNS, "system_name": K.SYSTEM_NAME_PATTERNS}
    return t.b_enrolment.filter(filters.ilike_any(names)).select("school_id", "school_name", "system_name")


_APPROVED = ", ".join(f"'{x}'" for x in K.APPROVED_TITLES)


@query(
    "f3_in_list",
    f"select school_id, count(*) as n, sum(takers)::bigint as takers from b_course where lower(course_title) in ({_APPROVED}) group by 1",
)
def _(t):
    return (
        t.b_course.filter(F.lower("course_title").isin(*K.APPROVED_TITLES))
        .groupBy("school_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("takers").alias("takers"))
    )


@query("f4_positive", "select school_id, total_enrollment from (select school_id, try_cast(total_enrollment as double) as total_enrollment from b_enrolment) where total_enrollment > 0")
def _(t):
    return t.b_enrolment.select("school_id", text.to_number("total_enrollment").alias("total_enrollment")).filter(
        F.col("total_enrollment") > 0
    )


@query("f5_drop_missing", "select geoid, income, hispanic from b_member where income is not null and hispanic is not null")
def _(t):
    return filters.drop_missing(t.b_member.select("geoid", "income", "hispanic"), ["income", "hispanic"])


@query("f6_not_null", "select unique_school_id from b_school where lat is not null and lon is not null")
def _(t):
    return t.b_school.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("unique_school_id")


@query("f7_equality", "select c_custkey, c_acctbal from customer where c_nationkey = 13")
def _(t):
    return t.customer.filter(F.col("c_nationkey") == 13).select("c_custkey", "c_acctbal")


@query("f8_box", "select geoid from b_zone where lon between -85.5 and -82.8 and lat between 32.8 and 34.5")
def _(t):
    return filters.points_in_box(t.b_zone, "lon", "lat").select("geoid")


@query(
    "f9_virtual_teacher",
    """
    select teacher, coalesce(teacher in ('software-based instruction', 'gavs virtual teacher', 'virtual school (non-gavs)')
        or contains(teacher, 'de:'), false) as is_virtual, count(*) as n
    from (select lower(teacher_last_name) as teacher from b_roster) group by 1, 2
    """,
)
def _(t):
    rows = t.b_roster.select(F.lower("teacher_last_name").alias("teacher"))
    return rows.groupBy("teacher", text.is_virtual("teacher").alias("is_virtual")).agg(F.count(F.lit(1)).alias("n"))


_OLDER_LABELS = ", ".join(f"'{x}'" for x in K.OLDER_VIRTUAL_LABELS)


@query(
    "f10_virtual_prefix",
    f"""
    select school_id, count(*) as n, count(*) filter (starts_with(teacher_last_name, 'DE:')) as by_prefix from b_roster
    where starts_with(teacher_last_name, 'DE:') or teacher_last_name in ({_OLDER_LABELS}) group by 1
    """,
)
def _(t):
    return t.b_roster.filter(text.is_virtual_older("teacher_last_name")).groupBy("school_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("teacher_last_name").startswith("DE:")).alias("by_prefix")
    )


@query(
    "f11_class_slice",
    "select geoid, balance, category from (select geoid, round(balance, 6) as balance, case when balance > 0.05 then 'Overrepresented' when balance < -0.05 then 'Underrepresented' else 'Parity' end as category from (select geoid, income / 100000 - 0.03 as balance from b_member where income is not null)) where category <> 'Parity'",
)
def _(t):
    rows = t.b_member.select("geoid", (F.col("income") / 100000 - F.lit(0.03)).alias("balance")).dropna()
    rows = rows.withColumn("category", classify.ri_category("balance"))
    return filters.classified(rows, "category", besides="Parity").withColumn("balance", F.round("balance", 6))
