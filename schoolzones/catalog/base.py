"""Views that give the driver's tables the shape of the school data, and the query registry.

Each view is one SELECT that both Spark and the checking engine understand, so both sides
start from equal rows. Suppliers play schools, customers zones, line items courses.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import constants as K

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _school_key(key: str) -> str:
    digits = f"cast({key} as string)"
    return (
        f"lpad(cast(600 + {key} % 25 as string), 4, '0') || "
        f"case when length({digits}) < 4 then lpad({digits}, 4, '0') else {digits} end"
    )


_TITLES = K.EXPANDED_TITLES + ["algebra i", "world history", "studio art", "physical education"]


def _titles() -> str:
    rows = ", ".join(f"({i}, '{t.upper()}')" for i, t in enumerate(_TITLES))
    return f"(values {rows}) as titles(title_no, title)"


_COURSE_NO = "case when l_suppkey % 4 = 3 then 16 + p_partkey % 4 else (p_partkey * 3 + l_suppkey) % 20 end"


def _part_of(total: str, tenths: int) -> str:
    return f"cast(floor({total} * {tenths} / 10) as bigint)"


# ``{name}`` is a driver table or another view.
VIEWS = {
    "b_school": f"""
        select {_school_key('s_suppkey')} as unique_school_id,
            cast(600 + s_suppkey % 25 as int) as system_id,
            cast(s_suppkey as int) as school_id,
            cast(2 * (s_suppkey % 25) as int) as locale_code,
            case when s_suppkey % 29 <> 3
                then -85.5e0 + ((s_suppkey * 7919) % 10007) / 10007e0 * 4.5e0 end as lon,
            case when s_suppkey % 29 <> 3
                then 30.5e0 + ((s_suppkey * 104729) % 10009) / 10009e0 * 4.3e0 end as lat
        from {{supplier}}""",
    "b_enrolment": """
        select cast(600 + s_suppkey % 25 as int) as system_id,
            cast(s_suppkey as int) as school_id,
            case when s_suppkey % 25 = 24 then 'State Schools' else 'District ' || cast(s_suppkey % 25 as string) end
                as system_name,
            case s_suppkey % 16
                when 1 then s_name || ' Academy'
                when 5 then s_name || ' Early System High'
                when 9 then s_name || ' S.T.E.M. School'
                when 13 then null
                else s_name || ' High' end as school_name,
            case s_suppkey % 11
                when 2 then 'PK,KK,01-05'
                when 4 then '06-12'
                when 6 then 'KK-12'
                when 7 then '10'
                when 8 then ' 09'
                when 9 then '09,'
                when 10 then case when s_suppkey % 2 = 0 then null else '09-13' end
                else '09-12' end as grade_range,
            case when s_suppkey % 13 = 5 then 'TFS' when s_suppkey % 17 = 4 then '0'
                else cast(700 + (s_suppkey * 37) % 900 as string) end as total_enrollment,
            cast((s_suppkey * 7) % 90 as string) as asian,
            cast((s_suppkey * 11) % 300 as string) as black,
            cast((s_suppkey * 13) % 250 as string) as white,
            cast((s_suppkey * 17) % 120 as string) as hispanic,
            case when s_suppkey % 19 = 2 then 'TFS' else cast((s_suppkey * 5) % 400 as string) end as female,
            cast((s_suppkey * 3) % 400 as string) as male
        from {supplier}""",
    "b_contact": """
        select cast(600 + s_suppkey % 25 as int) as district_id,
            cast(s_suppkey as int) as school_id,
            cast(s_suppkey as string) || ' Main Street' as school_address,
            'City ' || cast(s_suppkey % 10 as string) as school_city,
            'GA' as state,
            30.5e0 + ((s_suppkey * 104729) % 10009) / 10009e0 * 4.3e0 as lat,
            -85.5e0 + ((s_suppkey * 7919) % 10007) / 10007e0 * 4.5e0 as lon
        from {supplier}
        where s_suppkey % 31 <> 7""",
    "b_district": """
        select case when c_custkey % 50 = 3 then cast(600 + c_nationkey as string)
                when c_custkey % 50 = 7 then 'GA-x'
                else 'GA-' || cast(600 + c_nationkey as string) end as state_district_id,
            cast(2 * c_nationkey + c_custkey % 2 as int) as locale_code
        from {customer}""",
    "b_zone": f"""
        select lpad(cast(c_custkey as string), 12, '0') as geoid,
            c_custkey as zone_no,
            -85.5e0 + ((c_custkey * 6007 + 1237) % 9973) / 9973e0 * 4.5e0 as lon,
            30.5e0 + ((c_custkey * 3571 + 4421) % 9967) / 9967e0 * 4.3e0 as lat
        from {{customer}}""",
    "b_census": f"""
        select cast(c_custkey as string) as geoid,
            c_custkey % 900 as total_population,
            {_part_of('(c_custkey % 900)', 4)} as white_alone_non_hispanic,
            {_part_of('(c_custkey % 900)', 3)} as black_alone_non_hispanic,
            {_part_of('(c_custkey % 900)', 1)} as asian_alone_non_hispanic,
            case when c_custkey % 23 = 5 then null else {_part_of('(c_custkey % 900)', 2)} end as hispanic_or_latino,
            (c_custkey * 7) % 301 as edu_less_than_hs,
            (c_custkey * 13) % 4003 as edu_hs_or_more,
            (c_custkey * 17) % 211 as without_internet_subscription,
            case when c_custkey % 19 = 4 then null else (c_custkey * 3) % 97 end as households_no_computer,
            (c_custkey * 29) % 2111 as households_with_subscription,
            case when c_acctbal > 0 then c_acctbal * 10 end as percapita_income_total,
            case when c_acctbal > 0 then cast(cast(round(c_acctbal * 25) as bigint) as string) else '-' end
                as median_household_income
        from {{customer}}""",
    # Zones under a school by key, for operators that need groups but no geometry.
    "b_member": f"""
        select {_school_key('c_nationkey')} as unique_school_id,
            lpad(cast(c_custkey as string), 12, '0') as geoid,
            cast((c_custkey * 37) % 5000 as double) as distance,
            cast(c_custkey % 900 as double) as pop,
            {_part_of('(c_custkey % 900)', 4)} as white,
            case when c_custkey % 23 = 5 then null else {_part_of('(c_custkey % 900)', 2)} end as hispanic,
            case when c_acctbal > 0 then round(c_acctbal / 100) * 100 end as income
        from {{customer}}""",
    # All rows; some schools have other ids in one of the two, so that a merge has rows of one side only.
    "b_course": f"""
        select cast(600 + l_suppkey % 25 as int) as system_id,
            cast(case when l_suppkey % 37 = 11 then l_suppkey + 5000 else l_suppkey end as int) as school_id,
            p_brand as course_number,
            title as course_title,
            cast(l_quantity as bigint) as takers,
            {_part_of('cast(l_quantity as bigint)', 1)} as asian,
            {_part_of('cast(l_quantity as bigint)', 3)} as black,
            case when l_suppkey % 3 = 0 then {_part_of('cast(l_quantity as bigint)', 4)} else null end as white,
            {_part_of('cast(l_quantity as bigint)', 2)} as hispanic,
            {_part_of('cast(l_quantity as bigint)', 6)} as female,
            {_part_of('cast(l_quantity as bigint)', 4)} as male
        from {{lineitem}} join {{part}} on l_partkey = p_partkey join {_titles()} on title_no = {_COURSE_NO}""",
    "b_roster": f"""
        select cast(600 + l_suppkey % 25 as int) as system_id,
            cast(case when l_suppkey % 37 = 12 then l_suppkey + 5000 else l_suppkey end as int) as school_id,
            case when l_orderkey % 41 = 0 then 'X-' || p_brand else p_brand end as course_number,
            title as course_title,
            case when o_custkey % 7 = 0 then 'n/a'
                when o_custkey % 11 = 0 then '.'
                when o_custkey % 13 = 0 then ''
                when l_suppkey % 5 = 0 then cast(l_suppkey * 10 + o_custkey % 3 as string)
                else cast(o_custkey as string) end as certificate_id,
            case when l_suppkey % 7 = 0 then 'GAVS Virtual Teacher'
                when l_suppkey % 7 = 2 then o_orderpriority
                when o_orderkey % 4 = 0 then 'DE: ' || o_orderpriority
                when o_orderkey % 4 = 1 then null
                when o_orderkey % 8 = 2 then 'Short-term Substitute'
                else o_orderpriority end as teacher_last_name
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join {{part}} on l_partkey = p_partkey
            join {_titles()} on title_no = {_COURSE_NO}""",
    # Segments of a path through the zones, ten zones a path (road).
    "b_segment": """
        select cast(floor(a.c_custkey / 10) as bigint) as road, a.c_custkey as step,
            case when floor(a.c_custkey / 10) % 2 = 0 then 'I' else 'S' end as rttyp,
            -85.5e0 + ((a.c_custkey * 6007 + 1237) % 9973) / 9973e0 * 4.5e0 as x1,
            30.5e0 + ((a.c_custkey * 3571 + 4421) % 9967) / 9967e0 * 4.3e0 as y1,
            -85.5e0 + ((b.c_custkey * 6007 + 1237) % 9973) / 9973e0 * 4.5e0 as x2,
            30.5e0 + ((b.c_custkey * 3571 + 4421) % 9967) / 9967e0 * 4.3e0 as y2
        from {customer} a join {customer} b on b.c_custkey = a.c_custkey + 1
        where a.c_custkey % 10 <> 9""",
}

# Views of the checking engine only: longer derivations shared by several checks.
CHECKS: dict[str, str] = {}


class Tables:
    """The driver's tables and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(self.path(name))
        if name in VIEWS:
            used = {n: getattr(self, n) for n in sorted(set(re.findall(r"\{(\w+)\}", VIEWS[name])))}
            return self.spark.sql(VIEWS[name], **used)
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        """Spark SQL over ``{table}`` placeholders."""
        used = {n: getattr(self, n) for n in sorted(set(re.findall(r"\{(\w+)\}", text)))}
        return self.spark.sql(text, **used)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _needed(text: str) -> list[str]:
    """Views used by a text, each after the views it uses itself."""
    found: list[str] = []
    for name in re.findall(r"\b[bo]_\w+\b", text):
        body = VIEWS.get(name) or CHECKS.get(name)
        if body and name not in found:
            for inner in [*_needed(body), name]:
                if inner not in found:
                    found.append(inner)
    return found


def check_sql(text: str) -> str:
    """Complete statement for the checking engine: the views it uses, then the text."""
    text = text.strip()
    views = []
    for name in _needed(text):
        body = VIEWS.get(name) or CHECKS[name]
        views.append(f"{name} as ({re.sub(r'{(\w+)}', r'\1', body).strip()})")
    if not views:
        return text
    if text.startswith(","):  # the text goes on with views of its own
        return f"with {', '.join(views)}{text}"
    return f"with {', '.join(views)} {text}"


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` with the SQL that must give equal rows."""

    def register(f: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} exists already")
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = check_sql(sql)
        return f

    return register
