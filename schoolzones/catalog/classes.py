"""Classes, bins and index formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, constants as K, text
from ..plans import courses as course_plans, layers, older
from .base import CHECKS, query
from .joining import _APPROVED

_LOCALE = "case when locale_code between 11 and 19 then 'City' when locale_code between 21 and 29 then 'Suburb' when locale_code between 31 and 39 then 'Town' when locale_code between 41 and 49 then 'Rural' else 'Unknown' end"


@query("c1_locale_class", f"select unique_school_id, locale_code, {_LOCALE} as locale from b_school")
def _(t):
    return t.b_school.select("unique_school_id", "locale_code", classify.locale_class("locale_code").alias("locale"))


# Course takers and enrolment of a school in one row.
CHECKS["o_shares"] = f"""
    select e.unique_school_id, {', '.join(f'coalesce(c.{c}, 0) as {c}' for c in ['cs_enrollment', *[f'cs_{g}' for g in K.DEMOGRAPHICS]])},
        e.total_enrollment, {', '.join(f'e.total_{g}' for g in K.DEMOGRAPHICS)}
    from o_enrolled e left join o_cs c on e.unique_school_id = c.unique_school_id"""
CHECKS["o_enrolled"] = f"""
    select lpad(cast(system_id as varchar), 4, '0') || case when school_id < 1000 then lpad(cast(school_id as varchar), 4, '0') else cast(school_id as varchar) end as unique_school_id,
        try_cast(total_enrollment as double) as total_enrollment, {', '.join(
            f'coalesce(try_cast({g} as double), 0) as total_{g}' for g in K.DEMOGRAPHICS)}
    from b_enrolment where try_cast(total_enrollment as double) > 0"""


def shares(t):
    cs = ["cs_enrollment", *[f"cs_{g}" for g in K.DEMOGRAPHICS]]
    totals = course_plans.enrolment_totals(t.b_enrolment).filter(F.col("total_enrollment") > 0)
    return totals.join(course_plans.cs_totals(course_plans.clean_courses(t.b_course)), "unique_school_id", "left").fillna(0, subset=cs)


def _ri_sql(g: str) -> str:
    return f"case when cs_enrollment = 0 then 0 else cs_{g} / cs_enrollment - total_{g} / total_enrollment end"


@query(
    "c2_representation_index",
    "select unique_school_id, " + ", ".join(f"round({_ri_sql(g)}, 6) as ri_{g}" for g in K.RI_GROUPS) + " from o_shares",
)
def _(t):
    ri = course_plans.with_representation_index(shares(t))
    return ri.select("unique_school_id", *[F.round(f"ri_{g}", 6).alias(f"ri_{g}") for g in K.RI_GROUPS])


@query(
    "c3_disproportion_index",
    "select unique_school_id, " + ", ".join(
        f"round_even(cs_{g.lower()} / nullif(cs_enrollment, 0) - total_{g.lower()} / nullif(total_enrollment, 0), 3) as di_{g.lower()}"
        for g in K.RACES
    ) + " from o_shares",
)
def _(t):
    return older.disproportion_index(shares(t)).select("unique_school_id", *[f"di_{g.lower()}" for g in K.RACES])


_CATEGORY = "case when {ri} is null then 'Missing' when {ri} > 0.05 then 'Overrepresented' when {ri} < -0.05 then 'Underrepresented' else 'Parity' end"


@query(
    "c4_ri_category",
    " union all ".join(
        f"select school as unique_school_id, '{race}' as race, {_CATEGORY.format(ri='ri_' + race.lower())} as category from o_indexed"
        for race in K.RACES
    ),
)
def _(t):
    from .grouping import indexed_schools

    categories = [
        F.struct(F.lit(race).alias("race"), classify.ri_category(f"ri_{race.lower()}").alias("category"))
        for race in K.RACES
    ]
    return indexed_schools(t).select("unique_school_id", F.inline(F.array(*categories)))


def _logic_sql(titles: str) -> str:
    return f"case when coalesce(course_title in ({titles}), false) then '1' else '0' end || case when certificate_id is not null then '1' else '0' end"


_EXPANDED = ", ".join(f"'{x}'" for x in K.EXPANDED_TITLES)


@query("c5_course_logic", f"select {_logic_sql(_APPROVED)} as course_logic, course_title, count(*) as n from o_course_merge group by 1, 2")
def _(t):
    rows = course_plans.course_logic(course_plans.clean_courses(t.b_course), course_plans.clean_roster(t.b_roster))
    return rows.groupBy("course_logic", "course_title").agg(F.count(F.lit(1)).alias("n"))


@query("c6_expanded_course_logic", f"select {_logic_sql(_EXPANDED)} as course_logic, course_title, count(*) as n from o_course_merge group by 1, 2")
def _(t):
    rows = course_plans.course_logic(
        course_plans.clean_courses(t.b_course), course_plans.clean_roster(t.b_roster), K.EXPANDED_TITLES
    )
    return rows.groupBy("course_logic", "course_title").agg(F.count(F.lit(1)).alias("n"))


def _school_logic_sql(titles: str) -> str:
    return f"""case when bool_or(course_title in ({titles}) and not is_virtual) then '1' else '0' end ||
        case when bool_or(course_title in ({titles}) and is_virtual) then '1' else '0' end ||
        case when bool_or(certificate_id is not null and not valid) then '1' else '0' end"""


def _logic_rows_sql(titles: str) -> str:
    return f"""
        select m.*, bool_or(course_title in ({titles})) over (partition by unique_school_id, certificate_id) as valid
        from o_course_merge m"""


CHECKS["o_logic"] = f"""
    select a.unique_school_id, a.logic_class, b.logic_class_2 from
        (select unique_school_id, {_school_logic_sql(_APPROVED)} as logic_class from ({_logic_rows_sql(_APPROVED)}) group by 1) a
        join (select unique_school_id, {_school_logic_sql(_EXPANDED)} as logic_class_2 from ({_logic_rows_sql(_EXPANDED)}) group by 1) b
        on a.unique_school_id = b.unique_school_id"""


def school_codes(t):
    """Codes need the roster only; a school that has courses but no roster has none of the three marks."""
    titles = {"logic_class": K.APPROVED_TITLES, "logic_class_2": K.EXPANDED_TITLES}
    codes = course_plans.school_logic(course_plans.clean_roster(t.b_roster), titles)
    others = course_plans.clean_courses(t.b_course).select("unique_school_id").distinct()
    return others.join(codes, "unique_school_id", "full").fillna("000", subset=list(titles))


@query("c7_school_logic", "select * from o_logic")
def _(t):
    return school_codes(t)


# Codes straight from the customers, so that every modality occurs.
CHECKS["o_code"] = """
    select c_custkey, cast(floor(c_custkey / 4) % 2 as int)::varchar || cast(floor(c_custkey / 2) % 2 as int)::varchar || (c_custkey % 2)::varchar as code
    from customer"""


def codes(t):
    digits = [F.floor(F.col("c_custkey") / d) % 2 for d in (4, 2, 1)]
    return t.customer.select("c_custkey", text.flags_to_code(*digits).alias("code"))


@query(
    "c8_modality_class",
    "select c_custkey, case substr(code, 1, 2) when '11' then 'Both' when '10' then 'In Person' when '01' then 'Virtual' else 'No' end as modality from o_code",
)
def _(t):
    return codes(t).select("c_custkey", classify.modality_class("code").alias("modality"))


_MARKER = "case code when '111' then 'Purple Triangle' when '110' then 'Purple Circle' when '101' then 'Pink Triangle' when '100' then 'Pink Circle' {rest} else 'Other' end"
_MARKER_REST = "when '011' then 'Yellow Triangle' when '010' then 'Yellow Circle' when '001' then 'Gray Triangle' when '000' then 'Gray Circle'"


@query(
    "c9_modality_marker",
    f"select c_custkey, {_MARKER.format(rest=_MARKER_REST)} as marker, {_MARKER.format(rest='')} as in_person_marker from o_code",
)
def _(t):
    return codes(t).select(
        "c_custkey",
        classify.modality_marker("code").alias("marker"),
        classify.modality_marker("code", ["11", "10"]).alias("in_person_marker"),
    )


# An index from -0.9 to 1.0 in steps that also hit bin limits and the gaps between bins.
CHECKS["o_index"] = "select l_orderkey, l_linenumber, l_partkey, case when l_partkey % 31 = 0 then null else round((l_partkey * 7919 % 19001) / 10000 - 0.9, 6) end as ri from lineitem"
_INDEX = "select l_orderkey, l_linenumber, l_partkey, case when l_partkey % 31 <> 0 then round((l_partkey * 7919 % 19001) / 10000e0 - 0.9e0, 6) end as ri from {lineitem}"


def ranges_sql(value: str, ranges, otherwise=None) -> str:
    tests = []
    for low, high, label in ranges:
        parts = [f"{value} >= {low}" if low is not None else "", f"{value} <= {high}" if high is not None else ""]
        tests.append(f"when {' and '.join(p for p in parts if p)} then '{label}'")
    return f"case {' '.join(tests)} else {repr(otherwise) if otherwise else 'null'} end"


@query(
    "c10_gapped_ranges",
    f"select l_orderkey, l_linenumber, {ranges_sql('ri', K.RI_FEMALE_RANGES)} as female, "
    f"{ranges_sql('ri', K.RI_HISPANIC_RANGES)} as hispanic, {ranges_sql('ri', K.RI_BLACK_RANGES)} as black from o_index",
)
def _(t):
    return t.sql(_INDEX).select(
        "l_orderkey", "l_linenumber",
        classify.range_bins("ri", K.RI_FEMALE_RANGES).alias("female"),
        classify.range_bins("ri", K.RI_HISPANIC_RANGES).alias("hispanic"),
        classify.range_bins("ri", K.RI_BLACK_RANGES).alias("black"),
    )


@query(
    "c11_touching_ranges",
    f"select l_orderkey, l_linenumber, {ranges_sql('ri', layers.DISPARITY_LAYERS['white'][0])} as white, "
    f"{ranges_sql('ri', layers.REGIONAL_BLACK[0])} as black from o_index",
)
def _(t):
    return t.sql(_INDEX).select(
        "l_orderkey", "l_linenumber",
        classify.range_bins("ri", layers.DISPARITY_LAYERS["white"][0]).alias("white"),
        classify.range_bins("ri", layers.REGIONAL_BLACK[0]).alias("black"),
    )


@query(
    "c12_open_ranges",
    f"select l_orderkey, l_linenumber, {ranges_sql('ri', K.RI_ASIAN_RANGES, K.RI_ASIAN_OTHERWISE)} as asian from o_index",
)
def _(t):
    return t.sql(_INDEX).select(
        "l_orderkey", "l_linenumber", classify.range_bins("ri", K.RI_ASIAN_RANGES, K.RI_ASIAN_OTHERWISE).alias("asian")
    )


def cut_sql(value: str, edges, lowest: bool) -> str:
    tests = [f"when {value} {'<' if lowest else '<='} {edges[0]} then null"]
    tests += [f"when {value} <= {e} then {i}" for i, e in enumerate(edges[1:])]
    return f"case {' '.join(tests)} end"


@query(
    "c13_cut_bins",
    f"select geoid, {cut_sql('black_alone_non_hispanic / nullif(total_population, 0)', *K.BLACK_RATIO_BINS)} as ratio_class, "
    f"{cut_sql('try_cast(median_household_income as double)', *K.INCOME_BINS)} as income_class, "
    f"{cut_sql('edu_hs_or_more', *K.EDUCATION_BINS)} as edu_class, "
    f"{cut_sql('households_with_subscription', *K.INTERNET_BINS)} as internet_class from b_census",
)
def _(t):
    ratio = classify.population_ratio("black_alone_non_hispanic", "total_population")
    return t.b_census.select(
        "geoid",
        classify.cut_bins(ratio, *K.BLACK_RATIO_BINS).alias("ratio_class"),
        classify.cut_bins(text.to_number("median_household_income"), *K.INCOME_BINS).alias("income_class"),
        classify.cut_bins("edu_hs_or_more", *K.EDUCATION_BINS).alias("edu_class"),
        classify.cut_bins("households_with_subscription", *K.INTERNET_BINS).alias("internet_class"),
    )


@query(
    "c14_population_ratio",
    "select geoid, round(hispanic_or_latino / nullif(total_population, 0), 6) as ratio from b_census",
)
def _(t):
    return t.b_census.select(
        "geoid", F.round(classify.population_ratio("hispanic_or_latino", "total_population"), 6).alias("ratio")
    )


@query(
    "c15_valid_course",
    f"select course_title, coalesce(lower(course_title) in ({_APPROVED}), false) as valid_course, count(*) as n from b_course group by 1, 2",
)
def _(t):
    valid = F.coalesce(F.lower("course_title").isin(*K.APPROVED_TITLES), F.lit(False))
    return t.b_course.groupBy("course_title", valid.alias("valid_course")).agg(F.count(F.lit(1)).alias("n"))


@query("c16_miles_to_metres", "select unique_school_id, buffer_distance * 1609.34 as metres from o_place")
def _(t):
    from .joining import places

    return places(t).select("unique_school_id", classify.miles_to_metres("buffer_distance").alias("metres"))
