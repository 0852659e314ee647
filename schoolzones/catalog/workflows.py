"""Whole workflows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K, geo, text
from ..plans import catchment, courses as course_plans, layers, older, schools as school_plans, upkeep
from ..session import fixed, scratch_path
from .base import CHECKS, query
from .classes import _ri_sql, cut_sql, ranges_sql, school_codes, shares
from .grouping import _SIDES, harmonic_sql
from .joining import conic_sql, places, spots
from .rows import _APPROVED
from .shapes import _CENTRES, _MX, _MY, _pieces_sql, stored_polygons, zone_polygons

SCHOOL = "unique_school_id"

# --- Approved schools -------------------------------------------------------------------------

_X, _Y = conic_sql("c.lon", "c.lat")
CHECKS["o_approved"] = f"""
    select lpad(cast(e.system_id as varchar), 4, '0') || lpad(cast(e.school_id as varchar), 4, '0') as unique_school_id,
        e.system_id, e.school_id, e.school_name, e.grade_range, c.school_city, c.lon, c.lat,
        {_X} as school_x, {_Y} as school_y
    from b_enrolment e left join b_contact c on e.system_id = c.district_id and e.school_id = c.school_id
    where e.school_id in (select school_id from o_high_school)
        and e.school_id not in (select school_id from o_alternative)"""


def approved(t):
    return school_plans.approved_schools(t.b_enrolment, t.b_contact)


@query(
    "l1_approved_schools",
    "select unique_school_id, school_name, grade_range, school_city, round(school_x, 3) as school_x, round(school_y, 3) as school_y from o_approved",
)
def _(t):
    return approved(t).select(
        SCHOOL, "school_name", "grade_range", "school_city",
        F.round("school_x", 3).alias("school_x"), F.round("school_y", 3).alias("school_y"),
    )


_LOCALE = "case when locale_code between 11 and 19 then 'City' when locale_code between 21 and 29 then 'Suburb' when locale_code between 31 and 39 then 'Town' when locale_code between 41 and 49 then 'Rural' else 'Unknown' end"
CHECKS["o_approved_located"] = f"""
    select *, (case locale when 'City' then 1 when 'Suburb' then 3 when 'Town' then 7 when 'Rural' then 18 end)::double as buffer_distance
    from (select a.*, l.district_code as locale_code, {_LOCALE.replace('locale_code', 'l.district_code')} as locale
        from o_approved a join o_located l on a.school_id = l.school_id)"""


def approved_located(t):
    empty = t.spark.createDataFrame([], "locale_type string, buffer_distance double")
    buffers = school_plans.buffer_lookup(empty)
    return school_plans.locale_and_buffer(approved(t), t.b_district, buffers)


@query("l2_locale_and_buffer", "select unique_school_id, locale_code, locale, buffer_distance from o_approved_located")
def _(t):
    return approved_located(t).select(SCHOOL, "locale_code", "locale", "buffer_distance")


# --- Zones to schools ---------------------------------------------------------------------------

CHECKS["o_assignment"] = """
    select geoid, unique_school_id, buffer_distance, distance from (
        select *, distance <= buffer_distance * 1609.34 as within,
            row_number() over (partition by geoid order by
                coalesce(distance <= buffer_distance * 1609.34, false) desc, distance, unique_school_id) as place
        from o_pair) where place = 1"""


def assignment(t):
    return catchment.assign_zones(spots(t), places(t))


@query(
    "l3_zone_assignment",
    "select geoid, unique_school_id, buffer_distance, round(distance, 3) as distance from o_assignment",
)
def _(t):
    return assignment(t).select("geoid", SCHOOL, "buffer_distance", F.round("distance", 3).alias("distance"))


@query(
    "l3_refreshed_assignment",
    "select geoid, unique_school_id, buffer_distance, round(distance, 3) as distance from o_assignment",
)
def _(t):
    """An assignment stored when a tenth of the schools were elsewhere, or not there yet, brought up to date."""
    path, now = scratch_path(t.spark, "upkeep"), fixed(places(t))
    turn = F.pmod(F.xxhash64(SCHOOL), F.lit(20))
    earlier = now.filter(turn != 3).withColumn("school_x", F.col("school_x") + F.when(turn == 7, 20_000.0).otherwise(0.0))
    upkeep.build(spots(t), earlier, path, 2)
    upkeep.refresh(now, path)
    return upkeep.assignment(t.spark, path).select(
        "geoid", SCHOOL, "buffer_distance", F.round("distance", 3).alias("distance")
    )


@query(
    "l4_zones_per_school",
    "select s.unique_school_id, count(a.geoid) as assigned_cbg_count from b_school s left join o_assignment a on a.unique_school_id = s.unique_school_id group by 1",
)
def _(t):
    return catchment.zones_per_school(assignment(t), t.b_school)


@query(
    "l4_coverage",
    """
    select (select count(unique_school_id) from o_assignment) as assigned_zones, 0::bigint as zones_assigned_twice,
        (select count(*) from b_zone) as total_zones,
        (select count(*) from b_zone where geoid not in (select geoid from o_assignment where unique_school_id is not null)) as unassigned_zones,
        (select count(*) from b_school where unique_school_id not in (select unique_school_id from o_assignment where unique_school_id is not null)) as schools_without_zone
    """,
)
def _(t):
    return catchment.coverage(assignment(t), t.b_zone, t.b_school)


# --- Courses and representation --------------------------------------------------------------------


@query(
    "l5_course_logic",
    f"""
    select unique_school_id, course_number, course_title,
        case when coalesce(course_title in ({_APPROVED}), false) then 1 else 0 end as approved_flag,
        case when certificate_id is not null then 1 else 0 end as certified_flag,
        case when coalesce(course_title in ({_APPROVED}), false) then '1' else '0' end ||
            case when certificate_id is not null then '1' else '0' end as course_logic,
        certificate_id, teacher_last_name, is_virtual
    from o_course_merge
    """,
)
def _(t):
    return course_plans.course_logic(course_plans.clean_courses(t.b_course), course_plans.clean_roster(t.b_roster))


_CS = ["cs_enrollment", *[f"cs_{g}" for g in K.DEMOGRAPHICS]]
CHECKS["o_certified"] = "select unique_school_id, count(distinct certificate_id) as certified_teachers from o_roster group by 1"
CHECKS["o_representation"] = f"""
    select s.unique_school_id, {', '.join(f'coalesce(h.{c}, 0) as {c}' for c in _CS)},
        case when h.unique_school_id is null then 0 else t.certified_teachers end as certified_teachers,
        {', '.join(f'{_ri_sql(g)} as ri_{g}' for g in K.RI_GROUPS)},
        coalesce(l.logic_class, '000') as logic_class, coalesce(l.logic_class_2, '000') as logic_class_2
    from b_school s left join o_shares h on s.unique_school_id = h.unique_school_id
    left join o_certified t on s.unique_school_id = t.unique_school_id
    left join o_logic l on s.unique_school_id = l.unique_school_id"""


def representation(t):
    return course_plans.school_representation(t.b_school, t.b_enrolment, t.b_course, t.b_roster)


_RI_ROUNDED = ", ".join(f"round(ri_{g}, 6) as ri_{g}" for g in K.RI_GROUPS)


@query(
    "l6_school_representation",
    f"select unique_school_id, {', '.join(_CS)}, certified_teachers, {_RI_ROUNDED}, logic_class, logic_class_2 from o_representation",
)
def _(t):
    return representation(t).withColumns({f"ri_{g}": F.round(f"ri_{g}", 6) for g in K.RI_GROUPS})


def _by_locale_sql(group: str) -> str:
    return f"""
        select case when grouping(locale) = 1 then 'Total' else locale end as locale, '{group}' as race,
            {_SIDES.replace('ri ', f'ri_{group} ')}
        from (select r.*, {_LOCALE} as locale from o_representation r join b_school s on r.unique_school_id = s.unique_school_id)
        group by rollup(locale)"""


@query("l7_representation_by_locale", " union all ".join(_by_locale_sql(g) for g in ("asian", "black", "hispanic", "white")))
def _(t):
    return course_plans.representation_by_locale(representation(t), places(t), ("asian", "black", "hispanic", "white"))


# --- Catchment metrics ----------------------------------------------------------------------------------

_GROUPS = list(K.POPULATION_GROUPS.values())
CHECKS["o_metrics"] = f"""
    select a.unique_school_id, {', '.join(
        f'coalesce(sum({c}), 0) / nullif(sum(total_population), 0) * 100 as weighted_avg_{c}' for c in K.SHARE_METRICS)},
        sum(total_population * percapita_income_total) / nullif(sum(total_population) filter (where percapita_income_total is not null), 0)
            as total_pop_weighted_avg_income,
        {', '.join(f'{harmonic_sql(g)} as {g}_population_avg_distance' for g in _GROUPS)}
    from o_assignment a join b_census c on a.geoid = lpad(c.geoid, 12, '0') group by 1"""
_METRICS = [
    *[f"weighted_avg_{c}" for c in K.SHARE_METRICS],
    "total_pop_weighted_avg_income",
    *[f"{g}_population_avg_distance" for g in _GROUPS],
]


def census(t):
    return t.b_census.withColumn("geoid", text.zfill("geoid", 12))


def metrics(t):
    return catchment.catchment_metrics(assignment(t), census(t))


@query(
    "l8_catchment_metrics",
    "select s.unique_school_id, " + ", ".join(f"round({m}, 4) as {m}" for m in _METRICS)
    + " from b_school s left join o_metrics m on s.unique_school_id = m.unique_school_id",
)
def _(t):
    joined = t.b_school.select(SCHOOL).join(metrics(t), SCHOOL, "left")
    return joined.select(SCHOOL, *[F.round(m, 4).alias(m) for m in _METRICS])


# --- Distributions ----------------------------------------------------------------------------------------


def _distribution_sql() -> str:
    parts = []
    for metric, source in K.DISTRIBUTION_METRICS.items():
        for race in K.RACES:
            column = source[race] if isinstance(source, dict) else source
            ri = f"ri_{race.lower()}"
            parts.append(
                f"select '{metric}' as metric, '{race}' as race, locale, unique_school_id, {ri} as ri, {column} as value "
                f"from o_school_metrics where {ri} is not null and {column} is not null"
            )
    return " union all ".join(parts)


CHECKS["o_school_metrics"] = f"""
    select r.*, {_LOCALE} as locale, {', '.join('m.' + m for m in _METRICS)} from o_representation r
    join b_school s on r.unique_school_id = s.unique_school_id
    left join o_metrics m on r.unique_school_id = m.unique_school_id"""
CHECKS["o_distribution"] = f"""
    select *, case when ri > 0.05 then 'Overrepresented' when ri < -0.05 then 'Underrepresented' else 'Parity' end as representation
    from ({_distribution_sql()})"""


def school_metrics(t):
    schools = places(t).select(SCHOOL, "locale")
    return catchment.school_metrics(schools, representation(t), metrics(t))


@query(
    "l9_distribution_rows",
    "select metric, race, locale, unique_school_id, round(ri, 6) as ri, round(value, 4) as value, representation from o_distribution",
)
def _(t):
    rows = layers.representation_rows(school_metrics(t))
    return rows.withColumns({"ri": F.round("ri", 6), "value": F.round("value", 4)})


CHECKS["o_counted"] = " union all ".join(
    f"select '{race}' as race, locale, ri_{race.lower()} as ri from o_school_metrics "
    f"where ri_{race.lower()} is not null and locale is not null"
    for race in K.RACES
)


@query("l9_counts_by_race", f"select race, {_SIDES} from o_counted group by 1")
def _(t):
    return layers.counts_by_race(school_metrics(t))


@query("l9_counts_by_locale", f"select locale, {_SIDES} from o_counted group by 1")
def _(t):
    return layers.counts_by_locale(school_metrics(t))


_QUARTILES = ", ".join(f"round(quantile_cont(value, {q}), 4) as q{i + 1}" for i, q in enumerate((0.25, 0.5, 0.75)))


def _rounded_quartiles(df):
    return df.withColumns({f"q{i}": F.round(f"q{i}", 4) for i in (1, 2, 3)})


@query(
    "l9_quartiles_by_race",
    f"select metric, race, representation, {_QUARTILES} from o_distribution where representation <> 'Parity' group by 1, 2, 3",
)
def _(t):
    return _rounded_quartiles(layers.distribution_quartiles(layers.representation_rows(school_metrics(t)), "race"))


@query(
    "l9_quartiles_by_locale",
    f"select metric, locale, representation, {_QUARTILES} from o_distribution where representation <> 'Parity' group by 1, 2, 3",
)
def _(t):
    return _rounded_quartiles(layers.distribution_quartiles(layers.representation_rows(school_metrics(t)), "locale"))


def _density_sql(by: str) -> str:
    return f"""
        , side as (select metric, {by}, representation, value from o_distribution where representation <> 'Parity'),
        stats as (select metric, {by}, representation, min(value) as lo, max(value) as hi, stddev_samp(value) * 0.2 as h from side group by 1, 2, 3),
        grid as (select *, case when lo = hi then lo else lo + (hi - lo) * grid_no / 99 end as grid_x
            from stats, range(0, 100) r(grid_no) where lo < hi or grid_no = 0),
        curve as (
            select g.metric, g.{by}, g.representation, grid_no, grid_x,
                sum(case when lo = hi then 1 else exp(-0.5 * ((grid_x - value) / h) * ((grid_x - value) / h)) end) as d
            from grid g join side s on g.metric = s.metric and g.{by} = s.{by} and g.representation = s.representation
            group by 1, 2, 3, 4, 5)
        select metric, {by}, representation, grid_no::int as grid_no, round(grid_x, 3) as grid_x,
            round(d / max(d) over (partition by metric, {by}, representation), 5) as density
        from curve"""


def _rounded_density(df):
    return df.withColumns({"grid_x": F.round("grid_x", 3), "density": F.round("density", 5)})


@query("l9_density_by_race", _density_sql("race"))
def _(t):
    return _rounded_density(layers.distribution_density(layers.representation_rows(school_metrics(t)), "race"))


@query("l9_density_by_locale", _density_sql("locale"))
def _(t):
    return _rounded_density(layers.distribution_density(layers.representation_rows(school_metrics(t)), "locale"))


# --- The whole chain ----------------------------------------------------------------------------------------
# Polygons, approved schools and raw rosters to quartiles: every step takes what the one before it made.

_CENTRE = {
    c: "case kind " + " ".join(f"when '{k}' then {at[i]!r}::double" for k, at in _CENTRES.items()) + " end"
    for i, c in enumerate(("lon", "lat"))
}
_CX, _CY = conic_sql(f"(lon + h * {_CENTRE['lon']})", f"(lat + h * {_CENTRE['lat']})")
CHECKS["o_chain_spot"] = f"select geoid, {_CX} as x, {_CY} as y from o_shape"
CHECKS["o_chain_pair"] = """
    select geoid, unique_school_id, buffer_distance,
        sqrt((x - school_x) * (x - school_x) + (y - school_y) * (y - school_y)) as distance
    from o_chain_spot cross join o_approved_located where school_x is not null"""
CHECKS["o_chain_assignment"] = CHECKS["o_assignment"].replace("o_pair", "o_chain_pair")
CHECKS["o_chain_metrics"] = CHECKS["o_metrics"].replace("o_assignment", "o_chain_assignment")
CHECKS["o_chain_school_metrics"] = f"""
    select r.*, s.locale, {', '.join('m.' + m for m in _METRICS)} from o_approved_located s
    join o_representation r on r.unique_school_id = s.unique_school_id
    left join o_chain_metrics m on s.unique_school_id = m.unique_school_id"""
CHECKS["o_chain_distribution"] = CHECKS["o_distribution"].replace("o_school_metrics", "o_chain_school_metrics")


@query(
    "l9_quartiles_of_the_whole_chain",
    f"select metric, race, representation, {_QUARTILES} from o_chain_distribution where representation <> 'Parity' group by 1, 2, 3",
)
def _(t):
    x, y = geo.conic_xy("lon", "lat")
    centres = catchment.zone_centroids(zone_polygons(t)).withColumnsRenamed({"x": "lon", "y": "lat"})
    schools = fixed(approved_located(t))
    chosen = catchment.assign_zones(centres.select("geoid", x.alias("x"), y.alias("y")), schools)
    index = course_plans.school_representation(schools, t.b_enrolment, t.b_course, t.b_roster)
    of_schools = catchment.school_metrics(
        schools.select(SCHOOL, "locale"), index, catchment.catchment_metrics(chosen, census(t))
    )
    return _rounded_quartiles(layers.distribution_quartiles(layers.representation_rows(of_schools), "race"))


# --- Map layers -------------------------------------------------------------------------------------------

_MODALITY = "case substr({c}, 1, 2) when '11' then 'Both' when '10' then 'In Person' when '01' then 'Virtual' else 'No' end"
CHECKS["o_school_code"] = f"""
    select s.unique_school_id, lon, lat, {_LOCALE} as locale, r.* exclude (unique_school_id)
    from b_school s join o_representation r on s.unique_school_id = r.unique_school_id where lon is not null and lat is not null"""
_LABELS = {name: label for _, name, label, _ in K.MODALITIES} | {K.NO_MODALITY[0]: K.NO_MODALITY[1]}
_COLOURS = {name: colour for _, name, _, colour in K.MODALITIES} | {K.NO_MODALITY[0]: K.NO_MODALITY[2]}


def _map_sql(column: str, mapping: dict[str, str]) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items()) + " end"


def _modality_sql(code: str) -> str:
    return f"""
        select unique_school_id, {code}, modality, {_map_sql('modality', _LABELS)} as label, {_map_sql('modality', _COLOURS)} as colour,
            round({_MX}, 3) as x_3857, round({_MY}, 3) as y_3857
        from (select *, {_MODALITY.format(c=code)} as modality from o_school_code)"""


def _flat(df):
    return df.drop("lon", "lat").withColumns({"x_3857": F.round("x_3857", 3), "y_3857": F.round("y_3857", 3)})


def coded_schools(t):
    """Logic codes of all schools, without the index."""
    codes = t.b_school.select(SCHOOL).join(school_codes(t), SCHOOL, "left")
    return codes.fillna("000", subset=["logic_class", "logic_class_2"])


@query("l10_modality_layer", _modality_sql("logic_class"))
def _(t):
    return _flat(layers.modality_layer(places(t), coded_schools(t)))


@query("l10_expanded_modality_layer", _modality_sql("logic_class_2"))
def _(t):
    return _flat(layers.modality_layer(places(t), coded_schools(t), "logic_class_2"))


def _marker_sql(prefixes) -> str:
    shown = [m for m in K.MARKERS if prefixes is None or m[0] in prefixes]
    marker = "case logic_class " + " ".join(f"when '{p}{s}' then '{m}'" for p, s, m, *_ in shown) + " else 'Other' end"
    return f"""
        select unique_school_id, logic_class, marker, {_map_sql('marker', {m[2]: m[3] for m in K.MARKERS})} as label,
            {_map_sql('marker', {m[2]: m[5] for m in K.MARKERS})} as colour, round({_MX}, 3) as x_3857, round({_MY}, 3) as y_3857
        from (select *, {marker} as marker from o_school_code)"""


@query("l10_in_person_markers", _marker_sql(["11", "10"]))
def _(t):
    return _flat(layers.marker_layer(places(t), coded_schools(t), ["11", "10"]))


@query("l10_other_markers", _marker_sql(["01", "00"]))
def _(t):
    return _flat(layers.marker_layer(places(t), coded_schools(t), ["01", "00"]))


@query("l10_all_markers", _marker_sql(None))
def _(t):
    return _flat(layers.marker_layer(places(t), coded_schools(t)))


_NAMES = ", ".join(f"('{n}')" for n in _LABELS)


@query(
    "l10_modality_legend",
    f"select m.modality, count(c.unique_school_id) as schools from (values {_NAMES}) m(modality) left join (select *, {_MODALITY.format(c='logic_class')} as k from o_school_code) c on c.k = m.modality group by 1",
)
def _(t):
    return layers.modality_legend(layers.modality_layer(places(t), coded_schools(t)))


@query(
    "l10_expanded_modality_legend",
    f"select m.modality, count(c.unique_school_id) as schools from (values {_NAMES}) m(modality) left join (select *, {_MODALITY.format(c='logic_class_2')} as k from o_school_code) c on c.k = m.modality group by 1",
)
def _(t):
    return layers.modality_legend(layers.modality_layer(places(t), coded_schools(t), "logic_class_2"))


def _register_marker_legend(name: str, prefixes: list[str]) -> None:
    shown = ", ".join(f"('{p}{s}', '{m}')" for p, s, m, *_ in K.MARKERS if p in prefixes)

    @query(
        name,
        f"select m.marker, count(c.unique_school_id) as schools from (values {shown}) m(code, marker) "
        "left join o_school_code c on c.logic_class = m.code group by 1",
    )
    def _(t):
        return layers.marker_legend(layers.marker_layer(places(t), coded_schools(t), prefixes), prefixes)


_register_marker_legend("l10_in_person_marker_legend", ["11", "10"])
_register_marker_legend("l10_other_marker_legend", ["01", "00"])


@query(
    "l10_marker_legend",
    "select m.marker, count(c.unique_school_id) as schools from (values "
    + ", ".join(f"('{p}{s}', '{m}')" for p, s, m, *_ in K.MARKERS)
    + ") m(code, marker) left join o_school_code c on c.logic_class = m.code group by 1",
)
def _(t):
    return layers.marker_legend(layers.marker_layer(places(t), coded_schools(t)))


def indices(t):
    """Representation index of each school, without the logic codes."""
    ri = course_plans.with_representation_index(shares(t))
    return ri.select(SCHOOL, *[f"ri_{g}" for g in K.RI_GROUPS])


def _disparity_sql(group: str, ranges, otherwise=None, box: bool = False) -> str:
    near = "and lon between -85.5 and -82.8 and lat between 32.8 and 34.5" if box else ""
    return f"""
        select * from (
            select unique_school_id, '{group}' as race, round(ri_{group}, 6) as ri, {ranges_sql(f'ri_{group}', ranges, otherwise)} as colour,
                round({_MX}, 3) as x_3857, round({_MY}, 3) as y_3857
            from (select s.unique_school_id, lon, lat, {_ri_sql(group)} as ri_{group}
                from b_school s join o_shares h on s.unique_school_id = h.unique_school_id where lon is not null {near}))
        where colour is not null"""


def _disparity(t, group, box=None):
    layer = layers.disparity_layer(places(t), indices(t), group, box)
    return _flat(layer).withColumns({"race": F.lit(group), "ri": F.round("ri", 6)})


def _register_disparity(group: str) -> None:
    @query(f"l11_{group}_layer", _disparity_sql(group, *layers.DISPARITY_LAYERS[group]))
    def _(t):
        return _disparity(t, group)


for _group in layers.DISPARITY_LAYERS:
    _register_disparity(_group)


@query("l11_regional_black_layer", _disparity_sql("black", *layers.REGIONAL_BLACK, box=True))
def _(t):
    return _disparity(t, "black", K.REGION_BOX)


@query(
    "l11_disparity_legend",
    "select m.colour, count(c.unique_school_id) as schools from (values "
    + ", ".join(f"('{c}')" for c in K.SEVEN_COLOURS)
    + f") m(colour) left join ({_disparity_sql('female', *layers.DISPARITY_LAYERS['female'])}) c on c.colour = m.colour group by 1",
)
def _(t):
    return layers.disparity_legend(layers.disparity_layer(places(t), indices(t), "female"), "female")


def _register_disparity_legend(name: str, group: str, colours: list[str], layer_sql: str, box=None) -> None:
    @query(
        name,
        f"select m.colour, count(c.unique_school_id) as schools from (values {', '.join(f"('{c}')" for c in dict.fromkeys(colours))}) "
        f"m(colour) left join ({layer_sql}) c on c.colour = m.colour group by 1",
    )
    def _(t):
        layer = layers.disparity_layer(places(t), indices(t), group, box)
        return layers.disparity_legend(layer, group, box)


for _group, (_ranges, _otherwise) in layers.DISPARITY_LAYERS.items():
    if _group != "female":  # above
        _register_disparity_legend(
            f"l11_{_group}_legend",
            _group,
            [c for *_, c in _ranges] + ([_otherwise] if _otherwise else []),
            _disparity_sql(_group, _ranges, _otherwise),
        )
_register_disparity_legend(
    "l11_regional_black_legend",
    "black",
    [c for *_, c in layers.REGIONAL_BLACK[0]],
    _disparity_sql("black", *layers.REGIONAL_BLACK, box=True),
    K.REGION_BOX,
)


def _quintile_sql(group: str) -> str:
    return f"""
        , shares as (select lpad(geoid, 12, '0') as geoid, {group} / nullif(total_population, 0) as ratio from b_census),
        edges as (select min(ratio) as lo, [{', '.join(f'quantile_cont(ratio, {q})' for q in (0.2, 0.4, 0.6, 0.8))}] as inner_edges from shares)
        select geoid, round(ratio, 6) as ratio, case when ratio is not null then
            len(list_filter(list_distinct(inner_edges), lambda e: e < ratio and e > lo)) end as ratio_class
        from shares, edges"""


def _register_quintiles(race: str, group: str) -> None:
    @query(f"l12_{race.lower()}_quintiles", _quintile_sql(group))
    def _(t):
        bins = layers.quintile_underlay(t.b_zone.select("geoid"), t.b_census, group)
        return bins.withColumns(
            {"ratio": F.round("ratio", 6), "ratio_class": F.col("ratio_class").cast("long")}
        )


for _race, _column in K.POPULATION_GROUPS.items():
    _register_quintiles(_race, _column)


def _regional_sql(metric: str) -> str:
    (edges, lowest), is_share = layers.REGIONAL_LAYERS[metric]
    value = f"{metric} / nullif(total_population, 0)" if is_share else f"try_cast({metric} as double)"
    return f"""
        select o.geoid, round(value, 6) as value, {cut_sql('value', edges, lowest)} as value_class
        from (select * from o_shape where {_pieces_sql()}) o
        left join (select lpad(geoid, 12, '0') as geoid, {value} as value from b_census) c on o.geoid = c.geoid"""


def _register_regional(name: str, metric: str) -> None:
    @query(f"l13_{name}_underlay", _regional_sql(metric))
    def _(t):
        zones = layers.regional_underlay(stored_polygons(t), t.b_census, metric)
        return zones.select("geoid", F.round("value", 6).alias("value"), "value_class")


for _name, _metric in zip(("ratio", "income", "education", "internet"), layers.REGIONAL_LAYERS):
    _register_regional(_name, _metric)


# --- Income statistics -------------------------------------------------------------------------------------------

CHECKS["o_income"] = """
    select a.unique_school_id, a.geoid, total_population::double as pop, try_cast(median_household_income as double) as income
    from o_assignment a join b_census c on a.geoid = lpad(c.geoid, 12, '0')
    where try_cast(median_household_income as double) is not null"""
CHECKS["o_income_running"] = """
    select *, sum(pop) over (partition by unique_school_id order by income, geoid
            rows between unbounded preceding and current row) as upto,
        sum(pop) over (partition by unique_school_id) as everyone
    from o_income"""
CHECKS["o_income_median"] = """
    select unique_school_id, lo + (half - lo_at) / (hi_at - lo_at) * (hi - lo) as weighted_median_income from (
        select unique_school_id, max(everyone) / 2 as half,
            arg_max(income, (upto, income, geoid)) filter (where upto <= everyone / 2) as lo,
            max(upto) filter (where upto <= everyone / 2) as lo_at,
            arg_min(income, (upto, income, geoid)) filter (where upto > everyone / 2) as hi,
            min(upto) filter (where upto > everyone / 2) as hi_at
        from o_income_running group by 1)"""
CHECKS["o_income_mean"] = "select unique_school_id, sum(pop * income) / nullif(sum(pop), 0) as avg_median_income from o_income group by 1"
CHECKS["o_income_spread"] = """
    select i.unique_school_id, sqrt(sum(pop * (income - avg_median_income) * (income - avg_median_income)) / nullif(sum(pop), 0)) as stddev_median_income
    from o_income i join o_income_mean m on i.unique_school_id = m.unique_school_id group by 1"""


@query(
    "l14_income_statistics",
    """
    select s.unique_school_id, round(weighted_median_income, 4) as weighted_median_income,
        round(avg_median_income, 4) as avg_median_income, round(stddev_median_income, 4) as stddev_median_income
    from b_school s left join o_income_median a on s.unique_school_id = a.unique_school_id
    left join o_income_mean b on s.unique_school_id = b.unique_school_id
    left join o_income_spread c on s.unique_school_id = c.unique_school_id
    """,
)
def _(t):
    columns = ["weighted_median_income", "avg_median_income", "stddev_median_income"]
    income = census(t).withColumnRenamed("median_household_income", "median_income")
    stats = catchment.income_statistics(assignment(t), income)
    stored = t.b_school.select(SCHOOL, *[F.lit(None).cast("double").alias(c) for c in columns])
    return catchment.write_back(stored, stats).select(SCHOOL, *[F.round(c, 4).alias(c) for c in columns])


# --- Older report --------------------------------------------------------------------------------------------------

_OLDER = ", ".join(f"'{x}'" for x in K.OLDER_APPROVED_TITLES)


@query(
    "l15_school_report",
    f"""
    , course_rows as (
        select school_id, teacher_last_name, case when certificate_id not in ('n/a', '.', '') then certificate_id end as certificate_id,
            case when lower(course_title) = 'web development' then 'Web Development' when lower(course_title) = 'introduction to python'
                then 'Introduction to Python' else course_title end as course_title
        from b_roster),
    extra as (
        select school_id, certificate_id, case when certificate_id is not null and bool_or(course_title in ({_OLDER})) then 0 else 1 end as extra
        from course_rows group by 1, 2)
    select e.school_id as unique_school_id, m.classification, max(extra) as extra_teacher_count,
        case when max(extra) = 1 then 'Yes' else 'No' end as has_extra_teacher
    from extra e join o_mode m on e.school_id = m.school_id group by 1, 2
    """,
)
def _(t):
    rows = t.b_roster.select(
        F.col("school_id").alias(SCHOOL),
        "teacher_last_name",
        text.null_if_in("certificate_id").alias("certificate_id"),
        F.when(F.lower("course_title") == "web development", "Web Development")
        .when(F.lower("course_title") == "introduction to python", "Introduction to Python")
        .otherwise(F.col("course_title"))
        .alias("course_title"),
    )
    return older.school_report(rows)
