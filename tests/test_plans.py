import math

import pandas as pd
import pytest

from schoolzones.functions import constants as K
from schoolzones.plans import catchment, courses, layers, older, schools
from schoolzones.sources import edge

ENROLMENT = "SYSTEM_ID int, SCHOOL_ID int, SYSTEM_NAME string, SCHOOL_NAME string, GRADE_RANGE string, `Total Student Count` string, `Race: Asian` string, `Race: Black` string, `Race: White` string, `Ethnicity: Hispanic` string, Female string, Male string"


@pytest.fixture(scope="module")
def enrolment(spark):
    rows = [
        (601, 1, "North County", "North High", "09-12", "1000", "100", "300", "400", "200", "500", "500"),
        (601, 2, "North County", "North Academy", "09-12", "500", "1", "1", "1", "1", "1", "1"),
        (601, 3, "North County", "Low School", "06-12", "500", "1", "1", "1", "1", "1", "1"),
        (602, 4, "South County", "South High", "09-12", "TFS", "TFS", "1", "1", "1", "1", "1"),
        (602, 5, "South County", "East High", "09-12", "800", "0", "TFS", "400", "400", "400", "400"),
        (603, 6, "State Schools", "West High", "09-12", "90", "1", "1", "1", "1", "1", "1"),
    ]
    return edge.inside(spark.createDataFrame(rows, ENROLMENT), edge.ENROLMENT)


@pytest.fixture(scope="module")
def approved(spark, enrolment):
    contacts = spark.createDataFrame(
        [(601, 1, "1 Road", "Town", "GA", 33.7, -84.4), (602, 5, "5 Road", "City", "GA", 32.8, -83.6)],
        "`District ID` int, `School ID` int, `School Address` string, `School City` string, State string, lat double, lon double",
    )
    return schools.approved_schools(enrolment, edge.inside(contacts, edge.CONTACTS))


def test_approved_schools(approved):
    rows = {r.unique_school_id: r for r in approved.collect()}
    assert sorted(rows) == ["06010001", "06020004", "06020005"]
    assert rows["06020004"].school_x is None and rows["06010001"].school_city == "Town"
    assert math.isclose(rows["06010001"].school_x, 1071701, rel_tol=0.01)


def test_locale_and_buffer(spark, approved):
    districts = spark.createDataFrame(
        [("GA-601", 42), ("GA-601", 41), ("602", 12), ("GA-x", 21), (None, 11)], "state_district_id string, locale_code int"
    )
    out = schools.locale_and_buffer(approved, districts, schools.default_buffers(spark))
    got = {r.unique_school_id: (r.locale_code, r.locale, r.buffer_distance) for r in out.collect()}
    assert got == {
        "06010001": (41, "Rural", 18.0), "06020004": (None, "Unknown", None), "06020005": (None, "Unknown", None),
    }
    existing = spark.createDataFrame([("City", 2.0)], "locale_type string, buffer_distance double")
    merged = dict(map(tuple, schools.buffer_lookup(existing).collect()))
    assert merged == {"City": 2.0, "Suburb": 3.0, "Town": 7.0, "Rural": 18.0}


@pytest.fixture(scope="module")
def course_tables(spark):
    web, art, digital = "Web Development", "Studio Art", "Introduction to Digital Technology"
    offered = spark.createDataFrame(
        [
            (601, 1, "11", web, 20, 10, 2, 3, 5, 8, 12),
            (601, 1, "12", art, 50, 1, 1, 1, 1, 1, 1),
            (602, 5, "11", web, 10, None, 5, 5, None, 5, 5),
            (602, 4, "13", digital, 10, 1, 1, 1, 1, 1, 1),
            (602, 5, "99", web, 0, 0, 0, 0, 0, 0, 0),
        ],
        "system_id int, school_id int, course_number string, course_title string, takers int, asian int, black int, white int, hispanic int, female int, male int",
    )
    roster = spark.createDataFrame(
        [
            (601, 1, "11", web, "111", "Smith"), (601, 1, "11", web, "111", "Smith"), (601, 1, "12", art, "222", "Jones"),
            (602, 5, "11", web, "n/a", "GAVS Virtual Teacher"), (602, 4, "13", digital, "333", "DE: Lee"),
            (602, 5, "77", art, ".", None),
        ],
        "system_id int, school_id int, course_number string, course_title string, certificate_id string, teacher_last_name string",
    )
    return offered, roster


def test_course_logic(course_tables):
    offered, roster = course_tables
    out = courses.course_logic(courses.clean_courses(offered), courses.clean_roster(roster)).collect()
    rows = {(r.unique_school_id, r.course_number): r for r in out}
    assert len(out) == len(rows) == 6
    assert rows["06010001", "11"].course_logic == "11" and rows["06010001", "12"].course_logic == "01"
    assert rows["06020005", "11"].course_logic == "10" and rows["06020005", "11"].is_virtual is True
    alone = rows["06020005", "99"]
    assert (alone.course_logic, alone.is_virtual, alone.teacher_last_name) == ("10", None, None)
    assert rows["06020005", "77"].is_virtual is False
    published = edge.published(courses.course_logic(courses.clean_courses(offered), courses.clean_roster(roster)), edge.COURSE_LOGIC)
    assert published.columns[0] == "UNIQUESCHOOLID" and "COURSE_LOGIC" in published.columns


def test_school_representation(approved, enrolment, course_tables):
    out = courses.school_representation(approved, enrolment, *course_tables)
    rows = {r.unique_school_id: r for r in out.collect()}
    assert sorted(rows) == ["06010001", "06020004", "06020005"]
    north, south, east = (rows[k] for k in sorted(rows))
    assert north.cs_enrollment == 20 and north.ri_asian == pytest.approx(0.5 - 0.1)
    assert north.ri_female == pytest.approx(8 / 20 - 0.5) and north.certified_teachers == 2
    assert (north.logic_class, north.logic_class_2) == ("101", "101")
    # No enrolment figure: appended with zero counts and no index, codes as the courses say.
    assert (south.cs_enrollment, south.certified_teachers, south.ri_asian) == (0, 0, None)
    assert (south.logic_class, south.logic_class_2) == ("001", "010")
    assert east.cs_asian == 0 and east.ri_black == pytest.approx(0.5) and east.certified_teachers == 0
    assert east.logic_class == "010"
    headings = edge.published(out, edge.REPRESENTATION).columns
    assert headings[1] == "CS_Enrollment" and headings[-1] == "LOGIC_CLASS_2"


def test_school_without_cs_enrolment_is_at_parity(spark, approved, enrolment, course_tables):
    offered, roster = course_tables
    out = courses.school_representation(approved, enrolment, offered.filter("school_id = 1"), roster)
    east = out.filter("unique_school_id = '06020005'").first()
    assert [east[f"ri_{g}"] for g in K.RI_GROUPS] == [0.0] * 5 and east.cs_enrollment == 0


def test_representation_by_locale(spark):
    ri = spark.createDataFrame([("a", 0.2), ("b", -0.2), ("c", None), ("d", 0.0)], "unique_school_id string, ri_asian double")
    places = spark.createDataFrame([("a", "City"), ("b", "City"), ("c", "Town"), ("d", None)], "unique_school_id string, locale string")
    ri = ri.selectExpr("*", "-ri_asian as ri_black")
    rows = courses.representation_by_locale(ri, places, ["asian", "black"]).collect()
    out = {r.locale: (r.overrepresentation, r.parity, r.underrepresentation) for r in rows if r.race == "asian"}
    assert len(rows) == 6
    assert out == {"City": (1, 0, 1), "Town": (0, 0, 0), "Total": (1, 1, 1)}


def census_frame(spark):
    names = [*K.SHARE_METRICS, *K.POPULATION_GROUPS.values()]
    rows = [
        ("z1", 100, 10.0, *[10, 20, 30, 40], *[50, 20, 10, 20]),
        ("z2", 300, None, *[30, 20, None, 0], *[150, 60, 30, 60]),
        ("z3", 50, 5.0, *[1, 1, 1, 1], *[1, 1, 1, 1]),
    ]
    schema = "geoid string, total_population int, percapita_income_total double, " + ", ".join(f"{n} int" for n in names)
    return spark.createDataFrame(rows, schema)


def test_catchment_metrics(spark):
    assignment = spark.createDataFrame(
        [("z1", "s", 100.0), ("z2", "s", 200.0), ("z3", "t", 0.0), ("zz", "t", 5.0)], "geoid string, unique_school_id string, distance double"
    )
    rows = {r.unique_school_id: r for r in catchment.catchment_metrics(assignment, census_frame(spark)).collect()}
    s = rows["s"]
    assert s.weighted_avg_edu_less_than_hs == pytest.approx(10.0)
    assert s.weighted_avg_without_internet_subscription == pytest.approx(7.5)
    assert s.total_pop_weighted_avg_income == pytest.approx(10.0)
    assert s.white_alone_non_hispanic_population_avg_distance == pytest.approx(200 / (0.5 + 0.75))
    assert rows["t"].white_alone_non_hispanic_population_avg_distance == 0.0


def test_income_statistics_and_write_back(spark):
    assignment = spark.createDataFrame([(f"z{i}", "s") for i in range(4)] + [("q", "one")], "geoid string, unique_school_id string")
    census = spark.createDataFrame(
        [("z0", 10, "100"), ("z1", 20, "200"), ("z2", 10, "300"), ("z3", 5, "-"), ("q", 4, "50")],
        "geoid string, total_population int, median_income string",
    )
    stats = catchment.income_statistics(assignment, census)
    rows = {r.unique_school_id: r for r in stats.collect()}
    assert rows["s"].weighted_median_income == pytest.approx(150.0)  # half of 40: ten into the second row
    assert rows["s"].avg_median_income == pytest.approx(200.0)
    assert rows["one"].weighted_median_income is None and rows["one"].stddev_median_income == 0.0
    stored = spark.createDataFrame([("s", 1.0), ("other", 7.0)], "unique_school_id string, avg_median_income double")
    written = {r.unique_school_id: r.avg_median_income for r in catchment.write_back(stored, stats).collect()}
    assert written == {"s": pytest.approx(200.0), "other": 7.0}


def test_distribution_rows_and_counts(spark):
    columns = sorted({c for v in K.DISTRIBUTION_METRICS.values() for c in (v.values() if isinstance(v, dict) else [v])})
    schema = "unique_school_id string, locale string, " + ", ".join(f"ri_{r.lower()} double" for r in K.RACES)
    schema += ", " + ", ".join(f"{c} double" for c in columns)
    rows = [
        ("a", "City", 0.2, -0.2, 0.0, None, *[1.0] * len(columns)),
        ("b", "Town", 0.3, 0.01, None, -0.3, *[None] * len(columns)),
        ("c", None, 0.3, 0.3, 0.3, 0.3, *[1.0] * len(columns)),
    ]
    df = spark.createDataFrame(rows, schema)
    long = layers.representation_rows(df).toPandas()
    assert len(long) == 6 * 3 and set(long.unique_school_id) == {"a"}
    by_race = {r.race: (r.overrepresentation, r.parity, r.underrepresentation) for r in layers.counts_by_race(df).collect()}
    assert by_race == {"White": (2, 0, 0), "Black": (0, 1, 1), "Asian": (0, 1, 0), "Hispanic": (0, 0, 1)}
    by_locale = {r.locale: (r.overrepresentation, r.parity, r.underrepresentation) for r in layers.counts_by_locale(df).collect()}
    assert by_locale == {"City": (1, 1, 1), "Town": (1, 1, 1)}


def test_layers(spark):
    places = spark.createDataFrame(
        [("a", -84.4, 33.7), ("b", -81.0, 32.0), ("c", None, 33.0)], "unique_school_id string, lon double, lat double"
    )
    codes = spark.createDataFrame([("a", "111", -0.2), ("b", "000", 0.0), ("c", "010", 0.1)], "unique_school_id string, logic_class string, ri_black double")
    layer = layers.modality_layer(places, codes)
    assert {r.unique_school_id: r.label for r in layer.collect()} == {"a": "In Person and Virtual", "b": "No approved CS Class"}
    legend = dict(map(tuple, layers.modality_legend(layer).collect()))
    assert legend == {"Both": 1, "In Person": 0, "Virtual": 0, "No": 1}
    markers = layers.marker_layer(places, codes, ["11", "10"])
    assert {r.unique_school_id: r.marker for r in markers.collect()} == {"a": "Purple Triangle", "b": "Other"}
    region = layers.disparity_layer(places, codes, "black", K.REGION_BOX)
    assert [(r.unique_school_id, r.colour) for r in region.collect()] == [("a", "#7f2704")]


def test_older_report_and_index(spark):
    rows = spark.createDataFrame(
        [("s", "Smith", "1", "Web Development"), ("s", "DE: x", "2", "Art"), ("t", "Jones", "1", "Web Development")],
        "unique_school_id string, teacher_last_name string, certificate_id string, course_title string",
    )
    out = {r.unique_school_id: (r.classification, r.has_extra_teacher) for r in older.school_report(rows).collect()}
    assert out == {"s": ("Both", "Yes"), "t": ("In Person", "No")}


def test_plans_agree_with_pandas_on_random_rosters(spark):
    import numpy as np

    rng = np.random.default_rng(11)
    titles = [*K.EXPANDED_TITLES, "art"]
    roster = pd.DataFrame(
        {
            "unique_school_id": rng.choice(list("abcdefgh"), 300), "course_number": rng.choice(list("12"), 300),
            "course_title": rng.choice(titles, 300), "certificate_id": rng.choice([1, 2, 3, 4, 5, np.nan], 300),
            "teacher_last_name": rng.choice(["x", "de: y"], 300),
        }
    )
    roster["is_virtual"] = roster.teacher_last_name.str.contains("de:")
    df = spark.createDataFrame(roster.astype({"certificate_id": "object"}).where(roster.notna(), None),
        "unique_school_id string, course_number string, course_title string, certificate_id double, teacher_last_name string, is_virtual boolean")
    got = {r[0]: r[1] for r in courses.school_logic(df, {"code": K.APPROVED_TITLES}).collect()}
    roster["ok"] = roster.course_title.isin(K.APPROVED_TITLES)
    for school, g in roster.groupby("unique_school_id"):
        extra = (~g.dropna(subset=["certificate_id"]).groupby("certificate_id").ok.any()).any()
        flags = (g.ok & ~g.is_virtual).any(), (g.ok & g.is_virtual).any(), extra
        assert got[school] == "".join(str(int(f)) for f in flags)
