import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from schoolzones.functions import constants as K, text
from schoolzones.operators import clean, filters


def test_composite_key_cuts_and_zfill_keeps(column):
    values = ["7", "12345", None]
    assert column(values, lambda c: text.composite_key(c, F.lit("1"))) == ["00070001", "12340001", None]
    assert column(values, lambda c: text.zfill_key(c, F.lit("1"))) == ["00070001", "123450001", None]


def test_zfill_like_python(column):
    values = ["7", "12", "1234", "1234567", "", None]
    expected = [v.zfill(4) if v is not None else None for v in values]
    assert column(values, lambda c: text.zfill(c, 4)) == expected


def test_markers_become_null(column):
    assert column(["n/a", "N/A", ".", "", "12", None], text.null_if_in) == [None] * 4 + ["12", None]


def test_to_number(column):
    values = ["1e3", " 7 ", "12d", "inf", "-Infinity", "1,000", "TFS", None, ".5", "5.", "nan"]
    expected = [1000.0, 7.0, None, float("inf"), float("-inf"), None, None, None, 0.5, 5.0, None]
    assert column(values, text.to_number) == expected
    assert column(["x", "2.5", None], text.number_or_zero) == [0.0, 2.5, 0.0]


def test_whole_numbers(column):
    assert column(["12", "3.0", " 4 ", "x", None], text.to_whole_number) == [12, 3, 4, None, None]
    assert column(["3.5"], lambda c: text.to_whole_number(c, strict=False)) == [None]
    with pytest.raises(PySparkException):
        column(["3.5"], text.to_whole_number)


def test_second_part(column):
    assert column(["GA-601", "601", "a-b-c", None], text.second_part) == ["601", "", "b", None]


def test_grade_tokens(column):
    assert column(["PK,KK,01-05", "09,", ""], text.grade_tokens) == [["0", "0.5", "01", "05"], ["09", ""], [""]]


@pytest.mark.parametrize(
    "grades, keep",
    [
        ("09-12", True), ("KK-12", False), ("06-12", False), ("PK,09", False), ("09", True), (" 09", False),
        ("09,", True), ("1.2.3", False), ("", False), (None, False), ("09-13", True), ("13", False), ("10", True),
    ],
)
def test_grade_span(column, grades, keep):
    assert column([grades], filters.grade_span) == [keep]


def test_name_patterns(spark):
    df = spark.createDataFrame(
        [
            (1, "Early System High", "x"), (2, "S.T.E.M. School", "x"), (3, None, "x"), (4, None, "City CHARTER Schools"),
            (5, "North High", "y"), (6, "SXTXEXM School", "y"), (7, "Altitude High", "y"),
        ],
        "id int, school_name string, system_name string",
    )
    test = filters.ilike_any({"school_name": K.SCHOOL_NAME_PATTERNS, "system_name": K.SYSTEM_NAME_PATTERNS})
    assert {r.id for r in df.filter(test).collect()} == {1, 2, 4, 7}
    assert {r.id for r in df.filter(~test).collect()} == {3, 5, 6}


def test_virtual_teacher(column):
    values = ["gavs virtual teacher", "x de: y", "smith", None]
    assert column(values, text.is_virtual) == [True, True, False, False]
    assert column(["DE: x", "de: x", "GAVS Virtual Teacher", None], text.is_virtual_older) == [True, False, True, False]


def test_round_half_even_like_numpy(column):
    import numpy as np

    values = [0.0005, 0.0015, 0.0025, 0.5015, -0.0015, 1.0005, 2.3456]
    assert column(values, lambda c: text.round_half_even(c, 3), "double") == list(np.round(values, 3))


def test_lower_columns_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], ["A", "b"])
    assert clean.lower_columns(df).columns == ["a", "b"]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError):
            clean.lower_columns(spark.createDataFrame([(1, 2)], ["A", "a"]))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_add_if_absent_and_labels(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert clean.add_if_absent(df, "k", F.lit("no")).columns == ["k"]
    out = clean.label_from(df, "k", {"a": "A", "b": "B"}, "label").collect()
    assert [r.label for r in out] == ["A", None, None]
