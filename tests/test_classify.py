import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from schoolzones.functions import classify, constants as K
from schoolzones.plans import layers


def test_locale_class(column):
    codes = [11, 19, 20, 21, 30, 41, 49, 50, None, 31]
    expected = ["City", "City", "Unknown", "Suburb", "Unknown", "Rural", "Rural", "Unknown", "Unknown", "Town"]
    assert column(codes, classify.locale_class, "int") == expected


def test_ri_category_limits_and_nan(column):
    values = [0.05, -0.05, 0.0501, -0.0501, None, math.nan]
    expected = ["Parity", "Parity", "Overrepresented", "Underrepresented", "Missing", "Missing"]
    assert column(values, classify.ri_category, "double") == expected


def test_share_gap(spark):
    df = spark.createDataFrame([(5, 10, 20, 100), (0, 0, 20, 100), (1, 10, 5, 0)], "p int, pt int, w int, wt int")
    out = [r[0] for r in df.select(classify.share_gap("p", "pt", "w", "wt")).collect()]
    assert out[0] == pytest.approx(0.3) and out[1] == 0.0 and out[2] is None
    older = [r[0] for r in df.select(classify.rounded_share_gap("p", "pt", "w", "wt")).collect()]
    assert older == [0.3, None, None]


def test_modality_and_markers(column):
    codes = ["111", "100", "010", "001", None, "01"]
    assert column(codes, classify.modality_class) == ["Both", "In Person", "Virtual", "No", None, "Virtual"]
    assert column(codes, lambda c: classify.modality_marker(c, ["11", "10"])) == [
        "Purple Triangle", "Pink Circle", "Other", "Other", None, "Other",
    ]
    assert column(["011", "000"], classify.modality_marker) == ["Yellow Triangle", "Gray Circle"]


def test_gapped_ranges(column):
    values = [-0.2965195, 0.0335, 0.032609, 0.034510, -0.9, 0.7, None, -0.864929]
    out = column(values, lambda c: classify.range_bins(c, K.RI_FEMALE_RANGES), "double")
    assert out == [None, None, "#ffffff", "#9ecae1", None, None, None, "#7f2704"]


def test_touching_ranges_lower_owns_edge(column):
    ranges = layers.DISPARITY_LAYERS["white"][0]
    out = column([-0.168843, 0.981273, 0.99, -0.7], lambda c: classify.range_bins(c, ranges), "double")
    assert out == ["#7f2704", "#08519c", None, None]


def test_open_ranges_catch_rest(column):
    out = column(
        [-5.0, -0.0502785, None, 0.2, 0.0], lambda c: classify.range_bins(c, K.RI_ASIAN_RANGES, K.RI_ASIAN_OTHERWISE), "double"
    )
    assert out == ["#d94801", "#3182bd", "#3182bd", "#3182bd", "#fdae6b"]


@pytest.mark.parametrize("lowest", [False, True])
def test_cut_bins_like_pandas(column, lowest):
    edges = [0.0, 0.1253, 0.3157, 0.5369, 0.7838, 1.0]
    values = [0.0, 0.1253, 0.12531, 0.5, 1.0, 1.01, -0.1, None]
    expected = pd.cut(pd.Series(values, dtype=float), edges, labels=False, include_lowest=lowest)
    out = column(values, lambda c: classify.cut_bins(c, edges, lowest), "double")
    assert [None if pd.isna(x) else int(x) for x in expected] == out


def test_population_ratio_without_people(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(classify.population_ratio("a", "b")).collect()] == [None, 0.25]


def test_course_logic(spark):
    df = spark.createDataFrame([(True, 5), (False, None), (None, 3)], "a boolean, c int")
    assert [r[0] for r in df.select(classify.course_logic(F.col("a"), F.col("c"))).collect()] == ["11", "00", "01"]
