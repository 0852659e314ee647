import math

import pytest

from schoolzones.functions import geo

RINGS = "array<array<struct<x:double,y:double>>>"
LINE = "array<struct<x:double,y:double>>"


def close(points):
    return [(float(x), float(y)) for x, y in points]


SQUARE = close([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)])
HOLE = close([(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)])


def test_conic_projection(spark):
    n, g, rho0, _ = geo.conic_constants()
    assert n == pytest.approx(0.6281986266179438) and g == pytest.approx(1.9090662238802316)
    assert rho0 == pytest.approx(7857781.933166309)
    x, y = geo.conic_xy("lon", "lat")
    rows = spark.createDataFrame([(-96.0, 39.0), (-84.388, 33.749)], "lon double, lat double").select(x, y).collect()
    assert tuple(rows[0]) == pytest.approx((0, 0), abs=1e-6)
    assert tuple(rows[1]) == pytest.approx((1071701.587, -514369.064), abs=1e-3)


def test_mercator(spark):
    x, y = geo.mercator_xy("lon", "lat")
    row = spark.createDataFrame([(180.0, 0.0)], "lon double, lat double").select(x, y).first()
    assert tuple(row) == pytest.approx((20037508.342789244, 0), abs=1e-6)


def test_point_null(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "x double, y double")
    assert [r[0] is None for r in df.select(geo.point("x", "y")).collect()] == [True, False]


def test_centroids(column):
    far = 1e6
    moved = [(x + far, y - far) for x, y in SQUARE]
    corner = close([(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)])
    side_hole = close([(2, 1), (3, 1), (3, 2), (2, 2), (2, 1)])
    cases = [
        ([SQUARE], (2, 2)),
        ([SQUARE[::-1]], (2, 2)),
        ([moved], (far + 2, 2 - far)),
        ([corner], (5 / 6, 5 / 6)),
        ([SQUARE, side_hole], (29.5 / 15, 30.5 / 15)),
        ([SQUARE, side_hole[::-1]], (29.5 / 15, 30.5 / 15)),
        ([close([(0, 0), (4, 0), (0, 0)])], (2, 0)),
        ([close([(3, 3), (3, 3)])], (3, 3)),
    ]
    out = column([rings for rings, _ in cases] + [None, []], geo.polygon_centroid, RINGS)
    for got, (_, expected) in zip(out, cases):
        assert (got.x, got.y) == pytest.approx(expected)
    assert out[-2:] == [None, None]


def test_polygon_hits_box(column):
    cases = [
        ([SQUARE], (1, 1, 2, 2), True),  # box inside
        ([SQUARE, HOLE], (1.5, 1.5, 2.5, 2.5), False),  # box inside the hole
        ([SQUARE, HOLE], (0.5, 0.5, 2, 2), True),
        ([SQUARE], (-1, -1, 9, 9), True),  # polygon inside
        ([SQUARE], (4, 4, 5, 5), True),  # touching corner
        ([SQUARE], (4.1, 0, 5, 5), False),
        ([close([(0, 0), (4, 4), (0, 4), (0, 0)])], (2, 0, 4, 1), False),  # envelopes meet, shapes do not
        ([close([(0, 0), (4, 4), (0, 4), (0, 0)])], (1, 2, 1.5, 2.5), True),
    ]
    for rings, box, expected in cases:
        assert column([rings], lambda c: geo.polygon_hits_box(c, box), RINGS) == [expected], (rings, box)
    assert column([None], lambda c: geo.polygon_hits_box(c, (0, 0, 1, 1)), RINGS) == [False]


def test_clip_span(spark):
    segments = [(0, 0, 4, 0), (0, 5, 4, 5), (-2, 1, 6, 1), (1, 1, 1, 1), (2, -2, 2, 6), (9, 9, 9, 9)]
    df = spark.createDataFrame([tuple(map(float, s)) for s in segments], "a double, b double, c double, d double")
    start, end = geo.clip_span("a", "b", "c", "d", (0, 0, 4, 2))
    rows = df.select(start.alias("s"), end.alias("e")).collect()
    kept = [None if r.s is None or r.s > r.e else (r.s, r.e) for r in rows]
    assert kept == [(0, 1), None, (0.25, 0.75), (0, 1), (0.25, 0.5), None]


def test_line_midpoint(column):
    lines = [close([(0, 0), (2, 0), (2, 4)]), close([(0, 0), (0, 0), (4, 0)]), close([(1, 1)]), [], None]
    out = column(lines, geo.line_midpoint, LINE)
    assert [(p.x, p.y) if p else None for p in out] == [(2, 1), (2, 0), (1, 1), None, None]
    assert column(lines[:1], geo.line_length, LINE) == [6.0]


def test_envelope_and_distance(column, spark):
    box = column([close([(0, 3), (2, -1)])], geo.envelope, LINE)[0]
    assert tuple(box) == (0, -1, 2, 3)
    d = spark.range(1).select(geo.distance("0d", "0d", "3d", "4d")).first()[0]
    assert d == 5.0 and math.isfinite(d)
