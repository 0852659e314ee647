"""Spatial operators. Polygons of three shapes stand at each zone; roads lead through ten zones each."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import constants as K, geo
from ..session import scratch_dir, scratch_path
from ..sources import polygons
from ..sources.tables import points_from_lonlat
from .base import CHECKS, query
from .joining import conic_sql

_X, _Y = conic_sql("lon", "lat")
_KIND = "case when zone_no % 40 = 17 then 'flat' when zone_no % 3 = 0 then 'square' when zone_no % 3 = 1 then 'corner' else 'holed' end"

# Corners of each shape in units of its size, from its lower left corner.
SHAPES = {
    "flat": [[(0, 0), (4, 0), (0, 0)]],
    "square": [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]],
    "corner": [[(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)]],
    "holed": [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(2, 1), (3, 1), (3, 2), (2, 2), (2, 1)]],
}
# The same shapes as rectangles (x0, y0, x1, y1) and their centres.
_PIECES = {
    "flat": [(0, 0, 4, 0)],
    "square": [(0, 0, 2, 2)],
    "corner": [(0, 0, 2, 1), (0, 1, 1, 2)],
    "holed": [(0, 0, 2, 4), (3, 0, 4, 4), (2, 0, 3, 1), (2, 2, 3, 4)],
}
_CENTRES = {"flat": (2, 0), "square": (1, 1), "corner": (5 / 6, 5 / 6), "holed": (59 / 30, 61 / 30)}


def _rings(kind: str) -> Column:
    h = F.col("h")
    return F.array(
        *[
            F.array(*[F.struct((F.col("lon") + x * h).alias("x"), (F.col("lat") + y * h).alias("y")) for x, y in ring])
            for ring in SHAPES[kind]
        ]
    )


def zone_polygons(t) -> DataFrame:
    """Zone id and polygon (rings of points, degrees).

    Zones are dealt out while they are small: a polygon takes far longer than its row, and all rows may lie in one file.
    """
    rows = t.b_zone.repartition("geoid").select("*", F.expr(_KIND).alias("kind"), F.expr("0.004e0 * (1 + zone_no % 5)").alias("h"))
    rings = F.when(F.lit(False), _rings("square"))
    for kind in SHAPES:
        rings = rings.when(F.col("kind") == kind, _rings(kind))
    return rows.select("geoid", "zone_no", rings.alias("rings"))


_STORED: dict[tuple[str, str], str] = {}


def stored_polygons(t) -> DataFrame:
    """The same zones as a stored polygon table, which is made once for each application and folder of tables."""
    key = (scratch_dir(t.spark), t.path("customer"))
    if key not in _STORED:
        path = scratch_path(t.spark, "polygons")
        polygons.write_polygons(zone_polygons(t).select("geoid", "rings"), path)
        _STORED[key] = path
    return polygons.read_polygons(t.spark, _STORED[key])


CHECKS["o_shape"] = f"select *, {_KIND} as kind, 0.004::double * (1 + zone_no % 5) as h from b_zone"
CHECKS["o_box"] = """
    select geoid, lon as x0, lat as y0, lon + h * (case when kind in ('flat', 'holed') then 4 else 2 end) as x1,
        lat + h * (case kind when 'flat' then 0 when 'holed' then 4 else 2 end) as y1
    from o_shape"""


@query("g1_point", "select unique_school_id, lon is not null and lat is not null as placed, round(lon, 9) as x, round(lat, 9) as y from b_school")
def _(t):
    p = geo.point("lon", "lat")
    return t.b_school.select(
        "unique_school_id", p.isNotNull().alias("placed"), F.round(p["x"], 9).alias("x"), F.round(p["y"], 9).alias("y")
    )


@query("g2_conic_metres", f"select geoid, round({_X}, 3) as x, round({_Y}, 3) as y from b_zone")
def _(t):
    x, y = geo.conic_xy("lon", "lat")
    return t.b_zone.select("geoid", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


_MX = "6378137.0::double * radians(lon)"
_MY = f"6378137.0::double * ln(tan({math.pi / 4!r}::double + radians(lat) / 2))"


@query("g3_mercator_metres", f"select geoid, round({_MX}, 3) as x, round({_MY}, 3) as y from b_zone")
def _(t):
    x, y = geo.mercator_xy("lon", "lat")
    return t.b_zone.select("geoid", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


def _centre_sql(i: int) -> str:
    return "case kind " + " ".join(f"when '{k}' then {c[i]!r}::double" for k, c in _CENTRES.items()) + " end"


@query(
    "g4_polygon_centroid",
    f"select geoid, round(lon + h * {_centre_sql(0)}, 7) as x, round(lat + h * {_centre_sql(1)}, 7) as y from o_shape",
)
def _(t):
    return zone_polygons(t).select("geoid", geo.polygon_centroid("rings").alias("c")).select(
        "geoid", F.round("c.x", 7).alias("x"), F.round("c.y", 7).alias("y")
    )


@query(
    "g5_distance",
    "select road, step, round(sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)), 7) as length from b_segment",
)
def _(t):
    return t.b_segment.select("road", "step", F.round(geo.distance("x1", "y1", "x2", "y2"), 7).alias("length"))


@query(
    "g6_within_distance",
    "select road, step from b_segment where sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)) <= 2.8",
)
def _(t):
    return t.b_segment.filter(geo.distance("x1", "y1", "x2", "y2") <= 2.8).select("road", "step")


_W, _S, _E, _N = K.REGION_BOX
CHECKS["o_span"] = f"""
    select *, case when miss then null else greatest(0, least(xa, xb), least(ya, yb)) end as t0,
        case when miss then null else least(1, greatest(xa, xb), greatest(ya, yb)) end as t1 from (
        select *, (x1 = x2 and (x1 < {_W} or x1 > {_E})) or (y1 = y2 and (y1 < {_S} or y1 > {_N})) as miss,
            case when x1 = x2 then 0 else ({_W} - x1) / (x2 - x1) end as xa,
            case when x1 = x2 then 1 else ({_E} - x1) / (x2 - x1) end as xb,
            case when y1 = y2 then 0 else ({_S} - y1) / (y2 - y1) end as ya,
            case when y1 = y2 then 1 else ({_N} - y1) / (y2 - y1) end as yb
        from b_segment where rttyp = 'I')"""


@query(
    "g7_clip_lines",
    """
    select road, step, round(x1 + t0 * (x2 - x1), 6) as from_x, round(y1 + t0 * (y2 - y1), 6) as from_y,
        round(x1 + t1 * (x2 - x1), 6) as to_x, round(y1 + t1 * (y2 - y1), 6) as to_y
    from o_span where t0 <= t1
    """,
)
def _(t):
    start, end = geo.clip_span("x1", "y1", "x2", "y2", K.REGION_BOX)
    rows = t.b_segment.filter(F.col("rttyp") == K.INTERSTATE).withColumn("t0", start).withColumn("t1", end)

    def at(axis, share):
        a, b = F.col(f"{axis}1"), F.col(f"{axis}2")
        return F.round(a + F.col(share) * (b - a), 6)

    return rows.filter("t0 <= t1").select(
        "road", "step", at("x", "t0").alias("from_x"), at("y", "t0").alias("from_y"),
        at("x", "t1").alias("to_x"), at("y", "t1").alias("to_y"),
    )


def roads(t) -> DataFrame:
    """Each road as an array of its (at most ten) points, in order."""
    points = t.b_zone.select(
        F.expr("cast(floor(zone_no / 10) as bigint)").alias("road"),
        F.struct("zone_no", F.col("lon").alias("x"), F.col("lat").alias("y")).alias("p"),
    )
    return points.groupBy("road").agg(F.array_sort(F.collect_list("p")).alias("line"))


CHECKS["o_walk"] = """
    select *, sum(d) over (partition by road order by step) as upto, sum(d) over (partition by road) / 2 as half
    from (select *, sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)) as d from b_segment)"""


@query(
    "g8_line_midpoint",
    """
    select road, round(x1 + (half - upto + d) / d * (x2 - x1), 6) as x, round(y1 + (half - upto + d) / d * (y2 - y1), 6) as y
    from o_walk where upto >= half and upto - d < half
    """,
)
def _(t):
    return roads(t).select("road", geo.line_midpoint("line").alias("m")).select(
        "road", F.round("m.x", 6).alias("x"), F.round("m.y", 6).alias("y")
    )


def _pieces_sql() -> str:
    tests = []
    for kind, pieces in _PIECES.items():
        hits = " or ".join(
            f"(lon + {a} * h <= {_E} and lon + {c} * h >= {_W} and lat + {b} * h <= {_N} and lat + {d} * h >= {_S})"
            for a, b, c, d in pieces
        )
        tests.append(f"(kind = '{kind}' and ({hits}))")
    return " or ".join(tests)


@query("g9_polygon_hits_box", f"select geoid from o_shape where {_pieces_sql()}")
def _(t):
    return zone_polygons(t).filter(geo.polygon_hits_box("rings", K.REGION_BOX)).select("geoid")


@query(
    "g10_envelope",
    "select geoid, round(x0, 7) as min_x, round(y0, 7) as min_y, round(x1, 7) as max_x, round(y1, 7) as max_y from o_box",
)
def _(t):
    boxes = zone_polygons(t).select("geoid", geo.envelope("rings[0]").alias("e"))
    return boxes.select("geoid", *[F.round(f"e.{c}", 7).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")])
