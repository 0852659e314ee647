"""Points, projections, polygons and lines as plain columns.

A point is two double columns, or ``struct<x,y>`` inside arrays. A polygon is an array of
closed rings (outer ring first, holes after it); a line is an array of points. Arguments
are column names or SQL text; the formulas are SQL expressions, so each intermediate value
of an array function is bound and computed once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from . import constants as K


def point(x: str, y: str) -> Column:
    """``struct<x,y>``, NULL if either coordinate is."""
    return F.expr(f"if({x} is not null and {y} is not null, named_struct('x', {x}, 'y', {y}), null)")


# --- Projections ---------------------------------------------------------------------------


def _arc_terms() -> list[float]:
    """Coefficients of the meridian arc: of the angle, and of the sines of 2, 4 and 6 angles."""
    e2 = K.GRS80_F * (2 - K.GRS80_F)
    e4, e6 = e2 * e2, e2 * e2 * e2
    return [
        1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256,
        -(3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024),
        15 * e4 / 256 + 45 * e6 / 1024,
        -35 * e6 / 3072,
    ]


def _meridian_arc(phi: float) -> float:
    first, *rest = _arc_terms()
    return K.GRS80_A * (first * phi + sum(c * math.sin(2 * (i + 1) * phi) for i, c in enumerate(rest)))


def conic_constants() -> tuple[float, float, float, float]:
    """Cone constant, G, radius of the origin parallel, central meridian (radians)."""
    e2 = K.GRS80_F * (2 - K.GRS80_F)
    p1, p2 = (math.radians(p) for p in K.CONIC_PARALLELS)
    lon0, lat0 = (math.radians(v) for v in K.CONIC_ORIGIN)

    def scale(phi):
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    n = K.GRS80_A * (scale(p1) - scale(p2)) / (_meridian_arc(p2) - _meridian_arc(p1))
    g = scale(p1) / n + _meridian_arc(p1) / K.GRS80_A
    return n, g, K.GRS80_A * g - _meridian_arc(lat0), lon0


def _double(value: float) -> str:
    return f"cast({value!r} as double)"


def conic_xy(lon: str, lat: str) -> tuple[Column, Column]:
    """Degrees to metres of the contiguous-US equidistant conic projection."""
    n, g, rho0, lon0 = conic_constants()
    first, *rest = _arc_terms()
    arc = f"{_double(first)} * radians({lat})" + "".join(
        f" + {_double(c)} * sin({2 * (i + 1)} * radians({lat}))" for i, c in enumerate(rest)
    )
    rho = f"({_double(K.GRS80_A * g)} - {_double(K.GRS80_A)} * ({arc}))"
    theta = f"({_double(n)} * (radians({lon}) - {_double(lon0)}))"
    return F.expr(f"{rho} * sin({theta})"), F.expr(f"{_double(rho0)} - {rho} * cos({theta})")


def mercator_xy(lon: str, lat: str) -> tuple[Column, Column]:
    """Degrees to web mercator metres."""
    r = _double(K.MERCATOR_R)
    return (
        F.expr(f"{r} * radians({lon})"),
        F.expr(f"{r} * ln(tan({_double(math.pi / 4)} + radians({lat}) / 2))"),
    )


def distance_text(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"sqrt(({x1} - {x2}) * ({x1} - {x2}) + ({y1} - {y2}) * ({y1} - {y2}))"


def distance(x1: str, y1: str, x2: str, y2: str) -> Column:
    return F.expr(distance_text(x1, y1, x2, y2))


# --- Boxes (min x, min y, max x, max y) -------------------------------------------------------


def in_box(x: str, y: str, box) -> Column:
    """Inside the closed box."""
    return F.expr(f"{x} between {_double(box[0])} and {_double(box[2])} and {y} between {_double(box[1])} and {_double(box[3])}")


def _clip_text(x1: str, y1: str, x2: str, y2: str, box) -> tuple[str, str]:
    """Where a segment's parameter (0 start, 1 end) enters and leaves a box; NULL beside it."""
    starts, ends, beside = ["0d"], ["1d"], []
    for a, b, low, high in ((x1, x2, box[0], box[2]), (y1, y2, box[1], box[3])):
        to_low = f"({_double(low)} - {a}) / nullif({b} - {a}, 0)"
        to_high = f"({_double(high)} - {a}) / nullif({b} - {a}, 0)"
        starts.append(f"coalesce(least({to_low}, {to_high}), 0d)")
        ends.append(f"coalesce(greatest({to_low}, {to_high}), 1d)")
        beside.append(f"({a} = {b} and {a} not between {_double(low)} and {_double(high)})")
    off = " or ".join(beside)
    return (
        f"if({off}, null, greatest({', '.join(starts)}))",
        f"if({off}, null, least({', '.join(ends)}))",
    )


def clip_span(x1: str, y1: str, x2: str, y2: str, box) -> tuple[Column, Column]:
    """Part of a segment inside a box as the range of its parameter (0 start, 1 end).

    The segment misses the box where the start of the range exceeds its end, or is NULL.
    """
    start, end = _clip_text(x1, y1, x2, y2, box)
    return F.expr(start), F.expr(end)


def _edges(path: str, body: str) -> str:
    """``body`` over each pair p, q of neighbouring points."""
    n = f"greatest(size({path}) - 1, 0)"
    return f"zip_with(slice({path}, 1, {n}), slice({path}, 2, {n}), (p, q) -> {body})"


def _bind(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for the value, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def envelope(points: str) -> Column:
    """Smallest box round an array of points."""
    sides = ", ".join(
        f"'{f}_{c}', array_{f}(transform(pts, p -> p.{c}))" for f in ("min", "max") for c in ("x", "y")
    )
    return F.expr(_bind(points, "pts", f"named_struct({sides})"))


def polygon_hits_box(rings: str, box) -> Column:
    """Exact test: an edge touches the box, or the box lies inside the polygon.

    The box corner is tested by the even-odd rule over all rings, so a hole is outside.
    """
    west, south, east, north = (_double(v) for v in box)
    start, end = _clip_text("p.x", "p.y", "q.x", "q.y", box)
    touches = f"exists(poly, ring -> exists({_edges('ring', f'coalesce({start} <= {end}, false)')}, hit -> hit))"
    crossed = (
        f"if((p.y > {south}) <> (q.y > {south}) and "
        f"{west} < p.x + ({south} - p.y) / nullif(q.y - p.y, 0) * (q.x - p.x), 1, 0)"
    )
    crossings = (
        "aggregate(flatten(transform(poly, ring -> " + _edges("ring", crossed) + ")), 0, (n, e) -> n + e)"
    )
    near = (
        f"exists(poly[0], p -> p.x <= {east}) and exists(poly[0], p -> p.x >= {west}) and "
        f"exists(poly[0], p -> p.y <= {north}) and exists(poly[0], p -> p.y >= {south})"
    )
    test = f"size(poly) > 0 and {near} and ({touches} or {crossings} % 2 = 1)"
    return F.expr(f"coalesce({_bind(rings, 'poly', test)}, false)")


# --- Centres ------------------------------------------------------------------------------------

_SUMS = ("a", "ax", "ay", "l", "lx", "ly")


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def polygon_centroid(rings: str) -> Column:
    """Area-weighted centre, holes taken off; a flat polygon uses its edge lengths.

    Coordinates are taken relative to the first vertex ``o``, which keeps the sums small.
    Each ring gives its signed area sums (positive outside, negative for holes, whichever
    way it turns) and its edge length sums.
    """
    zero = _struct({k: "0d" for k in _SUMS})
    edge = _struct(
        {
            "cross": "(p.x - o.x) * (q.y - o.y) - (q.x - o.x) * (p.y - o.y)",
            "length": distance_text("p.x", "p.y", "q.x", "q.y"),
            "sx": "p.x + q.x - 2 * o.x",
            "sy": "p.y + q.y - 2 * o.y",
        }
    )
    added = _struct(
        {
            "a": "s.a + e.cross", "ax": "s.ax + e.sx * e.cross", "ay": "s.ay + e.sy * e.cross",
            "l": "s.l + e.length", "lx": "s.lx + e.sx * e.length", "ly": "s.ly + e.sy * e.length",
        }
    )
    sign = "if((s.a < 0) = (i = 0), -1d, 1d)"
    signed = _struct({k: f"s.{k} * {sign}" if k.startswith("a") else f"s.{k}" for k in _SUMS})
    per_ring = f"transform(poly, (ring, i) -> aggregate({_edges('ring', edge)}, {zero}, (s, e) -> {added}, s -> {signed}))"
    both = _struct({k: f"s.{k} + r.{k}" for k in _SUMS})
    centre = _struct(
        {
            c: f"o.{c} + coalesce(t.a{c} / nullif(3 * t.a, 0), t.l{c} / nullif(2 * t.l, 0), 0d)"
            for c in ("x", "y")
        }
    )
    total = f"aggregate({per_ring}, {zero}, (s, r) -> {both}, t -> {centre})"
    return F.expr(_bind(rings, "poly", f"if(size(poly) > 0, {_bind('get(poly[0], 0)', 'o', total)}, null)"))


def _length_text(line: str) -> str:
    return f"aggregate({_edges(line, distance_text('p.x', 'p.y', 'q.x', 'q.y'))}, 0d, (n, d) -> n + d)"


def line_length(line: str) -> Column:
    return F.expr(_length_text(line))


def line_midpoint(line: str) -> Column:
    """Point half way along a line: walk its edges until half the length is reached."""
    edge = _struct({"p": "p", "q": "q", "d": distance_text("p.x", "p.y", "q.x", "q.y")})
    share = "coalesce((half - s.done) / nullif(e.d, 0), 0d)"

    def at(c: str) -> str:
        return f"if(s.{c} is null and s.done + e.d >= half, e.p.{c} + {share} * (e.q.{c} - e.p.{c}), s.{c})"

    step = _struct({"done": "s.done + e.d", "x": at("x"), "y": at("y")})
    start = "named_struct('done', 0d, 'x', cast(null as double), 'y', cast(null as double))"
    last = _struct({c: f"coalesce(s.{c}, pts[size(pts) - 1].{c})" for c in ("x", "y")})
    walk = f"aggregate({_edges('pts', edge)}, {start}, (s, e) -> {step}, s -> {last})"
    half = _bind(f"{_length_text('pts')} / 2", "half", walk)
    return F.expr(_bind(line, "pts", f"if(size(pts) > 0, {half}, null)"))
