"""Distance and nearest joins as equi joins on grid cells.

Points are two double columns in metres. The column names of both sides must differ.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import geo
from ..session import fixed

LEAF_PAIRS = 64  # row pairs of two cells that are compared one by one
FIRST = 4  # the first level: 16 by 16 cells, so at most 2^16 pairs of them
STEPS = (2, 1)  # levels from a cell to its parts, for few and for many open pairs: two cells have 256 or 16 pairs of parts
FEW = 20_000
DEEPEST = 40  # the finest cells are the extent over 2^40, about the digits of a coordinate
_LOWEST, _HIGHEST = -10, 1000  # cell sides of 2^-10 m up to beyond any finite distance


def _present(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows with a finite place."""
    return df.filter(f"abs({x}) < double('Infinity') and abs({y}) < double('Infinity')")


def distance_join(
    left: DataFrame,
    right: DataFrame,
    left_xy: Sequence[str] = ("x", "y"),
    right_xy: Sequence[str] = ("school_x", "school_y"),
    radius: str = "radius_m",
    out: str = "distance",
) -> DataFrame:
    """Pairs no further apart than the right row's radius (inclusive), with their distance.

    A right row goes to the cells its circle's box covers, on the grid whose cells are just
    wider than its radius (two or three cells each way); a left row goes to its own cell on
    each grid in use. So a pair meets once, small circles are tested against small cells, and
    Spark splits crowded cells by their left rows. Rows without finite coordinates, or without a
    radius, match nothing; an infinite radius reaches everything.
    """
    (lx, ly), (rx, ry) = left_xy, right_xy
    level = f"cast(greatest(least(coalesce(log2({radius}), {_LOWEST}), {_HIGHEST}), {_LOWEST}) + 0.999999999 as int)"
    usable = f"{radius} >= 0 and not isnan({radius})"
    circles = _present(right, rx, ry).filter(usable).selectExpr("*", f"{level} as _level")
    # One row per power of two, so a bounded number.
    levels = sorted(r[0] for r in circles.select("_level").distinct().collect()) or [0]

    def cell(value: str) -> str:
        return f"cast(floor(({value}) / pow(2d, _level)) as bigint)"

    # Rounding must not lose a pair on the rim.
    reach = f"(least({radius}, pow(2d, {_HIGHEST})) * (1 + 1e-9) + 1e-6)"

    def covered(c: str) -> str:
        return f"explode(sequence({cell(f'{c} - {reach}')}, {cell(f'{c} + {reach}')}))"

    spots = (
        _present(left, lx, ly)
        .selectExpr("*", f"explode(array({', '.join(map(str, levels))})) as _level")
        .selectExpr("*", f"{cell(lx)} as _cx", f"{cell(ly)} as _cy")
    )
    areas = circles.selectExpr("*", f"{covered(rx)} as _cx").selectExpr("*", f"{covered(ry)} as _cy")
    return (
        spots.join(areas, ["_level", "_cx", "_cy"])
        .withColumn(out, geo.distance(lx, ly, rx, ry))
        .filter(f"{out} <= {radius}")
        .drop("_level", "_cx", "_cy")
    )


_BOX = ("min_x", "min_y", "max_x", "max_y")
_LEFT_BOX = [f"l_{c}" for c in _BOX]
_RIGHT_BOX = [f"r_{c}" for c in _BOX]
_PAD = "* (1 + 1e-9) + 1e-6"  # keeps a bound a bound in spite of rounding


def _boxed(df: DataFrame, keys: Sequence[str], x: str, y: str, prefix: str, *more: str) -> DataFrame:
    """Bounding box of the points per key."""
    sides = [f"{c[:3]}({x if c.endswith('x') else y}) as {prefix}{c}" for c in _BOX]
    return df.groupBy(*keys).agg(*[F.expr(e) for e in (*sides, *more)])


def _hypot(dx: str, dy: str) -> str:
    return f"sqrt(pow({dx}, 2) + pow({dy}, 2))"


# Bounds of the distance between a point of the left box and one of the right box.
_FURTHEST = _hypot(*[f"greatest(l_max_{c} - r_min_{c}, r_max_{c} - l_min_{c})" for c in "xy"])
_CLOSEST = _hypot(*[f"greatest(0d, l_min_{c} - r_max_{c}, r_min_{c} - l_max_{c})" for c in "xy"])

# Whether cutting the two can tell more; not if both are single spots.
_APART = " or ".join(f"{s}_max_{c} > {s}_min_{c}" for s in "lr" for c in "xy")


def _text(value: float) -> str:
    return f"cast({value!r} as double)"


def _scaled(df: DataFrame, x: str, y: str, corner: tuple[float, float], extent: float) -> DataFrame:
    """``df`` with the place as shares ``_u``, ``_v`` of the extent; cells of any level come from these."""
    return df.selectExpr(
        "*", *[f"({c} - {_text(o)}) / {_text(extent)} as {n}" for c, o, n in ((x, corner[0], "_u"), (y, corner[1], "_v"))]
    )


def _cells(level: str, prefix: str) -> list[str]:
    """The cell of a place on a level with 2^level cells each way; levels are nested."""
    n = f"pow(2d, {level})"
    return [f"cast(least(floor({c} * {n}), {n} - 1) as bigint) as {prefix}{i}" for c, i in (("_u", "x"), ("_v", "y"))]


def _with_parent(cells: DataFrame, by: int, *columns: str) -> DataFrame:
    """Cells with the cell they are a part of, ``by`` levels up."""
    return cells.selectExpr("*", *[f"shiftright({c}, {by}) as {c}_up" for c in columns])


def _within(rows: DataFrame, cells: list[str], wanted: DataFrame) -> DataFrame:
    """The rows in wanted cells, with the columns of ``rows``."""
    kept = rows.selectExpr("*", *cells).join(wanted.distinct(), wanted.columns, "left_semi")
    return kept.select(*rows.columns)


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    left_xy: Sequence[str] = ("x", "y"),
    right_xy: Sequence[str] = ("school_x", "school_y"),
    out: str = "distance",
    reach: str | None = None,
) -> DataFrame:
    """Each left row with its nearest right row; ties go to the smallest right id.

    With ``reach`` (a radius column of ``right``) a left row prefers the nearest right row whose
    own radius covers it; only if there is none, the nearest of all. Both questions are answered
    side by side, as two classes of right rows: with their own radius, and with an endless one.

    Exact for any data. Left rows without a finite place, and all rows if ``right`` is empty, get
    NULLs. ``left`` is evaluated once, and dealt out anew: a left row meets many cells and places, and
    one small file of left rows would otherwise meet all of them in one task.
    """
    (lx, ly), (rx, ry) = left_xy, right_xy
    payload = [c for c in right.columns if c not in (right_id, rx, ry)]
    left = fixed(left.repartition(left_id, lx, ly))
    row = ", ".join([f"{right_id} as _id", *[f"{c} as {c}" for c in payload]])
    classes = ["struct('all' as _class, double('Infinity') as _reach)"]
    if reach:
        classes.append(f"struct('own' as _class, nanvl(cast({reach} as double), cast(null as double)) as _reach)")
    places = fixed(
        _present(right, rx, ry)
        .selectExpr(f"{rx} as _rx", f"{ry} as _ry", f"struct({row}) as _r", f"explode(array({', '.join(classes)})) as _c")
        .selectExpr("_c._class as _class", "_c._reach as _reach", "_rx", "_ry", "_r")
        .filter("_reach >= 0")
        .groupBy("_class", "_reach", "_rx", "_ry")  # equal places: the smallest id stays
        .agg(F.min("_r").alias("_r"))
    )
    spots = _present(left, lx, ly).selectExpr(f"{left_id} as _left", f"{lx} as _x", f"{ly} as _y")
    pairs = _nearest_pairs(spots, places.selectExpr("_class", "_reach", "_rx", "_ry", "_r._id as _id"))
    if pairs is None:
        nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in (right_id, rx, ry, *payload)]
        return left.select("*", *nothing, F.lit(None).cast("double").alias(out))

    # A task sorts what it met by left row and passes on one best row for each.
    best = (
        pairs.filter("_d <= _reach")
        .groupBy("_left")
        .agg(F.expr("min(struct(_class = 'all' as _any, _d, _id, _rx, _ry, _class, _reach)) as _b"))
        .selectExpr(f"_left as {left_id}", f"_b._id as {right_id}", f"_b._d as {out}", *[f"_b.{c}" for c in _PLACE])
    )
    if payload:  # only now: pairs carry no more than a place and its id
        best = best.join(places.select(*_PLACE, *[F.col("_r")[c].alias(c) for c in payload]), _PLACE)
    best = best.selectExpr(left_id, right_id, f"_rx as {rx}", f"_ry as {ry}", *payload, out)
    return left.join(best, left_id, "left")


_PLACE = ["_class", "_reach", "_rx", "_ry"]


def _nearest_pairs(spots: DataFrame, places: DataFrame) -> DataFrame | None:
    """Pairs of spots and places that contain the nearest place of each class within its reach, for each spot.

    Occupied cells are compared before rows, from a few large ones down to pairs of cells with few
    row pairs. In each round the pairs that still hold many are cut into parts on
    both sides. For a left cell and class the least "furthest distance" to a right cell, one of
    whose places reaches that far, is a bound: that place is in reach of every spot, and no further.
    Right cells beyond it, or beyond their own greatest reach, fall away, and so does the class
    without reach once the other has a bound. So only crowded spots go deeper, and a spot meets
    places of the few cells around it, however many there are and however their reaches are mixed.
    """
    s = (
        spots.selectExpr("_x as x", "_y as y", "false as r")
        .unionByName(places.selectExpr("_rx as x", "_ry as y", "true as r"))
        .selectExpr("count_if(r) as n", *[f"{f}({c}) as {f}_{c}" for f in ("min", "max") for c in ("x", "y")])
        .first()
    )
    if not s["n"]:
        return None
    corner, extent = (s["min_x"], s["min_y"]), max(s["max_x"] - s["min_x"], s["max_y"] - s["min_y"], 1e-300)
    if not math.isfinite(extent):
        raise ValueError("places are too far apart for distances")
    spots = fixed(_scaled(spots, "_x", "_y", corner, extent))
    places = fixed(_scaled(places, "_rx", "_ry", corner, extent))

    pair = ["_class", "_lx", "_ly", "_gx", "_gy", "_bound"]
    none = [f"0L as {c}" for c in pair[1:5]]
    open_ = places.select("_class").distinct().selectExpr("_class", *none, "double('Infinity') as _bound")
    left_open, right_open, done, levels, by = spots, places, [], [], FIRST
    while True:
        above = open_.selectExpr("_class", *[f"{c} as {c}_up" for c in pair[1:5]], "_bound")
        level = levels[-1] + by if levels else by
        levels.append(level)
        cells_l, cells_r = _cells(str(level), "_l"), _cells(str(level), "_g")
        parts_l = _boxed(
            left_open.selectExpr("_x", "_y", *cells_l), ["_lx", "_ly"], "_x", "_y", "l_", "count(1) as _rows"
        )
        parts_r = _boxed(
            right_open.selectExpr("_class", "_reach", "_rx", "_ry", *cells_r), ["_class", "_gx", "_gy"],
            "_rx", "_ry", "r_", "count(1) as _places", "max(_reach) as _most",
        )
        near = (
            above.join(_with_parent(parts_l, by, "_lx", "_ly"), ["_lx_up", "_ly_up"])
            .join(_with_parent(parts_r, by, "_gx", "_gy"), ["_class", "_gx_up", "_gy_up"])
            .selectExpr("*", f"{_CLOSEST} as _closest", f"{_FURTHEST} {_PAD} as _furthest")
            .filter(f"_closest <= least(_bound, _most {_PAD})")
            .selectExpr("*", "if(_furthest <= _most, least(_furthest, _bound), _bound) as _within")
            .selectExpr(
                "*",
                *[f"min(if(_class = '{c}', _within, null)) over (partition by _lx, _ly) as _{c}" for c in ("own", "all")],
            )
            .selectExpr("*", "if(_class = 'own', _own, _all) as _near")
            .filter("_closest <= _near and (_class = 'own' or coalesce(_own, double('Infinity')) = double('Infinity'))")
            .selectExpr(*pair[:5], "_near as _bound", *_RIGHT_BOX, "_rows * _places as _pairs", "_places", f"{_APART} as _apart")
        )
        near = fixed(near.selectExpr("*", f"{level} as _level"))
        many = f"_places > 1 and _apart and _pairs > {LEAF_PAIRS}" if level < DEEPEST else "false"
        done.append(near.filter(f"not ({many})"))
        open_ = near.filter(many).select(*pair)
        n_open = open_.count()
        if not n_open:
            break
        by = STEPS[n_open > FEW]
        # Only rows in cells of open pairs go on.
        left_open = fixed(_within(left_open, cells_l, open_.select("_lx", "_ly")))
        right_open = fixed(_within(right_open, cells_r, open_.select("_class", "_gx", "_gy")))

    # Rows. A spot is in one cell of each level.
    each_level = f"explode(array({', '.join(map(str, levels))})) as _level"
    to_box = _hypot(*[f"greatest(0d, r_min_{c} - _{c}, _{c} - r_max_{c})" for c in "xy"])
    asked = (
        spots.selectExpr("*", each_level)
        .selectExpr("_left", "_x", "_y", "_level", *_cells("_level", "_l"))
        .join(reduce(DataFrame.unionByName, done), ["_level", "_lx", "_ly"])
        .filter(f"{to_box} <= _bound")
        .select("_left", "_x", "_y", "_class", "_level", "_gx", "_gy")
    )
    targets = places.selectExpr("*", each_level).selectExpr(
        *_PLACE, "_id", "_level", *_cells("_level", "_g")
    )
    return asked.join(targets, ["_class", "_level", "_gx", "_gy"]).selectExpr(
        "_left", "_class", "_reach", f"{geo.distance_text('_x', '_y', '_rx', '_ry')} as _d", "_id", "_rx", "_ry"
    )
