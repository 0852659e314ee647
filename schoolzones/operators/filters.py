"""Row filters. A condition that is NULL drops the row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import constants as K, geo, text
from ..sources import polygons


def grade_span(column: Column | str, low: float = K.LOWEST_GRADE, high: float = K.HIGHEST_GRADE) -> Column:
    """No numeric token below ``low`` and at least one within ``low..high``."""
    tokens = text.grade_tokens(text.as_col(column))

    def some(test):
        def holds(token):
            number = F.when(token.rlike(K.GRADE_NUMBER), token.try_cast("double"))
            return F.coalesce(test(number), F.lit(False))

        return F.coalesce(F.exists(tokens, holds), F.lit(False))

    return ~some(lambda n: n < low) & some(lambda n: n.between(low, high))


def filter_grade_span(df: DataFrame, column: str, low=K.LOWEST_GRADE, high=K.HIGHEST_GRADE) -> DataFrame:
    return df.filter(grade_span(column, low, high))


def ilike_any(patterns: Mapping[str, Sequence[str]]) -> Column:
    """True where any column matches any of its patterns, case ignored; NULL does not match."""
    tests = [F.col(c).ilike(p) for c, ps in patterns.items() for p in ps]
    return F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests]), F.lit(False))


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with NULL or NaN in any of the columns (default: all)."""
    return df.dropna(subset=list(columns) if columns else None)


def points_in_box(df: DataFrame, lon: str, lat: str, box=K.REGION_BOX) -> DataFrame:
    return df.filter(geo.in_box(lon, lat, box))


def polygons_in_box(df: DataFrame, rings: str, box=K.REGION_BOX) -> DataFrame:
    """Polygons that meet the box; of a stored polygon table only the row groups near it are read."""
    return polygons.touching(df, box, rings)


def classified(df: DataFrame, column: str, besides: str | None = None) -> DataFrame:
    """Rows that have a class, other than ``besides``."""
    keep = F.col(column).isNotNull()
    return df.filter(keep if besides is None else keep & (F.col(column) != besides))
