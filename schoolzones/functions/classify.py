"""Classes, bins and index formulas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from . import constants as K
from .text import as_col, as_flag, flags_to_code, no_nan, round_half_even


def locale_class(code: Column | str) -> Column:
    c = as_col(code)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, low, high in K.LOCALE_BANDS:
        out = out.when(c.between(low, high), name)
    return out.otherwise(K.UNKNOWN_LOCALE)


def share_gap(part: Column | str, part_total: Column | str, whole: Column | str, whole_total: Column | str) -> Column:
    """Share in the part minus share in the whole; 0 where the part is empty."""
    part, part_total, whole, whole_total = (
        no_nan(as_col(c).cast("double")) for c in (part, part_total, whole, whole_total)
    )
    return F.when(part_total == 0, F.lit(0.0)).otherwise(
        F.try_divide(part, part_total) - F.try_divide(whole, whole_total)
    )


def rounded_share_gap(part, part_total, whole, whole_total, digits: int = 3) -> Column:
    """Share gap that is NULL for an empty part or whole; half-even rounding."""
    gap = F.try_divide(as_col(part), as_col(part_total)) - F.try_divide(as_col(whole), as_col(whole_total))
    return round_half_even(gap, digits)


def ri_category(ri: Column | str, limit: float = K.RI_LIMIT) -> Column:
    v = no_nan(ri)
    return (
        F.when(v.isNull(), "Missing")
        .when(v > limit, "Overrepresented")
        .when(v < -limit, "Underrepresented")
        .otherwise("Parity")
    )


def modality_class(code: Column | str) -> Column:
    c = as_col(code)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for prefix, name, _, _ in K.MODALITIES:
        out = out.when(c.startswith(prefix), name)
    return out.otherwise(K.NO_MODALITY[0])


def modality_marker(code: Column | str, prefixes: Sequence[str] | None = None) -> Column:
    """Marker of a logic code; codes outside ``prefixes`` (default: all) are ``Other``."""
    c = as_col(code)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for prefix, suffix, marker, *_ in K.MARKERS:
        if prefixes is None or prefix in prefixes:
            out = out.when(c.startswith(prefix) & c.endswith(suffix), marker)
    return out.otherwise(K.OTHER_MARKER)


def range_bins(c: Column | str, ranges, otherwise: str | None = None) -> Column:
    """Label of the first closed range holding the value; None is an open bound.

    Values in no range, and NULL, get ``otherwise``.
    """
    v = no_nan(as_col(c).cast("double"))
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for low, high, label in ranges:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (v >= low)
        if high is not None:
            inside = inside & (v <= high)
        out = out.when(inside, label)
    return out.otherwise(F.lit(otherwise).cast("string"))


def touching_ranges(edges: Sequence[float], labels: Sequence[str]):
    return list(zip(edges[:-1], edges[1:], labels))


def cut_bins(c: Column | str, edges: Sequence[float], include_lowest: bool = False) -> Column:
    """Number of the right-closed bin ``(a, b]``; outside is NULL."""
    v = no_nan(as_col(c).cast("double"))
    above_low = v >= edges[0] if include_lowest else v > edges[0]
    number = sum((F.when(v > e, 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    return F.when(above_low & (v <= edges[-1]), number)


def population_ratio(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(as_col(part), as_col(whole))


def miles_to_metres(c: Column | str) -> Column:
    return as_col(c) * F.lit(K.METRES_PER_MILE)


def course_logic(approved: Column, certificate: Column) -> Column:
    return flags_to_code(as_flag(approved), as_flag(certificate.isNotNull()))
