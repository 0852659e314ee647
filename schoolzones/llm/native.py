"""Small column helpers that stay inside Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, or one made from it, that is no column of these."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(*values: Column) -> Column:
    """32 bytes that differ where the values do (but for a collision of SHA-256); NULL is a value of its own."""
    texts = [x for v in values for x in (F.isnull(v).cast("string"), F.sha2(F.coalesce(v.cast("string"), F.lit("")), 256))]
    return F.unhex(F.sha2(F.concat(*texts), 256))
