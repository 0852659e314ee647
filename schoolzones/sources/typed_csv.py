"""CSV with inferred types; rows that don't fit go to a quarantine, not to NULL.

The text is parsed once and stored as text columns. One pass then counts, for every column, how many values each type
can hold; such counts are plain sums, so those of several files or days add up (``merged``). A column gets the narrowest
type that holds all its values, or all but a given share. Then a row is quarantined if it had too few or too many fields,
or a value that its column's type can't hold, with the reason and its text.

Whole numbers are long (leading zeros are dropped, as the first part of a number's text is no sign of a code), other
numbers double, then boolean, date, timestamp and string. Missing values are the usual marks (``MISSING``) and empty
fields; a column without any value is string.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import fixed

#: Texts that mean no value.
MISSING = ("", "#N/A", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Narrowest first; a type is tried only where the ones before don't hold all values.
TYPES = ("long", "double", "boolean", "date", "timestamp")
_BROKEN = "_broken"


def _missing(value: Column, marks: Sequence[str]) -> Column:
    return value.isNull() | F.trim(value).isin(*marks)


def _as(value: Column, kind: str) -> Column:
    """The value as that type; NULL if its text isn't one."""
    text = F.trim(value)
    return {
        "long": lambda: F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long")),
        "double": lambda: F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double")),
        "boolean": lambda: F.when(F.lower(text).isin("true", "false"), F.lower(text).try_cast("boolean")),
        "date": lambda: F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), text.try_cast("date")),
        "timestamp": lambda: F.when(text.rlike(r"^\d{4}-\d\d-\d\d([ T]\d\d:\d\d(:\d\d(\.\d+)?)?)?$"), text.try_cast("timestamp_ntz")),
        "string": lambda: value,
    }[kind]()


def read_text(spark: SparkSession, path: str, **options) -> DataFrame:
    """All columns as text, stored, with the whole line in ``_broken`` where it has too few or too many fields."""
    reader = spark.read.options(header=True, mode="PERMISSIVE", **options)
    names = reader.csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in (*names, _BROKEN)])
    return fixed(reader.schema(schema).option("columnNameOfCorruptRecord", _BROKEN).csv(path))


def profile(raw: DataFrame, missing: Sequence[str] = MISSING) -> DataFrame:
    """(column, position, n_values, n_long, n_double, ...): how many of the values each type can hold; one pass."""
    names = [c for c in raw.columns if c != _BROKEN]
    whole = raw.filter(F.col(_BROKEN).isNull()) if _BROKEN in raw.columns else raw

    def counts(position: int, name: str) -> Column:
        value = F.col(f"`{name}`")
        there = ~_missing(value, missing)
        fits = [F.count_if(there & _as(value, kind).isNotNull()).alias(f"n_{kind}") for kind in TYPES]
        return F.struct(F.lit(name).alias("column"), F.lit(position).alias("position"), F.count_if(there).alias("n_values"), *fits)

    return whole.agg(F.array(*[counts(i, c) for i, c in enumerate(names)]).alias("all")).select(F.inline("all"))


def merged(profiles: Sequence[DataFrame]) -> DataFrame:
    """The profile of all rows together. A column that one of them lacks counts as missing there."""
    stacked = reduce(DataFrame.unionByName, profiles)
    sums = [F.sum(c).alias(c) for c in stacked.columns if c.startswith("n_")]
    return stacked.groupBy("column").agg(F.min("position").alias("position"), *sums)


def types(found: DataFrame, tolerance: float = 0.0) -> dict[str, str]:
    """The narrowest type of each column that holds all but a share ``tolerance`` of its values."""
    out = {}
    for row in found.orderBy("position", "column").collect():  # one row per column
        most = row["n_values"] * (1 - tolerance)
        fitting = [k for k in TYPES if row["n_values"] and row[f"n_{k}"] >= most]
        out[row["column"]] = fitting[0] if fitting else "string"
    return out


@dataclass(frozen=True)
class Scan:
    """``rows`` are typed; ``quarantined`` has (reason, column, record), one row for each row left out."""

    types: dict[str, str]
    rows: DataFrame
    quarantined: DataFrame


def typed(raw: DataFrame, kinds: dict[str, str], missing: Sequence[str] = MISSING) -> Scan:
    """Split stored text rows into typed and quarantined ones. Columns without a type stay text, absent ones are NULL."""
    names = [c for c in raw.columns if c != _BROKEN]
    broken = F.col(_BROKEN) if _BROKEN in raw.columns else F.lit(None).cast("string")
    value = lambda c: F.when(~_missing(F.col(f"`{c}`"), missing), F.col(f"`{c}`"))
    wrong = [
        F.when(value(c).isNotNull() & _as(value(c), kinds[c]).isNull(), F.lit(c))
        for c in names
        if kinds.get(c, "string") != "string"
    ]
    judged = raw.withColumn("_wrong", F.coalesce(*wrong) if wrong else F.lit(None).cast("string"))
    record = F.coalesce(broken, F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names])))
    reason = F.when(broken.isNotNull(), "fields").when(F.col("_wrong").isNotNull(), "value")
    left_out = judged.select(
        reason.alias("reason"), F.when(broken.isNull(), F.col("_wrong")).alias("column"), record.alias("record")
    ).filter(F.col("reason").isNotNull())
    columns = [_as(value(c), kinds.get(c, "string")).alias(c) for c in names]
    absent = [
        F.lit(None).cast("timestamp_ntz" if k == "timestamp" else k).alias(c) for c, k in kinds.items() if c not in names
    ]
    return Scan(kinds, judged.filter(reason.isNull()).select(*columns, *absent), left_out)


def scan(
    spark: SparkSession, path: str, tolerance: float = 0.0, missing: Sequence[str] = MISSING, **options
) -> Scan:
    """Read CSV with a header. ``tolerance``: the share of values that may miss their column's type and be quarantined."""
    raw = read_text(spark, path, **options)
    return typed(raw, types(profile(raw, missing), tolerance), missing)
