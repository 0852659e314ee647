"""Row-wise functions and aggregates over the events as files that arrive; the second half comes after a first run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import classify, geo, text
from ..operators import filters
from ..session import scratch_path
from ..sources import versions
from ..streaming import runs
from .base import query

EDGES = [0.0, 25.0, 50.0, 100.0, 1000.0]


def cleaned(events: DataFrame) -> DataFrame:
    """Keys, classes and places of the events that are not errors and lie in a box."""
    x, y = geo.mercator_xy("lon", "lat")
    placed = events.withColumn("lon", -85.5 + F.col("user_id") / 50).withColumn("lat", 32.0 + F.col("user_id") / 50)
    rows = placed.filter(F.col("event_type") != "error")
    return filters.points_in_box(rows, "lon", "lat").select(
        "event_id",
        text.composite_key("user_id", F.col("event_id") % 1000).alias("key"),
        text.zfill("event_type", 8).alias("kind"),
        classify.cut_bins("value", EDGES).cast("long").alias("value_class"),
        F.round(x, 3).alias("x"),
        F.round(y, 3).alias("y"),
    )


def totals(events: DataFrame) -> DataFrame:
    rows = events.withColumn("value_class", classify.cut_bins("value", EDGES).cast("long"))
    return rows.groupBy("event_type", "value_class").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("most"), F.min("ts").alias("since")
    )


def _in_two_runs(t, run) -> None:
    """Half of the events arrive and are read, then the others."""
    folder = scratch_path(t.spark, "arriving")
    events = t.events
    half = events.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0] or 0
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        events.filter(part).repartition(3).write.mode("append").parquet(folder)
        run(runs.arriving(t.spark, folder, events.schema, files_a_batch=2))


_CLASS = "case when value > 0 and value <= 1000 then (value > 25)::int + (value > 50)::int + (value > 100)::int end"


@query(
    "st1_streamed_rows",
    f"""
    select event_id, lpad(cast(user_id as varchar), 4, '0') || lpad(cast(event_id % 1000 as varchar), 4, '0') as key,
        lpad(event_type, 8, '0') as kind, ({_CLASS})::bigint as value_class,
        round(6378137.0::double * radians(-85.5 + user_id / 50), 3) as x,
        round(6378137.0::double * ln(tan(0.7853981633974483::double + radians(32.0 + user_id / 50) / 2)), 3) as y
    from events where event_type <> 'error'
        and -85.5 + user_id / 50 between -85.5 and -82.8 and 32.0 + user_id / 50 between 32.8 and 34.5
    """,
)
def _(t):
    path, checkpoint = scratch_path(t.spark, "streamed"), scratch_path(t.spark, "progress")
    _in_two_runs(t, lambda stream: runs.append_rows(stream, cleaned, path, checkpoint))
    return t.spark.read.parquet(path)


@query(
    "st2_running_totals",
    f"select event_type, ({_CLASS})::bigint as value_class, count(*) as n, max(value) as most, min(ts) as since from events group by all",
)
def _(t):
    path, checkpoint = scratch_path(t.spark, "totals"), scratch_path(t.spark, "progress")
    _in_two_runs(t, lambda stream: runs.running_totals(stream, totals, path, checkpoint))
    return versions.read(t.spark, path)
