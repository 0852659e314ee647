import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from schoolzones.catalog import streams
from schoolzones.session import scratch_path
from schoolzones.sources import versions
from schoolzones.streaming import runs


@pytest.fixture
def events(spark):
    rows = [(i, None, i % 150, ["view", "error", "click"][i % 3], float(i % 400) if i % 11 else None, "{}") for i in range(900)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")


@pytest.fixture
def landed(spark, events):
    folder = scratch_path(spark, "arriving")
    for k in range(6):  # files in order
        events.filter(F.floor(F.col("event_id") / 150) == k).coalesce(1).write.mode("append").parquet(folder)
    return folder


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def failing(work, column="event_id"):
    """``work`` that breaks down when it meets a later row."""
    bad = F.when(F.col(column) == 500, F.raise_error(F.lit("power cut"))).cast("long")
    return lambda df: work(df.withColumn(column, F.coalesce(bad, F.col(column))))


def test_rows_after_a_stop_and_a_restart(spark, events, landed):
    path, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "progress")
    stream = lambda: runs.arriving(spark, landed, events.schema, 1)
    with pytest.raises(PySparkException):
        runs.append_rows(stream(), failing(streams.cleaned), path, checkpoint)
    want = rows(streams.cleaned(events))
    half = rows(spark.read.parquet(path))
    assert 0 < len(half) < len(want) and set(half) < set(want)
    runs.append_rows(stream(), streams.cleaned, path, checkpoint)
    assert rows(spark.read.parquet(path)) == want
    runs.append_rows(stream(), streams.cleaned, path, checkpoint)  # nothing new has come
    assert rows(spark.read.parquet(path)) == want


def test_totals_after_a_stop_between_table_and_checkpoint(spark, events, landed, monkeypatch):
    path, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "progress")
    stream = lambda: runs.arriving(spark, landed, events.schema, 2)
    replace, done = versions.replace, []

    def stored_then_stopped(df, where):
        replace(df, where)
        done.append(1)
        if len(done) == 2:
            raise RuntimeError("power cut")

    with monkeypatch.context() as m, pytest.raises(PySparkException):
        m.setattr(versions, "replace", stored_then_stopped)
        runs.running_totals(stream(), streams.totals, path, checkpoint)
    assert len(done) == 2
    runs.running_totals(stream(), streams.totals, path, checkpoint)
    assert rows(versions.read(spark, path)) == rows(streams.totals(events))
    extra = events.filter("event_id < 40").withColumn("event_id", F.col("event_id") + 5000)
    extra.write.mode("append").parquet(landed)
    runs.running_totals(stream(), streams.totals, path, checkpoint)
    assert rows(versions.read(spark, path)) == rows(streams.totals(events.union(extra)))
