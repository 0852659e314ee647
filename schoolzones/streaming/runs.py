"""Runs over arriving files: each takes all that has come, ends, and a later one goes on where it stopped.

What has been read is noted in the run's checkpoint folder, so a run that ended half-way is simply started again. Row-wise
work (column functions, filters, joins with tables) is the same as on a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources import versions


def arriving(spark: SparkSession, folder: str, schema: StructType, files_a_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files that come into a folder."""
    reader = spark.readStream.schema(schema)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.parquet(folder)


def append_rows(stream: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """Store ``work`` of all rows that have come since the last run; every row once, whatever ended earlier runs.

    Spark's file sink notes which files count for each batch, and ``spark.read.parquet`` of ``path`` reads those only.
    """
    sink = work(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    sink.trigger(availableNow=True).start(path).awaitTermination()


def running_totals(stream: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """Bring a versioned table of group aggregates up to date with the rows that have come since the last run.

    ``work`` ends in a group aggregate, whose state lies in the checkpoint. Each batch replaces the whole result, so a
    batch that is done again after a stop changes nothing.
    """

    def store(rows: DataFrame, batch: int) -> None:
        versions.replace(rows, path)

    sink = work(stream).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).outputMode("complete")
    sink.trigger(availableNow=True).start().awaitTermination()
