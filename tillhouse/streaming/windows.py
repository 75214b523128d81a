"""Totals of events by windows and sessions, over tables and over streams of files.

The same plan runs on both.  On a stream, a watermark says how late a row may come: state older than that is dropped, and
rows that come later still are not counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tillhouse.sources.versions import BUCKETS, VersionedTable

Totals = Mapping[str, Column]


def stream_files(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """The Parquet files of a folder as a stream, oldest first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def window_totals(
    events: DataFrame, time: str, by: Sequence[str], totals: Totals, width: str, slide: str | None = None, late: str | None = None
) -> DataFrame:
    """``totals`` per key and window of ``width``, tumbling or, with ``slide``, sliding: ``window_start``, ``window_end``.

    Rows without a time belong to no window; a null key is a key.  ``late`` is the watermark of a stream.
    """
    timed = events.withWatermark(time, late) if late else events
    own = F.window(time, width, slide) if slide else F.window(time, width)
    found = timed.groupBy(own.alias("_window"), *by).agg(*(total.alias(name) for name, total in totals.items()))
    return found.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *by, *totals)


def session_totals(
    events: DataFrame, time: str, by: Sequence[str], totals: Totals, gap: str, late: str | None = None
) -> DataFrame:
    """``totals`` per key and session, which ends ``gap`` after its last row: ``session_start``, ``session_end``.

    A row at the very end of a session continues it.

    On a stream a session appears once the watermark has passed its end.
    """
    timed = events.withWatermark(time, late) if late else events
    key = F.struct(F.lit(0).alias("_one"), *by).alias("_key")  # one key for any number of columns
    found = timed.where(F.col(time).isNotNull()).groupBy(F.session_window(time, gap).alias("_session"), key)
    return found.agg(*(total.alias(name) for name, total in totals.items())).select(
        F.col("_session.start").alias("session_start"),
        F.col("_session.end").alias("session_end"),
        *(F.col(f"_key.{name}").alias(name) for name in by),
        *totals,
    )


def session_counts(events: DataFrame, time: str, by: Sequence[str], gap: str, span: str = "1 day") -> DataFrame:
    """Sessions of a table with their ``events``, for keys of any size.

    Sessions are first found within spans of time, so that a key with a third of all rows is dealt out by its spans; then
    those that continue one another are joined, of which there is one per key and span at most besides closed ones.
    """
    cut = events.withColumn("_span", F.window(time, span)["start"])
    parts = session_totals(cut, time, [*by, "_span"], {"events": F.count(F.lit(1))}, gap)
    order = Window.partitionBy(*by).orderBy("session_start")
    before = F.max("session_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("session_start") > before, F.lit(True)).cast("int")
    numbered = parts.withColumn("_begins", begins).withColumn("_number", F.sum("_begins").over(order))
    return (
        numbered.groupBy(*by, "_number")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("events").alias("events"),
        )
        .select("session_start", "session_end", *by, "events")
    )


def keep_merged(totals: DataFrame, table: VersionedTable, keys: Sequence[str], checkpoint: str, buckets: int = BUCKETS) -> None:
    """Merge the totals that change into a versioned table, until all files there now are read.

    A batch that is run again after a failure merges the same totals once more, which changes nothing.
    """
    if not table.versions():
        table.create(totals.sparkSession.createDataFrame([], totals.schema), keys, buckets)

    def merge(batch: DataFrame, number: int) -> None:
        table.merge(batch)

    _finish(totals.writeStream.outputMode("update").foreachBatch(merge), checkpoint)


def append_files(totals: DataFrame, folder: str, checkpoint: str) -> None:
    """Append the totals that are final to Parquet files, each once, until all files there now are read."""
    _finish(totals.writeStream.outputMode("append").format("parquet").option("path", folder), checkpoint)


def _finish(writer, checkpoint: str) -> None:
    running = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
