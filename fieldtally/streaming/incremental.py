"""Incremental runs: each input file once, state in the stream's checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_available(source: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> int:
    """Process what has arrived since the last run with this checkpoint, then
    stop; the number of input rows.  Two runs at once can't share a checkpoint."""
    query = source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    rows: dict[int, int] = {}
    ended = False
    while not ended:  # only the last reports are kept by a query, so they are read as it goes on
        ended = query.awaitTermination(1)
        rows |= {p["batchId"]: p["numInputRows"] for p in query.recentProgress}
    return sum(rows.values())


def parquet_stream(spark: SparkSession, path: str, schema, pattern: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that is safe to repeat: each batch replaces its own folder."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return sink


def first_in_stream(events: DataFrame, keys: Sequence[str], at: str, within: str = "2 hours") -> DataFrame:
    """The first row of each key to arrive, in a stream.

    A key is remembered until the watermark has passed its time by ``within``, so
    state doesn't grow with the stream; rows later than that are left out, and
    a key that comes again after it counts as new.  State is part of the stream's
    checkpoint: a restarted run still knows what earlier ones have seen.
    """
    return _timed(events, at).withWatermark(at, within).dropDuplicatesWithinWatermark(list(keys))


def _timed(events: DataFrame, at: str) -> DataFrame:
    """Watermarks need a time with a zone; one without is of the session's."""
    return events.withColumn(at, F.col(at).cast("timestamp")) if events.schema[at].dataType.typeName() == "timestamp_ntz" else events


def windowed_counts(events: DataFrame, at: str, group: Sequence[str], width: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Counts for each window of event time; rows later than ``late`` are left out
    when a stream runs, and state is dropped as the watermark passes."""
    return _timed(events, at).withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *group).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *group, "n")


def session_counts(events: DataFrame, at: str, group: Sequence[str], gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """``group``, ``start``, ``until`` (the last row's time and ``gap``) and ``n`` of each
    session: rows of a group that follow each other within ``gap``.  In a stream a
    session is given out once the watermark has passed its end."""
    return _timed(events, at).withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), *group).agg(F.count("*").alias("n")).select(*group, F.col("w.start").alias("start"), F.col("w.end").alias("until"), "n")


def is_new(listing: DataFrame, state: DataFrame) -> DataFrame:
    """Files newer than the high-water mark of an earlier run (an empty state has none)."""
    mark = state.agg(F.max("last_processed")).scalar()
    return listing.where(mark.isNull() | (F.col("modified") > mark))
