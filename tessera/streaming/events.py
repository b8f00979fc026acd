"""Streams over event files: windows with watermarks, dedupe, and change-driven work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str, like: DataFrame, per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def _marked(events: DataFrame, time: str, late: str | None) -> DataFrame:
    """The events with an instant as their time and, in a stream, a watermark."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, late) if events.isStreaming and late else timed


def tumbling(events: DataFrame, size: str = "1 day", late: str | None = "1 day", time: str = "ts") -> DataFrame:
    """(start, event_type, n, total) by windows; the same for batches and streams."""
    marked = _marked(events, time, late)
    return marked.groupBy(F.window(time, size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str, step: str, late: str | None = "1 day", time: str = "ts") -> DataFrame:
    marked = _marked(events, time, late)
    return marked.groupBy(F.window(time, size, step).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "6 hours", late: str | None = "1 day", time: str = "ts") -> DataFrame:
    """(user_id, start, end, n): a user's events without a longer pause."""
    marked = _marked(events, time, late)
    return marked.groupBy("user_id", F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def once(events: DataFrame, keys: list[str], late: str = "1 day", time: str = "ts") -> DataFrame:
    """Each key once; in a stream, within the watermark."""
    return _marked(events, time, late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def drain(stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]) -> None:
    """Works off what has come since the last call, exactly where the checkpoint left off; one run a checkpoint."""
    stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def drain_to(stream: DataFrame, checkpoint: str, path: str, mode: str = "append") -> None:
    """Appends what has come to a table of files."""
    stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start().awaitTermination()
