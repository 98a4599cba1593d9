"""Streams: duplicates suppressed by fingerprint with durable state, and tails of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def tail(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """New files of JSON lines as a stream; the checkpoint remembers what was read."""
    return spark.readStream.schema(schema).json(path)


def first_seen(stream: DataFrame, keys: list[str], time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """One row per key, the first to arrive. With a time column the state of keys older than the delay goes."""
    if time:
        return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs a stream over all that is there now, writes Parquet, and reads it back."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path)
