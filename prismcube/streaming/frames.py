"""Structured Streaming over packet-like events: an extension, since the cube tools read whole files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums of events (ts, event_type, value) in windows; the same plan for a table and, with a watermark, for a stream."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    g = events.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.unix_timestamp(F.col("w.start")).alias("hour"), "event_type", "n", "total")


def follow(spark, path: str, schema) -> DataFrame:
    """A stream of the Parquet files that appear under a folder."""
    return spark.readStream.schema(schema).parquet(path)
