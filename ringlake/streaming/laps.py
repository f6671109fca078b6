"""Streaming extension: windowed event counts with a watermark (the operators above are batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, time: str = "ts", by: str = "event_type", size: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Rows and value sums of each tumbling window and type; works on a batch or a stream."""
    e = events.withColumn("_t", F.col(time).cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark("_t", late)
    return e.groupBy(F.window("_t", size), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), by, "n", "total")
