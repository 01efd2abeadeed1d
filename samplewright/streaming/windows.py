"""Windowed counts over an event stream; the same plan serves bounded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, ts: str, width: str, by: str, value: str, late: str | None = None) -> DataFrame:
    """start, by, n and total of each window and group. On a stream, `late` is how far behind the newest event one may be."""
    rows = events.withWatermark(ts, late) if late and events.isStreaming else events
    grouped = rows.groupBy(F.window(ts, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return grouped.select(F.col("w.start").alias("start"), by, "n", "total")
