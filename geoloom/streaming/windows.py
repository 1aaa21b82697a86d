"""Arriving documents and events: sliding counts with late data, first-wins identities, freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(df: DataFrame, time: str) -> DataFrame:
    """Event time as a timestamp with the session's zone; watermarks take no other."""
    return df.withColumn(time, F.col(time).cast("timestamp"))


def recent_signals(events: DataFrame, time: str, key: str, length: str = "183 days", slide: str = "1 day", late: str = "7 days") -> DataFrame:
    """Counts of each key in sliding windows; events later than the watermark are left out, as state is dropped then."""
    w = _timed(events, time).withWatermark(time, late).groupBy(F.window(time, length, slide), key).agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n")


def first_seen(docs: DataFrame, time: str, sha: str, late: str = "7 days") -> DataFrame:
    """Each content once within the watermark, however often it arrives."""
    return _timed(docs, time).withWatermark(time, late).dropDuplicatesWithinWatermark([sha])


def coverage_stream(cells: DataFrame) -> DataFrame:
    """Running counts of statuses by layer."""
    return cells.groupBy("layer", "status").agg(F.count("*").alias("n"))
