"""Five-minute counts by cell: additive partials, re-summed on read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def density(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    """(time_bucket, h3_cell, asset_type, cnt) of one batch."""
    by = events.groupBy(F.window("event_time", width).alias("w"), "h3_cell", "asset_type")
    return by.agg(F.count("*").alias("cnt")).select(F.col("w.start").alias("time_bucket"), "h3_cell", "asset_type", "cnt")


def merge(partials: DataFrame) -> DataFrame:
    return partials.groupBy("time_bucket", "h3_cell", "asset_type").agg(F.sum("cnt").alias("cnt"))
