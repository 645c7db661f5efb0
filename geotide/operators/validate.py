"""Event validation: the first failing rule is the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _reason(id_col: str, kind_col: str, lat: str, lon: str, time_millis: Column) -> Column:
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    y, x = F.coalesce(F.col(lat), F.lit(0)), F.coalesce(F.col(lon), F.lit(0))
    return (
        F.when(empty(id_col), f"empty {id_col}")
        .when(empty(kind_col), f"empty {kind_col}")
        .when(empty("source"), "empty source")
        .when((y == 0) & (x == 0), "null island coordinates (0,0)")
        .when(F.abs(y) > 900_000_000, "latitude out of range")
        .when(F.abs(x) > 1_800_000_000, "longitude out of range")
        .when(F.coalesce(time_millis, F.lit(0)) <= 0, "invalid timestamp")
    )


def telemetry_reason(time_millis: Column | None = None) -> Column:
    """Why a telemetry event is rejected; null if it is valid.  Positions are scaled integers (any width)."""
    return _reason("asset_id", "asset_type", "lat", "lon", F.unix_millis("event_time") if time_millis is None else time_millis)


def bgp_reason(time_millis: Column | None = None) -> Column:
    return _reason("event_id", "category", "lat", "lon", F.unix_millis("event_time") if time_millis is None else time_millis)


def valid_telemetry(df: DataFrame) -> DataFrame:
    return df.filter(telemetry_reason().isNull())


def valid_bgp(df: DataFrame) -> DataFrame:
    return df.filter(bgp_reason().isNull())
