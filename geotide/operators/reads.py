"""Reads of the stored tables: recency, viewport, retention, orbit ticks, snapshot comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotide import codes
from geotide.functions import cells, orbit
from geotide.operators import lookup


def recent(df: DataFrame, now: Column, minutes: int = 15, limit: int = 1000, order: tuple[str, ...] = ("asset_type", "asset_id")) -> DataFrame:
    """Rows of the last minutes, newest first, at most ``limit`` (the feature: a screenful)."""
    fresh = df.filter(F.col("event_time") >= now - F.expr(f"interval {minutes} minutes"))
    return fresh.orderBy(F.col("event_time").desc(), *order).limit(limit)


def in_viewport(df: DataFrame, cells_seen: DataFrame, res: int) -> DataFrame:
    """Rows whose ancestor cell is among the viewport's (a few hundred cells, broadcast after a count says so)."""
    return df.withColumn("_p", cells.parent(F.col("h3_cell"), res)).join(lookup.small(cells_seen.select(F.col("cell").alias("_p"))), "_p", "left_semi").drop("_p")


def within_ttl(df: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    return df.filter(F.col("event_time") >= now - F.expr(f"interval {hours} hours"))


def maneuvers(snapshots: DataFrame) -> DataFrame:
    """Element sets that moved since the fetch right before theirs; needs norad_id, fetch_no, period_minutes, inclination."""
    w = Window.partitionBy("norad_id").orderBy("fetch_no")
    before = F.lag(F.struct("fetch_no", "period_minutes", "inclination")).over(w)
    out = snapshots.withColumn("_b", before)
    moved = orbit.maneuvered(F.col("period_minutes"), F.col("_b.period_minutes"), F.col("inclination"), F.col("_b.inclination"))
    return out.filter((F.col("_b.fetch_no") == F.col("fetch_no") - 1) & moved).drop("_b")


def of_regime(elements: DataFrame, regime: str) -> DataFrame:
    """Element sets of one regime, each of which is propagated at its own pace."""
    if regime not in codes.TICK_SECONDS:
        raise ValueError(f"unknown regime {regime!r}: must be one of {', '.join(codes.TICK_SECONDS)}")
    return elements.filter(F.col("orbit_regime") == regime)


def ticks(elements: DataFrame, start: Column, end: Column) -> DataFrame:
    """Each element set once for each tick of its regime in [start, end]: adds tick_time."""
    step = F.when(F.lit(False), F.expr("interval 1 seconds"))
    for name, seconds in codes.TICK_SECONDS.items():
        step = step.when(F.col("orbit_regime") == name, F.expr(f"interval {seconds} seconds"))
    return elements.withColumn("tick_time", F.explode(F.sequence(start, end, step)))


def positions(elements: DataFrame, now: Column) -> DataFrame:
    """Propagated positions; needs mean_motion .. bstar and epoch.  Rows the kernel doesn't cover have null positions."""
    cols = ["mean_motion", "eccentricity", "inclination", "raan", "arg_perigee", "mean_anomaly", "bstar"]
    p = orbit.propagate(*[F.col(c).cast("double") for c in cols], F.unix_millis("epoch"), F.unix_millis(now))
    return elements.withColumn("_p", p).select(*elements.columns, "_p.lat", "_p.lon", "_p.alt_km")
