"""Live fan-out: one envelope for each event and cell resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotide import codes
from geotide.functions import cells
from geotide.schemas import WIRE_NAMES


def wire(df: DataFrame) -> DataFrame:
    """Columns under the short names that consumers know; times as milliseconds."""
    out = []
    for name, kind in df.dtypes:
        c = F.unix_millis(name) if kind == "timestamp" else F.col(name)
        out.append(c.alias(WIRE_NAMES.get(name, name)))
    return df.select(*out)


def to_json(df: DataFrame) -> DataFrame:
    """(data): each row as the JSON text that goes on the bus."""
    w = wire(df)
    return w.select(F.to_json(F.struct(*w.columns)).alias("data"))


def fan_out(events: DataFrame, prefix: str, resolutions: list[int], data: str = "data", cell: str = "h3_cell") -> DataFrame:
    """(other columns..., res, stream): the event once a resolution, on the stream of its ancestor cell.

    An event without a valid cell drops alone.
    """
    out = events.filter(F.col(cell).isNotNull() & (F.col(cell) > 0)).withColumn("res", F.explode(F.array(*[F.lit(r) for r in resolutions])))
    return out.withColumn("stream", F.concat(F.lit(prefix), cells.cell_hex(cells.parent(F.col(cell), F.col("res")))))


def telemetry(events: DataFrame, **names: str) -> DataFrame:
    return fan_out(events, "telemetry:", codes.TELEMETRY_RESOLUTIONS, **names)


def bgp(events: DataFrame, **names: str) -> DataFrame:
    return fan_out(events, "bgp:", codes.BGP_RESOLUTIONS, **names)


def envelopes(fanned: DataFrame, channel: str = "__anycable__") -> DataFrame:
    """(channel, body): what a live-update gateway takes from the bus, from rows with ``stream`` and ``data``."""
    return fanned.select(F.lit(channel).alias("channel"), F.to_json(F.struct("stream", "data")).alias("body"))


def messages(events: DataFrame, subject: str) -> DataFrame:
    """(channel, body): each event as JSON on one subject."""
    return to_json(events).select(F.lit(subject).alias("channel"), F.col("data").alias("body"))
