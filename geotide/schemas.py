"""Canonical schemas, and the short names that live consumers know."""

from __future__ import annotations

from pyspark.sql import types as T

_TELEMETRY = (
    "event_time timestamp, asset_id string, asset_type string, callsign string, origin string, category string, lat int, lon int, "
    "alt int, speed float, heading float, vertical_rate float, h3_cell long, source string, squawk string, nav_status string, "
    "imo_number long, ship_type string, destination string, draught float, dim_a int, dim_b int, dim_c int, dim_d int, eta string, "
    "rate_of_turn float, orbit_regime string, confidence string, tle_epoch timestamp, inclination float, period_minutes float, "
    "apogee_km float, perigee_km float, sat_status string"
)
_BGP = (
    "event_time timestamp, event_id string, category string, prefix string, origin_as long, prefix_as long, prefix_org string, "
    "as_path array<long>, path_coords array<int>, collector string, lat int, lon int, h3_cell long, source string"
)
_TYPES = {
    "timestamp": T.TimestampType(), "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "array<long>": T.ArrayType(T.LongType()), "array<int>": T.ArrayType(T.IntegerType()),
}


def struct(ddl: str) -> T.StructType:
    """A schema from ``name type, ...``, without a running session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


TELEMETRY, BGP = struct(_TELEMETRY), struct(_BGP)

#: Columns that the latest-state table keeps of an asset, besides key and time; ship dimensions and ETA aren't among them.
LATEST = [f.name for f in TELEMETRY.fields if f.name not in ("event_time", "asset_id", "asset_type", "dim_a", "dim_b", "dim_c", "dim_d", "eta")]

#: long name -> short name on the wire, where they differ
WIRE_NAMES = {
    "event_time": "ts", "asset_id": "id", "event_id": "id", "asset_type": "type", "category": "cat", "speed": "spd", "heading": "hdg",
    "vertical_rate": "vr", "h3_cell": "h3", "source": "src",
}

#: Schema versions: what each added, so that older files read with the columns they lack as null.
VERSIONS = {
    1: ["event_time", "asset_id", "asset_type", "callsign", "lat", "lon", "alt", "speed", "heading", "h3_cell", "source"],
    3: ["origin", "category", "vertical_rate"],
    4: ["squawk", "nav_status", "imo_number", "ship_type", "destination", "draught", "dim_a", "dim_b", "dim_c", "dim_d", "eta", "rate_of_turn"],
    5: ["orbit_regime", "confidence", "tle_epoch", "inclination", "period_minutes", "apogee_km", "perigee_km"],
    6: ["sat_status"],
}


def at_version(n: int) -> T.StructType:
    """The telemetry schema as of a version, in canonical column order."""
    have = {c for v, cols in VERSIONS.items() if v <= n for c in cols}
    return T.StructType([f for f in TELEMETRY.fields if f.name in have])
