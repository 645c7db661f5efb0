"""Feed payloads (JSON text) to canonical events.

Every parser takes a DataFrame with a ``body`` string column and returns
canonical columns; a body that isn't the expected JSON yields no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotide import codes
from geotide.functions import cells, orbit, scalar
from geotide.operators import routing, validate

#: A state vector is positional and of mixed types: icao24, callsign, origin, lon, lat, altitude, ground flag, velocity, track, vertical rate, squawk, category.
_STATE = {"icao24": 0, "callsign": 1, "origin": 2, "lon": 5, "lat": 6, "alt": 7, "on_ground": 8, "velocity": 9, "track": 10, "rate": 11, "squawk": 14, "category": 16}


def _once(df: DataFrame, c: Column, name: str, *carry: str) -> DataFrame:
    """``carry`` and one computed column that later expressions refer to instead of repeating it: the optimizer doesn't inline across a generator."""
    return df.select(*carry, F.explode(F.array(c)).alias(name))


def _rows_of(df: DataFrame, *columns: Column) -> DataFrame:
    """Computed columns that filters after them read instead of computing them again."""
    return _once(df, F.struct(*columns), "e").select("e.*")


def _number(v: Column) -> Column:
    """A JSON number as double; strings, booleans and null are misses."""
    return F.when(F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(v, "$", "double"))


def _text(v: Column) -> Column:
    """A JSON string's content; other values are misses."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def adsb(df: DataFrame, source: str) -> DataFrame:
    """Aircraft from state-vector responses ``{time, states: [[...], ...]}``.

    Drops rows that aren't arrays of at least 17, aircraft on the ground, those
    without numeric position or without icao24, and what validation rejects.
    """
    parsed = _once(df, F.from_json("body", "time bigint, states array<variant>"), "r").filter("r is not null")
    rows = parsed.select(F.col("r.time").alias("time"), F.explode("r.states").alias("s"))
    rows = _once(rows, F.try_variant_get("s", "$", "array<variant>"), "v", "time").filter(F.size("v") >= 17)
    kind = lambda k: _number if k in ("lon", "lat", "alt", "velocity", "track", "rate", "category") else _text
    ground = F.schema_of_variant(F.col("v")[_STATE["on_ground"]]) == "BOOLEAN"
    values = {k: kind(k)(F.col("v")[i]) for k, i in _STATE.items() if k != "on_ground"}
    values["on_ground"] = F.when(ground, F.try_variant_get(F.col("v")[_STATE["on_ground"]], "$", "boolean"))
    rows = _once(rows, F.struct(*[c.alias(k) for k, c in values.items()]), "r", "time").select("time", "r.*")
    num = {k: F.col(k) for k in ("lat", "lon", "alt", "velocity", "track", "rate", "category")}
    rows = rows.filter(~F.coalesce(F.col("on_ground"), F.lit(False)) & num["lat"].isNotNull() & num["lon"].isNotNull())
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    text = lambda k: F.coalesce(F.col(k), F.lit(""))
    out = _rows_of(
        rows,
        F.timestamp_millis(F.col("time") * 1000).alias("event_time"), F.upper(text("icao24")).alias("asset_id"), F.lit("aircraft").alias("asset_type"),
        F.trim(text("callsign")).alias("callsign"), text("origin").alias("origin"), scalar.emitter_category(num["category"].cast("int")).alias("category"),
        scalar.scale_degrees(num["lat"]).alias("lat"), scalar.scale_degrees(num["lon"]).alias("lon"), F.coalesce(scalar.truncate(num["alt"]), F.lit(0)).alias("alt"),
        (zero(num["velocity"]) * codes.KNOTS).cast("float").alias("speed"), zero(num["track"]).cast("float").alias("heading"),
        zero(num["rate"]).cast("float").alias("vertical_rate"), cells.cell(num["lat"], num["lon"]).alias("h3_cell"), F.lit(source).alias("source"), text("squawk").alias("squawk"),
    )
    return validate.valid_telemetry(out.filter("h3_cell is not null"))


_REPORT = "Sog double, Cog double, TrueHeading int, Latitude double, Longitude double, NavigationalStatus int, RateOfTurn double"
_STATIC = (
    "ImoNumber bigint, CallSign string, Name string, Type int, Dimension struct<A: bigint, B: bigint, C: bigint, D: bigint>, "
    "Eta struct<Month: int, Day: int, Hour: int, Minute: int>, MaximumStaticDraught double, Destination string"
)
_VESSEL = (
    "MessageType string, MetaData struct<MMSI: bigint, ShipName: string, latitude: double, longitude: double, time_utc: string>, "
    f"Message struct<PositionReport: struct<{_REPORT}>, StandardClassBPositionReport: struct<{_REPORT}>, ShipStaticData: struct<{_STATIC}>>"
)


def ais(df: DataFrame, source: str) -> DataFrame:
    """Vessels from AIS envelopes: position reports of both classes and static reports; other messages drop.

    Position reports take the report's position, static reports the
    envelope's; (0, 0) is no position.  A missing number is 0, so a class-B
    report, which has no navigational status, shows status 0.
    """
    zero, blank = (lambda c: F.coalesce(c, F.lit(0))), (lambda c: F.coalesce(c, F.lit("")))
    m = _once(df, F.from_json("body", _VESSEL), "m").select("m.*")
    kind = F.col("MessageType")
    report = F.when(kind == "PositionReport", F.col("Message.PositionReport")).when(kind == "StandardClassBPositionReport", F.col("Message.StandardClassBPositionReport"))
    # in three steps, so that no generated method is too long for the JVM to compile
    m = _rows_of(
        m,
        scalar.feed_time(F.col("MetaData.time_utc")).alias("event_time"), zero(F.col("MetaData.MMSI")).cast("string").alias("asset_id"), F.trim(blank(F.col("MetaData.ShipName"))).alias("ship"),
        report.alias("p"), F.when(kind == "ShipStaticData", F.col("Message.ShipStaticData")).alias("s"), F.col("MetaData.latitude").alias("y"), F.col("MetaData.longitude").alias("x"),
    ).filter("event_time is not null and (p is not null or s is not null)")
    moving, e = F.col("p").isNotNull(), F.col("s.Eta")
    static = lambda c, other: F.when(moving, other).otherwise(c)
    dim = lambda k: static(scalar.wrap(zero(F.col(f"s.Dimension.{k}")), 16), F.lit(0)).cast("int").alias(f"dim_{k.lower()}")
    m = _rows_of(
        m,
        F.col("event_time"), F.col("asset_id"), F.when(~moving & (F.col("ship") == ""), F.trim(blank(F.col("s.Name")))).otherwise(F.col("ship")).alias("callsign"), F.col("p"),
        zero(F.when(moving, F.col("p.Latitude")).otherwise(F.col("y"))).alias("y"), zero(F.when(moving, F.col("p.Longitude")).otherwise(F.col("x"))).alias("x"),
        static(scalar.wrap(zero(F.col("s.ImoNumber")), 32), F.lit(0)).alias("imo_number"),
        static(scalar.ship_type(zero(F.col("s.Type"))), F.lit("")).alias("ship_type"), static(F.trim(blank(F.col("s.Destination"))), F.lit("")).alias("destination"),
        static(zero(F.col("s.MaximumStaticDraught")), F.lit(0.0)).cast("float").alias("draught"), *map(dim, "ABCD"),
        F.coalesce(static(scalar.eta(e["Month"], e["Day"], e["Hour"], e["Minute"]), F.lit("")), F.lit("")).alias("eta"),
    )
    lat, lon, heading = F.col("y"), F.col("x"), zero(F.col("p.TrueHeading"))
    out = _rows_of(
        m,
        F.col("event_time"), F.col("asset_id"), F.lit("vessel").alias("asset_type"), F.col("callsign"),
        scalar.scale_degrees(lat).alias("lat"), scalar.scale_degrees(lon).alias("lon"), F.lit(0).alias("alt"),
        F.when(moving, zero(F.col("p.Sog"))).otherwise(0).cast("float").alias("speed"),
        F.when(~moving, 0).when((heading >= 0) & (heading < 360), heading).otherwise(zero(F.col("p.Cog"))).cast("float").alias("heading"),
        cells.cell(lat, lon).alias("h3_cell"), F.lit(source).alias("source"),
        F.when(moving, scalar.nav_status(zero(F.col("p.NavigationalStatus")))).otherwise("").alias("nav_status"),
        *[F.col(c) for c in ("imo_number", "ship_type", "destination", "draught", "dim_a", "dim_b", "dim_c", "dim_d", "eta")],
        F.when(moving, zero(F.col("p.RateOfTurn"))).otherwise(0).cast("float").alias("rate_of_turn"),
    )
    return validate.valid_telemetry(out.filter("h3_cell is not null"))


_RIS = (
    "type string, data struct<timestamp: double, peer: string, peer_asn: string, id: string, host: string, type: string, path: array<string>, "
    "announcements: array<struct<next_hop: string, prefixes: array<string>>>, withdrawals: array<string>>"
)


def ris_operations(df: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Prefix operations of route-collector UPDATE messages; ``carry`` names columns to keep, such as an arrival number.

    Has event_time, collector, as_path, peer_as, prefix, op, a_no, p_no,
    origin_as (of a withdrawal: the peer), is_leak.
    """
    carry = carry or []
    m = _once(df, F.from_json("body", _RIS), "m", *carry).filter((F.col("m.type") == "ris_message") & (F.col("m.data.type") == "UPDATE"))
    m = m.select(
        *carry, F.timestamp_millis((F.col("m.data.timestamp") * 1000).cast("long")).alias("event_time"), F.col("m.data.host").alias("collector"),
        routing.flat_path(F.coalesce("m.data.path", F.array().cast("array<string>"))).alias("as_path"), scalar.asn(F.col("m.data.peer_asn")).alias("peer_as"),
        F.col("m.data.announcements").alias("announcements"), F.col("m.data.withdrawals").alias("withdrawals"),
    )
    ops = routing.operations(m)
    return ops.withColumn("origin_as", F.when(F.col("op") == "A", routing.origin(F.col("as_path"))).otherwise(F.col("peer_as"))).withColumn("is_leak", (F.col("op") == "A") & routing.leaks(F.col("as_path")))


OMM = (
    "OBJECT_NAME string, OBJECT_ID string, EPOCH string, MEAN_MOTION double, ECCENTRICITY double, INCLINATION double, RA_OF_ASC_NODE double, "
    "ARG_OF_PERICENTER double, MEAN_ANOMALY double, EPHEMERIS_TYPE int, CLASSIFICATION_TYPE string, NORAD_CAT_ID int, ELEMENT_SET_NO int, "
    "REV_AT_EPOCH int, BSTAR double, MEAN_MOTION_DOT double, MEAN_MOTION_DDOT double"
)


def omm(df: DataFrame, confidence: str = "official") -> DataFrame:
    """Element sets from OMM records (a DataFrame of schema ``OMM``), with derived parameters; sets without mean motion drop."""
    out = df.filter(F.col("MEAN_MOTION") > 0).select(
        F.col("NORAD_CAT_ID").cast("long").alias("norad_id"), F.col("OBJECT_NAME").alias("name"), F.to_timestamp("EPOCH").alias("epoch"),
        F.col("MEAN_MOTION").alias("mean_motion"), F.col("ECCENTRICITY").alias("eccentricity"), F.col("INCLINATION").alias("inclination"),
        F.col("RA_OF_ASC_NODE").alias("raan"), F.col("ARG_OF_PERICENTER").alias("arg_perigee"), F.col("MEAN_ANOMALY").alias("mean_anomaly"),
        F.col("BSTAR").alias("bstar"), F.lit(confidence).alias("confidence"),
    )
    return orbit.parameters(out)


def satellite_events(elements: DataFrame, now: Column) -> DataFrame:
    """Satellite telemetry at ``now`` from element sets (with optional ``maneuvering`` flag); uncovered orbits drop."""
    from geotide.operators import reads

    flag = F.col("maneuvering") if "maneuvering" in elements.columns else F.lit(False)
    p = reads.positions(elements.withColumn("_m", flag), now).filter("lat is not null")
    out = p.select(
        now.alias("event_time"), F.col("norad_id").cast("string").alias("asset_id"), F.lit("satellite").alias("asset_type"), F.col("name").alias("callsign"),
        scalar.scale_degrees(F.col("lat")).alias("lat"), scalar.scale_degrees(F.col("lon")).alias("lon"), scalar.truncate(F.col("alt_km") * 1000).alias("alt"),
        cells.cell(F.col("lat"), F.col("lon")).alias("h3_cell"), orbit.source_label(F.col("confidence")).alias("source"), "orbit_regime",
        orbit.confidence(F.col("confidence"), F.col("orbit_regime"), F.col("epoch"), now).alias("confidence"), F.col("epoch").alias("tle_epoch"),
        *[F.col(c).cast("float").alias(c) for c in ("inclination", "period_minutes", "apogee_km", "perigee_km")],
        orbit.status(F.col("_m"), F.col("perigee_km"), F.col("bstar")).alias("sat_status"),
    )
    return validate.valid_telemetry(out)
