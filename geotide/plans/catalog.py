"""Registered queries over the driver tables, each with its SQL.

The driver tables stand in for the feeds: ``events`` for telemetry and routing
operations, ``part`` for orbital elements, ``customer``/``orders`` for
dimensions.  Positions and prefixes are derived from ids, so both sides can
state them.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geotide import codes
from geotide.functions import cells, orbit, scalar
from geotide.operators import broadcast, density, dims, latest, lookup, reads, routing, validate
from geotide.sources import feeds, files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
NOW = "2024-01-30 00:00:00"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.strip()
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    """Events as telemetry: key (event type, user), scaled derived position, cell."""
    e = table(spark, sf, "events")
    lat, lon = (F.col("event_id") * 37 % 17000) / 100.0 - 85, (F.col("event_id") * 101 % 35000) / 100.0 - 175
    df = e.select(
        "event_id", F.col("ts").cast("timestamp").alias("event_time"), F.col("user_id").cast("string").alias("asset_id"), F.col("event_type").alias("asset_type"),
        F.col("value").alias("speed"), lat.alias("lat_deg"), lon.alias("lon_deg"), F.concat(F.lit("feed"), F.col("event_id") % 3).alias("source"),
        F.concat(F.lit("C"), F.col("event_id") % 1000).alias("callsign"),
    )
    df = df.withColumn("lat", scalar.scale_degrees(F.col("lat_deg"))).withColumn("lon", scalar.scale_degrees(F.col("lon_deg")))
    return df.withColumn("h3_cell", cells.cell(F.col("lat_deg"), F.col("lon_deg")))


def _cell_sql(lat: str, lon: str, res: int = 7) -> str:
    """The grid's cell id in SQL."""
    rows = cols = 1
    cuts = cells._cuts(res)
    for a, b in cuts:
        rows, cols = rows * a, cols * b
    y = f"least(floor(({lat}+90.0::DOUBLE)/180.0::DOUBLE*{cells.BASE_ROWS * rows}),{cells.BASE_ROWS * rows - 1})::BIGINT"
    x = f"least(floor(({lon}+180.0::DOUBLE)/360.0::DOUBLE*{cells.BASE_COLS * cols}),{cells.BASE_COLS * cols - 1})::BIGINT"
    parts = [f"{(1 << 59) | (res << 52)}::BIGINT", f"((({y})//{rows}*{cells.BASE_COLS}+({x})//{cols})<<45)"]
    for r, (a, b) in enumerate(cuts, 1):
        rows, cols = rows // a, cols // b
        parts.append(f"(((({y})//{rows})%{a}*{b}+(({x})//{cols})%{b})<<{3 * (15 - r)})")
    return "(" + "+".join(parts) + f"+{(1 << 3 * (15 - res)) - 1})"


def _parent_sql(cell: str, res: str) -> str:
    return f"((({cell}) & ~(15::BIGINT<<52)) | (({res})::BIGINT<<52) | ((1::BIGINT<<(3*(15-({res})))::INTEGER)-1))"


_T = f"""t AS (SELECT event_id, ts AS event_time, CAST(user_id AS VARCHAR) AS asset_id, event_type AS asset_type, value AS speed,
 ((event_id*37)%17000)/100.0::DOUBLE-85 AS lat_deg, ((event_id*101)%35000)/100.0::DOUBLE-175 AS lon_deg, 'feed'||(event_id%3) AS source, 'C'||(event_id%1000) AS callsign,
 CAST(round((((event_id*37)%17000)/100.0::DOUBLE-85)*1e7) AS INTEGER) AS lat, CAST(round((((event_id*101)%35000)/100.0::DOUBLE-175)*1e7) AS INTEGER) AS lon,
 {_cell_sql("(((event_id*37)%17000)/100.0::DOUBLE-85)", "(((event_id*101)%35000)/100.0::DOUBLE-175)")} AS h3_cell FROM events)"""
_MS = "epoch_us(event_time)//1000"
PAYLOAD = ["callsign", "lat", "lon", "speed", "source", "h3_cell"]


def _millis(df: DataFrame, *names: str) -> DataFrame:
    for n in names:
        df = df.withColumn(n, F.unix_millis(n))
    return df


_LATEST = f"""WITH {_T} SELECT asset_type, asset_id, {_MS} AS event_time, event_id, callsign, lat, lon, speed, source, h3_cell
FROM t QUALIFY row_number() OVER (PARTITION BY asset_type, asset_id ORDER BY t.event_time DESC, event_id DESC)=1"""


@query(_LATEST)
def latest_by_asset(spark, sf):
    return _millis(latest.latest(telemetry(spark, sf), PAYLOAD, "event_id"), "event_time")


def _days(spark, sf) -> DataFrame:
    """Partial states by day of arrival, as micro-batches leave them."""
    t = telemetry(spark, sf).withColumn("day", F.date_format("event_time", "yyyyMMdd"))
    return latest.partial(t, PAYLOAD, "event_id", ["day", *latest.KEYS])


@query(f"""WITH {_T} SELECT strftime(t.event_time,'%Y%m%d') AS day, asset_type, asset_id, {_MS} AS event_time, event_id, callsign, lat, lon, speed, source, h3_cell
FROM t QUALIFY row_number() OVER (PARTITION BY strftime(t.event_time,'%Y%m%d'), asset_type, asset_id ORDER BY t.event_time DESC, event_id DESC)=1""")
def latest_partial(spark, sf):
    return _millis(latest.flat(_days(spark, sf)), "event_time")


@query(_LATEST)
def latest_merge(spark, sf):
    return _millis(latest.flat(latest.merge(_days(spark, sf).drop("day"), "event_id")), "event_time")


_DENSITY = f"""WITH {_T} SELECT (epoch_us(time_bucket(INTERVAL '5 minutes', event_time))//1000) AS time_bucket, h3_cell, asset_type, count(*) AS cnt FROM t GROUP BY ALL"""


@query(_DENSITY)
def density_5min(spark, sf):
    return _millis(density.density(telemetry(spark, sf)), "time_bucket")


@query(_DENSITY)
def density_merge(spark, sf):
    t = telemetry(spark, sf)
    parts = [density.density(t.filter(F.col("event_id") % 4 == i)) for i in range(4)]
    return _millis(density.merge(dims.union_all(*parts)), "time_bucket")


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, (epoch_us(o_orderdate)//1000) AS o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY orders.o_orderdate DESC, o_orderkey DESC)=1""")
def dedup_latest_version(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("o_orderdate"))
    return dims.newest_version(o, ["o_custkey"], "o_orderdate", "o_orderkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_quantity DESC)=1""")
def dedup_last_row(spark, sf):
    return dims.newest_version(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), ["l_orderkey"], "l_linenumber", "l_partkey", "l_quantity")


@query("""SELECT c_custkey, c_name, CASE WHEN c_custkey%3=0 THEN 'img/'||c_custkey ELSE '' END AS image_url,
CASE WHEN c_custkey%3=0 THEN 'by '||c_name ELSE '' END AS image_attribution FROM customer""")
def carry_forward(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    old = c.filter("c_custkey % 3 = 0").select("c_custkey", F.concat(F.lit("img/"), "c_custkey").alias("image_url"), F.concat(F.lit("by "), "c_name").alias("image_attribution"))
    return dims.carry_forward(c, old, "c_custkey", ["image_url", "image_attribution"])


@query("""SELECT s_suppkey, CASE WHEN s_suppkey%2=0 THEN s_name||' v2' ELSE s_name END AS s_name, CASE WHEN s_suppkey%2=0 THEN 2 ELSE 1 END AS updated_at FROM supplier
UNION ALL SELECT s_suppkey+1000000, s_name, 2 FROM supplier WHERE s_suppkey%10=0""")
def dim_upsert(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.lit(1).alias("updated_at"))
    new = s.filter("s_suppkey % 2 = 0").select("s_suppkey", F.concat("s_name", F.lit(" v2")).alias("s_name"), F.lit(2).alias("updated_at"))
    fresh = s.filter("s_suppkey % 10 = 0").select((F.col("s_suppkey") + 1000000).alias("s_suppkey"), "s_name", F.lit(2).alias("updated_at"))
    return dims.upsert(s, new.unionByName(fresh), ["s_suppkey"])


_BROKEN = """b AS (SELECT event_id, CASE WHEN event_id%11=0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS k, CASE WHEN event_id%13=0 THEN '' ELSE event_type END AS kind,
 CASE WHEN event_id%17=0 THEN '' ELSE 'feed' END AS source,
 CASE WHEN event_id%19=0 THEN 0 WHEN event_id%23=0 THEN 910000000 ELSE 500000000 END AS lat, CASE WHEN event_id%19=0 THEN 0 WHEN event_id%29=0 THEN -1900000000 ELSE 70000000 END AS lon,
 CASE WHEN event_id%31=0 THEN 0 ELSE (epoch_us(ts)//1000) END AS ms FROM events)"""


def _reason_sql(key: str, kind: str) -> str:
    return f"""WITH {_BROKEN} SELECT event_id, CASE WHEN k='' THEN 'empty {key}' WHEN kind='' THEN 'empty {kind}' WHEN source='' THEN 'empty source'
WHEN lat=0 AND lon=0 THEN 'null island coordinates (0,0)' WHEN abs(lat)>900000000 THEN 'latitude out of range' WHEN abs(lon)>1800000000 THEN 'longitude out of range'
WHEN ms<=0 THEN 'invalid timestamp' ELSE 'ok' END AS reason FROM b"""


def _broken(spark, sf, key: str, kind: str) -> DataFrame:
    e = table(spark, sf, "events")
    hit = lambda n: F.col("event_id") % n == 0
    return e.select(
        "event_id", F.when(hit(11), "").otherwise(F.col("user_id").cast("string")).alias(key), F.when(hit(13), "").otherwise(F.col("event_type")).alias(kind),
        F.when(hit(17), "").otherwise("feed").alias("source"), F.when(hit(19), 0).when(hit(23), 910_000_000).otherwise(500_000_000).cast("long").alias("lat"),
        F.when(hit(19), 0).when(hit(29), -1_900_000_000).otherwise(70_000_000).cast("long").alias("lon"),
        F.when(hit(31), 0).otherwise(F.unix_millis(F.col("ts").cast("timestamp"))).alias("ms"),
    )


@query(_reason_sql("asset_id", "asset_type"))
def validate_reason(spark, sf):
    return _broken(spark, sf, "asset_id", "asset_type").select("event_id", F.coalesce(validate.telemetry_reason(F.col("ms")), F.lit("ok")).alias("reason"))


@query(_reason_sql("event_id", "category"))
def validate_reason_bgp(spark, sf):
    b = _broken(spark, sf, "key", "category").withColumnRenamed("event_id", "n").withColumnRenamed("key", "event_id")
    return b.select(F.col("n").alias("event_id"), F.coalesce(validate.bgp_reason(F.col("ms")), F.lit("ok")).alias("reason"))


@query(f"WITH {_T} SELECT event_id, lat, lon FROM t")
def scale_coords(spark, sf):
    return telemetry(spark, sf).select("event_id", "lat", "lon")


@query(f"WITH {_T} SELECT event_id, h3_cell, printf('%x', h3_cell) AS hex FROM t")
def cell_rows(spark, sf):
    return telemetry(spark, sf).select("event_id", "h3_cell", cells.cell_hex(F.col("h3_cell")).alias("hex"))


@query(f"WITH {_T} SELECT event_id, res, {_parent_sql('h3_cell', 'res')} AS parent, printf('%x', {_parent_sql('h3_cell', 'res')}) AS hex FROM t, range(2,8) r(res)")
def cell_parent(spark, sf):
    t = telemetry(spark, sf).select("event_id", "h3_cell", F.explode(F.sequence(F.lit(2).cast("long"), F.lit(7).cast("long"))).alias("res"))
    p = cells.parent(F.col("h3_cell"), F.col("res"))
    return t.select("event_id", "res", p.alias("parent"), cells.cell_hex(p).alias("hex"))


@query("""SELECT event_id, 'bgp-'||printf('%x', list_reduce(list_prepend(14695981039346656037::HUGEINT, [ord(c)::HUGEINT for c in string_split(
 (epoch_us(ts)//1000)||'|10.'||(user_id%256)||'.0.0/24|announcement|'||(event_id%7), '')]), lambda a, b: (xor(a, b)*1099511628211::HUGEINT) % 18446744073709551616::HUGEINT)) AS bgp_id FROM events""")
def event_id_fnv(spark, sf):
    e = table(spark, sf, "events")
    prefix = F.concat(F.lit("10."), F.col("user_id") % 256, F.lit(".0.0/24"))
    return e.select("event_id", scalar.routing_event_id(F.unix_millis(F.col("ts").cast("timestamp")), prefix, F.lit("announcement"), F.col("event_id") % 7).alias("bgp_id"))


@query("""SELECT event_id, upper(printf('a%05x', event_id % 65536)) AS asset_id, 'F'||(event_id%500) AS callsign, (epoch_us(date_trunc('second', ts))//1000) AS event_time,
 CAST(round((((event_id*37)%17000)/100.0::DOUBLE-85)*1e7) AS INTEGER) AS lat, CAST(round((((event_id*101)%35000)/100.0::DOUBLE-175)*1e7) AS INTEGER) AS lon,
 CAST(trunc((event_id%9000)+0.75) AS INTEGER) AS alt, round(CAST((event_id%300)*1.94384::DOUBLE AS FLOAT)::DOUBLE, 3) AS speed, CASE WHEN event_id%2=0 THEN '7700' ELSE '' END AS squawk,
 ['none','none','light','small','large','high_vortex_large','heavy','high_performance','rotorcraft','glider','lighter_than_air','parachutist','ultralight','reserved','uav','space','surface_emergency','surface_service','',''][(event_id%20)::INTEGER+1] AS category
FROM events WHERE event_id%5<>0 AND event_id%7<>0 AND NOT ((event_id*37)%17000=8500 AND (event_id*101)%35000=17500)""")
def adsb_parse(spark, sf):
    e = table(spark, sf, "events")
    i = F.col("event_id")
    lat, lon = (i * 37 % 17000) / 100.0 - 85, (i * 101 % 35000) / 100.0 - 175
    body = F.concat(
        F.lit('{"time":'), F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"), F.lit(',"states":[["'), F.format_string("a%05x", i % 65536), F.lit('"," F'), i % 500,
        F.lit(' ","Country '), i, F.lit('",1,2,'), F.when(i % 7 == 0, "null").otherwise(F.format_string("%.2f", lon)), F.lit(","), F.format_string("%.2f", lat), F.lit(","),
        F.concat((i % 9000).cast("string"), F.lit(".75")), F.when(i % 5 == 0, ",true,").otherwise(",false,"), (i % 300).cast("string"), F.lit(",90,0.5,null,null,"),
        F.when(i % 2 == 0, '"7700"').otherwise("null"), F.lit(",false,"), (i % 20).cast("string"), F.lit("]]}"),
    )
    got = feeds.adsb(e.select(body.alias("body")), "opensky")
    return _millis(got.select(F.substring("origin", 9, 20).cast("long").alias("event_id"), "asset_id", "callsign", "event_time", "lat", "lon", "alt", F.round(F.col("speed").cast("double"), 3).alias("speed"), "squawk", "category"), "event_time")


@query("""SELECT CAST(200000000+event_id AS VARCHAR) AS asset_id, 'V'||(event_id%77) AS callsign, (epoch_us(date_trunc('second', ts))//1000) AS event_time,
 round(CASE WHEN event_id%3=2 THEN 0 ELSE (event_id%40)/2.0::DOUBLE END, 3) AS speed,
 CAST(CASE WHEN event_id%3=2 THEN 0 WHEN event_id%400<360 THEN event_id%400 ELSE 77 END AS DOUBLE) AS heading,
 CASE WHEN event_id%3=2 THEN '' WHEN event_id%3=1 THEN 'under_way_using_engine' ELSE ['under_way_using_engine','at_anchor','not_under_command','restricted_manoeuvrability','constrained_by_draught','moored','aground','engaged_in_fishing','under_way_sailing','reserved_hsc','reserved_wig','reserved_11','reserved_12','reserved_13','ais_sart','not_defined','not_defined','not_defined'][(event_id%18)::INTEGER+1] END AS nav_status,
 CASE WHEN event_id%3=2 THEN event_id%70000%65536 ELSE 0 END AS dim_a, CASE WHEN event_id%3=2 THEN printf('%02d-%02d 06:00', event_id%12+1, event_id%28+1) ELSE '' END AS eta
FROM events WHERE event_id%10<>9""")
def ais_parse(spark, sf):
    e = table(spark, sf, "events")
    i = F.col("event_id")
    s = lambda c: c.cast("string")
    kind = F.when(i % 10 == 9, "BaseStationReport").when(i % 3 == 0, "PositionReport").when(i % 3 == 1, "StandardClassBPositionReport").otherwise("ShipStaticData")
    when = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    when = F.when(i % 2 == 0, F.concat(when, F.lit(".000000000 +0000 UTC"))).otherwise(F.concat(F.translate(when, " ", "T"), F.lit("Z")))
    report = F.concat(F.lit('{"Sog":'), s((i % 40) / 2.0), F.lit(',"Cog":77,"TrueHeading":'), s(i % 400), F.lit(',"Latitude":31.5,"Longitude":32.3'), F.when(i % 3 == 0, F.concat(F.lit(',"NavigationalStatus":'), s(i % 18))).otherwise(""), F.lit("}"))
    static = F.concat(F.lit('{"ImoNumber":1,"Type":70,"Name":"N","Dimension":{"A":'), s(i % 70000), F.lit(',"B":1,"C":1,"D":1},"Eta":{"Month":'), s(i % 12 + 1), F.lit(',"Day":'), s(i % 28 + 1), F.lit(',"Hour":6,"Minute":0}}'))
    body = F.concat(
        F.lit('{"MessageType":"'), kind, F.lit('","MetaData":{"MMSI":'), s(i + 200000000), F.lit(',"ShipName":"V'), s(i % 77), F.lit('  ","latitude":31.5,"longitude":32.3,"time_utc":"'), when,
        F.lit('"},"Message":{"'), kind, F.lit('":'), F.when(kind == "ShipStaticData", static).otherwise(report), F.lit("}}"),
    )
    got = feeds.ais(e.select(body.alias("body")), "aisstream")
    return _millis(got.select("asset_id", "callsign", "event_time", F.round(F.col("speed").cast("double"), 3).alias("speed"), F.col("heading").cast("double").alias("heading"), "nav_status", F.col("dim_a").cast("long").alias("dim_a"), "eta"), "event_time")


@query(f"""WITH {_T} SELECT event_id, {_MS} AS ts, asset_id AS id, asset_type AS type, lat, lon, h3_cell AS h3, source AS src FROM t""")
def event_json(spark, sf):
    t = telemetry(spark, sf).select("event_id", "event_time", "asset_id", "asset_type", "lat", "lon", "h3_cell", "source")
    w = broadcast.wire(t.withColumnRenamed("event_id", "event_no"))
    data = w.select("event_no", F.to_json(F.struct(*[c for c in w.columns if c != "event_no"])).alias("data"))
    back = data.select("event_no", F.from_json("data", "ts bigint, id string, type string, lat int, lon int, h3 bigint, src string").alias("j"))
    return back.select(F.col("event_no").alias("event_id"), "j.*")


def _case(col: str, spans) -> str:
    return "CASE " + " ".join(f"WHEN {col} BETWEEN {a} AND {b} THEN '{name}'" for a, b, name in spans)


_SHIP = _case("code", codes.SHIP_TYPES) + " " + " ".join(f"WHEN code BETWEEN {k * 10} AND {k * 10 + 9} THEN '{v}'" for k, v in codes.SHIP_TYPE_TENS.items()) + " ELSE 'other' END"


@query(f"""WITH c AS (SELECT event_id, event_id%130-10 AS code FROM events) SELECT event_id, code,
 {_case("code", [(i, i, n) for i, n in enumerate(codes.EMITTER_CATEGORIES)])} ELSE '' END AS emitter, {_case("code", [(i, i, n) for i, n in enumerate(codes.NAV_STATES)])} ELSE 'not_defined' END AS nav, {_SHIP} AS ship FROM c""")
def code_maps(spark, sf):
    c = table(spark, sf, "events").select("event_id", (F.col("event_id") % 130 - 10).alias("code"))
    code = F.col("code")
    return c.select("event_id", "code", scalar.emitter_category(code).alias("emitter"), scalar.nav_status(code).alias("nav"), scalar.ship_type(code).alias("ship"))


@query("""SELECT event_id, CASE WHEN event_id%13>0 AND event_id%32>0 THEN printf('%02d-%02d %02d:%02d', event_id%13, event_id%32, event_id%24, event_id%60) ELSE '' END AS eta FROM events""")
def eta_format(spark, sf):
    i = F.col("event_id")
    return table(spark, sf, "events").select("event_id", scalar.eta(i % 13, i % 32, i % 24, i % 60).alias("eta"))


@query("""SELECT event_id, CASE WHEN event_id%3=2 THEN NULL ELSE (epoch_us(date_trunc('second', ts))//1000) END AS ms FROM events""")
def parse_time(spark, sf):
    t = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.translate(t, " ", "T"), F.lit("Z"))).when(F.col("event_id") % 3 == 1, F.concat(t, F.lit(".0 +0000 UTC"))).otherwise(t)
    return table(spark, sf, "events").select("event_id", F.unix_millis(scalar.feed_time(text)).alias("ms"))


@query("""SELECT event_id, CASE WHEN event_id%3=2 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events""")
def parse_launch_date(spark, sf):
    t, i = F.col("ts").cast("timestamp"), F.col("event_id") % 3
    named = F.concat(F.date_format(t, "yyyy MMM "), F.lpad(F.dayofmonth(t).cast("string"), 2, " "))
    text = F.when(i == 0, named).when(i == 1, F.date_format(t, "yyyy-MM-dd")).otherwise("1998 Spring")
    return table(spark, sf, "events").select("event_id", scalar.launch_date(text).cast("string").alias("day"))


@query("""SELECT event_id, CASE WHEN event_id%4=3 THEN NULL WHEN event_id%4=2 THEN NULL ELSE event_id END AS asn FROM events""")
def parse_asn(spark, sf):
    i = F.col("event_id")
    text = F.when(i % 4 == 0, F.concat(F.lit("AS"), i)).when(i % 4 == 1, i.cast("string")).when(i % 4 == 2, F.concat(F.lit("ASx"), i)).otherwise(F.concat(F.lit("as99999"), i + 4000000000))
    return table(spark, sf, "events").select("event_id", scalar.asn(text).alias("asn"))


@query("""SELECT c_custkey, upper(trim('  '||c_name||' ')) AS up, lower(c_mktsegment) AS low, CASE WHEN c_custkey%4=0 THEN NULL ELSE c_name END AS value FROM customer""")
def string_norm(spark, sf):
    c = table(spark, sf, "customer")
    raw = F.when(F.col("c_custkey") % 8 == 0, " - ").when(F.col("c_custkey") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), "c_name"))
    return c.select("c_custkey", F.upper(F.trim(F.concat(F.lit("  "), "c_name", F.lit(" ")))).alias("up"), F.lower("c_mktsegment").alias("low"), scalar.missing(raw).alias("value"))


@query("""WITH p AS (SELECT event_id, event_id%256 AS a, event_id*7%256 AS b, event_id*13%256 AS c, event_id%33 AS len FROM events)
SELECT event_id, len::INTEGER AS len, ((10::BIGINT*16777216+a*65536+b*256+c)//(1::BIGINT<<(32-len)::INTEGER))*(1::BIGINT<<(32-len)::INTEGER) AS net FROM p""")
def cidr_mask(spark, sf):
    i = F.col("event_id")
    text = F.concat(F.lit("10."), i % 256, F.lit("."), i * 7 % 256, F.lit("."), i * 13 % 256, F.lit("/"), i % 33)
    n = lookup.v4_network(text)
    return table(spark, sf, "events").select("event_id", n["len"].alias("len"), n["net"].alias("net"))


_HOPS = [174, 64500, 15169, 3356, 13335, 14061]
_PATH = f"""p AS (SELECT event_id, [{",".join(map(str, _HOPS))}][((event_id)%6)::INTEGER+1]::BIGINT AS h1, [{",".join(map(str, _HOPS))}][((event_id//6)%6)::INTEGER+1]::BIGINT AS h2, [{",".join(map(str, _HOPS))}][((event_id//36)%6)::INTEGER+1]::BIGINT AS h3 FROM events)"""
_T1 = "(" + ",".join(map(str, codes.TIER1_ASNS)) + ")"


def _paths(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    hop = lambda c: F.get(F.array(*map(F.lit, _HOPS)), (c % 6).cast("int")).cast("long")
    i = F.col("event_id")
    return e.withColumn("as_path", F.array(hop(i), hop(F.floor(i / 6)), hop(F.floor(i / 36))))


@query(f"WITH {_PATH} SELECT event_id, h3 AS origin_as, 3::INTEGER AS hops, h1||'-'||h2||'-'||h3 AS path FROM p")
def path_array_ops(spark, sf):
    p = _paths(spark, sf)
    raw = F.array(F.get("as_path", F.lit(0)).cast("string"), F.lit("junk"), F.concat(F.lit("["), F.get("as_path", F.lit(1)), F.lit(","), F.get("as_path", F.lit(2)), F.lit("]")))
    flat = p.select("event_id", routing.flat_path(raw).alias("f"))
    return flat.select("event_id", routing.origin(F.col("f")).alias("origin_as"), F.size("f").alias("hops"), F.array_join(F.col("f").cast("array<string>"), "-").alias("path"))


@query(f"""WITH {_PATH} SELECT event_id, ((h1 NOT IN {_T1} AND (h2 IN {_T1} OR h3 IN {_T1})) OR (h2 NOT IN {_T1} AND h3 IN {_T1})) AS is_leak FROM p""")
def leak_detect(spark, sf):
    return _paths(spark, sf).select("event_id", routing.leaks(F.col("as_path")).alias("is_leak"))


def _values(rows: dict) -> str:
    return ",".join(f"({k},{v[0]}::DOUBLE,{v[1]}::DOUBLE)" for k, v in rows.items())


_POS = {a: codes.CENTROIDS[c] for a, c in codes.SEED_ASNS.items()}


@query(f"""WITH {_PATH}, pos(asn,la,lo) AS (VALUES {_values(_POS)}), h AS (SELECT event_id, 1 AS i, h1 AS asn FROM p UNION ALL SELECT event_id, 2, h2 FROM p UNION ALL SELECT event_id, 3, h3 FROM p),
g AS (SELECT event_id, string_agg(CAST(round(la*1e7) AS INTEGER)||','||CAST(round(lo*1e7) AS INTEGER), ',' ORDER BY i) AS coords FROM h JOIN pos USING (asn) GROUP BY event_id)
SELECT event_id, coalesce(coords,'') AS coords FROM p LEFT JOIN g USING (event_id)""")
def path_coords(spark, sf):
    out = routing.path_coords(_paths(spark, sf).select("event_id", "as_path"), lookup.seed_positions(spark), "event_id")
    return out.select("event_id", F.array_join(F.col("path_coords").cast("array<string>"), ",").alias("coords"))


def _ops(spark, sf) -> DataFrame:
    """Prefix operations: 'error' events withdraw, the others announce one of a few origins along a path."""
    p = _paths(spark, sf)
    prefix = F.concat(F.lit("10."), F.col("user_id") % 256, F.lit("."), F.col("event_id") % 4, F.lit(".0/24"))
    out = p.select("event_id", F.col("ts").cast("timestamp").alias("event_time"), prefix.alias("prefix"), F.when(F.col("event_type") == "error", "W").otherwise("A").alias("op"), "as_path")
    return out.withColumn("origin_as", F.when(F.col("op") == "A", routing.origin(F.col("as_path"))).otherwise(F.lit(3356))).withColumn("is_leak", (F.col("op") == "A") & (F.col("event_id") % 10 == 0) & routing.leaks(F.col("as_path")))


_OPS = f"""{_PATH}, o AS (SELECT event_id, ts, '10.'||(user_id%256)||'.'||(event_id%4)||'.0/24' AS prefix, user_id%256 AS o2, event_id%4 AS o3, CASE WHEN event_type='error' THEN 'W' ELSE 'A' END AS op, h1, h2, h3,
 CASE WHEN event_type='error' THEN 3356 ELSE h3 END AS origin_as, (event_type<>'error' AND event_id%10=0 AND ((h1 NOT IN {_T1} AND (h2 IN {_T1} OR h3 IN {_T1})) OR (h2 NOT IN {_T1} AND h3 IN {_T1}))) AS is_leak FROM events JOIN p USING (event_id)),
l AS (SELECT *, lag(op) OVER w AS p_op, lag(origin_as) OVER w AS p_or FROM o WINDOW w AS (PARTITION BY prefix ORDER BY ts, event_id)),
k AS (SELECT *, CASE WHEN op='W' THEN CASE WHEN p_op='A' THEN 'withdrawal' END WHEN is_leak THEN 'leak' WHEN p_op='A' AND p_or<>origin_as THEN 'hijack' WHEN p_op IS DISTINCT FROM 'A' THEN 'announcement' END AS category FROM l),
ev AS (SELECT * FROM k WHERE category IS NOT NULL)"""


def _events(spark, sf) -> DataFrame:
    return routing.classify(_ops(spark, sf), ["event_time", "event_id"])


@query(f"WITH {_OPS} SELECT event_id, prefix, category, origin_as FROM ev")
def bgp_classify(spark, sf):
    return _events(spark, sf).select("event_id", "prefix", "category", "origin_as")


def _cities(spark) -> DataFrame:
    rows = [(f"10.{i}.0.0/16", i / 2.0 + 1, i / 4.0 + 1) for i in range(0, 100, 2)] + [(f"10.{i}.1.0/24", 0.0, 0.0) for i in range(0, 40, 4)]
    return spark.createDataFrame(rows, "network string, lat double, lon double")


def _holders(spark) -> DataFrame:
    rows = [("10.0.0.0/8", 15169, "Root")] + [(f"10.{i}.0.0/16", 13335, f"Org {i}") for i in range(0, 200, 3)] + [(f"10.{i}.2.0/24", 0, "") for i in range(0, 200, 5)]
    return spark.createDataFrame(rows, "network string, asn long, org string")


_CITY = "city AS (SELECT o2, o3, CASE WHEN o3=1 AND o2<40 AND o2%4=0 THEN NULL WHEN o2<100 AND o2%2=0 THEN o2/2.0::DOUBLE+1 END AS c_lat, CASE WHEN o3=1 AND o2<40 AND o2%4=0 THEN NULL WHEN o2<100 AND o2%2=0 THEN o2/4.0::DOUBLE+1 END AS c_lon FROM (SELECT DISTINCT o2, o3 FROM o))"
_HOLD = "hold AS (SELECT o2, o3, CASE WHEN o2<200 AND o2%5=0 AND o3=2 THEN 0 WHEN o2<200 AND o2%3=0 THEN 13335 ELSE 15169 END AS prefix_as, CASE WHEN o2<200 AND o2%5=0 AND o3=2 THEN '' WHEN o2<200 AND o2%3=0 THEN 'Org '||o2 ELSE 'Root' END AS prefix_org FROM (SELECT DISTINCT o2, o3 FROM o))"


@query(f"""WITH {_OPS}, {_CITY}, pos(asn,la,lo) AS (VALUES {_values(_POS)}), x AS (SELECT ev.*, c_lat, c_lon, p1.la AS la1, p1.lo AS lo1, p2.la AS la2, p2.lo AS lo2, p3.la AS la3, p3.lo AS lo3, pw.la AS law, pw.lo AS low FROM ev
 LEFT JOIN city USING (o2,o3) LEFT JOIN pos p1 ON p1.asn=h1 LEFT JOIN pos p2 ON p2.asn=h2 LEFT JOIN pos p3 ON p3.asn=h3 LEFT JOIN pos pw ON pw.asn=3356),
y AS (SELECT event_id, category, CASE WHEN op='W' THEN coalesce(c_lat,law) ELSE coalesce(c_lat,la3,la2,la1) END AS lat_deg, CASE WHEN op='W' THEN coalesce(c_lon,low) ELSE coalesce(c_lon,lo3,lo2,lo1) END AS lon_deg FROM x)
SELECT * FROM y WHERE lat_deg IS NOT NULL""")
def bgp_geo(spark, sf):
    out = routing.locate(_events(spark, sf), _cities(spark), lookup.seed_positions(spark), "event_id", known=_ops(spark, sf))
    return out.select("event_id", "category", "lat_deg", "lon_deg")


@query(f"WITH {_OPS}, {_HOLD} SELECT event_id, prefix, prefix_as::BIGINT AS prefix_as, prefix_org FROM ev JOIN hold USING (o2,o3)")
def holder_left_join(spark, sf):
    return lookup.holder(_events(spark, sf).select("event_id", "prefix"), _holders(spark), known=_ops(spark, sf))


@query(f"WITH {_OPS}, {_HOLD} SELECT event_id, prefix, origin_as, prefix_as::BIGINT AS prefix_as FROM ev JOIN hold USING (o2,o3) WHERE category='hijack' AND prefix_as<>0 AND prefix_as<>origin_as")
def hijack_divergence(spark, sf):
    return lookup.hijack_divergence(lookup.holder(_events(spark, sf), _holders(spark), known=_ops(spark, sf))).select("event_id", "prefix", "origin_as", "prefix_as")


@query("""WITH a AS (SELECT event_id, (10::BIGINT*16777216+(event_id%256)*65536+(event_id%4)*256) AS addr FROM events)
SELECT event_id, CASE WHEN event_id%256<200 AND event_id%256%5=0 AND event_id%4=2 THEN '' WHEN event_id%256<200 AND event_id%256%3=0 THEN 'Org '||(event_id%256) ELSE 'Root' END AS org FROM a""")
def lpm_join(spark, sf):
    i = F.col("event_id")
    probes = table(spark, sf, "events").select("event_id", F.concat(F.lit("10."), i % 256, F.lit("."), i % 4, F.lit(".9/24")).alias("prefix"))
    return lookup.longest_match(probes, _holders(spark).select("network", "org")).select("event_id", "org")


#: Countries that stand for the nations of the tables; the last one has no centroid.
_COUNTRIES = [*sorted(codes.CENTROIDS)[:24], "--"]


@query(f"""WITH c(k,la,lo) AS (VALUES {_values({k: codes.CENTROIDS[c] for k, c in enumerate(_COUNTRIES[:24])})})
SELECT 64512 + c_custkey AS asn, la AS asn_lat, lo AS asn_lon FROM customer JOIN c ON c_nationkey = k""")
def asn_centroid_join(spark, sf):
    """A registry of systems and their countries, placed where the countries' centroids are."""
    country = F.get(F.array(*[F.lit(c) for c in _COUNTRIES]), F.col("c_nationkey"))
    systems = table(spark, sf, "customer").select((F.col("c_custkey") + 64512).alias("asn"), country.alias("cc"))
    return lookup.positions(systems).select("asn", "asn_lat", "asn_lon")


@query(f"WITH {_PATH}, pos(asn,la,lo) AS (VALUES {_values(_POS)}) SELECT event_id, h3 AS asn, la AS asn_lat, lo AS asn_lon, la IS NOT NULL AS ok FROM p LEFT JOIN pos ON pos.asn=h3")
def asn_lookup_left(spark, sf):
    p = _paths(spark, sf).select("event_id", routing.origin(F.col("as_path")).alias("asn"))
    out = p.join(F.broadcast(lookup.seed_positions(spark).drop("cc")), "asn", "left")
    return out.select("event_id", "asn", "asn_lat", "asn_lon", F.col("asn_lat").isNotNull().alias("ok"))


@query(f"WITH {_PATH} SELECT event_id, h1 IN {_T1} AS tier1 FROM p")
def dim_lookup(spark, sf):
    return _paths(spark, sf).select("event_id", F.get("as_path", F.lit(0)).isin(codes.TIER1_ASNS).alias("tier1"))


_ELEM = """el AS (SELECT p_partkey AS norad_id, p_name AS name, 1.0::DOUBLE+(p_partkey%150)/10.0::DOUBLE AS n, (p_size%40)/100.0::DOUBLE AS e, (p_partkey%100)::DOUBLE AS incl, (p_partkey%30)/2000.0::DOUBLE AS bstar FROM part),
q AS (SELECT *, 1440.0::DOUBLE/n AS period, cbrt(398600.4418::DOUBLE/((n*2.0::DOUBLE*pi()/86400.0::DOUBLE)*(n*2.0::DOUBLE*pi()/86400.0::DOUBLE))) AS sma FROM el),
o AS (SELECT *, sma*(1-e)-6371.0::DOUBLE AS perigee, sma*(1+e)-6371.0::DOUBLE AS apogee, CASE WHEN e>0.25 THEN 'heo' WHEN abs(sma-42164)<200 THEN 'geo' WHEN sma<8371 THEN 'leo' ELSE 'meo' END AS regime FROM q)"""


def _elements(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    el = p.select(
        k.alias("norad_id"), F.col("p_name").alias("name"), (1.0 + (k % 150) / 10.0).alias("mean_motion"), ((F.col("p_size") % 40) / 100.0).alias("eccentricity"),
        (k % 100).cast("double").alias("inclination"), ((k % 30) / 2000.0).alias("bstar"), (k % 360).cast("double").alias("raan"), (k * 7 % 360).cast("double").alias("arg_perigee"),
        (k * 11 % 360).cast("double").alias("mean_anomaly"), (F.lit(NOW).cast("timestamp") - F.make_dt_interval((k % 45).cast("int"))).alias("epoch"),
        F.when(k % 10 == 0, "community_derived").otherwise("official").alias("confidence"),
    )
    return orbit.parameters(el)


@query(f"WITH {_ELEM} SELECT norad_id, round(period,6) AS period_minutes, round(perigee,4) AS perigee_km, round(apogee,4) AS apogee_km FROM o")
def orbit_params(spark, sf):
    return _elements(spark, sf).select("norad_id", F.round("period_minutes", 6).alias("period_minutes"), F.round("perigee_km", 4).alias("perigee_km"), F.round("apogee_km", 4).alias("apogee_km"))


@query(f"WITH {_ELEM} SELECT norad_id, regime AS orbit_regime FROM o WHERE regime = 'meo'")
def regime_filter(spark, sf):
    return reads.of_regime(_elements(spark, sf), "meo").select("norad_id", "orbit_regime")


@query(f"WITH {_ELEM} SELECT regime AS orbit_regime, count(*) AS n FROM o GROUP BY regime")
def orbit_regime(spark, sf):
    return _elements(spark, sf).groupBy("orbit_regime").agg(F.count("*").alias("n"))


@query(f"WITH {_ELEM} SELECT norad_id, CASE WHEN norad_id%9=0 THEN 'maneuvering' WHEN perigee<150 OR bstar>0.01 THEN 'decaying' ELSE '' END AS sat_status, CASE WHEN norad_id%10=0 THEN 'classfd' ELSE 'celestrak' END AS source FROM o")
def sat_status(spark, sf):
    e = _elements(spark, sf)
    return e.select("norad_id", orbit.status(F.col("norad_id") % 9 == 0, F.col("perigee_km"), F.col("bstar")).alias("sat_status"), orbit.source_label(F.col("confidence")).alias("source"))


@query(f"WITH {_ELEM} SELECT norad_id, CASE WHEN norad_id%45 > CASE WHEN regime IN ('leo','heo') THEN 14 ELSE 30 END THEN 'stale' WHEN norad_id%10=0 THEN 'community_derived' ELSE 'official' END AS confidence FROM o")
def staleness(spark, sf):
    e = _elements(spark, sf)
    return e.select("norad_id", orbit.confidence(F.col("confidence"), F.col("orbit_regime"), F.col("epoch"), F.lit(NOW).cast("timestamp")).alias("confidence"))


@query("""WITH s AS (SELECT p_partkey AS norad_id, f AS fetch_no, 90.0::DOUBLE+CASE WHEN p_partkey%5=0 AND f=2 THEN 1 ELSE 0 END AS period, (p_partkey%90)+CASE WHEN p_partkey%7=0 AND f=3 THEN 0.5::DOUBLE ELSE 0 END AS incl
 FROM part, range(0,4) r(f) WHERE NOT (p_partkey%11=0 AND f=1)), l AS (SELECT *, lag(fetch_no) OVER w AS pf, lag(period) OVER w AS pp, lag(incl) OVER w AS pi2 FROM s WINDOW w AS (PARTITION BY norad_id ORDER BY fetch_no))
SELECT norad_id, fetch_no FROM l WHERE pf=fetch_no-1 AND ((period<>pp AND abs(1440.0::DOUBLE/period-1440.0::DOUBLE/pp)>0.01) OR abs(incl-pi2)>0.1)""")
def maneuver_detect(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("norad_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("fetch_no"))
    k, f = F.col("norad_id"), F.col("fetch_no")
    s = p.filter(~((k % 11 == 0) & (f == 1))).withColumn("period_minutes", 90.0 + F.when((k % 5 == 0) & (f == 2), 1).otherwise(0)).withColumn("inclination", (k % 90) + F.when((k % 7 == 0) & (f == 3), 0.5).otherwise(0.0))
    return reads.maneuvers(s).select("norad_id", "fetch_no")


@query("""SELECT p_partkey AS norad_id, CASE WHEN p_partkey%6=0 THEN 'community_derived' ELSE 'official' END AS confidence, CASE WHEN p_partkey%6=0 THEN upper(p_name) ELSE p_name END AS name FROM part
UNION ALL SELECT p_partkey+5000000, 'community_derived', upper(p_name) FROM part WHERE p_partkey%12=0""")
def overlay_union(spark, sf):
    base = table(spark, sf, "part").select(F.col("p_partkey").alias("norad_id"), F.lit("official").alias("confidence"), F.col("p_name").alias("name"))
    secret = base.filter("norad_id % 6 = 0").select("norad_id", F.lit("community_derived").alias("confidence"), F.upper("name").alias("name"))
    extra = base.filter("norad_id % 12 = 0").select((F.col("norad_id") + 5000000).alias("norad_id"), F.lit("community_derived").alias("confidence"), F.upper("name").alias("name"))
    return dims.overlay(base, secret.unionByName(extra), ["norad_id"])


@query(f"WITH {_T} SELECT event_id, source FROM t UNION ALL SELECT event_id, 'second' FROM t WHERE event_id%2=0")
def union_sources(spark, sf):
    t = telemetry(spark, sf).select("event_id", "source")
    return dims.union_all(t, t.filter("event_id % 2 = 0").withColumn("source", F.lit("second")))


def _fan_sql(prefix: str, res: str) -> str:
    return f"WITH {_T} SELECT event_id, res, '{prefix}'||printf('%x', {_parent_sql('h3_cell', 'res')}) AS stream FROM t, {res}"


@query(_fan_sql("telemetry:", "range(2,8) r(res)"))
def broadcast_fanout(spark, sf):
    return broadcast.telemetry(telemetry(spark, sf).select("event_id", "h3_cell")).select("event_id", F.col("res").cast("long").alias("res"), "stream")


@query(_fan_sql("bgp:", "range(3,4) r(res)"))
def broadcast_fanout_bgp(spark, sf):
    return broadcast.bgp(telemetry(spark, sf).select("event_id", "h3_cell")).select("event_id", F.col("res").cast("long").alias("res"), "stream")


@query(f"WITH {_T} SELECT event_id FROM t WHERE event_time >= TIMESTAMP '{NOW}' - INTERVAL 24 HOURS")
def ttl_filter(spark, sf):
    return reads.within_ttl(telemetry(spark, sf), F.lit(NOW).cast("timestamp")).select("event_id")


@query(f"WITH {_T} SELECT event_id, {_MS} AS event_time FROM t WHERE event_time >= TIMESTAMP '{NOW}' - INTERVAL 2000 MINUTES ORDER BY t.event_time DESC, event_id LIMIT 1000")
def viewport_recent(spark, sf):
    return _millis(reads.recent(telemetry(spark, sf), F.lit(NOW).cast("timestamp"), 2000, 1000, ("event_id",)).select("event_id", "event_time"), "event_time")


@query(f"WITH {_T}, v AS (SELECT DISTINCT {_parent_sql('h3_cell', '3')} AS cell FROM t WHERE event_id%500=0) SELECT event_id FROM t WHERE {_parent_sql('h3_cell', '3')} IN (SELECT cell FROM v)")
def viewport_cells(spark, sf):
    t = telemetry(spark, sf)
    seen = t.filter("event_id % 500 = 0").select(cells.parent(F.col("h3_cell"), 3).alias("cell")).distinct()
    return reads.in_viewport(t, seen, 3).select("event_id")


@query(f"WITH {_T} SELECT strftime(event_time, '%Y%m%d%H') AS event_hour, count(*) AS n FROM t GROUP BY 1")
def hour_partition(spark, sf):
    t = telemetry(spark, sf)
    return t.groupBy(F.date_format(F.date_trunc("hour", "event_time"), "yyyyMMddHH").alias("event_hour")).agg(F.count("*").alias("n"))


def _place(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, for queries that write and read back."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.gettempdir()
    return f"{root.rstrip('/')}/{name}-{os.getpid()}-{os.urandom(6).hex()}"


@query(f"WITH {_T} SELECT event_id, asset_type, h3_cell FROM t WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00' AND event_time < TIMESTAMP '2024-01-12 12:00:00'")
def sorted_layout(spark, sf):
    path = _place(spark, "layout")
    files.append(telemetry(spark, sf).coalesce(2).select("event_id", "event_time", "asset_id", "asset_type", "h3_cell"), path, ["asset_type", "h3_cell", "event_time", "asset_id"])
    at = lambda s: F.lit(s).cast("timestamp")
    return files.scan(spark, path, at("2024-01-10 00:00:00"), at("2024-01-12 12:00:00")).select("event_id", "asset_type", "h3_cell")


@query("""WITH s AS (SELECT user_id AS prefix, max(ts) AS last_seen FROM events GROUP BY user_id), n AS (SELECT count(*) AS n FROM s), k AS (SELECT *, row_number() OVER (ORDER BY last_seen DESC, prefix) AS r FROM s)
SELECT prefix, (epoch_us(last_seen)//1000) AS last_seen FROM k, n WHERE n<=100 OR r<=75""")
def state_prune_topk(spark, sf):
    s = table(spark, sf, "events").groupBy(F.col("user_id").alias("prefix")).agg(F.max(F.col("ts").cast("timestamp")).alias("last_seen"))
    return _millis(routing.prune(s, 100, 0.75), "last_seen")


@query("""SELECT 'dump/aircraft-'||o_orderkey||'.csv' AS key, (o_totalprice*1000)::BIGINT AS size FROM orders WHERE o_orderkey%2=0 AND (o_totalprice*1000)::BIGINT>=50000000 ORDER BY o_orderdate DESC, key LIMIT 1""")
def latest_object(spark, sf):
    o = table(spark, sf, "orders")
    key = F.concat(F.when(F.col("o_orderkey") % 2 == 0, "dump/aircraft-").otherwise("dump/vessel-"), F.col("o_orderkey"), F.lit(".csv"))
    objects = o.select(key.alias("key"), F.round(F.col("o_totalprice") * 1000).cast("long").alias("size"), F.col("o_orderdate").alias("last_modified"))
    return dims.latest_object(objects, dims.is_aircraft_csv(F.col("key"))).select("key", "size")


@query(f"SELECT count(*) AS parsed, count(*) FILTER (WHERE reason<>'ok') AS skipped FROM ({_reason_sql('asset_id', 'asset_type')})")
def ingest_stats(spark, sf):
    r = _broken(spark, sf, "asset_id", "asset_type").select(validate.telemetry_reason(F.col("ms")).alias("reason"))
    return r.agg(F.count("*").alias("parsed"), F.count_if(F.col("reason").isNotNull()).alias("skipped"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal <> 0 AND c_mktsegment <> ''")
def scan_project_filter(spark, sf):
    return table(spark, sf, "customer").filter("c_acctbal <> 0 and c_mktsegment <> ''").select("c_custkey", "c_name")


@query(f"WITH {_T} SELECT {_MS} AS ts, asset_id AS id, asset_type AS type, speed AS spd, h3_cell AS h3, source AS src, lat, lon, callsign FROM t")
def rename_projection(spark, sf):
    return broadcast.wire(telemetry(spark, sf).select("event_time", "asset_id", "asset_type", "speed", "h3_cell", "source", "lat", "lon", "callsign"))


@query(f"WITH {_T} SELECT event_id, {_MS} AS event_time, asset_id, lat, lon, speed FROM t")
def raw_roundtrip(spark, sf):
    path = _place(spark, "raw")
    files.append(telemetry(spark, sf).select("event_id", "event_time", "asset_type", "h3_cell", "asset_id", "lat", "lon", "speed"), path, ["asset_type", "h3_cell", "event_time", "asset_id"])
    return _millis(files.scan(spark, path).select("event_id", "event_time", "asset_id", "lat", "lon", "speed"), "event_time")


@query(f"WITH {_OPS} SELECT event_id, category, prefix, CASE WHEN op='A' THEN h1||','||h2||','||h3 ELSE '' END AS path FROM ev")
def bgp_roundtrip(spark, sf):
    path = _place(spark, "bgp")
    hops = F.when(F.col("op") == "A", F.col("as_path")).otherwise(F.array().cast("array<long>"))
    files.append(_events(spark, sf).select("event_id", "event_time", "category", "prefix", hops.alias("as_path")), path, ["category", "event_time"])
    return files.scan(spark, path).select("event_id", "category", "prefix", F.array_join(F.col("as_path").cast("array<string>"), ",").alias("path"))


@query("""SELECT p_partkey::BIGINT AS norad_id, p_name AS name, (p_partkey%180 + 0.5)::DOUBLE AS inclination, (p_partkey%1000)/10000.0::DOUBLE AS eccentricity,
(1 + (p_partkey%150)/10.0)::DOUBLE AS mean_motion, 1704110400000::BIGINT AS epoch_ms FROM part""")
def src_element_text(spark, sf):
    k = F.col("p_partkey")
    number = files.element_number(k)
    one = F.format_string("1 %sU 24001A   24001.50000000  .00000000  00000-0  10000-3 0  9990", number)
    two = F.format_string("2 %s %8.4f %8.4f %07d %8.4f %8.4f %11.8f    00", number, k % 180 + 0.5, F.lit(10.0), (k % 1000) * 1000, F.lit(20.0), F.lit(30.0), 1 + (k % 150) / 10.0)
    text = table(spark, sf, "part").select(F.floor(k / 1000).alias("file"), F.concat_ws("\n", "p_name", one, two).alias("set")).groupBy("file").agg(F.concat_ws("\n", F.collect_list("set")).alias("value"))
    return files.element_text(text).select("norad_id", "name", "inclination", "eccentricity", "mean_motion", F.unix_millis("epoch").alias("epoch_ms"))


@query("""SELECT p_partkey AS norad_id, p_name AS name, round(1440.0::DOUBLE/(1.0::DOUBLE+(p_partkey%150)/10.0::DOUBLE), 6) AS period_minutes FROM part""")
def src_omm_json(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    rec = F.struct(F.col("p_name").alias("OBJECT_NAME"), F.lit("2024-01-01T00:00:00.000000").alias("EPOCH"), (1.0 + (k % 150) / 10.0).alias("MEAN_MOTION"), F.lit(0.001).alias("ECCENTRICITY"), F.lit(51.6).alias("INCLINATION"), k.alias("NORAD_CAT_ID"), F.lit(0.0001).alias("BSTAR"))
    path = _place(spark, "omm")
    p.select(F.to_json(rec).alias("value")).write.text(path)
    return feeds.omm(spark.read.schema(feeds.OMM).json(path)).select("norad_id", "name", F.round("period_minutes", 6).alias("period_minutes"))


@query("""SELECT upper(printf('c%05x', c_custkey%1048576)) AS icao24, c_name||', Inc' AS operator, c_mktsegment AS model FROM customer WHERE c_custkey%9<>0""")
def src_csv_quoted(spark, sf):
    c = table(spark, sf, "customer")
    key = F.when(F.col("c_custkey") % 9 == 0, "").otherwise(F.format_string("c%05x", F.col("c_custkey") % 1048576))
    line = F.concat(F.lit("'"), F.col("c_mktsegment"), F.lit("','x','"), F.concat("c_name", F.lit(", Inc")), F.lit("',' "), key, F.lit("'"))
    return files.aircraft_rows(c.select(line.alias("line")), "'MODEL','unknown','operator','ICAO24'").select("icao24", "operator", "model")


@query("""SELECT s_suppkey AS norad_cat_id, s_name AS object_name, CASE WHEN s_suppkey%2=0 THEN '1998-11-05' END AS launch_date, round((s_suppkey/4.0::DOUBLE), 3) AS mass_kg FROM supplier WHERE s_suppkey%7<>0""")
def src_tsv_rows(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    line = F.concat(F.when(k % 7 == 0, "# ").otherwise(""), F.lit("S"), k, F.lit("\t"), k, F.lit("\t-\t"), F.col("s_name"), F.lit("\t"), F.when(k % 2 == 0, "1998 Nov  5").otherwise("-"), F.lit("\t"), k / 4.0)
    got = files.satellite_rows(s.select(line.alias("line")), "#JCAT\tSatcat\tName\tPLName\tLDate\tMass")
    return got.select("norad_cat_id", "object_name", F.col("launch_date").cast("string").alias("launch_date"), F.round(F.col("mass_kg").cast("double"), 3).alias("mass_kg"))


@query(f"""WITH {_ELEM} SELECT norad_id, 1704067200000::BIGINT + i*1000*CASE regime WHEN 'geo' THEN 120 WHEN 'meo' THEN 60 ELSE 30 END AS tick_ms
FROM o, range(0, 21) r(i) WHERE i*CASE regime WHEN 'geo' THEN 120 WHEN 'meo' THEN 60 ELSE 30 END <= 600""")
def propagate_ticks(spark, sf):
    at = lambda s: F.lit(s).cast("timestamp")
    t = reads.ticks(_elements(spark, sf).select("norad_id", "orbit_regime"), at("2024-01-01 00:00:00"), at("2024-01-01 00:10:00"))
    return t.select("norad_id", F.unix_millis("tick_time").alias("tick_ms"))


@query()
def propagate_rows(spark, sf):
    return reads.positions(_elements(spark, sf), F.lit(NOW).cast("timestamp")).select("norad_id", "orbit_regime", "lat", "lon", "alt_km")


@query(f"""WITH {_T}, x AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY asset_type, asset_id ORDER BY event_time DESC, event_id DESC)=1)
SELECT asset_type, asset_id, event_id, coalesce(c_name, '') AS registration FROM x LEFT JOIN customer ON c_custkey = CAST(asset_id AS BIGINT)""")
def latest_enriched(spark, sf):
    last = latest.latest(telemetry(spark, sf), ["callsign"], "event_id")
    meta = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("asset_id"), F.col("c_name").alias("registration"))
    return last.join(meta, "asset_id", "left").select("asset_type", "asset_id", "event_id", F.coalesce("registration", F.lit("")).alias("registration"))


@query(f"""WITH {_T}, z AS (SELECT *, CASE WHEN event_id%3=0 THEN '' ELSE callsign END AS cs FROM t) SELECT asset_type, asset_id, (epoch_us(max(event_time))//1000) AS event_time,
arg_max(cs, (event_time, event_id)) FILTER (WHERE cs<>'') AS callsign FROM z GROUP BY asset_type, asset_id""")
def latest_non_empty(spark, sf):
    t = telemetry(spark, sf).withColumn("callsign", F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("callsign")))
    return _millis(latest.latest_non_empty(t, ["callsign"], "event_id"), "event_time")


@query("""WITH d AS (SELECT event_id, user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) SELECT event_id, user_id FROM d WHERE p IS NULL OR ts - p > INTERVAL 60 SECONDS""")
def dedup_60s(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    before = F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.withColumn("p", before).filter(F.col("p").isNull() | (F.col("ts") > F.col("p") + F.expr("interval 60 seconds"))).select("event_id", "user_id")
