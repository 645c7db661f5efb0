import datetime as dt
import json

from pyspark.sql import functions as F

from geotide.sources import feeds, files


def bodies(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "body string")


def test_adsb(spark):
    base = ["a1b2c3", "ABC12X  ", "Nowhere", 1, 1, -2.3456, 48.3211, 8123.9, False, 211.0, 93.0, 0.5, None, 1, "4321", False, 3, 0]
    change = lambda **k: [k.get(f"i{n}", v) for n, v in enumerate(base)]
    states = [
        base, change(i8=True), change(i6=None), change(i5="7.5"), change(i0=""), base[:16], "junk", change(i0="faa", i14=None, i16=99),
        change(i0="fbb", i5=0.0, i6=0.0), change(i0="fcc", i6=300.0), change(i0="fdd", i7=None),
    ]
    got = feeds.adsb(bodies(spark, {"time": 1706933106, "states": states}, {"time": 1, "states": []}, {"time": 1, "states": None}, "{broken"), "opensky").orderBy("asset_id").collect()
    assert [r["asset_id"] for r in got] == ["A1B2C3", "FAA", "FDD"]
    r = got[0]
    assert (r["event_time"], r["lat"], r["lon"], r["alt"], r["squawk"], r["callsign"], r["category"]) == (dt.datetime(2024, 2, 3, 4, 5, 6), 483211000, -23456000, 8123, "4321", "ABC12X", "small")
    assert abs(r["speed"] - 211 * 1.94384) < 0.01 and r["heading"] == 93 and abs(r["vertical_rate"] - 0.5) < 1e-6
    assert got[1]["squawk"] == "" and got[1]["category"] == "" and got[2]["alt"] == 0


def vessel(kind, report, mmsi=219000111, name="BLUE HERON  ", lat=-12.25, lon=45.75, when="2024-03-05 07:08:09.000000000 +0000 UTC"):
    return {"MessageType": kind, "MetaData": {"MMSI": mmsi, "ShipName": name, "latitude": lat, "longitude": lon, "time_utc": when}, "Message": {kind: report}}


def test_ais(spark):
    pos = {"Sog": 9.5, "Cog": 201.0, "TrueHeading": 199, "Latitude": -12.25, "Longitude": 45.75, "NavigationalStatus": 0, "RateOfTurn": 3.0}
    b = {"Sog": 4.1, "Cog": 88.5, "TrueHeading": 511, "Latitude": 10.5, "Longitude": -61.25}
    static = {"ImoNumber": 9000001, "Type": 71, "Name": "GREY SEAL", "Destination": " HALIFAX ", "Dimension": {"A": 120, "B": 30, "C": 11, "D": 65548}, "Eta": {"Month": 9, "Day": 2, "Hour": 17, "Minute": 5}, "MaximumStaticDraught": 8.25}
    got = feeds.ais(
        bodies(
            spark, vessel("PositionReport", pos), vessel("StandardClassBPositionReport", b, 338000222), vessel("ShipStaticData", static, 477000333, " "),
            vessel("BaseStationReport", pos), "{", vessel("PositionReport", pos | {"Latitude": 0, "Longitude": 0}), vessel("ShipStaticData", static, lat=0, lon=0), vessel("PositionReport", pos, when="yesterday"),
            {"MessageType": "PositionReport", "MetaData": {"MMSI": 1, "time_utc": "2024-03-05T07:08:09Z"}, "Message": {}},
        ),
        "aisstream",
    ).orderBy("asset_id").collect()
    assert [r["asset_id"] for r in got] == ["219000111", "338000222", "477000333"]
    p, c, s = got
    assert (p["lat"], p["lon"], p["speed"], p["heading"], p["nav_status"], p["rate_of_turn"], p["alt"], p["callsign"]) == (-122500000, 457500000, 9.5, 199.0, "under_way_using_engine", 3.0, 0, "BLUE HERON")
    assert abs(c["heading"] - 88.5) < 1e-6 and c["lat"] == 105000000 and c["nav_status"] == "under_way_using_engine"
    assert (s["imo_number"], s["ship_type"], s["destination"], s["draught"], s["dim_a"], s["dim_d"], s["eta"], s["callsign"], s["nav_status"], s["speed"]) == (9000001, "cargo", "HALIFAX", 8.25, 120, 12, "09-02 17:05", "GREY SEAL", "", 0.0)


ELEMENTS = """EXAMPLE 12 (B-3)
1 41234U 16072A   24001.50000000 0.00000000  00000-0  12345-3 0    06
2 41234  63.4000 100.0000 0120000  10.0000 350.0000 13.41000000    07
1 00005U 58002B   00179.78495062  .00000023  00000-0  28098-4 0  4753
2 00005  34.2682 348.7242 1859667 331.7664  19.3264 10.82419157413667\r
BROKEN
1 xxxxx
1 IS A NAME
1 25544U 98067A   24001.00000000  .00016717  00000-0 -10270-3 0  9005
2 25544  51.6400 208.9163 0006703 130.5360 325.0288 15.50000000    08
1 00006U 58002B   00179.78495062  .00000023  00000-0  28098-4 0  4753
2 00006  34.2682 348.7242 1859667 331.7664  19.3264 10.82419157413667"""


def test_element_text(spark):
    got = files.element_text(spark.createDataFrame([(ELEMENTS,), (None,), ("",)], "value string")).orderBy("norad_id").collect()
    assert [(r["norad_id"], r["name"]) for r in got] == [(5, ""), (6, ""), (25544, "1 IS A NAME"), (41234, "EXAMPLE 12 (B-3)")]
    assert abs(got[0]["eccentricity"] - 0.1859667) < 1e-9 and abs(got[0]["bstar"] - 0.28098e-4) < 1e-12 and abs(got[2]["bstar"] + 0.1027e-3) < 1e-12
    assert abs(got[0]["mean_motion"] - 10.82419157) < 1e-9 and got[0]["epoch"].year == 2000


def test_element_numbers_of_more_than_five_digits(spark):
    """Alpha-5 up to 339,999, all digits beyond; the columns behind a wide number move in both lines."""
    one, two = "1 %sU 16072A   24001.50000000 0.00000000  00000-0  12345-3 0    06", "2 %s  63.4000 100.0000 0120000  10.0000 350.0000 13.41000000"
    numbers = [0, 99_999, 100_000, 179_999, 180_000, 229_999, 230_000, 339_999, 340_000, 1_199_999, 5_000_000_000, 2**63 - 1]
    written = [r[0] for r in spark.createDataFrame([(n,) for n in numbers], "n long").select(files.element_number(F.col("n"))).collect()]
    assert written[:9] == ["00000", "99999", "A0000", "H9999", "J0000", "N9999", "P0000", "Z9999", "340000"]
    bad = ["I0000", "O0000", "a0000", "A-001", "A 001", str(2**63)]
    text = "\n".join(f"N{w}\n{one % w}\n{two % w}" for w in written + bad) + "\nshort\n" + one % 340_001 + "\n" + two[:-1] % 340_001
    damaged = files.parse_elements(one % "00009" + "\n" + (two % "00009").replace("9  ", "97 "))  # a digit in line 2 alone is none of the number
    assert [(r[1], r[4]) for r in damaged] == [(9, 100.0)]
    got = files.element_text(spark.createDataFrame([(text,)], "value string")).orderBy("norad_id").collect()
    assert [(r["norad_id"], r["name"]) for r in got] == [(n, f"N{w}") for n, w in zip(numbers, written, strict=True)]
    assert {(r["inclination"], r["eccentricity"], r["mean_motion"], round(r["bstar"], 9), r["epoch"].isoformat()) for r in got} == {(63.4, 0.012, 13.41, 0.00012345, "2024-01-01T12:00:00")}


def test_aircraft_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("'Model','unknown','OPERATOR','icao24'\n'A320','x','O''Brien, Inc',' abc123 '\n'B737','x','','def456'\n'too','few'\n'a','b','c','d','e'\n'A','x','y',''\n\n")
    got = files.read_aircraft(spark, str(tmp_path / "a.csv")).orderBy("icao24").collect()
    assert [(r["icao24"], r["model"], r["operator"], r["registration"]) for r in got] == [("ABC123", "A320", "O'Brien, Inc", ""), ("DEF456", "B737", "", "")]


def test_satellite_tsv(spark, tmp_path):
    head = "#JCAT\tSatcat\tName\tPLName\tLDate\tMass\tInc\tStatus"
    rows = ["# comment", "", "S1\t100\t-\tPayload\t1998 Nov  5\t12.5\t51.6\tO", "S2\t-\tFirst\tSecond", "-\t0\tNobody\t-\t-\t-\t-\t-", "-\t7\tx\ty\tbad\tbad\t-\t-"]
    (tmp_path / "s.tsv").write_text("\n".join([head, *rows]) + "\n")
    got = files.read_satellites(spark, str(tmp_path / "s.tsv")).orderBy("sat_key").collect()
    assert [(r["sat_key"], r["object_name"], r["launch_date"], r["mass_kg"]) for r in got] == [("100", "Payload", dt.date(1998, 11, 5), 12.5), ("7", "x", None, 0.0), ("S2", "First", None, 0.0)]


def test_object_listing(spark, tmp_path):
    item = lambda k, s, t: f"<Contents><Key>{k}</Key><Size>{s}</Size><LastModified>{t}</LastModified></Contents>"
    (tmp_path / "l.xml").write_text("<ListBucketResult>" + item("m/aircraft-1.csv", 60_000_000, "2024-01-01T00:00:00Z") + item("m/aircraft-2.csv", 10, "2024-02-01T00:00:00Z") + item("m/Aircraft-3.CSV", 50_000_000, "2024-01-15T00:00:00Z") + item("m/ship.csv", 60_000_000, "2024-03-01T00:00:00Z") + "</ListBucketResult>")
    from geotide.operators import dims

    got = dims.latest_object(files.object_listing(spark, str(tmp_path / "l.xml")), dims.is_aircraft_csv(F.col("key"))).collect()
    assert [r["key"] for r in got] == ["m/Aircraft-3.CSV"]


def test_store(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("event_time"), F.lit("a").alias("asset_type"))
    files.append(df, str(tmp_path / "t"), ["asset_type", "event_time"])
    files.append(df.limit(0), str(tmp_path / "t"), ["asset_type", "event_time"])
    at = lambda s: F.lit(s).cast("timestamp")
    part = files.scan(spark, str(tmp_path / "t"), at("2024-01-02 00:30:00"), at("2024-01-02 05:00:00"))
    assert sorted(r["id"] for r in part.collect()) == [25, 26, 27, 28]
    assert "PartitionFilters: [isnotnull(event_hour" in part._jdf.queryExecution().toString()


def test_satellite_events(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    rows = [("ISS", "2024-01-01T23:50:00", 15.4887769, 0.00064516, 51.6326, 25544, 1e-4), ("OLD", "2023-12-01T00:00:00", 15.4887769, 0.00064516, 51.6326, 1, 1e-4), ("TDRS", "2024-01-01T00:00:00", 1.00271, 0.0003, 1.5, 2, 0.0)]
    df = spark.createDataFrame(rows, "OBJECT_NAME string, EPOCH string, MEAN_MOTION double, ECCENTRICITY double, INCLINATION double, NORAD_CAT_ID int, BSTAR double")
    for c in ("RA_OF_ASC_NODE", "ARG_OF_PERICENTER", "MEAN_ANOMALY"):
        df = df.withColumn(c, F.lit(10.0))
    got = {r["callsign"]: r for r in feeds.satellite_events(feeds.omm(df), now).collect()}
    assert set(got) == {"ISS", "OLD", "TDRS"} and abs(got["TDRS"]["alt"] - 35_786_000) < 300_000 and got["ISS"]["confidence"] == "official" and got["OLD"]["confidence"] == "stale"
    assert 300_000 < got["ISS"]["alt"] < 500_000 and got["ISS"]["source"] == "celestrak"
