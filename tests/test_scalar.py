import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from geotide import codes
from geotide.functions import cells, orbit, scalar


def values(spark, schema, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


@pytest.mark.parametrize(("deg", "want"), [(51.5074, 515074000), (-33.8688, -338688000), (0.0001, 1000), (90.0, 900000000), (-180.0, -1800000000), (300.0, None), (0.5e-7, 1), (-0.5e-7, -1)])
def test_scale(spark, deg, want):
    assert values(spark, "d double", [(deg,)], scalar.scale_degrees(F.col("d"))) == [(want,)]


def test_codes(spark):
    rows = [(c,) for c in (0, 1, 5, 7, 15, 99, -1, None)]
    got = [r[0] for r in values(spark, "c int", rows, scalar.nav_status(F.col("c")))]
    assert got == ["under_way_using_engine", "at_anchor", "moored", "engaged_in_fishing", "not_defined", "not_defined", "not_defined", "not_defined"]
    rows = [(c,) for c in (0, 30, 35, 36, 37, 52, 60, 70, 80, 99, 54, 38, 10, 123)]
    got = [r[0] for r in values(spark, "c int", rows, scalar.ship_type(F.col("c")))]
    assert got == ["", "fishing", "military", "sailing", "pleasure_craft", "tug", "passenger", "cargo", "tanker", "other", "special", "special", "reserved", "other"]
    got = [r[0] for r in values(spark, "c int", [(0,), (1,), (8,), (17,), (18,), (-1,)], scalar.emitter_category(F.col("c")))]
    assert got == ["none", "none", "rotorcraft", "surface_service", "", ""]


def test_times(spark):
    rows = [("2024-01-02T03:04:05Z",), ("2024-01-02T05:04:05+02:00",), ("2024-01-02 03:04:05.123456789 +0000 UTC",), ("2024-01-02 03:04:05",), ("x",), (None,)]
    got = [r[0] for r in values(spark, "t string", rows, F.unix_seconds(scalar.feed_time(F.col("t"))))]
    assert got == [1704164645] * 3 + [None] * 3
    rows = [("1998 Nov 20",), ("1998 Nov  5",), ("1998-11-20",), ("1998",), ("1998 Nov 99",), (None,)]
    got = [r[0] for r in values(spark, "t string", rows, scalar.launch_date(F.col("t")))]
    assert got == [dt.date(1998, 11, 20), dt.date(1998, 11, 5), dt.date(1998, 11, 20), None, None, None]
    assert values(spark, "m int, d int", [(4, 15), (0, 15), (4, None)], scalar.eta(F.col("m"), F.col("d"), F.lit(6), F.lit(0))) == [("04-15 06:00",), ("",), ("",)]


def fnv(data: bytes) -> int:
    h = 14695981039346656037
    for b in data:
        h = (h ^ b) * 1099511628211 % 2**64
    return h


def test_fnv(spark):
    texts = ["", "a", "1712345678500|10.0.0.0/24|hijack|13335", "é☃" * 40]
    got = values(spark, "t string", [(t,) for t in texts], scalar.fnv1a(F.col("t")))
    assert [int(r[0]) for r in got] == [fnv(t.encode()) for t in texts]
    assert values(spark, "t string", [("a",)], scalar.hex64(scalar.fnv1a(F.col("t")))) == [("af63dc4c8601ec8c",)]


def test_asn(spark):
    rows = [("AS13335",), ("as1",), (" 42 ",), ("4294967295",), ("4294967296",), ("AS",), ("-1",), (None,)]
    assert [r[0] for r in values(spark, "t string", rows, scalar.asn(F.col("t")))] == [13335, 1, 42, 4294967295, None, None, None, None]


def test_cells(spark):
    rows = [(51.5, -0.12), (-33.9, 151.2), (90.0, 180.0), (-90.0, -180.0), (91.0, 0.0)]
    df = spark.createDataFrame(rows, "lat double, lon double").withColumn("c", cells.cell(F.col("lat"), F.col("lon")))
    got = df.select("c", *[cells.parent(F.col("c"), r).alias(f"p{r}") for r in range(8)], cells.cell_hex(F.col("c")).alias("h"), *[cells.cell(F.col("lat"), F.col("lon"), r).alias(f"d{r}") for r in range(8)]).collect()
    assert got[4]["c"] is None
    for r in got[:4]:
        assert r["p7"] == r["c"] and len(r["h"]) == 15
        for res in range(8):
            assert r[f"p{res}"] == r[f"d{res}"]  # an ancestor is the cell of that resolution
            assert (r[f"p{res}"] >> 52) & 15 == res


@pytest.mark.parametrize(("n", "e", "regime"), [(15.4887769, 0.00064516, "leo"), (1.00271, 0.0003, "geo"), (2.00562, 0.004, "meo"), (2.006, 0.74, "heo")])
def test_regimes(spark, n, e, regime):
    row = orbit.parameters(spark.createDataFrame([(n, e)], "mean_motion double, eccentricity double")).first()
    assert row["orbit_regime"] == regime
    if regime == "leo":
        assert abs(row["period_minutes"] - 93) < 2 and 350 < row["perigee_km"] < 450


def test_status(spark):
    rows = [(92.0, 91.0, 51.6, 51.6, True), (92.0, 92.0, 51.6, 52.0, True), (92.0, 92.001, 51.6, 51.601, False), (None, 92.0, None, 51.6, False), (0.0, 92.0, 51.6, 51.6, False)]
    got = values(spark, "op double, p double, oi double, i double, want boolean", rows, orbit.maneuvered(F.col("p"), F.col("op"), F.col("i"), F.col("oi")), "want")
    assert all(a == b for a, b in got)
    got = values(spark, "m boolean, p double, b double", [(True, 100.0, 0.0), (False, 120.0, 0.0), (False, 400.0, 0.02), (False, 400.0, 0.0)], orbit.status(F.col("m"), F.col("p"), F.col("b")))
    assert [r[0] for r in got] == ["maneuvering", "decaying", "decaying", ""]


def test_sgp4_published_case():
    """Near-earth test case of Spacetrack Report 3, positions at 0 and 360 minutes."""
    for t, want in ((0.0, (2328.97, -5995.22, 1719.97)), (360.0, (2456.11, -6071.94, 1222.90))):
        got = orbit.sgp4([16.05824518], [0.0086731], [72.8435], [115.9689], [52.6988], [110.5714], [0.66816e-4], [t])
        assert abs(got[:, 0] - want).max() < 0.05


def test_sgp4_iss(spark):
    now = spark.createDataFrame([(15.4887769, 0.00064516, 51.6326, 10.0, 20.0, 30.0, 1e-4, 0, 600_000)], "n double, e double, i double, o double, w double, m double, b double, t0 long, t long")
    r = now.select(orbit.propagate(*[F.col(c) for c in ("n", "e", "i", "o", "w", "m", "b", "t0", "t")]).alias("p")).first()["p"]
    assert abs(r["lat"]) < 52 and 300 < r["alt_km"] < 500 and abs(r["lon"]) <= 180
    # a day of a geostationary orbit: the longitude stays
    day = now.withColumns({"n": F.lit(1.00273), "e": F.lit(0.0001), "i": F.lit(0.05), "b": F.lit(0.0)}).withColumn("t", F.explode(F.sequence(*[F.lit(x).cast("long") for x in (0, 86_400_000, 7_200_000)])))
    got = day.select(orbit.propagate(*[F.col(c) for c in ("n", "e", "i", "o", "w", "m", "b", "t0", "t")]).alias("p")).select("p.*").collect()
    assert max(r["lon"] for r in got) - min(r["lon"] for r in got) < 0.5 and all(abs(r["lat"]) < 0.2 and abs(r["alt_km"] - 35_786) < 60 for r in got)


#: Published verification positions (km) of deep-space sets: elements, epoch as year and day, minutes and position.
DEEP = [
    ((2.28537848, 0.7318036, 46.7916, 230.4354, 47.4722, 10.4117, 0.14311e-1), (1980, 230.29629788), 0.0, (7473.37066650, 428.95261765, 5828.74846783), 0.05),
    ((2.28537848, 0.7318036, 46.7916, 230.4354, 47.4722, 10.4117, 0.14311e-1), (1980, 230.29629788), 1440.0, (9787.86975097, 33753.34667969, -15030.81176758), 0.05),
    ((2.00491383, 0.6877146, 64.1586, 279.0717, 264.7651, 20.2257, 0.11873e-3), (2006, 176.33215444), 0.0, (2349.89483350, -14785.93811562, 0.02119378), 1e-6),
    ((2.00491383, 0.6877146, 64.1586, 279.0717, 264.7651, 20.2257, 0.11873e-3), (2006, 176.33215444), 120.0, (15223.91713658, -17852.95881713, 25280.39558224), 1e-6),
    ((1.00778054, 0.0026640, 3.8536, 80.0121, 311.0977, 48.3000, 0.10000e-3), (2006, 177.04061740), 0.0, (7534.10987189, 41266.39266843, -0.10801028), 1e-6),
    ((1.00778054, 0.0026640, 3.8536, 80.0121, 311.0977, 48.3000, 0.10000e-3), (2006, 177.04061740), 120.0, (-14289.19940414, 39469.05530051, 1428.62838591), 1e-6),
]


@pytest.mark.parametrize(("elements", "epoch", "minutes", "want", "off"), DEEP)
def test_sdp4_published_cases(elements, epoch, minutes, want, off):
    """An eccentric orbit without resonance, a half-day one and a daily one; beside a near-earth set in the same call."""
    since = (dt.datetime(epoch[0], 1, 1) - dt.datetime(1949, 12, 31)).days + epoch[1] - 1
    near = (16.05824518, 0.0086731, 72.8435, 115.9689, 52.6988, 110.5714, 0.66816e-4)
    got = orbit.sgp4(*zip(elements, near, strict=True), [minutes, 360.0], [since, 11236.0])
    assert abs(got[:, 0] - want).max() < off and abs(got[:, 1] - (2456.11, -6071.94, 1222.90)).max() < 0.05
    assert np.isnan(orbit.sgp4(*([x] for x in elements), [minutes])).all()  # without an epoch there is no Sun to place


def test_constants():
    assert len(codes.EMITTER_CATEGORIES) == 18 and len(codes.NAV_STATES) == 16 and len(codes.TIER1_ASNS) == 18 and len(codes.SEED_ASNS) == 53
    assert set(codes.SEED_ASNS.values()) <= set(codes.CENTROIDS)
