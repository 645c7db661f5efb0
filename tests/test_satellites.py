"""Ticks, element sets by version, and the satellite service."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from geotide import cli, codes, settings
from geotide.sources import elements
from geotide.sources.ticks import TickReader
from geotide.streaming import apps, supervise
from tests.test_live import Bus

RECORD = {
    "OBJECT_NAME": "ONE", "OBJECT_ID": "1998-067A", "EPOCH": "2026-01-01T00:00:00.000000", "MEAN_MOTION": 15.5, "ECCENTRICITY": 0.0006, "INCLINATION": 51.6, "RA_OF_ASC_NODE": 100.0,
    "ARG_OF_PERICENTER": 50.0, "MEAN_ANOMALY": 310.0, "EPHEMERIS_TYPE": 0, "CLASSIFICATION_TYPE": "U", "NORAD_CAT_ID": 1, "ELEMENT_SET_NO": 999, "REV_AT_EPOCH": 1, "BSTAR": 0.0001, "MEAN_MOTION_DOT": 0.0, "MEAN_MOTION_DDOT": 0.0,
}
GEO = RECORD | {"NORAD_CAT_ID": 2, "OBJECT_NAME": "TWO", "MEAN_MOTION": 1.0027, "ECCENTRICITY": 0.0001, "INCLINATION": 0.1}


def test_ticks():
    now = [1_000_000.0]
    reader = TickReader({}, lambda: now[0])
    rows, at = reader.read(reader.initialOffset())
    assert sorted(r[0] for r in rows) == sorted(codes.TICK_SECONDS) and at == {r: int(now[0] // s) for r, s in codes.TICK_SECONDS.items()}
    assert [tuple(r) for r in TickReader({}).readBetweenOffsets({}, at)] == list(TickReader({}).readBetweenOffsets(reader.initialOffset(), at))
    rows, same = reader.read(at)
    assert list(rows) == [] and same == at
    now[0] += 120
    rows, later = reader.read(at)
    rows = list(rows)
    assert {r: sum(x[0] == r for x in rows) for r in codes.TICK_SECONDS} == {"leo": 4, "meo": 2, "geo": 1, "heo": 4}
    assert list(TickReader({}).readBetweenOffsets(at, later)) == rows and all(x[1].timestamp() % codes.TICK_SECONDS[x[0]] == 0 for x in rows)
    now[0] += 86_400  # after a day off the ticks come in several batches, none is left out
    seen, at = len(rows), later
    while True:
        rows, end = reader.read(at)
        rows = list(rows)
        if not rows:
            break
        assert max(sum(x[0] == r for x in rows) for r in codes.TICK_SECONDS) <= reader.most
        seen, at = seen + len(rows), end
    assert at == {r: int(now[0] // s) for r, s in codes.TICK_SECONDS.items()}


@pytest.fixture
def site():
    said = {"/a": (200, [RECORD]), "/b": (200, [GEO, RECORD | {"EPOCH": "2025-12-01T00:00:00"}]), "/limit": (403, []), "/down": (500, []), "/odd": (200, {})}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            status, body = said[self.path]
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    server.said, server.at = said, f"http://127.0.0.1:{server.server_port}"
    yield server
    server.shutdown()


def test_element_versions(spark, site, tmp_path):
    path = str(tmp_path / "elements")
    with pytest.raises(elements.RateLimited):
        elements.fetch(site.at + "/limit")
    for bad in ("/down", "/odd"):
        with pytest.raises(RuntimeError):
            elements.refresh(spark, [site.at + "/a", site.at + bad], path, 1)
    assert not (tmp_path / "elements").exists()
    assert elements.refresh(spark, [site.at + "/a", site.at + "/b"], path, 1000) == 2
    site.said["/a"] = (200, [RECORD | {"MEAN_MOTION": 15.1, "EPOCH": "2026-01-02T00:00:00"}])
    assert elements.refresh(spark, [site.at + "/a"], path, 2000) == 1
    got = {r["norad_id"]: r for r in elements.newest(spark, path).collect()}
    assert got[1]["mean_motion"] == 15.1 and got[1]["maneuvering"] and got[2]["mean_motion"] == 1.0027 and not got[2]["maneuvering"]
    tries = []

    def limited():
        tries.append(1)
        return elements.fetch(site.at + ("/limit" if len(tries) < 3 else "/a"))

    assert supervise.first_success(limited, threading.Event(), 0.01, 0.02)[0]["OBJECT_NAME"] == "ONE" and len(tries) == 3


def test_service(spark, site, tmp_path):
    path = str(tmp_path / "elements")
    elements.refresh(spark, [site.at + "/a", site.at + "/b"], path, 1000)
    queries, counters = apps.start_satellites(spark, path, str(tmp_path / "s"), str(tmp_path / "c"), ttl_hours=None, leo=1, geo=2)
    stored = apps.opened(spark, str(tmp_path / "s"), "satellite", None)
    for _ in range(90):
        if queries[0].exception() or counters.flushed >= 6:
            break
        time.sleep(1)
    queries[0].stop()
    rows = stored.read("events").select("asset_id", "orbit_regime", F.unix_seconds("event_time").alias("t"), "lat", "alt").collect()
    at = {k: sorted(r["t"] for r in rows if r["asset_id"] == k) for k in ("1", "2")}
    assert len(at["1"]) >= 3 and at["1"] == list(range(at["1"][0], at["1"][-1] + 1)) and all(t % 2 == 0 for t in at["2"])
    assert {r["orbit_regime"] for r in rows if r["asset_id"] == "1"} == {"leo"} and apps.latest_view(stored).count() == 2
    # a batch that is replayed adds nothing
    ticks = spark.createDataFrame([("leo", "2026-01-01 00:00:00")], "orbit_regime string, t string").select("orbit_regime", F.col("t").cast("timestamp").alias("tick_time"))
    sink = apps.satellite_sink(stored, path, apps.Counters(), stream="again")
    n = stored.read("events").count()
    for _ in range(2):
        sink(ticks, 0)
    assert stored.read("events").count() == n + 1


def test_feeds(spark, tmp_path):
    where = lambda url, **more: settings.Integration("n", url, **more)
    for url in ("https://x/y", "wss://x", "resp://x", "nats://x"):
        df = apps.feed(spark, "vessel", where(url), str(tmp_path))
        assert df.isStreaming and df.columns == ["body", "fetched_at"]
    with pytest.raises(ValueError, match="no feed"):
        apps.feed(spark, "vessel", where("ftp://x"), str(tmp_path))


def test_live_services(spark, site, tmp_path):
    """Feeds that are asked again and again, from a settings file to the store and the bus."""
    bus = Bus("resp")
    state = ["abc123", "CALL1", "X", 1, 2, 10.0, 50.0, 1000.0, False, 100.0, 90.0, 1.0, None, 1000.0, "1234", False, 0, 3]
    site.said["/states"] = (200, {"time": int(time.time()), "states": [state]})
    (tmp_path / "s.toml").write_text(
        f'''store = "{tmp_path}/store"\ncheckpoints = "{tmp_path}/c"\nspool = "{tmp_path}/spool"\nbus = "{bus.url}"\nttl_hours = 100000
[[integrations.aircraft]]\nname = "sky"\napi_url = "{site.at}/states"\ninterval = 1\n[[integrations.satellite]]\nname = "sets"\napi_url = "{site.at}/a"\n'''
    )
    s, stop, failures = settings.load(str(tmp_path / "s.toml")), threading.Event(), []
    with pytest.raises(ValueError, match="vessel"):
        cli.serve(spark, s, ["vessel"], stop)
    t = threading.Thread(target=cli.serve, args=(spark, s, ["aircraft", "satellite"], stop, lambda *e: failures.append(e)))
    t.start()
    views = {k: apps.opened(spark, s.store, k, s.ttl_hours) for k in ("aircraft", "satellite")}
    for _ in range(90):
        time.sleep(1)
        if failures or bus.got and all("events" in v.record()["tables"] for v in views.values()):
            break
    stop.set()
    t.join(90)
    assert not failures
    assert [(r["asset_id"], r["source"]) for r in apps.latest_view(views["aircraft"]).collect()] == [("ABC123", "sky")]
    assert apps.latest_view(views["satellite"]).first()["asset_id"] == "1" and bus.got
