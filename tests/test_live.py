"""Socket feeds, bus sinks, restarts and services, against small servers on this machine."""

import base64
import hashlib
import json
import os
import socket
import struct
import threading
import time

import pytest
from pyspark.sql import functions as F

from geotide import cli, settings
from geotide.operators import broadcast, lookup
from geotide.sources.bus import BusSink
from geotide.sources.sockets import SocketReader, SocketSource, WebSocket, routing_subscription, vessel_subscription
from geotide.streaming import apps, supervise


class Server:
    """Accepts connections one after the other and hands each to ``talk(connection, number)``."""

    def __init__(self, talk):
        self.listener = socket.create_server(("127.0.0.1", 0))
        self.port, self.errors = self.listener.getsockname()[1], []

        def run():
            n = 0
            while True:
                try:
                    conn, _ = self.listener.accept()
                except OSError:
                    return
                threading.Thread(target=self._one, args=(talk, conn, n), daemon=True).start()
                n += 1

        threading.Thread(target=run, daemon=True).start()

    def _one(self, talk, conn, n):
        try:
            with conn:
                talk(conn, n)
        except Exception as e:
            self.errors.append(e)


def frame(body, kind=1, last=True):
    n = len(body)
    size = bytes([n]) if n < 126 else struct.pack("!BH", 126, n) if n < 1 << 16 else struct.pack("!BQ", 127, n)
    return bytes([(0x80 if last else 0) | kind]) + size + body


def shake(conn):
    """Server side of the handshake; returns what the client sends first."""
    f = conn.makefile("rb")
    head = {}
    f.readline()
    while (line := f.readline().strip()):
        k, v = line.decode().split(": ", 1)
        head[k] = v
    accept = base64.b64encode(hashlib.sha1(head["Sec-WebSocket-Key"].encode() + b"258EAFA5-E914-47DA-95CA-C5AB0DC85B11").digest())
    conn.sendall(b"HTTP/1.1 101 Switching Protocols\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Accept: " + accept + b"\r\n\r\n")
    first, size = f.read(2)
    size &= 127
    if size == 126:
        size = struct.unpack("!H", f.read(2))[0]
    mask = f.read(4)
    return bytes(b ^ mask[i % 4] for i, b in enumerate(f.read(size))).decode(), f


@pytest.fixture
def feed():
    heard = []

    def talk(conn, n):
        said, f = shake(conn)
        heard.append(said)
        big = "x" * 70_000
        conn.sendall(frame(f"a{n}".encode()) + frame(b"hi", 9) + frame(b"two ", 1, False) + frame(b"parts", 0) + frame(big.encode()))
        if n == 0:
            return  # lost
        time.sleep(5)

    server = Server(talk)
    server.heard = heard
    return server


def test_socket_feed(feed, tmp_path):
    options = {"url": f"ws://127.0.0.1:{feed.port}/v0?x=1", "subscribe": routing_subscription(), "seconds": "2.5", "spool": str(tmp_path / "s")}
    reader = SocketReader(options)
    reader.backoff = supervise.Backoff(0.1)
    rows, at = reader.read(reader.initialOffset())
    got = [r[0] for r in rows]
    assert got[:2] == ["a0", "two parts"] and len(got[2]) == 70_000 and at == {"batches": 1}
    if len(got) == 3:  # the connection was lost; the next batch has the new one's messages
        rows, at = reader.read(at)
        got += [r[0] for r in rows]
    assert got[3:5] == ["a1", "two parts"] and json.loads(feed.heard[0]) == {"type": "ris_subscribe", "data": {"type": "UPDATE"}} and len(feed.heard) == 2
    again = [r[0] for r in SocketReader(options).readBetweenOffsets({"batches": 0}, at)]
    assert again == got
    reader.socket.close()


def test_message_limit_and_subscription(feed):
    s = WebSocket(f"ws://127.0.0.1:{feed.port}/", limit=1000)
    s.send("go")
    end = time.monotonic() + 5
    assert s.receive(end) == "a0" and s.receive(end) == "two parts"
    with pytest.raises(ConnectionError, match="1000"):
        s.receive(end)
    said = json.loads(vessel_subscription("k"))
    assert said == {"APIKey": "k", "BoundingBoxes": [[[-90, -180], [90, 180]]], "FilterMessageTypes": ["PositionReport", "StandardClassBPositionReport", "ShipStaticData"]}


def test_socket_stream(spark, feed, tmp_path):
    spark.dataSource.register(SocketSource)
    stream = spark.readStream.format("socket_feed").option("url", f"ws://127.0.0.1:{feed.port}/").option("subscribe", "go").option("rows", 3).option("spool", str(tmp_path / "s")).load()
    q = stream.writeStream.format("memory").queryName("sockets").option("checkpointLocation", str(tmp_path / "c")).start()
    for _ in range(120):
        if spark.table("sockets").count() >= 3 or q.exception():
            break
        time.sleep(0.5)
    q.stop()
    assert {"a0", "two parts"} <= {r["body"] for r in spark.table("sockets").collect()}


class Bus:
    """Takes published messages in either protocol."""

    def __init__(self, kind):
        self.got, self.kind, self.lock = [], kind, threading.Lock()
        self.server = Server(self.resp if kind == "resp" else self.nats)
        self.url = f"{kind}://127.0.0.1:{self.server.port}"

    def resp(self, conn, n):
        f = conn.makefile("rb")
        while (line := f.readline()):
            parts = []
            for _ in range(int(line[1:])):
                size = int(f.readline()[1:])
                parts.append(f.read(size + 2)[:-2].decode())
            if parts[1] == "refused":
                conn.sendall(b"-NOPERM no\r\n")
                continue
            with self.lock:
                self.got.append(tuple(parts[1:]))
            conn.sendall(b":1\r\n")

    def nats(self, conn, n):
        f = conn.makefile("rb")
        conn.sendall(b'INFO {"version": "0"}\r\n')
        while (line := f.readline()):
            if line.startswith(b"PUB"):
                _, channel, size = line.split()
                with self.lock:
                    self.got.append((channel.decode(), f.read(int(size) + 2)[:-2].decode()))
            elif line == b"PING\r\n":
                conn.sendall(b"PONG\r\n")


@pytest.mark.parametrize("kind", ["resp", "nats"])
def test_bus(spark, kind):
    bus = Bus(kind)
    spark.dataSource.register(BusSink)
    rows = [(f"c{i % 3}", f"body {i} é\r\n" + "x" * (i * 50)) for i in range(120)]
    spark.createDataFrame(rows, "channel string, body string").repartition(3).write.format("bus").option("url", bus.url).option("rows", 7).mode("append").save()
    assert sorted(bus.got) == sorted(rows)


def test_bus_refusals_fail_the_job(spark):
    bus = Bus("resp")
    spark.dataSource.register(BusSink)
    with pytest.raises(Exception, match="NOPERM"):
        spark.createDataFrame([("refused", "x")], "channel string, body string").write.format("bus").option("url", bus.url).mode("append").save()
    with pytest.raises(Exception, match="no bus protocol"):
        spark.createDataFrame([("c", "x")], "channel string, body string").write.format("bus").option("url", "pigeon://x").mode("append").save()


def test_backoff():
    now = [0.0]
    b = supervise.Backoff(1, 60, 60, lambda: now[0])
    waits = []
    for _ in range(8):
        b.started()
        waits.append(b.failed())
    assert waits == [1, 2, 4, 8, 16, 32, 60, 60]
    b.started()
    now[0] += 61
    assert b.failed() == 1


def test_first_success():
    tries, stop = [], threading.Event()

    def fetch():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("not yet")
        return "elements"

    assert supervise.first_success(fetch, stop, 0.01) == "elements" and len(tries) == 3
    stop.set()
    assert supervise.first_success(fetch, stop) is None


def test_a_failed_query_starts_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\n")
    seen, failures = [], []

    def sink(df, batch_id):
        if not failures:
            raise ValueError("first time")
        seen.extend(r["value"] for r in df.collect())

    def start():
        return spark.readStream.text(str(tmp_path / "in")).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()

    supervise.keep_running(start, threading.Event(), supervise.Backoff(0.1), lambda e, wait: failures.append(wait))
    assert sorted(seen) == ["one", "two"] and failures == [0.1]


def lines(folder, name, docs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"body": json.dumps(d)}) + "\n" for d in docs))
    os.utime(folder / name, (1_700_000_000 + int(name[0]),) * 2)  # files are taken by age


def bodies(spark, folder):
    return spark.readStream.schema("body string").option("maxFilesPerTrigger", 1).json(str(folder))


def test_vessel_service(spark, tmp_path):
    bus = Bus("resp")
    spark.dataSource.register(BusSink)
    report = lambda i: {"MessageType": "PositionReport", "MetaData": {"MMSI": i, "ShipName": f"S{i}", "time_utc": "2024-03-05T07:08:09Z"}, "Message": {"PositionReport": {"Sog": 1.0, "Latitude": 10.0 + i, "Longitude": 20.0}}}
    lines(tmp_path / "in", "0.json", [report(i) for i in (1, 2)])
    lines(tmp_path / "in", "1.json", [report(i) for i in (3,)] + [{"junk": 1}])
    queries, counters = apps.start_telemetry(spark, "vessel", bodies(spark, tmp_path / "in"), "feed", str(tmp_path / "store"), str(tmp_path / "c"), bus.url, once=True, ttl_hours=None)
    for q in queries:
        q.awaitTermination()
    stored = apps.opened(spark, str(tmp_path / "store"), "vessel", None).read("events")
    assert sorted(r["asset_id"] for r in stored.collect()) == ["1", "2", "3"] and len(stored.columns) == 34
    assert counters.flushed == 3 and counters.published == 18 == len(bus.got)
    channel, body = bus.got[0]
    inner = json.loads(body)
    assert channel == "__anycable__" and inner["stream"].startswith("telemetry:") and json.loads(inner["data"])["type"] == "vessel"


def test_routing_service(spark, tmp_path):
    bus = Bus("resp")
    spark.dataSource.register(BusSink)

    def update(t, path, prefixes=(), withdrawn=()):
        return {"type": "ris_message", "data": {"timestamp": t, "peer": "p", "peer_asn": "3356", "id": "x", "host": "rrc00", "type": "UPDATE", "path": path, "announcements": [{"next_hop": "n", "prefixes": list(prefixes)}], "withdrawals": list(withdrawn)}}

    lines(tmp_path / "in", "0.json", [update(1.5, [701, 15169], ["8.8.8.0/24", "9.9.9.0/24"]), update(2, [701, 15169], ["8.8.8.0/24"])])
    lines(tmp_path / "in", "1.json", [update(3, [701, 13335], ["8.8.8.0/24"]), update(4, [], withdrawn=["9.9.9.0/24", "7.7.7.0/24"]), {"type": "other"}])
    cities = spark.createDataFrame([("8.8.8.0/24", 1.0, 2.0)], "network string, lat double, lon double")
    holders = spark.createDataFrame([("8.0.0.0/8", 15169, "Org")], "network string, asn long, org string")
    queries, counters = apps.start_routing(spark, bodies(spark, tmp_path / "in"), "ris", str(tmp_path / "store"), str(tmp_path / "c"), cities, holders, bus=bus.url, once=True, ttl_hours=None)
    queries[0].awaitTermination()
    stored = apps.opened(spark, str(tmp_path / "store"), "bgp", None)
    got = stored.read("events").collect()
    assert sorted((r["prefix"], r["category"], r["origin_as"]) for r in got) == [("8.8.8.0/24", "announcement", 15169), ("8.8.8.0/24", "hijack", 13335), ("9.9.9.0/24", "announcement", 15169), ("9.9.9.0/24", "withdrawal", 3356)]
    by = {(r["prefix"], r["category"]): r for r in got}
    assert by["8.8.8.0/24", "hijack"]["prefix_as"] == 15169 and by["8.8.8.0/24", "hijack"]["lat"] == 10000000 and by["9.9.9.0/24", "withdrawal"]["as_path"] == []
    assert counters.emitted == counters.published == 4 and all(json.loads(b)["stream"].startswith("bgp:") for _, b in bus.got)
    # after a restart the state is still there: the same origin again is no event, another one is a hijack
    lines(tmp_path / "in", "2.json", [update(5, [701, 13335], ["8.8.8.0/24"]), update(6, [701, 15169], ["8.8.8.0/24"])])
    queries, counters = apps.start_routing(spark, bodies(spark, tmp_path / "in"), "ris", str(tmp_path / "store"), str(tmp_path / "c"), cities, holders, once=True, ttl_hours=None)
    queries[0].awaitTermination()
    assert counters.emitted == 1 and stored.read("events").filter("category = 'hijack'").count() == 2


def test_known_kinds():
    assert apps.subject("bgp").endswith("bgp.events") and apps.known_kind("vessel") == "vessel"
    with pytest.raises(ValueError, match="aircraftx"):
        apps.known_kind("aircraftx")


def test_settings(tmp_path):
    path = tmp_path / "s.toml"
    good = 'store = "s"\ncheckpoints = "c"\nspool = "p"\nbus = "resp://x"\n'
    path.write_text(good + '[[integrations.aircraft]]\nname = "n"\napi_url = "u"\ninterval = 5\n')
    assert settings.load(str(path)).integrations["aircraft"][0].interval == 5
    for bad, why in (("store = 's'", "checkpoints"), (good + "stor = 'x'", "stor")):
        path.write_text(bad)
        with pytest.raises(ValueError, match=why):
            settings.load(str(path))


def test_refresh_keeps_images(spark, tmp_path):
    (tmp_path / "a.csv").write_text("'icao24','model'\n'abc','A'\n'def','B'\n")
    out = str(tmp_path / "dim")
    assert cli.refresh(spark, "aircraft", str(tmp_path / "a.csv"), None) == {"parsed": 2, "skipped": 0, "flushed": 0}
    assert cli.refresh(spark, "aircraft", str(tmp_path / "a.csv"), out) == {"parsed": 2, "skipped": 0, "flushed": 2}
    spark.read.parquet(out).filter("icao24 = 'ABC'").withColumns({"image_url": F.lit("u"), "image_attribution": F.lit("me"), "updated_at": F.current_timestamp()}).write.mode("append").parquet(out)
    (tmp_path / "a.csv").write_text("'icao24','model'\n'abc','A2'\n'def','B2'\n'','none'\n")
    assert cli.refresh(spark, "aircraft", str(tmp_path / "a.csv"), out) == {"parsed": 2, "skipped": 1, "flushed": 2}
    newest = {r["icao24"]: r for r in cli.dimension(spark, "aircraft", out).collect()}
    assert (newest["ABC"]["model"], newest["ABC"]["image_url"], newest["DEF"]["image_url"]) == ("A2", "u", "") and len(newest["ABC"].asDict()) == 17


def test_envelopes(spark):
    df = spark.createDataFrame([("s1", '{"a":1}')], "stream string, data string")
    assert [tuple(r) for r in broadcast.envelopes(df).collect()] == [("__anycable__", '{"stream":"s1","data":"{\\"a\\":1}"}')]
    assert broadcast.messages(spark.range(1), "t").first()["body"] == '{"id":0}'


def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["version"]) == 0 and capsys.readouterr().out.strip() == cli.VERSION
    assert cli.main(["run", "no_such_query", str(tmp_path)]) == 2 and "no_such_query" in capsys.readouterr().err
    spark.range(5).selectExpr("id AS c_custkey", "'n' AS c_name", "id AS c_acctbal", "'m' AS c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    assert cli.main(["run", "scan_project_filter", str(tmp_path), "--out", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    with pytest.raises(ValueError, match="vessels"):
        cli.main(["stream", "vessels", "x", "--store", "s", "--checkpoints", "c"])


def test_command_line_service(spark, tmp_path):
    doc = {"MessageType": "PositionReport", "MetaData": {"MMSI": 9, "ShipName": "S", "time_utc": "2024-03-05T07:08:09Z"}, "Message": {"PositionReport": {"Sog": 1.0, "Latitude": 10.0, "Longitude": 20.0}}}
    lines(tmp_path / "in", "0.json", [doc])
    assert cli.main(["stream", "vessel", str(tmp_path / "in"), "--store", str(tmp_path / "s"), "--checkpoints", str(tmp_path / "c"), "--once", "--ttl-hours", "1000000"]) == 0
    assert apps.opened(spark, str(tmp_path / "s"), "vessel", None).read("events").first()["source"] == "vessel"
