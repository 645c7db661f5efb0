"""Consumer groups on a bus: publish, read, kill at any point, start again, and nothing is lost or counted twice."""

import json
import threading
import time

import pytest

from geotide.sources.subscribe import BusReader, BusSource
from tests.test_live import Server


class Streams:
    """A bus that keeps messages, in either protocol; groups have a place and what is delivered but not acknowledged."""

    def __init__(self, kind):
        self.log, self.place, self.pending, self.acked, self.lock = [], 0, {}, [], threading.Lock()
        self.drop_after_delivery = False
        self.server = Server(self.resp if kind == "resp" else self.nats)
        self.url = f"{kind}://127.0.0.1:{self.server.port}"

    def take(self, n):
        with self.lock:
            got = list(range(self.place, min(len(self.log), self.place + n)))
            self.place += len(got)
            self.pending.update({i: self.log[i] for i in got})
        return got

    def resp(self, conn, n):
        f = conn.makefile("rb")
        bulk = lambda x: b"$%d\r\n%b\r\n" % (len(x), x)
        while line := f.readline():
            words = []
            for _ in range(int(line[1:])):
                words.append(f.read(int(f.readline()[1:]) + 2)[:-2].decode())
            if words[0] == "XGROUP":
                conn.sendall(b"+OK\r\n" if n == 0 else b"-BUSYGROUP it exists\r\n")
            elif words[0] == "XACK":
                with self.lock:
                    for w in words[3:]:
                        self.acked.append(int(w.split("-")[0]) - 1)
                        self.pending.pop(self.acked[-1], None)
                conn.sendall(b":%d\r\n" % (len(words) - 3))
            elif words[0] == "XREADGROUP":
                count, after = int(words[words.index("COUNT") + 1]), words[-1]
                if after == ">":
                    got, end = self.take(count), time.monotonic() + 0.2
                    while not got and time.monotonic() < end:
                        time.sleep(0.02)
                        got = self.take(count)
                else:
                    got = [i for i in sorted(self.pending) if i + 1 > int(after.split("-")[0])][:count]
                if self.drop_after_delivery:
                    return
                entries = b"".join(b"*2\r\n" + bulk(b"%d-0" % (i + 1)) + b"*2\r\n" + bulk(b"body") + bulk(self.log[i].encode()) for i in got)
                conn.sendall(b"*1\r\n*2\r\n" + bulk(b"s") + b"*%d\r\n" % len(got) + entries if got or after != ">" else b"*-1\r\n")

    def nats(self, conn, n):
        with self.lock:  # what a lost member held is delivered again
            again = sorted(self.pending)
        f = conn.makefile("rb")
        conn.sendall(b'INFO {"version": "0"}\r\n')
        while line := f.readline():
            words = line.split()
            if words[0] == b"PING":
                conn.sendall(b"PONG\r\n")
            elif words[0] == b"PUB" and words[1].startswith(b"$JS.API"):
                ask = json.loads(f.read(int(words[3]) + 2))
                got = again[: ask["batch"]]
                again = again[len(got) :]
                got += self.take(ask["batch"] - len(got))
                if self.drop_after_delivery:
                    return
                for i in got:
                    body = self.log[i].encode()
                    conn.sendall(b"MSG x 1 $JS.ACK.s.g.1.%d.%d.0.0 %d\r\n%b\r\n" % (i + 1, i + 1, len(body), body))
                if len(got) < ask["batch"]:
                    head = b"NATS/1.0 408 Request Timeout\r\n\r\n"
                    conn.sendall(b"HMSG x 1 %d %d\r\n%b\r\n" % (len(head), len(head), head))
            elif words[0] == b"PUB":
                f.read(int(words[2]) + 2)
                with self.lock:
                    self.acked.append(int(words[1].split(b".")[5]) - 1)
                    self.pending.pop(self.acked[-1], None)


def options(bus, tmp_path):
    return {"url": bus.url, "subject": "s", "group": "g", "stream": "s", "rows": "4", "seconds": "0.3", "spool": str(tmp_path / "spool")}


def drain(reader, at, want):
    got = []
    for _ in range(40):
        rows, at = reader.read(at)
        got += [r[0] for r in rows]
        if len(got) >= want:
            break
    return got, at


@pytest.mark.parametrize("kind", ["resp", "nats"])
def test_group(kind, tmp_path):
    bus = Streams(kind)
    bus.log += [f"m{i} é" for i in range(10)]
    reader = BusReader(options(bus, tmp_path))
    got, at = drain(reader, reader.initialOffset(), 10)
    assert got == bus.log and at == {"batches": 3} and sorted(bus.acked) == list(range(10)) and not bus.pending
    assert [r[0] for r in BusReader(options(bus, tmp_path)).readBetweenOffsets({"batches": 1}, at)] == bus.log[4:]
    reader.commit({"batches": 2})
    assert reader.spool.numbers() == [2]
    rows, same = reader.read(at)
    assert list(rows) == [] and same == at


@pytest.mark.parametrize("kind", ["resp", "nats"])
@pytest.mark.parametrize("killed", ["delivered", "spooled", "acknowledged"])
def test_killed_and_started_again(kind, killed, tmp_path, monkeypatch):
    bus = Streams(kind)
    bus.log += [f"m{i}" for i in range(6)]
    first = BusReader(options(bus, tmp_path))
    got, at = drain(first, first.initialOffset(), 4)
    if killed == "delivered":  # the bus has sent it, and nobody has it
        bus.drop_after_delivery = True
        with pytest.raises(OSError):
            first.read(at)
        bus.drop_after_delivery = False
    else:
        if killed == "spooled":
            monkeypatch.setattr(first.member, "acknowledge", lambda numbers: (_ for _ in ()).throw(ConnectionError("killed")))
            with pytest.raises(OSError):
                first.read(at)
        else:
            first.read(at)  # but its offset was never written
    bus.log.append("late")
    again = BusReader(options(bus, tmp_path))
    more, at = drain(again, at, 3)
    assert got + more == [*[f"m{i}" for i in range(6)], "late"]
    rows, _ = again.read(at)
    assert list(rows) == [] and not bus.pending


def test_no_such_bus():
    with pytest.raises(ValueError, match="no bus protocol"):
        BusReader({"url": "pigeon://x"})


def test_stream(spark, tmp_path):
    bus = Streams("resp")
    bus.log += [f"m{i}" for i in range(9)]
    spark.dataSource.register(BusSource)

    def run(want):
        q = spark.readStream.format("bus_feed").options(**options(bus, tmp_path)).load().select("body").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).start()
        for _ in range(120):
            if q.exception() or (tmp_path / "out/_spark_metadata").exists() and spark.read.schema("body string").parquet(str(tmp_path / "out")).count() >= want:
                break
            time.sleep(0.5)
        q.stop()

    run(9)
    bus.log += ["x", "y"]
    run(11)
    assert sorted(r["body"] for r in spark.read.schema("body string").parquet(str(tmp_path / "out")).collect()) == sorted(bus.log)
