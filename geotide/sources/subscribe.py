"""A streaming source that takes messages from a bus as a member of a consumer group: one row (body, fetched_at) a message.

    spark.dataSource.register(BusSource)
    spark.readStream.format("bus_feed").option("url", "resp://host:6379").option("subject", "geotide.telemetry.vessel").option("group", "store").option("spool", folder).load()

The bus keeps the group's place.  A message is written to the spool before it
is acknowledged, so it is read again from the bus or from the spool, whatever
is killed in between; one that comes twice (its number says so) counts once.

Protocols: ``resp`` reads a stream of that name with XREADGROUP and XACK;
``nats`` pulls from a durable consumer (options ``stream`` and ``group``) and
acknowledges each message, or, without ``stream``, is a queue subscriber: then
the bus keeps nothing, and what is sent while no member listens is lost.

Options: ``url``, ``subject``, ``group``, ``consumer`` (name within the group,
default "1"), ``rows`` and ``seconds`` (a micro-batch ends at whichever comes
first), ``timeout``, ``spool``.
"""

from __future__ import annotations

import json
import socket
import time
import urllib.parse
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from geotide import codes
from geotide.schemas import struct
from geotide.sources.bus import NatsBus, RespBus
from geotide.sources.polling import _rows
from geotide.sources.spool import Spool


class RespGroup(RespBus):
    """A member of a consumer group of a stream; what was delivered to it and never acknowledged comes first."""

    def __init__(self, sock: socket.socket, password: str | None, options: dict):
        super().__init__(sock, password)
        self.stream, self.group, self.consumer = options["subject"], options["group"], options.get("consumer", "1")
        self.pending = "0"  # the next one to ask for of what is pending; '>' once there is none
        try:
            self._ask("XGROUP", "CREATE", self.stream, self.group, "0", "MKSTREAM")
        except ConnectionError as e:
            if "BUSYGROUP" not in str(e):  # it is there
                raise

    def _ask(self, *words: str) -> object:
        raw = [w.encode() for w in words]
        self.sock.sendall(b"*%d\r\n" % len(raw) + b"".join(b"$%d\r\n%b\r\n" % (len(x), x) for x in raw))
        return self._answer()

    def _answer(self) -> object:
        line = self.file.readline()
        if not line:
            raise ConnectionError("connection closed")
        kind, rest = line[:1], line[1:].strip()
        if kind == b"-":
            raise ConnectionError(f"bus refused: {rest.decode(errors='replace')}")
        if kind == b":":
            return int(rest)
        if kind == b"$":
            return None if int(rest) < 0 else self.file.read(int(rest) + 2)[:-2]
        if kind == b"*":
            return None if int(rest) < 0 else [self._answer() for _ in range(int(rest))]
        return rest

    def fetch(self, rows: int, seconds: float) -> list[tuple[str, str]]:
        wait = ["BLOCK", str(max(1, int(seconds * 1000)))] if self.pending == ">" else []
        said = self._ask("XREADGROUP", "GROUP", self.group, self.consumer, "COUNT", str(rows), *wait, "STREAMS", self.stream, self.pending)
        entries = said[0][1] if said else []
        if self.pending != ">":
            self.pending = entries[-1][0].decode() if entries else ">"
        out = []
        for number, fields in entries:
            if fields:  # a pending entry that the stream no longer has is nothing
                named = dict(zip(fields[::2], fields[1::2], strict=True))
                out.append((number.decode(), named.get(b"body", b"").decode(errors="replace")))
        return out

    def acknowledge(self, numbers: list[str]) -> None:
        self._ask("XACK", self.stream, self.group, *numbers)


class NatsGroup(NatsBus):
    """A puller of a durable consumer, or a queue subscriber."""

    def __init__(self, sock: socket.socket, password: str | None, options: dict):
        super().__init__(sock, password)
        self.stream, self.group, self.subject = options.get("stream"), options["group"], options["subject"]
        self.inbox = f"_INBOX.{self.group}.{options.get('consumer', '1')}.{time.time_ns()}"
        sub = f"SUB {self.inbox} 1" if self.stream else f"SUB {self.subject} {self.group} 1"
        self.sock.sendall(sub.encode() + b"\r\n")

    def _message(self) -> tuple[str, str, bytes, bytes] | None:
        """(subject, reply, headers, body) of the next message; None for other lines."""
        line = self.file.readline()
        if not line or line.startswith(b"-ERR"):
            raise ConnectionError(f"bus refused: {line.decode(errors='replace').strip() or 'connection closed'}")
        words = line.split()
        if words[0] == b"PING":
            self.sock.sendall(b"PONG\r\n")
        if words[0] not in (b"MSG", b"HMSG"):
            return None
        body, sizes = self.file.read(int(words[-1]) + 2)[:-2], 2 if words[0] == b"HMSG" else 1
        head = int(words[-2]) if sizes == 2 else 0
        reply = words[3].decode() if len(words) > 3 + sizes else ""
        return words[1].decode(), reply, body[:head], body[head:]

    def fetch(self, rows: int, seconds: float) -> list[tuple[str, str]]:
        out, end = [], time.monotonic() + seconds
        if self.stream:
            ask = json.dumps({"batch": rows, "expires": int(seconds * 1e9)}).encode()
            self.sock.sendall(b"PUB $JS.API.CONSUMER.MSG.NEXT.%b.%b %b %d\r\n%b\r\n" % (self.stream.encode(), self.group.encode(), self.inbox.encode(), len(ask), ask))
        while len(out) < rows and (left := end - time.monotonic()) > 0:
            self.sock.settimeout(left + (1 if self.stream else 0))
            try:
                got = self._message()
            except TimeoutError:
                self.file = self.sock.makefile("rb")  # one that has timed out reads no more
                break
            if got is None:
                continue
            _, reply, head, body = got
            if head and not reply:  # the status that ends a pull: nothing (more) within its time
                break
            out.append((reply, body.decode(errors="replace")))
        return out

    def acknowledge(self, numbers: list[str]) -> None:
        if self.stream:
            self.sock.sendall(b"".join(b"PUB %b 4\r\n+ACK\r\n" % n.encode() for n in numbers) + b"PING\r\n")
            while self.file.readline() not in (b"PONG\r\n", b""):
                pass

    @staticmethod
    def number(reply: str) -> str:
        """The message's number in its stream, from where it wants to be acknowledged ('$JS.ACK', stream, consumer, deliveries, number, ...)."""
        words = reply.split(".")
        return words[5] if len(words) > 5 else reply


_GROUPS = {"resp": (RespGroup, 6379), "nats": (NatsGroup, 4222)}


class BusReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        u = urllib.parse.urlsplit(options["url"])
        if u.scheme not in _GROUPS:
            raise ValueError(f"no bus protocol {u.scheme!r}; there are {', '.join(_GROUPS)}")
        self.kind, self.address, self.password = u.scheme, (u.hostname, u.port or _GROUPS[u.scheme][1]), u.password
        self.options, self.timeout = options, float(options.get("timeout", 5))
        self.rows, self.seconds = int(options.get("rows", codes.STORE_ROWS)), float(options.get("seconds", codes.STORE_SECONDS))
        self.spool, self.member = Spool(options.get("spool")), None
        kept = self.spool.numbers()
        self.seen = {r[2] for n in kept for r in self.spool.get(n, n + 1)}

    def initialOffset(self) -> dict:
        return {"batches": 0}

    def _joined(self) -> RespGroup | NatsGroup:
        if self.member is None:
            sock = socket.create_connection(self.address, self.timeout)
            sock.settimeout(self.timeout + self.seconds)
            self.member = _GROUPS[self.kind][0](sock, self.password, self.options)
        return self.member

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if start["batches"] in self.spool.numbers():  # written by one that was killed before the offset was
            return self._again(start)
        try:
            member = self._joined()
            got = member.fetch(self.rows, self.seconds)
            number = getattr(member, "number", str)
            fresh = {number(n): body for n, body in got if not n or number(n) not in self.seen}
            rows = [[body, time.time(), n] for n, body in fresh.items()] if any(n for n, _ in got) else [[body, time.time(), ""] for _, body in got]
            if rows:
                self.spool.put(start["batches"], rows)
                self.seen |= fresh.keys() - {""}
            if got:
                member.acknowledge([n for n, _ in got])
        except OSError:
            self.member = None
            raise
        return (_rows([r[:2] for r in rows]), {"batches": start["batches"] + 1}) if rows else (iter([]), start)

    def _again(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end = {"batches": start["batches"] + 1}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return _rows([r[:2] for r in self.spool.get(start["batches"], end["batches"])])

    def commit(self, end: dict) -> None:
        self.spool.drop_before(end["batches"])


class BusSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bus_feed"

    def schema(self) -> StructType:
        return struct("body string, fetched_at timestamp")

    def simpleStreamReader(self, schema: StructType) -> BusReader:
        return BusReader(dict(self.options))
