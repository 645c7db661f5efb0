"""Sinks that publish rows (channel, body) on a message bus, batch or stream.

    spark.dataSource.register(BusSink)
    broadcast.envelopes(...).write.format("bus").option("url", "resp://host:6379").mode("append").save()

Tasks publish their own partition over one connection, in pipelined groups of
``rows`` (default 500).  Protocols: ``resp`` (PUBLISH) and ``nats`` (PUB).
Delivery is at least once: a task that fails publishes again what it had sent.
"""

from __future__ import annotations

import itertools
import json
import socket
import urllib.parse
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from geotide import codes
from geotide.schemas import struct


class RespBus:
    """PUBLISH in the serialization protocol of in-memory stores: one integer reply a message."""

    def __init__(self, sock: socket.socket, password: str | None):
        self.sock, self.file = sock, sock.makefile("rb")
        if password:
            self._send([[b"AUTH", password.encode()]])

    def _send(self, commands: list[list[bytes]]) -> None:
        out = bytearray()
        for c in commands:
            out += b"*%d\r\n" % len(c)
            for x in c:
                out += b"$%d\r\n%b\r\n" % (len(x), x)
        self.sock.sendall(out)
        for _ in commands:
            said = self.file.readline()
            if not said or said.startswith(b"-"):
                raise ConnectionError(f"bus refused: {said.decode(errors='replace').strip() or 'connection closed'}")

    def publish(self, rows: list[tuple[str, str]]) -> None:
        self._send([[b"PUBLISH", channel.encode(), body.encode()] for channel, body in rows])


class NatsBus:
    """PUB in the text protocol of subject-based buses; a PING after each group tells that it has arrived."""

    def __init__(self, sock: socket.socket, password: str | None):
        self.sock, self.file = sock, sock.makefile("rb")
        self.file.readline()  # what the server says of itself
        self.sock.sendall(b"CONNECT " + json.dumps({"verbose": False, "pedantic": False, **({"auth_token": password} if password else {})}).encode() + b"\r\n")

    def publish(self, rows: list[tuple[str, str]]) -> None:
        out = bytearray()
        for channel, body in rows:
            raw = body.encode()
            out += b"PUB %b %d\r\n%b\r\n" % (channel.encode(), len(raw), raw)
        self.sock.sendall(out + b"PING\r\n")
        while (said := self.file.readline()) != b"PONG\r\n":
            if not said or said.startswith(b"-ERR"):
                raise ConnectionError(f"bus refused: {said.decode(errors='replace').strip() or 'connection closed'}")
            if said == b"PING\r\n":
                self.sock.sendall(b"PONG\r\n")


_BUSES = {"resp": (RespBus, 6379), "nats": (NatsBus, 4222)}


class _Writing:
    def __init__(self, options: dict):
        u = urllib.parse.urlsplit(options["url"])
        if u.scheme not in _BUSES:
            raise ValueError(f"no bus protocol {u.scheme!r}; there are {', '.join(_BUSES)}")
        self.kind, self.host, self.port, self.password = u.scheme, u.hostname, u.port or _BUSES[u.scheme][1], u.password
        self.rows, self.timeout = int(options.get("rows", codes.LIVE_ROWS)), float(options.get("timeout", 5))

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        first = next(iterator, None)
        if first is not None:  # an empty partition needs no connection
            with socket.create_connection((self.host, self.port), self.timeout) as sock:
                bus = _BUSES[self.kind][0](sock, self.password)
                for group in itertools.batched(itertools.chain([first], iterator), self.rows):
                    bus.publish([(r["channel"], r["body"]) for r in group])
        return WriterCommitMessage()


class BusWriter(_Writing, DataSourceWriter):
    pass


class BusStreamWriter(_Writing, DataSourceStreamWriter):
    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803 - the interface's name
        pass

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        pass


class BusSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bus"

    def schema(self) -> StructType:
        return struct("channel string, body string")

    def writer(self, schema: StructType, overwrite: bool) -> BusWriter:
        return BusWriter(dict(self.options))

    def streamWriter(self, schema: StructType, overwrite: bool) -> BusStreamWriter:
        return BusStreamWriter(dict(self.options))
