"""A streaming source that reads a WebSocket feed: each message is one row (body, fetched_at).

    spark.dataSource.register(SocketSource)
    spark.readStream.format("socket_feed").option("url", "wss://...").option("subscribe", vessel_subscription(key)).load()

Options: ``url`` (ws or wss), ``subscribe`` (text sent after connecting),
``rows`` and ``seconds`` (a micro-batch ends at whichever comes first, default
10,000 and 2), ``limit`` (bytes of a message, default 1 MiB), ``spool`` (see
``spool``).  A lost connection is taken up again, after 1 second at first and
then twice as long each time up to 60, from the start once a connection has
held for 60 seconds.  Only the protocol's client side is here (RFC 6455).
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import socket
import ssl
import struct as pack
import time
import urllib.parse
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from geotide import codes
from geotide.schemas import struct
from geotide.sources.polling import _rows
from geotide.sources.spool import Spool
from geotide.streaming.supervise import Backoff

_GUID = b"258EAFA5-E914-47DA-95CA-C5AB0DC85B11"


def vessel_subscription(key: str, box: tuple[tuple[float, float], tuple[float, float]] = ((-90, -180), (90, 180))) -> str:
    """What a vessel feed wants to hear first: the key, the area, and the three kinds of messages that ``feeds.ais`` reads."""
    kinds = ["PositionReport", "StandardClassBPositionReport", "ShipStaticData"]
    return json.dumps({"APIKey": key, "BoundingBoxes": [[list(p) for p in box]], "FilterMessageTypes": kinds})


def routing_subscription() -> str:
    """Asks a route collector feed for updates."""
    return json.dumps({"type": "ris_subscribe", "data": {"type": "UPDATE"}})


class WebSocket:
    """One connection: text out, whole messages in."""

    def __init__(self, url: str, limit: int = 1 << 20, timeout: float = 10.0):
        u = urllib.parse.urlsplit(url)
        port = u.port or (443 if u.scheme == "wss" else 80)
        self.limit, self.buffer, self.parts = limit, b"", bytearray()
        self.sock = socket.create_connection((u.hostname, port), timeout)
        if u.scheme == "wss":
            self.sock = ssl.create_default_context().wrap_socket(self.sock, server_hostname=u.hostname)
        nonce = base64.b64encode(os.urandom(16))
        path = (u.path or "/") + (f"?{u.query}" if u.query else "")
        lines = [f"GET {path} HTTP/1.1", f"Host: {u.hostname}:{port}", "Upgrade: websocket", "Connection: Upgrade", f"Sec-WebSocket-Key: {nonce.decode()}", "Sec-WebSocket-Version: 13", "", ""]
        self.sock.sendall("\r\n".join(lines).encode())
        while b"\r\n\r\n" not in self.buffer:
            self._more()
        head, self.buffer = self.buffer.split(b"\r\n\r\n", 1)
        want = base64.b64encode(hashlib.sha1(nonce + _GUID).digest())
        if b" 101 " not in head.split(b"\r\n")[0] + b" " or want not in head:
            raise ConnectionError(f"no WebSocket at {url}: {head.splitlines()[0].decode(errors='replace')}")

    def _more(self) -> None:
        got = self.sock.recv(1 << 16)
        if not got:
            raise ConnectionError("connection closed")
        self.buffer += got

    def _send(self, kind: int, body: bytes) -> None:
        n = len(body)
        size = bytes([0x80 | n]) if n < 126 else pack.pack("!BH", 0x80 | 126, n) if n < 1 << 16 else pack.pack("!BQ", 0x80 | 127, n)
        mask = os.urandom(4)
        self.sock.sendall(bytes([0x80 | kind]) + size + mask + bytes(b ^ mask[i % 4] for i, b in enumerate(body)))

    def send(self, text: str) -> None:
        self._send(1, text.encode())

    def _frame(self) -> tuple[bool, int, bytes] | None:
        """(last, kind, body) of the next whole frame in the buffer."""
        b = self.buffer
        if len(b) < 2:
            return None
        n, at = b[1] & 0x7F, 2
        if n >= 126:
            wide = 2 if n == 126 else 8
            if len(b) < 2 + wide:
                return None
            n, at = int.from_bytes(b[2 : 2 + wide], "big"), 2 + wide
        if n + len(self.parts) > self.limit:
            raise ConnectionError(f"message of more than {self.limit} bytes")
        if len(b) < at + n:
            return None
        self.buffer = b[at + n :]
        return bool(b[0] & 0x80), b[0] & 0x0F, b[at : at + n]

    def receive(self, until: float) -> str | None:
        """The next message, or None at the time ``until`` (monotonic)."""
        while True:
            frame = self._frame()
            if frame is None:
                left = until - time.monotonic()
                if left <= 0:
                    return None
                self.sock.settimeout(left)
                try:
                    self._more()
                except TimeoutError:
                    return None
                continue
            last, kind, body = frame
            if kind == 8:
                raise ConnectionError("closed by the other side")
            if kind == 9:
                self._send(10, body)
            elif kind in (0, 1, 2):
                self.parts += body
                if last:
                    text, self.parts = self.parts.decode(errors="replace"), bytearray()
                    return text

    def close(self) -> None:
        try:
            self._send(8, b"\x03\xe8")
            self.sock.close()
        except OSError:
            pass


class SocketReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.url, self.subscribe = options["url"], options.get("subscribe")
        self.rows, self.seconds = int(options.get("rows", codes.STORE_ROWS)), float(options.get("seconds", codes.STORE_SECONDS))
        self.limit, self.spool = int(options.get("limit", 1 << 20)), Spool(options.get("spool"))
        self.socket, self.backoff = None, Backoff()

    def initialOffset(self) -> dict:
        return {"batches": 0}

    def _connected(self) -> WebSocket:
        if self.socket is None:
            self.backoff.started()
            self.socket = WebSocket(self.url, self.limit)
            if self.subscribe:
                self.socket.send(self.subscribe)
        return self.socket

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = [], time.monotonic() + self.seconds
        while len(rows) < self.rows and time.monotonic() < end:
            try:
                text = self._connected().receive(end)
            except OSError:  # connection errors are its kinds
                self.socket = None
                wait = self.backoff.failed()
                if rows or time.monotonic() + wait > end:
                    time.sleep(max(0.0, min(wait, end - time.monotonic())))
                    break
                time.sleep(wait)
                continue
            if text is not None:
                rows.append([text, time.time()])
        if not rows:
            return iter([]), start
        self.spool.put(start["batches"], rows)
        return _rows(rows), {"batches": start["batches"] + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return _rows(self.spool.get(start["batches"], end["batches"]))

    def commit(self, end: dict) -> None:
        self.spool.drop_before(end["batches"])


class SocketSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "socket_feed"

    def schema(self) -> StructType:
        return struct("body string, fetched_at timestamp")

    def simpleStreamReader(self, schema: StructType) -> SocketReader:
        return SocketReader(dict(self.options))
