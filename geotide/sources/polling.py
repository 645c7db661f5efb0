"""A streaming source that polls a URL: each fetch is one row (body, fetched_at).

    spark.dataSource.register(PollingSource)
    spark.readStream.format("polling").option("url", ...).option("spool", folder).load()

Options: ``url``, ``interval`` (seconds between fetches, default 10), ``timeout``
(default 30), ``spool`` (folder that outlives the driver; without one a restart
can't replay a planned batch and fails instead of losing it), and for the
bearer either ``token`` or ``token_url``, ``client_id`` and ``client_secret``.
An answer other than 200 fails the batch; ``streaming.supervise`` decides what
then.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from geotide.schemas import struct
from geotide.sources.spool import Spool


class Token:
    """A client-credentials bearer, fetched when first needed and again shortly before it expires."""

    def __init__(self, url: str, client_id: str, client_secret: str, timeout: float = 30.0):
        self.url, self.timeout, self.value, self.until = url, timeout, "", 0.0
        self.form = urllib.parse.urlencode({"grant_type": "client_credentials", "client_id": client_id, "client_secret": client_secret}).encode()

    def get(self) -> str:
        if time.monotonic() >= self.until:
            with urllib.request.urlopen(urllib.request.Request(self.url, self.form), timeout=self.timeout) as answer:
                said = json.load(answer)
            self.value = said["access_token"]
            self.until = time.monotonic() + max(0.0, float(said.get("expires_in", 300)) - 30)
        return self.value


class PollingReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.url, self.token = options["url"], options.get("token")
        self.interval, self.timeout = float(options.get("interval", 10)), float(options.get("timeout", 30))
        # option names come in lower case
        self.issuer = Token(options["token_url"], options.get("client_id", ""), options.get("client_secret", ""), self.timeout) if options.get("token_url") else None
        self.last, self.spool = 0.0, Spool(options.get("spool"))

    def initialOffset(self) -> dict:
        return {"fetches": 0}

    def _fetch(self) -> str:
        token = self.issuer.get() if self.issuer else self.token
        request = urllib.request.Request(self.url, headers={"Authorization": f"Bearer {token}"} if token else {})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            if answer.status != 200:
                raise RuntimeError(f"{self.url} answered {answer.status}")
            return answer.read().decode()

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if time.monotonic() - self.last < self.interval:
            return iter([]), start
        self.last = time.monotonic()
        rows = [[self._fetch(), time.time()]]
        self.spool.put(start["fetches"], rows)
        return _rows(rows), {"fetches": start["fetches"] + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return _rows(self.spool.get(start["fetches"], end["fetches"]))

    def commit(self, end: dict) -> None:
        self.spool.drop_before(end["fetches"])


def _rows(rows: list[list]) -> Iterator[tuple]:
    return iter([(body, dt.datetime.fromtimestamp(at)) for body, at in rows])


class PollingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "polling"

    def schema(self) -> StructType:
        return struct("body string, fetched_at timestamp")

    def simpleStreamReader(self, schema: StructType) -> PollingReader:
        return PollingReader(dict(self.options))
