"""A streaming source of ticks: (orbit_regime, tick_time), each regime at its own pace.

    spark.dataSource.register(TickSource)
    spark.readStream.format("ticks").load()

Offsets are tick numbers (times div pace), so a replayed batch has the same
ticks, and a query that was down takes up where it stopped.  Options: ``most``
(ticks of a regime in one batch, default 20; the rest come with the next), and
a pace in seconds under a regime's name.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from geotide import codes
from geotide.schemas import struct


class TickReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict, clock=time.time):
        self.paces = {regime: int(options.get(regime, seconds)) for regime, seconds in codes.TICK_SECONDS.items()}
        self.most, self.clock = int(options.get("most", 20)), clock

    def initialOffset(self) -> dict:
        return {}  # whatever the time, so that the first batch can be replayed: of a regime without a number it has the last tick

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        now = self.clock()
        end = {r: min(int(now // s), start[r] + self.most) if r in start else int(now // s) for r, s in self.paces.items()}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        out = [(r, dt.datetime.fromtimestamp(n * self.paces[r])) for r in end for n in range(start.get(r, end[r] - 1) + 1, end[r] + 1)]
        return iter(out)


class TickSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ticks"

    def schema(self) -> StructType:
        return struct("orbit_regime string, tick_time timestamp")

    def simpleStreamReader(self, schema: StructType) -> TickReader:
        return TickReader(dict(self.options))
