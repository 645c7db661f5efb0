"""IP databases in the MaxMind DB format as lookup tables (network, columns...).

The file is a binary search tree over address bits, a data section and
metadata (the format's specification is public).  Each task walks the subtree
of some address prefixes, so a large database is read in parallel; the file
must be at a path that all executors see.
"""

from __future__ import annotations

import datetime as dt
import ipaddress
import struct as pack
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from geotide.schemas import struct

_MARK = b"\xab\xcd\xefMaxMind.com"
#: Columns of the two kinds of databases, as paths into a record.
CITY = {"lat double": ("location", "latitude"), "lon double": ("location", "longitude")}
HOLDER = {"asn long": ("autonomous_system_number",), "org string": ("autonomous_system_organization",)}
#: Address bits by which the tree is dealt to tasks.
SPLIT_BITS = 8


class Database:
    """An open database: ``metadata``, ``built`` and the networks below a prefix.  A path that is empty or missing, or another kind of file, is an error here."""

    def __init__(self, path: str):
        if not path:
            raise ValueError("no path of an IP database given")
        self.raw = Path(path).read_bytes()
        at = self.raw.rfind(_MARK)
        if at < 0:
            raise ValueError(f"{path} is no IP database")
        try:
            self.metadata, _ = self._value(at + len(_MARK), at + len(_MARK))
            self.nodes, self.bits, self.version = (self.metadata[k] for k in ("node_count", "record_size", "ip_version"))
            self.built = dt.datetime.fromtimestamp(self.metadata["build_epoch"], dt.timezone.utc)
        except (KeyError, IndexError, TypeError, pack.error) as e:
            raise ValueError(f"{path} is a damaged IP database") from e
        self.tree = self.nodes * self.bits // 4
        if self.bits not in (24, 28, 32) or self.tree + 16 > at:
            raise ValueError(f"{path} is a damaged IP database")
        self.cache: dict[int, dict] = {}

    def _value(self, at: int, base: int) -> tuple[object, int]:
        """(value, where the next one starts) of the data section that begins at ``base``."""
        control = self.raw[at]
        kind, size, at = control >> 5, control & 31, at + 1
        if kind == 1:  # a pointer
            wide = (size >> 3) + 1
            low = int.from_bytes(self.raw[at : at + wide], "big")
            offset = (low + ((size & 7) << 8 * wide) + (0, 2048, 526336, 0)[wide - 1]) if wide < 4 else low
            return self._value(base + offset, base)[0], at + wide
        if kind == 0:
            kind, at = 7 + self.raw[at], at + 1
        if size >= 29:
            wide = size - 28
            size, at = int.from_bytes(self.raw[at : at + wide], "big") + (29, 285, 65821)[wide - 1], at + wide
        if kind in (7, 11):  # map, array
            out: dict | list = {} if kind == 7 else []
            for _ in range(size):
                key, at = self._value(at, base) if kind == 7 else (None, at)
                value, at = self._value(at, base)
                if kind == 7:
                    out[key] = value
                else:
                    out.append(value)
            return out, at
        if kind == 14:
            return bool(size), at
        body, at = self.raw[at : at + size], at + size
        if kind == 2:
            return body.decode(), at
        if kind in (3, 15):
            return pack.unpack(">d" if kind == 3 else ">f", body)[0], at
        if kind == 8:
            return int.from_bytes(body, "big", signed=len(body) == 4), at
        return (body if kind == 4 else int.from_bytes(body, "big")), at

    def _child(self, node: int, bit: int) -> int:
        at = node * self.bits // 4
        if self.bits == 28:
            r = self.raw[at : at + 7]
            return ((r[3] >> 4) << 24 | int.from_bytes(r[:3], "big")) if not bit else ((r[3] & 15) << 24 | int.from_bytes(r[4:], "big"))
        wide = self.bits // 8
        return int.from_bytes(self.raw[at + bit * wide : at + (bit + 1) * wide], "big")

    def _record(self, node: int) -> dict:
        if node not in self.cache:
            if len(self.cache) > 100_000:
                self.cache.clear()
            base = self.tree + 16
            self.cache[node] = self._value(base + node - self.nodes - 16, base)[0]
        return self.cache[node]

    def networks(self, part: int = 0, split: int = 0) -> Iterator[tuple[str, dict]]:
        """(CIDR, record) of the networks whose address begins with the ``split`` bits ``part``; shorter networks go to their first part."""
        v6 = self.version == 6
        start, depth = 0, 0
        if v6:  # IPv4 addresses are the last 32 bits of ::/96
            while depth < 96 and start < self.nodes:
                start, depth = self._child(start, 0), depth + 1
        yield from self._walk(start, 0, 0, 32, part, split, False)
        if v6:
            yield from self._walk(0, 0, 0, 128, part, split, True)

    def _walk(self, node: int, address: int, depth: int, wide: int, part: int, split: int, v6: bool) -> Iterator[tuple[str, dict]]:
        stack = [(node, address, depth)]
        while stack:
            node, address, depth = stack.pop()
            shared = min(depth, split)
            if (address >> (wide - shared) if shared else 0) != part >> (split - shared):
                continue
            if v6 and depth == 96 and address == 0:
                continue
            if node < self.nodes and depth < wide:
                stack += [(self._child(node, bit), address | bit << (wide - 1 - depth), depth + 1) for bit in (1, 0)]
            elif node > self.nodes:
                if depth < split and part & ((1 << (split - depth)) - 1):
                    continue
                kind = ipaddress.IPv6Address if v6 else ipaddress.IPv4Address
                yield f"{kind(address)}/{depth}", self._record(node)


def read(spark: SparkSession, path: str, columns: dict[str, tuple[str, ...]]) -> tuple[DataFrame, dt.datetime]:
    """((network, columns...), when the database was built).  Fails at once if the file isn't a database.

    ``columns`` maps "name type" to a path into the records, such as ``CITY``
    or ``HOLDER``; a record without any of them drops.
    """
    built = Database(path).built
    schema = struct(", ".join(["network string", *columns]))
    paths = list(columns.values())

    def rows(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        db = Database(path)
        for pdf in it:
            for part in pdf["id"]:
                out = []
                for network, record in db.networks(int(part), SPLIT_BITS):
                    values = []
                    for keys in paths:
                        x: object = record
                        for k in keys:
                            x = x.get(k) if isinstance(x, dict) else None
                        values.append(x)
                    if any(v is not None for v in values):
                        out.append((network, *values))
                yield pd.DataFrame(out, columns=schema.names)

    parts = 1 << SPLIT_BITS
    return spark.range(0, parts, 1, min(parts, spark.sparkContext.defaultParallelism)).mapInPandas(rows, schema), built
