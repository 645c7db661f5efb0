"""The stored tables of a service: raw events and the views kept of them, committed together.

A micro-batch adds a part to each table and then one commit record that names
all parts that count, so readers see a batch in every table or in none, and a
batch that is replayed after its commit changes nothing.  Views are kept as
mergeable partials: a batch adds its own, reading merges them, and so does
compaction, which joins parts of about one size so that their number stays
small however long a service runs.  Tables are partitioned by the hour of
their events; hours past the retention are dropped as a whole.

One writer a store; any number of readers.  Parts that no longer count stay
for ``GRACE_SECONDS``, for readers that began before.
"""

from __future__ import annotations

import dataclasses
import json
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of one size that are joined into one of the next, seconds that dropped parts stay, and events of a batch or stored bytes that one writing task takes.
FAN, GRACE_SECONDS, WRITE_ROWS, PART_BYTES = 8, 600, 1_000_000, 128 << 20
_ALL = "all"  # the only partition of a table that isn't kept by hour


@dataclasses.dataclass(frozen=True)
class Table:
    """``partial``: what a batch adds; ``merge``: partials as one (None: rows stay as they are); ``time``: the column whose hour partitions the table, or by which rows without a partition expire."""

    partial: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame] | None
    order: tuple[str, ...]
    time: str = "event_time"
    by_hour: bool = True


def hour_of(t: Column) -> Column:
    return F.date_format(F.date_trunc("hour", t), "yyyyMMddHH")


class Store:
    """Tables under ``root`` with commit records in ``_commits``; ``clock`` gives the time that retention counts from."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Table], ttl_hours: int | None = 24, clock: Callable[[], float] = time.time):
        self.spark, self.root, self.tables, self.ttl_hours, self.clock = spark, root, tables, ttl_hours, clock
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._swept = False

    # commit records

    def record(self) -> dict:
        """The newest commit: its number, the last batch of each stream, and the parts of each table by hour, with their levels."""
        numbers = self._numbers()
        if not numbers:
            return {"n": 0, "batches": {}, "tables": {}, "dropped": {}}
        source = self._fs.open(self._path(self._commit(numbers[-1])))
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def _numbers(self) -> list[int]:
        return sorted(int(name) for name in self._names(f"{self.root}/_commits") if name.isdigit())

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _commit(self, n: int) -> str:
        return f"{self.root}/_commits/{n:012d}"

    def commit(self, record: dict) -> None:
        """Makes a record the one that counts, by one rename."""
        record = {**record, "n": record["n"] + 1}
        held = self._path(f"{self.root}/_commits/_{uuid.uuid4().hex}")
        out = self._fs.create(held, True)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        if not self._fs.rename(held, self._path(self._commit(record["n"]))):
            raise RuntimeError(f"{self.root} has a second writer: commit {record['n']} is there already")
        for old in self._numbers()[:-3]:
            self._fs.delete(self._path(self._commit(old)), False)

    # writing

    def sink(self, stream: str) -> Callable[[DataFrame, int], int]:
        """``write`` for ``foreachBatch``; ``stream`` names where batch ids count, with the query's own id in a running query."""

        def write(df: DataFrame, batch_id: int) -> int:
            query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
            return self.write(df, batch_id, f"{stream}{query}")

        return write

    def write(self, df: DataFrame, batch_id: int, stream: str = "") -> int:
        """Adds a batch to all tables; returns its rows, 0 for a batch that is there already."""
        record = self.record()
        if not self._swept:
            self._sweep(record)
        if batch_id <= record["batches"].get(stream, -1):
            return 0
        df = df.persist()
        try:
            rows = df.count()
            for name, table in self.tables.items():
                if rows:
                    version = f"b{batch_id}-{uuid.uuid5(uuid.NAMESPACE_URL, stream).hex[:12]}"
                    record = self._with(record, name, self.put(table.partial(df), name, version, -(-rows // WRITE_ROWS)), version, 0)
        finally:
            df.unpersist()
        record["batches"][stream] = batch_id
        self.commit(record)
        self.maintain()
        return rows

    def put(self, rows: DataFrame, name: str, version: str, tasks: int) -> tuple[list[str], str]:
        """Writes a part with so many tasks, sorted within hours; returns its hours and its schema."""
        table = self.tables[name]
        at = f"{self.root}/{name}/part_version={version}"
        out = rows.withColumn("event_hour", hour_of(F.col(table.time)) if table.by_hour else F.lit(_ALL))
        by = ["event_hour", *table.order]
        out = out.coalesce(1) if tasks <= 1 else out.repartitionByRange(tasks, *by)
        out.sortWithinPartitions(*by).write.mode("overwrite").partitionBy("event_hour").parquet(at)
        return [x.split("=", 1)[1] for x in self._names(at) if x.startswith("event_hour=")], rows.schema.json()

    def _with(self, record: dict, name: str, written: tuple[list[str], str], version: str, level: int) -> dict:
        record = json.loads(json.dumps(record))
        entry = record["tables"].setdefault(name, {"hours": {}})
        entry["schema"] = written[1]
        for hour in written[0]:
            entry["hours"].setdefault(hour, []).append([version, level])
        return record

    # upkeep

    def maintain(self) -> None:
        """Drops hours past the retention, joins parts, and removes what has been dropped for long enough."""
        self._expire()
        for name in self.tables:
            while self._compact(name):
                pass
        self._collect()

    def _drop(self, record: dict, name: str, hour: str, versions: Iterable[str]) -> None:
        for v in versions:
            record["dropped"][f"{name}/part_version={v}/event_hour={hour}"] = self.clock()

    def _oldest(self) -> str | None:
        return None if self.ttl_hours is None else time.strftime("%Y%m%d%H", time.gmtime(self.clock() - 3600 * self.ttl_hours))

    def _expire(self) -> None:
        record, oldest, gone = self.record(), self._oldest(), False
        for name, entry in record["tables"].items():
            for hour in [h for h in entry["hours"] if h != _ALL and oldest and h < oldest]:
                self._drop(record, name, hour, [v for v, _ in entry["hours"].pop(hour)])
                gone = True
        if gone:
            self.commit(record)

    def _compact(self, name: str) -> bool:
        """Joins, in every hour that has ``FAN`` parts of one level, these to one of the next level; all hours in one job."""
        record, table = self.record(), self.tables[name]
        hours = record["tables"].get(name, {"hours": {}})["hours"]
        full = {}
        for hour, parts in hours.items():
            for level in sorted({k for _, k in parts}):
                same = [v for v, k in parts if k == level]
                if len(same) >= FAN:
                    full.setdefault(level, {})[hour] = same
                    break
        if not full:
            return False
        level = min(full)
        parts = [(h, v) for h, versions in full[level].items() for v in versions]
        schema = T.StructType.fromJson(json.loads(record["tables"][name]["schema"]))
        rows = self._scan(name, schema, parts).drop("event_hour", "part_version")
        size = sum(self._fs.getContentSummary(self._path(f"{self.root}/{name}/part_version={v}/event_hour={h}")).getLength() for h, v in parts)
        if table.merge:
            rows = table.merge(rows)
        if not table.by_hour:
            rows = self._fresh(rows, table)
        version = f"c{record['n'] + 1}"
        written = self.put(rows, name, version, -(-size // PART_BYTES))
        for hour, versions in full[level].items():
            hours[hour] = [p for p in hours[hour] if p[0] not in versions]
            self._drop(record, name, hour, versions)
        self.commit(self._with(record, name, written, version, level + 1))
        return True

    def _collect(self) -> None:
        record = self.record()
        old = [p for p, t in record["dropped"].items() if t <= self.clock() - GRACE_SECONDS]
        for p in old:
            folder = self._path(f"{self.root}/{p}")
            self._fs.delete(folder, True)
            if not any(x.startswith("event_hour=") for x in self._names(f"{self.root}/{p.rsplit('/', 1)[0]}")):
                self._fs.delete(folder.getParent(), True)
            del record["dropped"][p]
        if old:
            self.commit(record)

    def _sweep(self, record: dict) -> None:
        """Removes parts that an earlier writer began and never committed."""
        for name in self.tables:
            known = {v for parts in record["tables"].get(name, {"hours": {}})["hours"].values() for v, _ in parts}
            known |= {p.split("/")[1].removeprefix("part_version=") for p in record["dropped"] if p.startswith(f"{name}/")}
            for x in self._names(f"{self.root}/{name}"):
                if x.removeprefix("part_version=") not in known:
                    self._fs.delete(self._path(f"{self.root}/{name}/{x}"), True)
        self._swept = True

    # reading

    def _scan(self, name: str, schema: T.StructType, parts: list[tuple[str, str]]) -> DataFrame:
        """The rows of some (hour, version) parts, with their partition columns."""
        with_hour = T.StructType([*schema.fields, T.StructField("event_hour", T.StringType())])
        paths = [f"{self.root}/{name}/part_version={v}/event_hour={h}" for h, v in parts]
        return self.spark.read.schema(with_hour).option("basePath", f"{self.root}/{name}").parquet(*paths)

    def _fresh(self, rows: DataFrame, table: Table) -> DataFrame:
        return rows if self.ttl_hours is None else rows.filter(F.col(table.time) >= F.timestamp_seconds(F.lit(self.clock() - 3600 * self.ttl_hours)))

    def read(self, name: str, since: str | None = None, until: str | None = None) -> DataFrame:
        """A table as of the newest commit, merged and without what has expired; of hours from ``since`` to ``until`` (timestamps as text) only."""
        record, table = self.record(), self.tables[name]
        if name not in record["tables"]:
            raise ValueError(f"{self.root} has no table {name!r} yet")
        schema = T.StructType.fromJson(json.loads(record["tables"][name]["schema"]))
        hour = lambda t: t.replace("-", "").replace(" ", "").replace("T", "")[:10]
        oldest = self._oldest()
        parts = [(h, v) for h, versions in record["tables"][name]["hours"].items() for v, _ in versions if h == _ALL or not (oldest and h < oldest or since and h < hour(since) or until and h > hour(until))]
        if not parts:
            return self.spark.createDataFrame([], schema)
        rows = self._scan(name, schema, parts)
        if since and table.by_hour:
            rows = rows.filter((F.col(table.time) >= F.lit(since).cast("timestamp")) & (F.col("event_hour") >= hour(since)))
        if until and table.by_hour:
            rows = rows.filter((F.col(table.time) < F.lit(until).cast("timestamp")) & (F.col("event_hour") <= hour(until)))
        rows = self._fresh(rows.drop("event_hour", "part_version"), table)
        return table.merge(rows) if table.merge else rows

    def parts(self, name: str) -> dict[str, int]:
        """How many parts each hour of a table has."""
        return {h: len(p) for h, p in self.record()["tables"].get(name, {"hours": {}})["hours"].items()}
