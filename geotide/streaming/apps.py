"""The running services: a feed in, the store and the live bus out, for telemetry and for routing.

Store and live path of a kind are two queries with checkpoints of their own
and different triggers, so a slow store never holds up the map.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geotide import codes
from geotide.operators import broadcast, density, latest, lookup, routing, validate
from geotide.schemas import BGP, LATEST, TELEMETRY
from geotide.settings import Integration
from geotide.sources import elements as element_sets
from geotide.sources import feeds
from geotide.sources.polling import PollingSource
from geotide.sources.sockets import SocketSource, routing_subscription, vessel_subscription
from geotide.sources.subscribe import BusSource
from geotide.sources.ticks import TickSource
from geotide.streaming import pipelines
from geotide.streaming.store import Store, Table

KINDS = ("aircraft", "vessel", "satellite", "bgp")


def known_kind(kind: str) -> str:
    """``kind``, or an error: a wrong name would wait for ever on a subject that nobody writes."""
    if kind not in KINDS:
        raise ValueError(f"unknown type {kind!r}: must be one of {', '.join(KINDS)}")
    return kind


def subject(kind: str) -> str:
    return "geotide.bgp.events" if known_kind(kind) == "bgp" else f"geotide.telemetry.{kind}"


@dataclasses.dataclass
class Counters:
    """What a service has done since it started: messages read, events made of them, rows stored, envelopes published."""

    processed: int = 0
    emitted: int = 0
    flushed: int = 0
    published: int = 0


def telemetry(bodies: DataFrame, kind: str, source: str) -> DataFrame:
    """Canonical events of a stream of message bodies; satellites come as canonical JSON from the propagation job."""
    if known_kind(kind) == "aircraft":
        out = feeds.adsb(bodies, source)
    elif kind == "vessel":
        out = feeds.ais(bodies, source)
    elif kind == "satellite":
        out = bodies.select(F.from_json("body", TELEMETRY).alias("e")).select("e.*").filter("asset_id is not null")
    else:
        raise ValueError("routing has a service of its own: routing_store")
    return validate.valid_telemetry(canonical(out))


def canonical(events: DataFrame) -> DataFrame:
    """All columns of the schema, those that a feed doesn't have as null."""
    have = set(events.columns)
    return events.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in TELEMETRY.fields])


def _publish(df: DataFrame, url: str, rows: int) -> None:
    df.write.format("bus").option("url", url).option("rows", rows).mode("append").save()


def _observed(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Rows that ``write`` wrote, counted as they pass."""
    seen = Observation()
    write(df.observe(seen, F.count("*").alias("n")))
    return seen.get["n"]


#: What a telemetry service keeps: the events, each asset's latest state, and counts by cell and five minutes.
TELEMETRY_TABLES = {
    "events": Table(lambda df: df, None, ("h3_cell", "event_time", "asset_id")),
    "latest": Table(lambda df: latest.partial(df, [c for c in LATEST if c != "source"], "source"), lambda p: latest.merge(p, "source"), tuple(latest.KEYS), by_hour=False),
    "density": Table(density.density, density.merge, ("h3_cell", "asset_type"), time="time_bucket"),
}
BGP_TABLES = {"events": Table(lambda df: df, None, ("category", "event_time", "prefix"))}


def opened(spark: SparkSession, root: str, kind: str, ttl_hours: int | None = 24) -> Store:
    """The stored tables of a service, for its readers and its writer; ``ttl_hours``: how long events are kept."""
    return Store(spark, f"{root}/{known_kind(kind)}", BGP_TABLES if kind == "bgp" else TELEMETRY_TABLES, ttl_hours)


def latest_view(store: Store) -> DataFrame:
    """Each asset's newest state as of the last commit."""
    return latest.flat(store.read("latest"))


def store_sink(store: Store, counters: Counters, stream: str = "") -> Callable[[DataFrame, int], None]:
    """Stores a batch of canonical events in all tables at once."""
    write = store.sink(stream)

    def sink(df: DataFrame, batch_id: int) -> None:
        counters.flushed += write(df, batch_id)

    return sink


def live_sink(kind: str, url: str, counters: Counters) -> Callable[[DataFrame, int], None]:
    """Publishes a batch of canonical events: envelopes for each cell resolution."""
    fan = broadcast.bgp if known_kind(kind) == "bgp" else broadcast.telemetry

    def sink(df: DataFrame, batch_id: int) -> None:
        counters.published += _observed(broadcast.envelopes(fan(_with_json(df))), lambda x: _publish(x, url, codes.LIVE_ROWS))

    return sink


def _with_json(df: DataFrame) -> DataFrame:
    """``data``: the wire JSON of each row, beside its cell."""
    wired = broadcast.wire(df.withColumn("_cell", F.col("h3_cell")))
    names = [c for c in wired.columns if c != "_cell"]
    return wired.select(F.to_json(F.struct(*names)).alias("data"), F.col("_cell").alias("h3_cell"))


#: Order of a prefix's operations within a micro-batch: by the collector's time, then by message.
ARRIVAL = ["event_time", "message", "op", "a_no", "p_no"]


def operations(bodies: DataFrame) -> DataFrame:
    """A stream's prefix operations that can be classified, each with its message's digest."""
    ops = feeds.ris_operations(bodies.withColumn("message", F.md5("body")), ["message"])
    return ops.filter("prefix is not null").withColumn("origin_as", F.coalesce("origin_as", F.lit(0))).withColumn("is_leak", F.coalesce("is_leak", F.lit(False)))


def routing_events(classified: DataFrame, cities: DataFrame, holders: DataFrame, positions: DataFrame, source: str) -> DataFrame:
    """Canonical routing events of classified operations (with ``key``): located, held against the registry, and valid."""
    placed = lookup.holder(routing.locate(classified, cities, positions, "key"), holders)
    placed = routing.build(routing.path_coords(placed, positions, "key"), source)
    return validate.valid_bgp(placed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BGP.fields]))


def routing_sink(store: Store, cities: DataFrame, holders: DataFrame, positions: DataFrame, source: str, counters: Counters, live: Callable[[DataFrame, int], None] | None = None, stream: str = "") -> Callable[[DataFrame, int], None]:
    """Locates, stores and publishes a batch of classified operations."""
    write = store.sink(stream)

    def sink(df: DataFrame, batch_id: int) -> None:
        df = df.persist()  # the stream's state is read and written once
        counters.processed += df.count()
        events = routing_events(df.withColumn("key", F.monotonically_increasing_id()), cities, holders, positions, source).persist()
        try:
            done = write(events, batch_id)
            counters.emitted += done
            counters.flushed += done
            if live:
                live(events, batch_id)
        finally:
            events.unpersist()
            df.unpersist()

    return sink


def start_telemetry(spark: SparkSession, kind: str, bodies: DataFrame | dict[str, DataFrame], source: str, store: str, checkpoints: str, bus: str | None = None, once: bool = False, ttl_hours: int | None = 24) -> tuple[list[StreamingQuery], Counters]:
    """Starts store and live path of a telemetry feed (a stream with ``body``, or several by their source's name); ``once``: over what is there, then end."""
    streams = bodies if isinstance(bodies, dict) else {source: bodies}
    counters = Counters()
    events = functools.reduce(DataFrame.unionByName, [telemetry(b, kind, name) for name, b in streams.items()])
    started = [pipelines.run(events, store_sink(opened(spark, store, kind, ttl_hours), counters), f"{checkpoints}/{kind}-store", None if once else codes.STORE_SECONDS)]
    if bus:
        started.append(pipelines.run(events, live_sink(kind, bus, counters), f"{checkpoints}/{kind}-live", None if once else codes.LIVE_MILLIS / 1000))
    return started, counters


def start_routing(spark: SparkSession, bodies: DataFrame, source: str, store: str, checkpoints: str, cities: DataFrame, holders: DataFrame, positions: DataFrame | None = None, bus: str | None = None, once: bool = False, ttl_hours: int | None = 24) -> tuple[list[StreamingQuery], Counters]:
    """Starts the routing service over a stream with ``body``; its live path follows the store path's batches."""
    counters = Counters()
    live = live_sink("bgp", bus, counters) if bus else None
    positions = positions if positions is not None else lookup.seed_positions(spark)
    sink = routing_sink(opened(spark, store, "bgp", ttl_hours), cities, holders, positions, source, counters, live)
    return [pipelines.run(pipelines.classify(operations(bodies), ARRIVAL), sink, f"{checkpoints}/bgp-store", None if once else codes.STORE_SECONDS)], counters


def satellite_sink(store: Store, elements: str, counters: Counters, live: Callable[[DataFrame, int], None] | None = None, stream: str = "") -> Callable[[DataFrame, int], None]:
    """Propagates the newest element sets to a batch of ticks (a few rows), stores and publishes the events."""
    write = store.sink(stream)

    def sink(df: DataFrame, batch_id: int) -> None:
        sets = element_sets.newest(df.sparkSession, elements)
        events = canonical(feeds.satellite_events(sets.join(F.broadcast(df), "orbit_regime"), F.col("tick_time"))).persist()
        try:
            counters.emitted += events.count()
            counters.flushed += write(events, batch_id)
            if live:
                live(events, batch_id)
        finally:
            events.unpersist()

    return sink


def start_satellites(spark: SparkSession, elements: str, store: str, checkpoints: str, bus: str | None = None, once: bool = False, ttl_hours: int | None = 24, **pace: int) -> tuple[list[StreamingQuery], Counters]:
    """Starts the satellite service over a table of element sets: each regime at its own pace, or at that of ``pace``."""
    spark.dataSource.register(TickSource)
    counters = Counters()
    live = live_sink("satellite", bus, counters) if bus else None
    ticks = spark.readStream.format("ticks").options(**pace).load()
    sink = satellite_sink(opened(spark, store, "satellite", ttl_hours), elements, counters, live)
    return [pipelines.run(ticks, sink, f"{checkpoints}/satellite-store", None if once else min([*codes.TICK_SECONDS.values(), *pace.values()]) / 2)], counters


def feed(spark: SparkSession, kind: str, where: Integration, spool: str) -> DataFrame:
    """The stream of bodies of a live feed: asked again and again (http), heard (ws), or taken from a bus as a member of a group."""
    scheme = where.api_url.split(":", 1)[0]
    folder = f"{spool}/{known_kind(kind)}-{where.name}"
    if scheme in ("http", "https"):
        spark.dataSource.register(PollingSource)
        out = spark.readStream.format("polling").option("url", where.api_url).option("interval", where.interval or 10)
        if where.token_url:
            out = out.option("token_url", where.token_url).option("client_id", where.client_id).option("client_secret", where.client_secret)
        elif where.api_key:
            out = out.option("token", where.api_key)
    elif scheme in ("ws", "wss"):
        spark.dataSource.register(SocketSource)
        out = spark.readStream.format("socket_feed").option("url", where.api_url)
        out = out.option("subscribe", routing_subscription() if kind == "bgp" else vessel_subscription(where.api_key))
    elif scheme in ("resp", "nats"):
        spark.dataSource.register(BusSource)
        out = spark.readStream.format("bus_feed").option("url", where.api_url).option("subject", subject(kind)).option("group", f"batcher-{kind}")
        if where.stream:
            out = out.option("stream", where.stream)
    else:
        raise ValueError(f"{where.name}: no feed at {where.api_url!r}")
    return out.option("spool", folder).load()


class Together:
    """Several queries as one for a supervisor: ends when all have, fails when one does."""

    def __init__(self, queries: list[StreamingQuery]):
        self.queries = queries

    def awaitTermination(self, seconds: float) -> bool:  # noqa: N802 - as a query's
        try:
            return all([q.awaitTermination(seconds / len(self.queries)) for q in self.queries])
        except Exception:
            self.stop()
            raise

    def stop(self) -> None:
        for q in self.queries:
            q.stop()
