"""Command line: run registered queries and services, refresh dimensions, show the version."""

from __future__ import annotations

import argparse
import signal
import sys
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotide import settings
from geotide.operators import dims
from geotide.settings import Settings
from geotide.sources import elements, files, mmdb
from geotide.sources.bus import BusSink
from geotide.streaming import apps, pipelines, supervise

VERSION = "0.2.0"
IMAGES = ["image_url", "image_attribution"]
#: Seconds between two fetches of element sets where the settings name none.
ELEMENT_SECONDS = 7200
KEYS = {"aircraft": "icao24", "satellite": "sat_key"}


def dimension(spark: SparkSession, kind: str, out: str) -> DataFrame:
    """What readers of a refreshed dimension see: of each key the newest row."""
    return dims.newest_version(spark.read.parquet(out), [KEYS[kind]], "updated_at")


def refresh(spark: SparkSession, kind: str, path: str, out: str | None) -> dict[str, int]:
    """Appends a dimension file to the table ``out`` and counts; without ``out`` it only parses and counts (a dry run).

    Aircraft keep the images that earlier rows of the table have, since the
    files know none.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "").count() - 1
    rows = files.read_aircraft(spark, path) if kind == "aircraft" else files.read_satellites(spark, path)
    if kind == "aircraft":
        known = dimension(spark, kind, out) if out and pipelines.exists(spark, out) else None
        rows = dims.carry_forward(rows, known, "icao24", IMAGES) if known is not None else rows.withColumns(dict.fromkeys(IMAGES, F.lit("")))
    parsed = rows.count()
    if out:
        rows.withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(out)
    return {"parsed": parsed, "skipped": lines - parsed, "flushed": parsed if out else 0}


def stream(spark: SparkSession, args: argparse.Namespace) -> int:
    """Runs a service over a folder of JSON lines with ``body`` until it is stopped, restarting it when it fails."""
    apps.known_kind(args.kind)
    spark.dataSource.register(BusSink)
    bodies = spark.readStream.schema("body string").option("maxFilesPerTrigger", 100).json(args.input)
    common = (bodies, args.source or args.kind, args.store, args.checkpoints)
    if args.kind == "bgp":
        cities, holders = (mmdb.read(spark, p, c)[0].persist() for p, c in ((args.city_db, mmdb.CITY), (args.asn_db, mmdb.HOLDER)))
        start = lambda: apps.start_routing(spark, *common, cities, holders, bus=args.bus, once=args.once, ttl_hours=args.ttl_hours)[0]
    else:
        start = lambda: apps.start_telemetry(spark, args.kind, *common, bus=args.bus, once=args.once, ttl_hours=args.ttl_hours)[0]
    stop = threading.Event()
    signal.signal(signal.SIGTERM, lambda *_: stop.set())
    supervise.keep_running(lambda: apps.Together(start()), stop, on_error=lambda e, wait: print(f"{args.kind}: {e}; again in {wait:.0f} s", file=sys.stderr))
    return 0


def refresh_elements(spark: SparkSession, s: Settings, stop: threading.Event, ready: threading.Event) -> None:
    """Fetches the element sets of all satellite integrations again and again: after a failure later and later, else after their interval."""
    feeds = s.integrations["satellite"]
    while not stop.is_set():
        supervise.first_success(lambda: elements.refresh(spark, [f.api_url for f in feeds], f"{s.store}/elements", int(time.time() * 1000)), stop)
        ready.set()
        stop.wait(max(f.interval for f in feeds) or ELEMENT_SECONDS)


def serve(spark: SparkSession, s: Settings, kinds: list[str], stop: threading.Event, on_error: Callable[[str, Exception, float], None] | None = None) -> None:
    """Runs the services of some kinds over the live feeds that the settings name, restarting what fails, until ``stop`` is set."""
    for kind in kinds:
        if not s.integrations.get(apps.known_kind(kind)):
            raise ValueError(f"settings: no integration for {kind}")
    spark.dataSource.register(BusSink)
    threads = []
    ready = threading.Event()
    if "satellite" in kinds:
        threads.append(threading.Thread(target=refresh_elements, args=(spark, s, stop, ready), daemon=True))

    def starter(kind: str) -> Callable[[], apps.Together]:
        feeds = s.integrations[kind]
        common = {"bus": s.bus, "ttl_hours": s.ttl_hours}
        if kind == "satellite":
            return lambda: apps.Together(apps.start_satellites(spark, f"{s.store}/elements", s.store, s.checkpoints, **common)[0])
        bodies = lambda: {f.name: apps.feed(spark, kind, f, s.spool) for f in feeds}
        if kind == "bgp":
            cities, holders = (mmdb.read(spark, p, c)[0].persist() for p, c in ((s.city_db, mmdb.CITY), (s.asn_db, mmdb.HOLDER)))
            return lambda: apps.Together(apps.start_routing(spark, bodies()[feeds[0].name], feeds[0].name, s.store, s.checkpoints, cities, holders, **common)[0])
        return lambda: apps.Together(apps.start_telemetry(spark, kind, bodies(), kind, s.store, s.checkpoints, **common)[0])

    def run(kind: str) -> None:
        while kind == "satellite" and not ready.wait(1):
            if stop.is_set():
                return
        supervise.keep_running(starter(kind), stop, on_error=lambda e, wait: on_error and on_error(kind, e, wait))

    threads += [threading.Thread(target=run, args=(kind,), daemon=True) for kind in kinds]
    for t in threads:
        t.start()
    stop.wait()
    for t in threads:
        t.join(60)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="geotide")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    run = sub.add_parser("run", help="run a registered query")
    run.add_argument("name")
    run.add_argument("tables")
    run.add_argument("--out")
    ref = sub.add_parser("refresh", help="load a dimension file")
    ref.add_argument("kind", choices=["aircraft", "satellite"])
    ref.add_argument("path")
    ref.add_argument("--out")
    srv = sub.add_parser("stream", help="run a service")
    srv.add_argument("kind")
    srv.add_argument("input")
    srv.add_argument("--store", required=True)
    srv.add_argument("--checkpoints", required=True)
    for name in ("--source", "--bus", "--city-db", "--asn-db"):
        srv.add_argument(name, default=None)
    srv.add_argument("--once", action="store_true")
    srv.add_argument("--ttl-hours", type=int, default=24)
    live = sub.add_parser("serve", help="run the services over the live feeds of a settings file")
    live.add_argument("--settings", required=True)
    live.add_argument("kinds", nargs="+")
    args = parser.parse_args(argv)
    if args.command == "version":
        print(VERSION)
        return 0
    spark = SparkSession.builder.appName("geotide").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "refresh":
        print(refresh(spark, args.kind, args.path, args.out))
        return 0
    if args.command == "stream":
        return stream(spark, args)
    if args.command == "serve":
        stop = threading.Event()
        signal.signal(signal.SIGTERM, lambda *_: stop.set())
        serve(spark, settings.load(args.settings), args.kinds, stop, lambda kind, e, wait: print(f"{kind}: {e}; again in {wait:.0f} s", file=sys.stderr))
        return 0
    from geotide.plans import catalog

    if args.name not in catalog.QUERIES:
        print(f"no query {args.name!r}; there are {', '.join(sorted(catalog.QUERIES))}", file=sys.stderr)
        return 2
    df = catalog.QUERIES[args.name](spark, args.tables)
    df.write.mode("overwrite").parquet(args.out) if args.out else df.show(50, False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
