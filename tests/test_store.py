"""The services' tables: all or none of a batch, replays, upkeep, retention, pruning."""

import json
import random

import pytest
from pyspark.sql import functions as F

from geotide.operators import density, latest
from geotide.streaming import apps, store
from geotide.streaming.store import Store, Table

NOW = 1_704_110_400.0  # 2024-01-01 12:00
TABLES = {
    "events": Table(lambda df: df, None, ("h3_cell",)),
    "latest": Table(lambda df: latest.partial(df, ["v"], "n"), lambda p: latest.merge(p, "n"), tuple(latest.KEYS), by_hour=False),
    "density": Table(density.density, density.merge, ("h3_cell",), time="time_bucket"),
}


def batch(spark, k, n=40, hours=3):
    rng = random.Random(k)
    rows = [(k * 1000 + i, "a", str(rng.randrange(6)), int(NOW) - rng.randrange(hours * 3600), rng.choice("xyz"), rng.randrange(3)) for i in range(n)]
    return spark.createDataFrame(rows, "n long, asset_type string, asset_id string, t long, v string, h3_cell long").withColumn("event_time", F.timestamp_seconds("t"))


def opened(spark, path, **more):
    return Store(spark, str(path), TABLES, clock=lambda: NOW, **more)


def same(store_, events):
    """All tables equal what the events give in one piece."""
    rows = lambda df, like: sorted(str(r) for r in df.select(*like.columns).collect())
    want = {"events": events, "latest": latest.partial(events, ["v"], "n"), "density": density.density(events)}
    for name, w in want.items():
        assert rows(store_.read(name), w) == rows(w, w), name


def union(spark, ks):
    out = batch(spark, ks[0])
    for k in ks[1:]:
        out = out.unionByName(batch(spark, k))
    return out


def test_batches_and_replays(spark, tmp_path):
    s = opened(spark, tmp_path / "s")
    for k in (0, 1, 1, 2, 0):
        s.write(batch(spark, k), k)
    same(s, union(spark, [0, 1, 2]))
    assert s.write(batch(spark, 3), 3, "other") == 40 and s.write(batch(spark, 4).limit(0), 3) == 0
    same(opened(spark, tmp_path / "s"), union(spark, [0, 1, 2, 3]))


class Crash(Exception):
    pass


@pytest.mark.parametrize("at", range(5))
def test_a_crash_between_any_two_writes(spark, tmp_path, monkeypatch, at):
    """Readers see the batch before, and the replay after a restart gives what one batch over everything gives."""
    s = opened(spark, tmp_path / "s")
    s.write(batch(spark, 0), 0)
    left, put, commit = [at], Store.put, Store.commit

    def failing(f):
        def run(self, *args):
            if not left[0]:
                raise Crash
            left[0] -= 1
            return f(self, *args)

        return run

    monkeypatch.setattr(Store, "put", failing(put))
    monkeypatch.setattr(Store, "commit", failing(commit))
    if at < 4:  # three tables and a commit
        with pytest.raises(Crash):
            s.write(batch(spark, 1), 1)
        same(opened(spark, tmp_path / "s"), batch(spark, 0))
    else:
        s.write(batch(spark, 1), 1)
    monkeypatch.setattr(Store, "put", put)
    monkeypatch.setattr(Store, "commit", commit)
    again = opened(spark, tmp_path / "s")
    again.write(batch(spark, 1), 1)
    same(again, union(spark, [0, 1]))


def test_a_crash_during_upkeep(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "FAN", 2)
    s = opened(spark, tmp_path / "s")
    s.write(batch(spark, 0), 0)
    monkeypatch.setattr(Store, "_compact", lambda self, name: (_ for _ in ()).throw(Crash()))
    with pytest.raises(Crash):
        s.write(batch(spark, 1), 1)
    same(opened(spark, tmp_path / "s"), union(spark, [0, 1]))
    assert opened(spark, tmp_path / "s").write(batch(spark, 1), 1) == 0


def test_many_batches_leave_few_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "FAN", 3)
    monkeypatch.setattr(store, "GRACE_SECONDS", 0)
    s = opened(spark, tmp_path / "s")
    for k in range(28):
        s.write(batch(spark, k, hours=1), k)
    same(s, union_hours(spark, range(28)))
    for name in TABLES:
        assert max(s.parts(name).values()) <= 2 * 4  # at most two of each of four levels
        files = list((tmp_path / "s" / name).rglob("*.parquet"))
        assert len(files) == sum(s.parts(name).values())
    assert len(list((tmp_path / "s/_commits").iterdir())) <= 8  # three records, with their checksums


def union_hours(spark, ks):
    out = None
    for k in ks:
        b = batch(spark, k, hours=1)
        out = b if out is None else out.unionByName(b)
    return out


def test_retention_and_pruning(spark, tmp_path):
    s = opened(spark, tmp_path / "s")
    s.write(batch(spark, 0, 400, hours=20), 0)
    assert len(s.parts("events")) > 15
    later = Store(spark, str(tmp_path / "s"), TABLES, ttl_hours=4, clock=lambda: NOW + 100)
    later.write(batch(spark, 1), 1)
    assert len(later.parts("events")) <= 5 and len(later.parts("density")) <= 5
    kept = batch(spark, 0, 400, hours=20).unionByName(batch(spark, 1)).filter(F.unix_seconds("event_time") >= NOW + 100 - 4 * 3600)
    assert later.read("events").count() == kept.count() and later.read("latest").count() == kept.select("asset_id").distinct().count()
    since = later.read("events", since="2024-01-01 10:30:00", until="2024-01-01 11:15:00")
    assert since.count() == kept.filter("event_time >= '2024-01-01 10:30:00' and event_time < '2024-01-01 11:15:00'").count()
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_hour" in plan and since.inputFiles() and all("event_hour=2024010110" in f or "event_hour=2024010111" in f for f in since.inputFiles())


def test_a_second_writer_is_an_error(spark, tmp_path):
    s = opened(spark, tmp_path / "s")
    s.write(batch(spark, 0), 0)
    old = s.record()
    s.write(batch(spark, 1), 1)
    with pytest.raises(RuntimeError, match="second writer"):
        s.commit(old)


def test_empty(spark, tmp_path):
    s = opened(spark, tmp_path / "s")
    assert s.write(batch(spark, 0).limit(0), 0) == 0
    with pytest.raises(ValueError, match="no table"):
        s.read("events")


def test_service_views(spark, tmp_path):
    report = lambda i, minute: {"MessageType": "PositionReport", "MetaData": {"MMSI": i, "ShipName": f"S{i}", "time_utc": f"2024-03-05T07:{minute:02d}:09Z"}, "Message": {"PositionReport": {"Sog": float(minute), "Latitude": 10.0, "Longitude": 20.0}}}
    (tmp_path / "in").mkdir()
    for k, docs in enumerate([[report(1, 5), report(2, 6)], [report(1, 4), report(2, 8), report(0, 9) | {"MessageType": "none"}]]):
        (tmp_path / "in" / f"{k}.json").write_text("".join(json.dumps({"body": json.dumps(d)}) + "\n" for d in docs))
    feed = spark.readStream.schema("body string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    queries, counters = apps.start_telemetry(spark, "vessel", feed, "feed", str(tmp_path / "store"), str(tmp_path / "c"), once=True, ttl_hours=None)
    queries[0].awaitTermination()
    kept = apps.opened(spark, str(tmp_path / "store"), "vessel", None)
    assert sorted((r["asset_id"], r["speed"]) for r in apps.latest_view(kept).collect()) == [("1", 5.0), ("2", 8.0)]
    assert kept.read("density").agg(F.sum("cnt")).first()[0] == kept.read("events").count() == counters.flushed == 4
