import json
import random

import pytest
from pyspark.sql import functions as F

from geotide.schemas import TELEMETRY, at_version, struct
from geotide.streaming import pipelines
from tests.test_operators import reference_classes

EVENTS = struct("n long, asset_type string, asset_id string, t long, v string, h3_cell long")


def write(folder, name, rows, fields):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(dict(zip(fields, r, strict=True))) + "\n" for r in rows))


@pytest.fixture
def feed(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, "a", str(rng.randrange(6)), rng.randrange(5000), rng.choice("xyz"), rng.randrange(3)) for i in range(400)]
    for k in range(4):
        write(tmp_path / "in", f"{k}.json", rows[k * 100 : (k + 1) * 100], [f.name for f in EVENTS.fields])
    batch = spark.createDataFrame(rows, EVENTS).withColumn("event_time", F.timestamp_seconds("t"))
    return tmp_path, batch


def stream(spark, tmp_path):
    return pipelines.read_json(spark, str(tmp_path / "in"), EVENTS, 1).withColumn("event_time", F.timestamp_seconds("t"))


def test_stateful_classify(spark, tmp_path):
    """Over several micro-batches and a restart, the same as over everything at once."""
    rng = random.Random(4)
    ops = [(i, f"p{rng.randrange(10)}", rng.choice("AAW"), rng.randrange(3), rng.random() < 0.1) for i in range(300)]
    fields = ["seq", "prefix", "op", "origin_as", "leak"]
    schema = struct("seq long, prefix string, op string, origin_as long, leak int")
    start = lambda: (
        pipelines.classify(pipelines.read_json(spark, str(tmp_path / "in"), schema, 1).withColumn("is_leak", F.col("leak") == 1).drop("leak"), ["seq"])
        .writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    )
    for k in range(3):
        write(tmp_path / "in", f"{k}.json", [(*o[:4], int(o[4])) for o in ops[k * 100 : (k + 1) * 100]], fields)
        if k:
            start()
    got = sorted((r["seq"], r["prefix"], r["category"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted(reference_classes(ops))


def test_tumbling_and_dedup(spark, feed):
    tmp_path, batch = feed
    q = pipelines.tumbling(stream(spark, tmp_path)).writeStream.format("memory").queryName("tumble").outputMode("complete").option("checkpointLocation", str(tmp_path / "ct")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("tumble").agg(F.sum("cnt")).first()[0] == 400
    q = pipelines.dedup(stream(spark, tmp_path), ["asset_id", "t"], "2 hours").writeStream.format("memory").queryName("dd").option("checkpointLocation", str(tmp_path / "cd")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dd").count() == batch.select("asset_id", "t").distinct().count()


def test_schema_versions():
    assert [f.name for f in at_version(1).fields] == ["event_time", "asset_id", "asset_type", "callsign", "lat", "lon", "alt", "speed", "heading", "h3_cell", "source"]
    assert at_version(6) == TELEMETRY and len(TELEMETRY.fields) == 34
