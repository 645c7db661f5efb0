"""Structured Streaming twins of the batch operators.

One query per sink, each with its own checkpoint, stands for a consumer group.
Backpressure replaces a bounded queue that drops: the source is rate-limited,
nothing is lost.  A failed batch is replayed from the checkpoint; the store
knows the batches that it has, so a replay adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues


def read_json(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 100) -> DataFrame:
    """A folder of JSON-lines files as a stream; at most ``max_files`` a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def run(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, seconds: float | None = None) -> StreamingQuery:
    """Starts a query: every ``seconds`` (the store path 2, the live path 0.05), or once over what is there if None."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{int(seconds * 1000)} milliseconds")
    return writer.start()


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def dedup(stream: DataFrame, key: list[str], window: str = "60 seconds") -> DataFrame:
    """Drops repeated events (an extension): same key within the watermark."""
    return stream.withWatermark("event_time", window).dropDuplicatesWithinWatermark(key)


_LAST = T.StructType([T.StructField("known", T.BooleanType()), T.StructField("origin_as", T.LongType())])


class Classifier(StatefulProcessor):
    """Keeps the last operation of a prefix, and names what each new one is beside the one before it."""

    def __init__(self, order: list[str], ttl_millis: int):
        self.order, self.ttl_millis = order, ttl_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _LAST, self.ttl_millis)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        ops = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        known, origin = self.last.get() if self.last.exists() else (False, 0)
        announced = (ops["op"] == "A").to_numpy()
        was_known, was_origin = np.roll(announced, 1), np.roll(ops["origin_as"].to_numpy(), 1)
        was_known[0], was_origin[0] = known, origin
        moved = was_known & (was_origin != ops["origin_as"].to_numpy())
        category = np.select(
            [~announced & was_known, ~announced, ops["is_leak"].to_numpy(bool), moved, ~was_known], ["withdrawal", "", "leak", "hijack", "announcement"], ""
        )
        self.last.update((bool(announced[-1]), int(ops["origin_as"].iloc[-1])))
        yield ops.assign(category=category)[category != ""]

    def close(self) -> None:
        pass


def classify(ops: DataFrame, order: list[str], ttl: str = "1 day") -> DataFrame:
    """The twin of ``routing.classify`` over a stream: operations that are events, with ``category``.

    State is the last operation of each prefix, in RocksDB on the executors,
    and expires ``ttl`` after it, which bounds it as pruning the oldest does.
    Rows of a micro-batch are taken in ``order``; later batches count as later
    arrivals.  Needs origin_as not null.
    """
    spark = ops.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # expired state goes with the next batch of data; without this, batches without data would never stop
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    schema = T.StructType([*ops.schema.fields, T.StructField("category", T.StringType())])
    processor = Classifier(order, int(pd.Timedelta(ttl).total_seconds() * 1000))
    return ops.groupBy("prefix").transformWithStateInPandas(processor, schema, "append", "processingTime")


def tumbling(stream: DataFrame, width: str = "5 minutes", late: str = "1 day") -> DataFrame:
    """The density count as a streaming aggregation with a generous watermark (later events than that are lost here; the stored view has no such bound)."""
    return stream.withWatermark("event_time", late).groupBy(F.window("event_time", width), "h3_cell", "asset_type").agg(F.count("*").alias("cnt"))
