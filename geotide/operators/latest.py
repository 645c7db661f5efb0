"""Latest state per asset, as a mergeable aggregate.

A partial state is one row a key: the newest event's time, a tiebreak, and the
payload as one struct.  One ``max`` of (time, tiebreak, payload) does what an
argmax for each column would, with one comparison and one buffer, and decides
full ties the same way in every run; merging partials is the same aggregation
again.  Spark plans it as a sort aggregation, since a buffer with strings
can't be updated in place, but with a map-side partial: a task sorts its own
rows and one row a key and task is shuffled, however hot the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["asset_type", "asset_id"]


def _newest(df: DataFrame, payload: Column, tiebreak: str, keys: list[str] | None) -> DataFrame:
    keys = keys or KEYS
    best = df.groupBy(*keys).agg(F.max(F.struct("event_time", tiebreak, payload.alias("payload"))).alias("_o"))
    return best.select(*keys, F.col("_o.event_time").alias("event_time"), F.col(f"_o.{tiebreak}").alias(tiebreak), F.col("_o.payload").alias("payload"))


def partial(events: DataFrame, payload: list[str], tiebreak: str, keys: list[str] | None = None) -> DataFrame:
    """(keys..., event_time, tiebreak, payload struct): the newest event of each key in this batch."""
    return _newest(events, F.struct(*payload), tiebreak, keys)


def merge(partials: DataFrame, tiebreak: str, keys: list[str] | None = None) -> DataFrame:
    """Partials of any number of batches as one partial."""
    return _newest(partials, F.col("payload"), tiebreak, keys)


def flat(partials: DataFrame) -> DataFrame:
    """The readable view: payload columns at top level."""
    return partials.select(*[c for c in partials.columns if c != "payload"], "payload.*")


def latest(events: DataFrame, payload: list[str], tiebreak: str) -> DataFrame:
    return flat(partial(events, payload, tiebreak))


def latest_non_empty(events: DataFrame, payload: list[str], tiebreak: str) -> DataFrame:
    """Of each column the newest value that isn't null, '' or 0 (an extension; ``latest`` takes values as they come)."""
    order = F.struct("event_time", tiebreak)
    kinds = dict(events.dtypes)
    some = lambda c: F.col(c) != ("" if kinds[c] == "string" else 0)
    return events.groupBy(*KEYS).agg(F.max("event_time").alias("event_time"), *[F.max_by(F.when(some(c), F.col(c)), F.when(some(c), order)).alias(c) for c in payload])
