"""Reference dimensions: versioned upserts, last-row-wins, carry-forward, overlays, object choice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest_version(df: DataFrame, keys: list[str], *version: str) -> DataFrame:
    """One row a key, of the highest version.  Partial aggregation on the map side, so a key with many versions is no hot spot."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*version)
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], version: str = "updated_at") -> DataFrame:
    """What readers see after ``new`` rows are appended."""
    return newest_version(old.unionByName(new, allowMissingColumns=True), keys, version)


def carry_forward(new: DataFrame, old: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """New rows with the columns that only older ones have filled in; empty strings count as missing."""
    known = newest_version(old.select(key, *columns).filter(reduce(lambda a, b: a | b, [F.col(c) != "" for c in columns])), [key], *columns)
    known = known.select(F.col(key), *[F.col(c).alias(f"_old_{c}") for c in columns])
    out = new.join(known, key, "left")
    for c in columns:
        own = F.col(c) if c in new.columns else F.lit(None).cast("string")
        out = out.withColumn(c, F.coalesce(F.nullif(own, F.lit("")), F.col(f"_old_{c}"), F.lit("")))
    return out.drop(*[f"_old_{c}" for c in columns])


def overlay(base: DataFrame, over: DataFrame, keys: list[str]) -> DataFrame:
    """Union in which rows of ``over`` replace those of the same key."""
    both = base.withColumn("_p", F.lit(0)).unionByName(over.withColumn("_p", F.lit(1)), allowMissingColumns=True)
    return newest_version(both, keys, "_p").drop("_p")


def union_all(*feeds: DataFrame) -> DataFrame:
    """Several integrations of one feed as one: a bag union, nothing removed."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def latest_object(objects: DataFrame, accept: Column, size: int = 50_000_000) -> DataFrame:
    """The accepted object of at least ``size`` bytes that was modified last; of ties the first by key."""
    return objects.filter(accept & (F.col("size") >= size)).orderBy(F.col("last_modified").desc(), "key").limit(1)


def is_aircraft_csv(key: Column) -> Column:
    return F.lower(key).endswith(".csv") & F.lower(key).contains("aircraft")
