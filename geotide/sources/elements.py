"""Orbital elements of a fetch as a version of a table; readers take the newest version of each object.

A version is a folder named by the milliseconds of its fetch.  Propagation
between two fetches reads one version, whatever arrives meanwhile.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geotide.operators import reads
from geotide.sources import feeds


class RateLimited(RuntimeError):
    """The feed asks to come again later."""


def fetch(url: str, timeout: float = 30.0) -> list[dict]:
    """The records of one address; 403 is a limit of the feed, anything else but 200 an error."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer:
            if answer.status != 200:
                raise RuntimeError(f"{url} answered {answer.status}")
            got = json.loads(answer.read())
    except urllib.error.HTTPError as e:
        if e.code == 403:
            raise RateLimited(f"{url}: too many requests") from e
        raise RuntimeError(f"{url} answered {e.code}") from e
    if not isinstance(got, list):
        raise RuntimeError(f"{url} answered no list")
    return got


def refresh(spark: SparkSession, urls: Iterable[str], path: str, now_millis: int, confidence: str = "official") -> int:
    """Fetches all addresses and writes one version; returns its objects.  If one address fails, nothing is written."""
    text = [(json.dumps(record),) for url in urls for record in fetch(url)]
    records = spark.createDataFrame(text, "body string").select(F.from_json("body", feeds.OMM).alias("r")).select("r.*")
    newest = F.row_number().over(Window.partitionBy("norad_id").orderBy(F.col("epoch").desc(), "name"))
    sets = feeds.omm(records, confidence).withColumn("_n", newest).filter("_n = 1").drop("_n")
    sets.coalesce(1).write.mode("overwrite").parquet(f"{path}/fetched={now_millis}")
    return spark.read.parquet(f"{path}/fetched={now_millis}").count()


def newest(spark: SparkSession, path: str) -> DataFrame:
    """Each object's newest element set, with ``maneuvering``: whether it moved since the version before."""
    all_versions = spark.read.option("basePath", path).parquet(path)
    of_object = Window.partitionBy("norad_id").orderBy(F.col("fetched").desc())
    two = all_versions.withColumn("_n", F.row_number().over(of_object)).filter("_n <= 2")
    fetches = all_versions.select("fetched").distinct()
    rank = fetches.withColumn("fetch_no", F.row_number().over(Window.orderBy("fetched")))  # a row a fetch
    moved = reads.maneuvers(two.join(F.broadcast(rank), "fetched")).filter("_n = 1").select("norad_id", F.lit(True).alias("maneuvering"))
    return two.filter("_n = 1").drop("_n", "fetched").join(moved, "norad_id", "left").withColumn("maneuvering", F.coalesce("maneuvering", F.lit(False)))
