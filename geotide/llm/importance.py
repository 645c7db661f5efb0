"""Quality selection by importance resampling.

Two generative models of hashed word n-grams (one and two words): of target
texts, here those labelled good, and of all raw texts.  A text's importance
weight is the ratio of its likelihoods; a sample without replacement in
proportion to the weights is what Gumbel noise on the log weights and a top-k
give.  The k-th key is found by narrowing histograms, so no task or driver
sees more than a small bin of keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotide.llm._frames import documents, durable, project
from geotide.llm._text import Chunk, grams, text_chunks

#: Hash buckets of each n-gram length (fixed model size), and the pseudo-count of each bucket.
BUCKET_BITS, SMOOTHING = 16, 1.0
#: Labelled target texts that the target model is fitted on, at most; the raw model counts all texts.
TARGET_ROWS = 500_000
#: Share of the documents that the sample takes.
SHARE = 0.85
_BIN_ROWS = 5_000


def _features(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of all one- and two-word n-grams."""
    start, end, of = c.words()
    h = c.span_hash(start, end) if len(start) else np.zeros(0, np.uint64)
    two, first = grams(h, of, 2)
    shift = np.uint64(64 - BUCKET_BITS)
    bucket = np.concatenate([h >> shift, (two >> shift) + np.uint64(1 << BUCKET_BITS)]).astype(np.int64)
    return bucket, np.concatenate([of, of[first]])


def _count(wanted):
    """Bucket counts of all texts (``raw``), and of those whose id is among the wanted ones (``target``)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = wanted.value
        raw, target = np.zeros(2 << BUCKET_BITS, np.int64), np.zeros(2 << BUCKET_BITS, np.int64)
        for b in it:
            x = b["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
            good = np.asarray(b["doc_id"].is_valid()) & (ids[np.minimum(np.searchsorted(ids, x), len(ids) - 1)] == x if len(ids) else False)
            for i, j, c in text_chunks(b["text"]):
                bucket, of = _features(c)
                raw += np.bincount(bucket, minlength=len(raw))
                target += np.bincount(bucket[good[i:j][of]], minlength=len(raw))
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    return run


def _log_ratio(docs: DataFrame, good: DataFrame) -> np.ndarray:
    """Log of target over raw probability by bucket: a table of fixed size, so it may come to the driver.

    ``good``: ids of target texts; of more than TARGET_ROWS those first in
    hash order are taken.  Only the ids travel to the texts.
    """
    ids = good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_ROWS).toArrow()["doc_id"].to_numpy()
    wanted = docs.sparkSession.sparkContext.broadcast(np.sort(ids.astype(np.int64)))
    counts = np.zeros((2, 2 << BUCKET_BITS))
    for r in docs.mapInArrow(_count(wanted), "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        counts[:, r["bucket"]] = r["raw"], r["target"]
    out = []
    for raw, target in zip(counts[0].reshape(2, -1), counts[1].reshape(2, -1), strict=True):
        # target counts as many as raw ones, so that the pseudo-counts weigh alike in both models
        scaled = target * (raw.sum() / target.sum()) if target.sum() else raw
        out.append(np.log((scaled + SMOOTHING) / (raw + SMOOTHING)))
    return np.concatenate(out)


def weights(docs: DataFrame, good: DataFrame, seed: int = 29, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, log_weight, key): the log importance weight, and with seeded Gumbel noise.  Empty texts weigh 0 (log)."""
    d = documents(docs, id_col, text_col)
    ratio = docs.sparkSession.sparkContext.broadcast(_log_ratio(d, good))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, c in text_chunks(b["text"]):
                bucket, of = _features(c)
                w = np.bincount(of, ratio.value[bucket], c.n)
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), b["noise"].slice(i, j - i), pa.array(w)], ["doc_id", "noise", "log_weight"])

    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", F.coalesce("text", F.lit(""))), 11)
    noise = -F.log(-F.log((bits.cast("double") + 0.5) * 2.0**-53))
    out = d.withColumn("noise", noise).mapInArrow(run, "doc_id long, noise double, log_weight double")
    return out.select("doc_id", "log_weight", (F.col("log_weight") + F.col("noise")).alias("key"))


def _narrow(rows: DataFrame, value: Column, k: int) -> tuple[DataFrame, DataFrame, int]:
    """(rows surely among the k of largest ``value``, rows at the border, how many of these to take).

    The border's range is narrowed by histograms of 256 bins until it holds
    _BIN_ROWS rows at most, or one value.  ``value`` is a double or a decimal.
    """
    rows = rows.withColumn("_v", value)
    span = rows.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("*").alias("n")).first()
    lo, hi, n, above = span["lo"], span["hi"], span["n"], 0  # the border lies in [lo, hi]; so many rows are above hi
    kind = rows.schema["_v"].dataType
    at = lambda x: F.lit(x).cast(kind)
    while n > _BIN_ROWS and lo < hi:
        step = (hi - lo) / 256
        if lo + step == lo:  # a double's last digits
            break
        inside = rows.filter((F.col("_v") >= at(lo)) & (F.col("_v") <= at(hi)))
        bin_ = F.least(F.floor(((F.col("_v") - at(lo)) / F.lit(step)).cast("double")), F.lit(255)).alias("b")
        found = sorted(inside.groupBy(bin_).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("*").alias("n")).collect(), key=lambda r: r["lo"], reverse=True)
        for r in found:
            if above + r["n"] >= k:
                lo, hi, n = r["lo"], r["hi"], r["n"]
                break
            above += r["n"]
    sure = rows.filter(F.col("_v") > at(hi)).drop("_v")
    return sure, rows.filter((F.col("_v") >= at(lo)) & (F.col("_v") <= at(hi))).drop("_v"), k - above


def _any(rows: DataFrame, k: int) -> DataFrame:
    """Any k rows of interchangeable ones: those of the first partitions, of which only numbers of rows are gathered."""
    number = F.monotonically_increasing_id()
    tagged = rows.withColumn("_n", number).withColumn("_p", F.shiftright("_n", 33)).withColumn("_n", F.col("_n").bitwiseAND(F.lit(2**33 - 1)))
    whole = 0
    for r in sorted(tagged.groupBy("_p").count().collect(), key=lambda r: r["_p"]):
        if whole + r["count"] >= k:
            return tagged.filter((F.col("_p") < r["_p"]) | ((F.col("_p") == r["_p"]) & (F.col("_n") < k - whole))).drop("_n", "_p")
        whole += r["count"]
    return rows


def top_share(keyed: DataFrame, k: int) -> DataFrame:
    """The k rows of largest ``key``; rows with equal keys at the border are taken by doc_id, equal ones of those in any order."""
    if k <= 0:
        return keyed.limit(0)
    if k >= keyed.count():
        return keyed
    sure, border, k = _narrow(keyed, F.col("key"), k)
    if border.limit(_BIN_ROWS + 1).count() > _BIN_ROWS:  # one key: a text that is repeated very often
        by_id = -F.coalesce(F.col("doc_id").cast("decimal(38,0)"), F.lit(Decimal(2**64)).cast("decimal(38,0)"))
        more, border, k = _narrow(border, by_id, k)
        sure = sure.unionByName(more)
        if border.limit(_BIN_ROWS + 1).count() > _BIN_ROWS:
            return sure.unionByName(_any(border, k))
    place = F.row_number().over(Window.orderBy(F.col("key").desc(), F.col("doc_id").asc_nulls_last()))
    return sure.unionByName(border.withColumn("_p", place).filter(F.col("_p") <= k).drop("_p"))


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE, seed: int = 29) -> DataFrame:
    """(doc_id, log_weight, key, kept) of the sampled documents; ``labels`` (doc_id, quality) names the target texts.

    Takes ceil(share * rows) rows.  Null and empty texts have weight 1 and
    take part; a repeated row is a row; labels that are null or of unknown ids
    are ignored, of several labels of an id the smaller counts; without any
    good label all weights are equal to the smoothing's.  Long texts count
    whole; extra columns, with any names, are ignored; an empty table gives no
    rows.  Reruns agree.
    """
    good = project(labels, {"doc_id": "doc_id", "quality": "quality"}).groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    keyed = durable(weights(docs, good, seed))
    n = keyed.count()
    return top_share(keyed, math.ceil(share * n)).withColumn("kept", F.lit(True))


def op4(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
