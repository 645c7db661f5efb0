"""Spark plumbing shared by the corpus operators."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def project(df: DataFrame, want: Mapping[str, str]) -> DataFrame:
    """Columns of ``df`` under new names: ``{new: old}``.

    Picks by position, so that extra columns whose names differ only in case,
    or appear twice, cannot make a reference ambiguous.  An exact name wins
    over one that differs in case; of repeated names the first is taken.
    """
    plain, at = by_position(df, *want.values())
    return plain.select(*[F.col(c).alias(new) for new, c in zip(want, at, strict=True)])


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """(doc_id long, text string, more...): what most operators read; other columns are pruned."""
    out = project(df, {"doc_id": id_col, "text": text_col} | more)
    return out.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string"))


def by_position(df: DataFrame, *want: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns named _0, _1, ... and which of them the wanted ones are; for operators that carry all columns."""
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    at = []
    for old in want:
        exact = [i for i, c in enumerate(df.columns) if c == old]
        loose = [i for i, c in enumerate(df.columns) if c.lower() == old.lower()]
        if not (exact or loose):
            raise ValueError(f"no column {old!r} among {df.columns}")
        at.append(f"_{(exact or loose)[0]}")
    return plain, at


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, and all run in one process, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = _temporary()
    return folder.rstrip("/")


@functools.cache
def _temporary() -> str:
    return "file://" + tempfile.mkdtemp(prefix="corpus-")


def durable(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: later plans start from files that outlive executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def text_bytes(df: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of a text column (one scan, one number to the driver)."""
    return int(df.agg(F.sum(F.octet_length(col)).alias("n")).first()["n"] or 0)


def null_last(c: Column) -> Column:
    return c.asc_nulls_last()
