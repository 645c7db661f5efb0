"""The corpus pipeline: raw documents to token counts and digests, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir), works
on all that its predecessor kept, and all but the last return the columns of
``documents``: doc_id, text, lang, source, n_chars.  Other columns, whatever
their names, are left behind.  In every stage a null text is an empty one, a
null id or source is a value like others, repeated rows are rows, long texts
are taken whole, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotide.llm import bag_minhash, bpe, line_dedup, mixing, quality_rules
from geotide.llm._frames import durable, project

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    return project(docs, {c: c for c in COLUMNS})


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; that includes null and empty texts and all of under 50 words."""
    return quality_rules.keep(_documents(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to one in an earlier place (smaller id, then line) go; documents stay, with what is left of them.

    Rows of one id leave one another alone; rows without an id keep all.
    """
    return line_dedup.remove_lines(_documents(docs)).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id; of repeated rows one.

    Texts without words are in no group; rows without an id stay.
    """
    return bag_minhash.one_of_each(_documents(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them; those without words are taken no times."""
    return mixing.mixed(_documents(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of the mix."""
    return bpe.encode(_documents(docs), bpe.default_vocabulary())


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("mix_sources", mix),
    ("bpe_encode", encode),
]

#: BPE and the bands of near-duplicates aren't SQL; tests compare the whole with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
