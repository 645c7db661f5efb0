"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from geotide.llm._frames import durable

#: Parts into which the links of one node are dealt, so that those of a hub don't meet in one task.
SALT = 8


def _written(edges: DataFrame) -> tuple[DataFrame, tuple[int, object]]:
    """The edges as a table, with their number and a checksum, observed as they are written."""
    seen = Observation()
    out = durable(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
    return out, (seen.get.get("n", 0), seen.get.get("h"))


def _with_lowest(edges: DataFrame, by: str, how: str) -> DataFrame:
    """(u, v, m): links with the smallest v that the node in column ``by`` links to as their u."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), "m", F.explode(F.array(*[F.lit(i) for i in range(SALT)])).alias("salt"))
    other: Column = F.col("u" if by == "v" else "v")
    dealt = edges.withColumn("part", F.pmod(F.xxhash64(other), F.lit(SALT)).cast("int"))
    return dealt.join(low, (F.col(by) == F.col("node")) & (F.col("part") == F.col("salt")), how).select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in (a, b) links; root is the smallest id of the component.

    Links point from the larger id u to the smaller v.  Alternates two local
    rewrites, each a partial aggregation and an equi-join: every node links its
    larger neighbours to the smallest node it sees, then every node links its
    smaller neighbours and itself to the smallest of them.  Links never grow in
    number, and log(diameter) rounds end in stars, whose centres are the roots.
    Only a count and a checksum reach the driver.
    """
    edges, state = _written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while state != before and state[0]:
        before = state
        large = _with_lowest(edges, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        small = _with_lowest(large, "u", "inner")
        new = small.select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
        edges, state = _written(new.filter("u <> v").distinct())
    roots = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()
