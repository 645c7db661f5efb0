"""Merkle manifest of a dataset, built level by level with DataFrames.

Every row is a leaf.  Leaves of a group (a language) stand in order and
``fanout`` consecutive nodes at a time are hashed into a parent until one, the
subroot, is left; the subroots in the order of their groups give the root the
same way.

Places come from a range sort: rows are ordered over all partitions, numbered
within each, and a small table of runs (one row a group and partition) turns
that into places within a group, so no group is gathered for its numbering.
Going up, place div ``fanout`` names the parent and a grouped, sorted array of
at most ``fanout`` children is hashed into it.  Going down, every level joins
its parents' paths and puts its siblings before them; each level is smaller by
``fanout``, so all of them together cost little more than the first.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotide.llm._frames import durable, n_parts, project

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(*values: Column) -> Column:
    """Digest of values with their lengths in bytes, so that no two different rows are written alike; null is '-'."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings lead to."""
    return F.aggregate(path, start, lambda h, step: digest(step["left"], h, step["right"]))


def proof(path: Column) -> Column:
    """The siblings of a path one after the other, level by level and from left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (tree, hash, ...) with ``i``, their place within the tree in the given order, and ``n``, the tree's number of nodes.

    Equal rows are told apart by their place in the input, so a row that is
    repeated any number of times is dealt over many partitions.
    """
    by = ["tree", *order, "hash", "_row"]
    ranged = nodes.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(n_parts(nodes.sparkSession), *by).sortWithinPartitions(*by)
    placed = durable(ranged.withColumn("_place", F.monotonically_increasing_id()).drop("_row")).withColumn("_part", F.shiftright("_place", 33))
    runs = placed.groupBy("tree", "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    all_runs = Window.partitionBy("tree")
    earlier = all_runs.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(all_runs).alias("n"))
    return placed.join(runs, ["tree", "_part"]).withColumn("i", F.col("_place") + F.col("_shift")).drop("_part", "_place", "_shift")


class Forest:
    """Trees over numbered nodes (tree, i, n, hash, own): their levels as tables of sibling groups, and their top nodes."""

    def __init__(self, nodes: DataFrame, fanout: int):
        up = F.floor(F.col("i") / fanout).alias("up")
        groups = nodes.groupBy("tree", "n", up).agg(F.sort_array(F.collect_list(F.struct("i", "hash", "own"))).alias("children"))
        self.levels, tops = [durable(groups)], []
        alone = self.levels[0].filter("n = 1").select("tree", F.col("children")[0]["hash"].alias("hash"))
        tops.append(alone)
        most = self.levels[0].agg(F.max("n").alias("n")).first()["n"] or 0
        nodes = self._parents(self.levels[0], fanout)
        while (most := -(-most // fanout)) > 1:
            tops.append(nodes.filter("n = 1").select("tree", "hash"))
            self.levels.append(durable(nodes.filter("n > 1").groupBy("tree", "n", up).agg(F.sort_array(F.collect_list(F.struct("i", "hash"))).alias("children"))))
            nodes = self._parents(self.levels[-1], fanout)
        tops.append(nodes.select("tree", "hash"))
        self.tops = tops

    @staticmethod
    def _parents(groups: DataFrame, fanout: int) -> DataFrame:
        hashed = F.sha2(F.array_join(F.col("children.hash"), ""), 256)
        return groups.filter("n > 1").select("tree", F.col("up").alias("i"), F.ceil(F.col("n") / fanout).alias("n"), hashed.alias("hash"))

    def roots(self) -> DataFrame:
        """(tree, hash) of every tree's top."""
        return reduce(DataFrame.unionByName, self.tops)

    def paths(self, above: DataFrame) -> DataFrame:
        """(tree, hash, own, path, ...) of every node given; ``above``: (tree, path, ...) of the tops, whose path goes on from there."""
        rest = [c for c in above.columns if c not in ("tree", "path")]
        down = self.tops[-1].select("tree", F.lit(0).cast("long").alias("up")).join(above, "tree")
        for k in range(len(self.levels) - 1, -1, -1):
            met = self.levels[k].filter("n > 1").join(down, ["tree", "up"])
            if not k:
                met = met.unionByName(self.levels[0].filter("n = 1").join(above, "tree"))
            at, siblings = F.col("pos"), F.col("children.hash")
            step = F.struct(
                F.array_join(F.slice(siblings, F.lit(1), at), "").alias("left"),
                F.array_join(F.slice(siblings, at + 2, F.size(siblings)), "").alias("right"),
            )
            met = met.select("tree", "n", "path", "children", *rest, F.posexplode("children").alias("pos", "child"))
            path = F.when(F.col("n") > 1, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path")).alias("path")
            if not k:
                return met.select("tree", F.col("child.hash").alias("hash"), F.col("child.own").alias("own"), path, *rest)
            down = met.select("tree", F.col("child.i").alias("up"), path, *rest)
            down = down.unionByName(self.tops[k].select("tree", F.lit(0).cast("long").alias("up")).join(above, "tree"))
        raise AssertionError("a forest has a level")


def manifest(rows: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id", fanout: int = FANOUT, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """(order column, leaf, subroot, root, path, carried columns...), one row for each row.

    ``path``: array of (left, right), the siblings' digests before and after
    the node on each level, from the leaf to the root.  ``carry``: more columns
    out of the fields.  A null in any field is a value of its own; a null group
    is the first one, null ids come first; rows of one id stand in the order of
    their leaves, repeated rows each have a leaf; texts are taken whole; other
    columns, with any names, are ignored; an empty table gives no rows.
    """
    picked = project(rows, {f: f for f in dict.fromkeys((*fields, group, order))})
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree")  # null first, never null
    own = F.struct(F.col(order), *[c.alias(k) for k, c in (carry or {}).items()]).alias("own")
    leaves = durable(picked.select(tree, F.col(order).alias("_order"), leaf(*[F.col(f) for f in fields]).alias("hash"), own))
    trees = Forest(_numbered(leaves, ["_order"]), fanout)
    subroots = trees.roots().select(F.lit("").alias("tree"), "hash", F.struct(F.col("tree").alias("name"), F.col("hash").alias("subroot")).alias("own"), F.col("tree").alias("_order"))
    top = Forest(_numbered(subroots, ["_order"]), fanout)
    root = top.roots().select("tree", F.col("hash").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    above = top.paths(root).select(F.col("own.name").alias("tree"), F.col("own.subroot").alias("subroot"), "root", "path")
    out = trees.paths(durable(above))
    return out.select(F.col(f"own.{order}").alias(order), F.col("hash").alias("leaf"), "subroot", "root", "path", *[F.col(f"own.{k}").alias(k) for k in (carry or {})])


def op12(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lowered = [F.translate("text", _UPPER, _LOWER) if f == "text" else F.col(f) for f in FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf(*lowered))
    m = manifest(docs, carry={"claimed": tampered}).withColumn("folded_root", fold(F.coalesce("claimed", "leaf"), F.col("path")))
    return m.select("doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle_sql(levels: int = 9) -> str:
    """The same in SQL for up to ``FANOUT ** levels`` rows: levels written out one after the other."""
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    crc = (
        "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(doc_id::VARCHAR)), lambda k: ascii(substr(doc_id::VARCHAR, (k + 1)::BIGINT, 1))::BIGINT)), "
        f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: {bit})))"
    )
    as_leaf = lambda text: "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [
        f"WITH b AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {as_leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {as_leaf(lowered)} END AS claimed FROM documents)",
        "l0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM b)",
        "n0 AS (SELECT tree, i, n, leaf AS h FROM l0)",
    ]

    def climb(name: str, tops: str, f: int = FANOUT) -> None:
        w = f"WINDOW o AS (PARTITION BY tree, i // {f} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), p AS (PARTITION BY tree, i // {f} ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
        for k in range(levels):
            out.append(f"{name}s{k} AS (SELECT tree, i, coalesce(string_agg(h, '') OVER o, '') AS lft, coalesce(string_agg(h, '') OVER p, '') AS rgt FROM {name}{k} WHERE n > 1 {w})")
            out.append(f"{name}{k + 1} AS (SELECT tree, i // {f} AS i, (n + {f - 1}) // {f} AS n, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}{k} WHERE n > 1 GROUP BY ALL)")
        out.append(f"{tops} AS (" + " UNION ALL ".join(f"SELECT tree, h FROM {name}{k} WHERE n = 1" for k in range(levels + 1)) + ")")

    climb("n", "subs")
    out += ["u AS (SELECT tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM subs)", "m0 AS (SELECT '' AS tree, i, n, h FROM u)"]
    climb("m", "top")
    out.append("f0 AS (SELECT l0.*, u.i AS j, u.h AS subroot, top.h AS root, coalesce(claimed, leaf) AS cur, '' AS proof FROM l0 JOIN u ON l0.tree = u.name, top)")
    k = 0
    for name, at, key in (("n", "i", "s.tree = f.tree"), ("m", "j", "true")):
        for level in range(levels):
            step = f"{FANOUT**level}"
            out.append(
                f"f{k + 1} AS (SELECT f.* EXCLUDE (cur, proof), CASE WHEN s.i IS NULL THEN cur ELSE sha256(lft || cur || rgt) END AS cur, proof || coalesce(lft || rgt, '') AS proof "
                f"FROM f{k} f LEFT JOIN {name}s{level} s ON {key} AND s.i = f.{at} // {step})"
            )
            k += 1
    tail = f" SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified FROM f{k}"
    return ",\n".join(out) + "\n" + tail
