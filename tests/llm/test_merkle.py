"""The Merkle manifest against hashing in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from geotide.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, _row int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(hashes, fanout):
    """The root, and of each leaf the (left, right) siblings on each level."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        runs = [hashes[k : k + fanout] for k in range(0, len(hashes), fanout)]
        for i, k in enumerate(at):
            run, j = runs[k // fanout], k % fanout
            paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            at[i] = k // fanout
        hashes = [sha("".join(r)) for r in runs]
    return hashes[0], paths


def brute(rows, fanout):
    groups = {}
    for r in rows:
        doc_id, text, lang, source, n_chars = r[:5]
        groups.setdefault(lang, []).append(((doc_id is not None, doc_id or 0), leaf(doc_id, source, lang, n_chars, text), r))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    built = {g: tree([h for _, h, _ in sorted(groups[g], key=lambda x: x[:2])], fanout) for g in langs}
    root, upper = tree([built[g][0] for g in langs], fanout)
    out = []
    for g, up in zip(langs, upper, strict=True):
        for (_, h, r), path in zip(sorted(groups[g], key=lambda x: x[:2]), built[g][1], strict=True):
            out.append((r, h, built[g][0], root, path + up))
    return out


def rows(n=150):
    rng = random.Random(3)
    langs = [None, "", "en", "en", "en", "é", "de"]
    out = [(k, rng.choice(["Text ABC", "abc", "É Z", None, ""]) and f"T{k} X", rng.choice(langs), rng.choice([None, "a"]), k % 5 or None, "clash", 1) for k in range(n)]
    out += [(None, "no id", "en", "a", 1, "c", 1), (None, None, None, None, None, None, None), (7, "other Text", "en", "b", 2, "c", 1), (9001, "alone", "zz", "b", 2, "c", 1)]
    return out + [(5000, "SAME", "en", "a", 1, "c", 1)] * 40


@pytest.mark.parametrize("fanout", [2, 8])
def test_manifest(spark, fanout):
    data = rows()
    got = merkle.manifest(spark.createDataFrame(data, SCHEMA).repartition(5), fanout=fanout).collect()
    want = brute(data, fanout)
    key = lambda x: tuple(map(str, x))
    assert sorted([(r.doc_id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path]) for r in got], key=key) == sorted([(r[0], h, s, t, p) for r, h, s, t, p in want], key=key)


def test_op12(spark, tmp_path):
    data = rows(60)
    spark.createDataFrame([r[:5] for r in data], ", ".join(SCHEMA.split(", ")[:5])).write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op12(spark, str(tmp_path)).collect()
    want = []
    small = lambda t: t and "".join(c.lower() if c.isascii() else c for c in t)
    for (doc_id, text, lang, source, n_chars, *_), h, sub, root, path in brute(data, 8):
        cur = leaf(doc_id, source, lang, n_chars, small(text)) if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 else h
        for left, right in path:
            cur = sha(left + cur + right)
        want.append((doc_id, h, sub, root, sha("".join(a + b for a, b in path)), cur, cur == root))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r.verified for r in got} == {True, False}


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "x", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    r = merkle.manifest(one).first()
    assert r.leaf == r.subroot == r.root == leaf(1, "s", "en", 1, "x") and r.path == []
    assert merkle.manifest(one.filter("false")).count() == 0


def test_rows_are_dealt_by_place_not_by_key(spark, monkeypatch):
    """A group with most rows, all of them alike, is numbered over many partitions."""
    same = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    leaves = same.select(F.lit("=en").alias("tree"), F.col("doc_id").alias("_order"), F.lit("h").alias("hash"), F.struct("doc_id").alias("own"))
    written, durable = [], merkle.durable
    monkeypatch.setattr(merkle, "durable", lambda df: written.append(durable(df)) or written[-1])
    numbered = merkle._numbered(leaves, ["_order"])
    assert [r.i for r in numbered.select("i").orderBy("i").collect()] == list(range(4000))
    sizes = [r["count"] for r in written[0].groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 3000
