"""Line dedup by an exact set-similarity join.

A line is the set of its words.  A line goes if an earlier one (smaller
document id, then line number) has Jaccard similarity of at least 0.8 with it;
all lines are judged on the input.  The join:

* Lines of the same words in the same order collapse to one, with the place of
  the first.
* Words are put in one global order, rarest first (classes of word counts over
  the whole corpus, in a hashed table of fixed size, then the word's hash; any
  total order gives right results, a rarer-first one few candidates).
* Similar sets share a word among their first ``n - ceil(0.8 n) + 1`` words
  (prefix filter), with lengths within 0.8 (length filter), the first shared
  word early enough that the rest can make up the overlap (positional filter),
  and parity bitmaps that differ in no more bits than the sets may differ in
  words.  The filters only drop pairs that cannot be similar.
* What is left is verified on the whole sets.  Candidates leave a task as a
  spanning forest, never as all pairs; components over BLOCK sets are cut into
  blocks that are compared block against block.

A line that very many documents share is found by its count; there are at most
``1 / HOT_SHARE`` such lines, so their table is small.  Only the first of its
places looks for similar lines, and its other places are settled where they
are read, without meeting in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotide.llm import _idfilter
from geotide.llm._frames import by_position, documents, durable, text_bytes
from geotide.llm._graph import components
from geotide.llm._text import Chunk, mix, order_within, text_chunks

#: Entries of the hashed word-count table: 2**22 counts (16 MB), whatever the corpus.
COUNT_BITS, SLICES = 22, 64
#: Text that a task turns into postings before it sends them, and text for each bucket of words.
SEND_BYTES, BUCKET_BYTES = 6 << 20, 6 << 20
BLOCK = 1024
#: A line is hot if it makes up this share of all lines (and is on HOT_LEAST of them).
HOT_SHARE, HOT_LEAST = 1e-4, 256
#: One posting: word, line, size of the set and the word's place in it (up to LONG - 1), two parity bitmaps.
_POSTING = np.dtype([("t", "<u4"), ("k", "<u8"), ("n", "<u2"), ("i", "<u2"), ("b0", "<u8"), ("b1", "<u8")])
LONG = (1 << 16) - 1

_SEEN = "doc_id long, line_no int, key long, slice int, body binary"


def _lines(c: Chunk) -> dict[str, np.ndarray]:
    """Lines that have words: text, number within the text, key (of the words in order); and the words' hashes and lines."""
    l_start, l_end, l_of = c.lines()
    start, end = c.runs()
    h = c.span_hash(start, end) if len(start) else np.zeros(0, np.uint64)
    at = np.searchsorted(start, l_start)
    n = np.searchsorted(start, l_end) - at
    some = np.flatnonzero(n)
    number = np.arange(len(l_of)) - np.searchsorted(l_of, l_of)
    at, n = at[some], n[some]
    place = np.arange(len(h)) - np.repeat(at, n)
    key = np.add.reduceat(mix(h + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), at) if len(at) else np.zeros(0, np.uint64)
    return {"of": l_of[some], "no": number[some], "key": mix(key + n.astype(np.uint64)), "at": at, "n": n, "h": h}


def _sets(lines: dict[str, np.ndarray], pick: np.ndarray, rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first, size) of the word sets of some lines, flat; ordered by word, or by rank class and word if ``rank`` is given."""
    n, at = lines["n"][pick], lines["at"][pick]
    total = int(n.sum())
    owner = np.repeat(np.arange(len(pick)), n)
    h = lines["h"] if total == len(lines["h"]) else lines["h"][np.arange(total) + np.repeat(at - (np.cumsum(n) - n), n)]
    if rank is None:
        by = order_within(owner, h)
    else:
        value = (rank[(h >> np.uint64(64 - COUNT_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))
        by = order_within(owner, value)
        x, y = by[1:], by[:-1]
        if ((h[x] != h[y]) & (value[x] == value[y]) & (owner[x] == owner[y])).any():
            by = np.lexsort((h, value, owner))
    owner, h = owner[by], h[by]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    h, owner = h[new], owner[new]
    size = np.bincount(owner, minlength=len(pick))
    return h, np.cumsum(size) - size, size


def _seen(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One scan: every line's place and key, and the counts of its words by hash, in slices so that summing them is spread."""
    table = np.zeros(1 << COUNT_BITS, np.uint32)
    names = [x.split()[0] for x in _SEEN.split(", ")]
    for b in it:
        for i, j, c in text_chunks(b["text"]):
            s = _lines(c)
            slot = np.sort((s["h"] >> np.uint64(64 - COUNT_BITS)).astype(np.uint32))
            at = np.flatnonzero(np.diff(slot, prepend=np.uint32(1 << COUNT_BITS)))
            table[slot[at]] += np.diff(np.append(at, len(slot))).astype(np.uint32)
            ids, n = b["doc_id"].slice(i, j - i).take(pa.array(s["of"])), len(s["key"])
            yield pa.RecordBatch.from_arrays([ids, pa.array(s["no"].astype(np.int32)), pa.array(s["key"].view(np.int64)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
    part = len(table) // SLICES
    for k in range(SLICES):  # what isn't zero, as places and counts
        own = table[k * part : (k + 1) * part]
        at = np.flatnonzero(own)
        if len(at):
            body = at.astype("<u4").tobytes() + own[at].tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.array([k], pa.int32()), pa.array([body], pa.binary())], names)


def _sum_counts(t: pa.Table) -> pa.Table:
    total = np.zeros((1 << COUNT_BITS) // SLICES, np.int64)
    for x in t["body"]:
        at, n = np.frombuffer(x.as_buffer(), "<u4").reshape(2, -1)
        total[at] += n
    # classes of a quarter of an octave; 0: met once at most
    rank = np.where(total > 1, 1 + np.floor(4 * np.log2(np.maximum(total, 1))), 0)
    return pa.table([pa.array([t["slice"][0].as_py()], pa.int32()), pa.array([np.minimum(rank, 255).astype(np.uint8).tobytes()], pa.binary())], ["slice", "body"])


def _prefixes(c: Chunk, rank: np.ndarray, ids: np.ndarray, hot: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Postings of the prefix words of each distinct line, of a hot line only where it comes first; and what deals them into buckets."""
    s = _lines(c)
    pick = np.sort(np.unique(s["key"], return_index=True)[1])
    if len(hot["key"]):
        k = np.searchsorted(hot["key"], s["key"])
        k[k == len(hot["key"])] = 0
        is_hot = hot["key"][k] == s["key"]
        first = is_hot & (hot["doc_id"][k] == ids[s["of"]]) & (hot["line_no"][k] == s["no"])
        # a repeated id may have other lines before: of a hot line's places in this chunk the first one counts wherever it is
        pick = np.union1d(pick[~is_hot[pick]], np.flatnonzero(first))
    h, at, n = _sets(s, pick, rank)
    owner = np.repeat(np.arange(len(pick)), n)
    place = np.arange(len(h)) - at[owner]
    bit = np.uint64(1) << (h & np.uint64(63))
    upper = (h & np.uint64(64)) != 0
    bitmap = [np.bitwise_xor.reduceat(np.where(on, bit, np.uint64(0)), at) if len(n) else np.zeros(0, np.uint64) for on in (upper, ~upper)]
    use = place < (n - (4 * n + 4) // 5 + 1)[owner]
    use[use] = rank[(h[use] >> np.uint64(64 - COUNT_BITS)).astype(np.int64)] > 0  # a word met once is in no other line
    out = np.zeros(int(use.sum()), _POSTING)
    o = owner[use]
    out["t"] = mix(h[use]) & np.uint64(0xFFFFFFFF)
    out["k"], out["n"], out["i"] = s["key"][pick][o], np.minimum(n, LONG)[o], np.minimum(place[use], LONG)
    out["b0"], out["b1"] = bitmap[0][o], bitmap[1][o]
    return out, (mix(h[use]) >> np.uint64(32))


def _postings(shared, buckets: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, hot = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def send() -> pa.RecordBatch:
            p, of = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
            of = (of % np.uint64(buckets)).astype(np.int32)
            by = np.argsort(of, kind="stable")
            p, of = p[by], of[by]
            at = np.flatnonzero(np.diff(of, prepend=-1))
            bodies = [x.tobytes() for x in np.split(p, at[1:])] if len(at) else []
            return pa.RecordBatch.from_arrays([pa.array(of[at], pa.int32()), pa.array(bodies, pa.binary())], ["bucket", "body"])

        for b in it:
            ids = b["doc_id"].to_numpy(zero_copy_only=False)
            for i, j, c in text_chunks(b["text"]):
                held.append(_prefixes(c, rank, ids[i:j], hot))
                size += len(c.buf)
                if size >= SEND_BYTES:
                    yield send()
                    held, size = [], 0
        if held:
            yield send()

    return run


class _Forest:
    """Union-find over integers 0..n-1 that keeps one link for each merge; pairs come as arrays."""

    def __init__(self, n: int):
        self.root, self.links = np.arange(n), []

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        a, b = self.root[x], self.root[y]
        new = a != b
        if not new.any():
            return
        n = len(self.root)
        pair = np.unique(np.minimum(a[new], b[new]) * n + np.maximum(a[new], b[new]))
        root = self.root
        for i, j in zip((pair // n).tolist(), (pair % n).tolist(), strict=True):
            u, v = i, j
            while root[u] != u:
                u = int(root[u])
            while root[v] != v:
                v = int(root[v])
            if u != v:
                root[max(u, v)] = min(u, v)
                self.links.append((i, j))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        self.root = root


def _candidates(t: pa.Table) -> pa.Table:
    """All pairs of one bucket of words that pass the filters, as a spanning forest over line keys."""
    p = np.frombuffer(b"".join(x.as_py() for x in t["body"]), _POSTING)
    p = p[np.lexsort((p["k"], (p["t"].astype(np.uint64) << np.uint64(16)) | p["n"]))]
    same = np.zeros(len(p), bool)
    same[1:] = (p["t"][1:] == p["t"][:-1]) & (p["k"][1:] == p["k"][:-1]) & (p["i"][1:] == p["i"][:-1])
    p = p[~same]
    word, n, i = p["t"], p["n"].astype(np.int64), p["i"].astype(np.int64)
    ends = np.searchsorted(word, word, "right")
    # the shorter of two similar sets shares a word within its first ninth: only such postings look for longer sets
    a, step = np.flatnonzero((i <= n - (8 * n + 8) // 9) | (n == LONG)), 0
    keys, key_of = np.unique(p["k"], return_inverse=True)
    forest = _Forest(len(keys))
    while len(a):
        step += 1
        a = a[a + step < ends[a]]
        a = a[4 * n[a + step] <= 5 * n[a]]  # within a word by length: beyond the first that is too long all are
        b = a + step
        need = (4 * (n[a] + n[b]) + 8) // 9  # overlap that similarity 0.8 takes
        long = n[b] == LONG  # a size that isn't known: no filter by it
        ok = long | (1 + np.minimum(n[a] - 1 - i[a], n[b] - 1 - i[b]) >= need)
        x, y, most = a[ok], b[ok], np.where(long, LONG, n[a] + n[b] - 2 * need)[ok]
        differ = np.bitwise_count(p["b0"][x] ^ p["b0"][y]).astype(np.int64) + np.bitwise_count(p["b1"][x] ^ p["b1"][y])
        ok = differ <= most
        forest.add(key_of[x[ok]], key_of[y[ok]])
    signed = keys.view(np.int64)
    return pa.table([pa.array([int(signed[u]) for u, _ in forest.links], pa.int64()), pa.array([int(signed[v]) for _, v in forest.links], pa.int64())], ["a", "b"])


def _fetch(wanted):
    """(doc_id, line_no, key, body) of the lines whose document and key the two filters let through; body is the word set."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_doc, of_key = wanted.value
        for b in it:
            b = b.filter(pa.array(of_doc.may_hold(b["doc_id"])))
            for i, j, c in text_chunks(b["text"]):
                s = _lines(c)
                pick = np.flatnonzero(of_key.may_hold(pa.array(s["key"].view(np.int64))))
                h, at, n = _sets(s, pick)
                bodies = [h[x : x + k].tobytes() for x, k in zip(at.tolist(), n.tolist(), strict=True)]
                ids = b["doc_id"].slice(i, j - i).take(pa.array(s["of"][pick]))
                cols = [ids, pa.array(s["no"][pick].astype(np.int32)), pa.array(s["key"][pick].view(np.int64)), pa.array(bodies, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "line_no", "key", "body"])

    return run


def _later(doc: np.ndarray, line: np.ndarray, bodies: list[np.ndarray], side: np.ndarray | None) -> np.ndarray:
    """Which sets have a similar one at an earlier place.  ``side``: compare only across."""
    order = np.lexsort((line, doc))
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.arange(len(doc))
    n = np.array([len(x) for x in bodies])
    flat, of = np.concatenate(bodies), np.repeat(np.arange(len(n)), n)
    by = np.argsort(flat)
    f = flat[by]
    new = np.ones(len(f), bool)
    new[1:] = f[1:] != f[:-1]
    size = np.diff(np.append(np.flatnonzero(new), len(f)))
    shared = np.repeat(size > 1, size)
    col = (np.cumsum(size > 1) - 1)[np.cumsum(new) - 1][shared]
    row = of[by][shared]
    rows_a = np.arange(len(n)) if side is None else np.flatnonzero(~side)
    rows_b = rows_a if side is None else np.flatnonzero(side)
    overlap = np.zeros((len(rows_a), len(rows_b)), np.float32)
    width = max(256, (1 << 23) // max(len(n), 1))
    cuts = np.searchsorted(col, np.arange(0, (col[-1] + 1 if len(col) else 0) + width, width))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if hi > lo:
            base = col[lo]
            x = np.zeros((len(n), int(col[hi - 1] - base) + 1), np.float32)
            x[row[lo:hi], col[lo:hi] - base] = 1
            overlap += x[rows_a] @ x[rows_b].T
    near = 9 * overlap >= 4 * (n[rows_a][:, None] + n[rows_b][None, :])
    before = rank[rows_a][:, None] < rank[rows_b][None, :]
    out = np.zeros(len(n), bool)
    out[rows_b[(near & before).any(0)]] = True
    out[rows_a[(near & (rank[rows_a][:, None] > rank[rows_b][None, :])).any(1)]] = True
    return out


def _verify(t: pa.Table) -> pa.Table:
    lo, hi = t["lo"][0].as_py(), t["hi"][0].as_py()
    root, key, part, doc, line = (t[c].to_numpy() for c in ("root", "key", "part", "doc_id", "line_no"))
    bodies = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["body"].combine_chunks()]
    out: list[int] = []
    by = np.lexsort((key, root))
    cuts = np.flatnonzero(np.diff(root[by], prepend=root[by[0]] - 1))
    for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(by)], strict=True):
        own = by[i:j]
        own = own[np.diff(key[own], prepend=key[own[0]] - 1) != 0]
        if len(own) > 1:
            side = None if lo == hi else part[own] == hi
            out += key[own][_later(doc[own], line[own], [bodies[k] for k in own.tolist()], side)].tolist()
    return pa.table([pa.array(out, pa.int64())], ["key"])


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line_no, key, kind) of the lines that go; kind 'equal' (the words of an earlier line in its order) or 'similar'.

    Lines without words are never compared and stay.  Null and empty texts
    have none.  Rows with the same id are one document: their lines stand in
    the same places and leave one another alone.  Rows with a null id take no
    part.  Extra columns are ignored; an empty table gives no rows.
    """
    d = documents(docs, id_col, text_col).filter("doc_id is not null")
    sc = docs.sparkSession.sparkContext
    seen = durable(d.mapInArrow(_seen, _SEEN))
    lines = seen.filter("key is not null").select("doc_id", "line_no", "key")
    slices = seen.filter("slice is not null").select("slice", "body").groupBy("slice").applyInArrow(_sum_counts, "slice int, body binary")
    rank = np.zeros(1 << COUNT_BITS, np.uint8)
    for r in slices.collect():  # the table of fixed size
        part = len(rank) // SLICES
        rank[r["slice"] * part : (r["slice"] + 1) * part] = np.frombuffer(r["body"], np.uint8)
    firsts = durable(lines.groupBy("key").agg(F.min(F.struct("doc_id", "line_no")).alias("at"), F.count("*").alias("copies")))
    total = firsts.agg(F.sum("copies").alias("n")).first()["n"] or 0
    least = max(HOT_LEAST, int(total * HOT_SHARE))
    hot_rows = firsts.filter(F.col("copies") >= least).select("key", "at.doc_id", "at.line_no").collect()  # 1 / HOT_SHARE rows at most
    hot_rows.sort(key=lambda r: r["key"] % 2**64)
    hot = {
        "key": np.array([r["key"] for r in hot_rows], np.int64).view(np.uint64),
        "doc_id": np.array([r["doc_id"] for r in hot_rows], np.int64),
        "line_no": np.array([r["line_no"] for r in hot_rows], np.int64),
    }
    shared = sc.broadcast((rank, hot))
    buckets = max(64, text_bytes(d) // BUCKET_BYTES)
    stars = d.mapInArrow(_postings(shared, buckets), "bucket int, body binary").groupBy("bucket").applyInArrow(_candidates, "a long, b long")
    comp = components(stars)
    sizes = comp.groupBy("root").agg(F.count("*").alias("size"))
    cand = comp.join(sizes, "root").withColumnRenamed("id", "key").join(firsts, "key")
    cand = durable(cand.select("key", "root", "size", F.col("at.doc_id").alias("doc_id"), F.col("at.line_no").alias("line_no")))
    n = cand.count()
    wanted = sc.broadcast((_idfilter.build(cand.select("doc_id"), n), _idfilter.build(cand.select("key"), n)))
    found = d.mapInArrow(_fetch(wanted), "doc_id long, line_no int, key long, body binary")
    members = found.join(cand, ["key", "doc_id", "line_no"])
    small = F.col("size") <= BLOCK
    blocks = F.when(small, 1).otherwise(F.ceil(F.col("size") / BLOCK))
    members = members.withColumn("part", F.pmod(F.xxhash64("key"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    members = members.withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other")).withColumn("small", small)
    group = F.when(small, F.pmod(F.xxhash64("root"), F.lit(max(1, n // 2048 + 1)))).otherwise(F.col("root"))
    similar = members.withColumn("g", group).groupBy("g", "small", "lo", "hi").applyInArrow(_verify, "key long").distinct()
    why = durable(firsts.join(similar.withColumn("similar", F.lit(True)), "key", "left").filter("copies > 1 or similar"))
    few, rest = F.broadcast(why.filter(F.col("copies") >= least)), why.filter(F.col("copies") < least)
    gone = lines.join(few, "key").unionByName(lines.join(few, "key", "left_anti").join(rest, "key"))
    first = (F.col("doc_id") == F.col("at.doc_id")) & (F.col("line_no") == F.col("at.line_no"))
    gone = gone.withColumn("kind", F.when(F.col("similar"), "similar").when(~first, "equal"))
    return gone.filter("kind is not null").select("doc_id", "line_no", "key", "kind")


def summaries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_equal, n_similar, gone array<(line_no, key)>) of the documents that lose lines."""
    gone = decisions(docs, id_col, text_col).distinct()
    return gone.groupBy("doc_id").agg(
        F.count_if(F.col("kind") == "equal").alias("n_equal"),
        F.count_if(F.col("kind") == "similar").alias("n_similar"),
        F.sort_array(F.collect_list(F.struct("line_no", "key"))).alias("gone"),
    )


def _cut(it: Iterator[pa.RecordBatch], names: list[str], text: str) -> Iterator[pa.RecordBatch]:
    for b in it:
        texts = b[text].to_pylist()
        gone = b["gone"].to_pylist()
        for i, _, c in text_chunks(b[text]):
            if not any(gone[i : i + c.n]):
                continue
            s = _lines(c)
            at, key = np.searchsorted(s["of"], np.arange(c.n + 1)), s["key"].view(np.int64)
            for k in range(c.n):
                if gone[i + k]:
                    keys = dict(zip(s["no"][at[k] : at[k + 1]].tolist(), key[at[k] : at[k + 1]].tolist(), strict=True))
                    drop = {g["line_no"] for g in gone[i + k] if keys.get(g["line_no"]) == g["key"]}
                    texts[i + k] = "\n".join(x for n, x in enumerate(texts[i + k].split("\n")) if n not in drop)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text else b[n] for n in names], names)


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the lines gone; what is left keeps its order.

    Every input row gives one output row: null and empty texts, rows with a
    null id and repeated rows stay (repeated rows lose the same lines).  Extra
    columns may have any names, also ones that clash; an empty table gives no rows.
    """
    plain, at = by_position(docs, id_col, text_col)
    names = plain.columns
    gone = summaries(docs, id_col, text_col).select(F.col("doc_id").alias("gone_id"), "gone")
    rich = plain.join(gone, F.col(at[0]).cast("long") == F.col("gone_id"), "left").drop("gone_id")
    return rich.mapInArrow(lambda it: _cut(it, names, at[1]), plain.schema).toDF(*docs.columns)


def op3(spark, sf_dir: str) -> DataFrame:
    """(doc_id, n_lines, n_equal, n_similar, removed_lines): the last is line numbers from 0, comma-joined."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    numbers = F.array_join(F.col("gone.line_no").cast("array<string>"), ",")
    found = summaries(docs).select(F.col("doc_id").alias("_id"), "n_equal", "n_similar", numbers.alias("lines"))
    ids = docs.select("doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).alias("n_lines"))
    out = ids.join(found, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    return out.select("doc_id", "n_lines", F.coalesce("n_equal", F.lit(0)).alias("n_equal"), F.coalesce("n_similar", F.lit(0)).alias("n_similar"), F.coalesce("lines", F.lit("")).alias("removed_lines"))
