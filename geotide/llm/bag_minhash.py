"""MinHash near-duplicates over weighted shingles: BagMinHash signatures, bands, exact verification.

A text is a bag of five-word shingles.  The signature of a bag estimates the
weighted Jaccard similarity sum(min) / sum(max) without bias: every shingle
carries Poisson processes over its discretised weight axis, cut into intervals
of doubling length; their points have an arrival time, a signature component
and a place on the axis, and count if the place is below the shingle's weight.
Each component keeps its smallest arrival.  Points come in order of time, so
a process stops when it passes the time by which all components are full:
each text costs about one number a shingle plus m log m.  Bags of fewer than
four shingles, which are similar only to their equals, need no signature.

Equal bags collapse first.  Bands of the signature propose; whoever shares a
band key is verified on the whole bags, never on the signature.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotide.llm import _idfilter
from geotide.llm._frames import by_position, documents, durable
from geotide.llm._graph import components
from geotide.llm._text import Chunk, grams, mix, order_within, text_chunks

SHINGLE = 5
SIMILARITY = 0.8
#: 50 bands of 7: a pair of similarity 0.8 shares none with a chance of 8e-6, one of 0.3 shares one with 1 in 100.
BANDS, ROWS = 50, 7
#: Texts of a candidate component that one task compares; larger components are cut into blocks, compared pair by pair.
BLOCK = 512


def shingles(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of all shingles; a text of fewer words is one shingle, one without words has none."""
    start, end, of = c.words()
    h = c.span_hash(start, end) if len(start) else np.zeros(0, np.uint64)
    g, first = grams(h, of, SHINGLE)
    n = np.bincount(of, minlength=c.n)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        at = np.searchsorted(of, short)
        whole = np.array([np.uint64(0)] * len(short), np.uint64)
        for k in range(SHINGLE - 1):
            inside = n[short] > k
            whole[inside] = mix(whole[inside] * np.uint64(0xD6E8FEB86659FD93) + h[at[inside] + k])
        g, t = np.concatenate([g, whole]), np.concatenate([of[first], short])
    else:
        t = of[first]
    by = order_within(t, g)
    return g[by], t[by]


_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bags of this total weight or more can be similar to one that isn't equal.
LEAST = 4


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(h: np.ndarray, weight: np.ndarray, of: np.ndarray, n: int, m: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash signatures (n x m, uint64) of n bags given as (shingle, weight, bag) triples.

    Component j of a bag is a hash of the point that arrives first at j; two
    bags agree at j with probability their weighted Jaccard similarity.
    Bags without shingles have zeros.
    """
    if not len(h):
        return np.zeros((n, m), np.uint64)
    # one process for each shingle and weight interval (0,1], (1,2], (2,4], (4,8], ... that the weight reaches into
    levels = np.where(weight > 1, np.ceil(np.log2(weight)).astype(np.int64) + 1, 1)
    item = np.repeat(np.arange(len(h)), levels)
    level = np.arange(len(item)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0).astype(np.float64)
    length = np.where(level > 1, low, 1.0)
    seed = mix(h[item] + level.astype(np.uint64) * _STEP)
    bag, top = of[item], weight[item].astype(np.float64)
    partial = low + length > top  # some of the interval lies above the weight
    total = np.bincount(of, weight, n)
    rate = m * length
    first_time, first_key = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    # where each process stands: points so far, and the time of the last
    nth, now = np.zeros(len(item), np.uint64), np.zeros(len(item))

    def advance(sel: np.ndarray, until: np.ndarray, k: int) -> np.ndarray:
        """The next points of some processes, up to ``k`` each; returns those that may have more before ``until``."""
        x = mix(seed[sel][:, None] + (nth[sel][:, None] + np.arange(k, dtype=np.uint64)) * _STEP)
        t = -np.log(_uniform(x)) / rate[sel][:, None]
        t[:, 0] += now[sel]
        np.cumsum(t, axis=1, out=t)
        ok = t <= until[:, None]
        done = ok.sum(1)
        some = np.flatnonzero(done)
        now[sel[some]] = t[some, done[some] - 1]
        nth[sel] += done.astype(np.uint64)
        s, t = mix(x[ok] ^ np.uint64(0xE7037ED1A0B428DB)), t[ok]
        who = sel if k == 1 and len(some) == len(sel) else np.repeat(sel, done)
        cell = bag[who] * m + (((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        inside = ~partial[who]
        if not inside.all():
            y = np.flatnonzero(~inside)
            inside[y] = low[who[y]] + length[who[y]] * _uniform(mix(s[y] + np.uint64(1))) <= top[who[y]]
            cell, t, s = cell[inside], t[inside], s[inside]
        np.minimum.at(first_time, cell, t)
        won = first_time[cell] == t
        first_key[cell[won]] = s[won]
        return sel[done == k]

    # by this time (over the bag's weight) all components of a bag have a point with a chance of exp(-exp(-0.5)), and so on
    reach = np.log(m) + 0.5
    todo = np.arange(len(item))
    while len(todo):
        left = todo
        while len(left):
            until = reach / total[bag[left]]
            many = rate[left] * (until - now[left]) > 16
            few = left[~many]
            rest = [advance(few, until[~many], 1)]
            left, until = left[many], until[many]
            rest += [advance(left[i : i + 8192], until[i : i + 8192], 32) for i in range(0, len(left), 8192)]
            left = np.concatenate(rest)
        short = ~np.isfinite(first_time).reshape(n, m).all(1)
        todo = todo[short[bag[todo]]]
        reach += 1
    return first_key.reshape(n, m)


def _bags(c: Chunk) -> tuple[np.ndarray, ...]:
    """(shingle, count, text) of the bags, and their elements (k-th occurrence counts as its own) with text offsets."""
    g, t = shingles(c)
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(g)))
    nth = np.arange(len(g)) - np.repeat(at, count)
    elements = np.where(nth > 0, mix(g + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), g)
    return g[at], count, t[at], elements, np.searchsorted(t, np.arange(c.n + 1))


def _bag_id(elements: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(elements.tobytes(), digest_size=8).digest(), "little", signed=True)


def _base(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, bag, n, bands); of equal bags worked on together one has bands, and none that can only equal others."""
    for b in it:
        for i, j, c in text_chunks(b["text"]):
            h, w, of, elements, at = _bags(c)
            ids = np.array([_bag_id(elements[at[k] : at[k + 1]]) for k in range(c.n)], np.int64)
            n = np.diff(at)
            _, lead = np.unique(ids, return_index=True)
            lead = np.sort(lead[n[lead] >= LEAST])
            place = np.full(c.n, -1)
            place[lead] = np.arange(len(lead))
            use = place[of] >= 0
            sig = signatures(h[use], w[use], place[of[use]], len(lead))
            keys = np.zeros((len(lead), BANDS), np.uint64)
            for r in range(ROWS):
                keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + sig[:, r * BANDS : (r + 1) * BANDS])
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            ends = np.append(0, np.cumsum(np.where(place >= 0, BANDS, 0)))
            bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel()), mask=pa.array(place < 0))
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), pa.array(ids), pa.array(n, pa.int32()), bands], ["doc_id", "bag", "n", "bands"])


def _elements(wanted):
    """(doc_id, bag, body) of the texts whose id the filter lets through."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            b = b.filter(pa.array(wanted.value.may_hold(b["doc_id"])))
            for i, j, c in text_chunks(b["text"]):
                _, _, _, elements, at = _bags(c)
                bodies = [elements[at[k] : at[k + 1]] for k in range(c.n)]
                ids = pa.array([_bag_id(x) for x in bodies], pa.int64())
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), ids, pa.array([x.tobytes() for x in bodies], pa.binary())], ["doc_id", "bag", "body"])

    return run


def _forest(ids: np.ndarray, bodies: list[np.ndarray], side: np.ndarray | None) -> list[tuple[int, int]]:
    """Links that connect whatever bags are similar: one fewer than bags in each class.  ``side``: compare only across."""
    n = np.array([len(x) for x in bodies])
    flat, of = np.concatenate(bodies), np.repeat(np.arange(len(n)), n)
    by = np.argsort(flat)
    f = flat[by]
    new = np.ones(len(f), bool)
    new[1:] = f[1:] != f[:-1]
    size = np.diff(np.append(np.flatnonzero(new), len(f)))
    shared = np.repeat(size > 1, size)  # elements of a single bag cannot overlap
    col = (np.cumsum(np.where(size > 1, 1, 0)) - 1)[np.cumsum(new) - 1][shared]
    row = of[by][shared]
    rows_a = np.arange(len(n)) if side is None else np.flatnonzero(~side)
    rows_b = rows_a if side is None else np.flatnonzero(side)
    place = np.zeros(len(n), np.int64)
    place[rows_a] = np.arange(len(rows_a))
    place[rows_b] = np.arange(len(rows_b))
    kind = np.float32 if n.max(initial=0) < 1 << 24 else np.float64
    overlap = np.zeros((len(rows_a), len(rows_b)), kind)
    width = max(256, (1 << 23) // max(len(n), 1))
    cuts = np.searchsorted(col, np.arange(0, (col[-1] + 1 if len(col) else 0) + width, width))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if hi > lo:
            base = col[lo]
            x = np.zeros((len(n), int(col[hi - 1] - base) + 1), kind)
            x[row[lo:hi], col[lo:hi] - base] = 1
            overlap += x[rows_a] @ x[rows_b].T
    near = 9 * overlap >= 4 * (n[rows_a][:, None] + n[rows_b][None, :])  # overlap / union >= 0.8, in integers
    a, b = np.nonzero(near)
    parent = list(range(len(n)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in zip(rows_a[a].tolist(), rows_b[b].tolist(), strict=True):
        if i != j and (x := find(i)) != (y := find(j)):
            parent[max(x, y)] = min(x, y)
            out.append((int(ids[i]), int(ids[j])))
    return out


def _verify(t: pa.Table) -> pa.Table:
    """One task: the candidate components of one group key, or one pair of blocks of a large one."""
    lo, hi = t["lo"][0].as_py(), t["hi"][0].as_py()
    root, bag, part = (t[c].to_numpy() for c in ("root", "bag", "part"))
    bodies = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["body"].combine_chunks()]
    out: list[tuple[int, int]] = []
    by = np.lexsort((bag, root))
    cuts = np.flatnonzero(np.diff(root[by], prepend=root[by[0]] - 1))
    for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(by)], strict=True):
        own = by[i:j]
        own = own[np.diff(bag[own], prepend=bag[own[0]] - 1) != 0]  # repeated rows
        if len(own) > 1:
            side = None if lo == hi else part[own] == hi
            out += _forest(bag[own], [bodies[k] for k in own.tolist()], side)
    return pa.table([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_shingles), one row for each input row; class_id is the smallest doc_id of the class.

    Classes are the connected components of "weighted Jaccard similarity of
    the five-word shingle bags >= 0.8".  Equal bags are one node, so copies of
    a text add no work beyond being read.  A null or empty text, or one of
    white space, has no shingle and is alone in its class; so is a row with a
    null id (its class_id is null).  Repeated rows share a class.  Ties cannot
    arise.  Extra columns are ignored; an empty table gives no rows.

    A class is never gathered in one task: candidate components over BLOCK
    bags are cut into blocks and compared block against block, and every
    comparison returns at most a spanning forest of its links.
    """
    return _classes(docs, id_col, text_col).select("doc_id", "class_id", "n_shingles")


def _classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``near_duplicates`` with each row's bag, and the root that tells classes apart even if they share ids."""
    d = documents(docs, id_col, text_col)
    base = durable(d.mapInArrow(_base, "doc_id long, bag long, n int, bands array<long>"))
    nodes = base.filter("n > 0 and doc_id is not null")
    classes = nodes.groupBy("bag").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    one = nodes.filter("bands is not null").dropDuplicates(["bag"])  # equal bags have equal bands
    keys = one.select("bag", F.explode("bands").alias("key"))
    meets = keys.groupBy("key").agg(F.min("bag").alias("hub"), F.max("bag").alias("top")).filter("hub <> top").select("key", "hub")
    stars = keys.join(meets, "key").filter("bag <> hub").select(F.col("bag").alias("a"), F.col("hub").alias("b"))
    comp = durable(components(stars))
    sizes = comp.groupBy("root").agg(F.count("*").alias("size"))
    cand = comp.join(sizes, "root").select(F.col("id").alias("bag"), "root", "size")
    cand = durable(cand.join(classes, "bag").select("bag", "root", "size", F.col("first").alias("doc_id")))
    n = cand.count()
    wanted = docs.sparkSession.sparkContext.broadcast(_idfilter.build(cand.select("doc_id"), n))
    members = d.mapInArrow(_elements(wanted), "doc_id long, bag long, body binary").join(cand, ["doc_id", "bag"])
    small = F.col("size") <= BLOCK
    blocks = F.when(small, 1).otherwise(F.ceil(F.col("size") / BLOCK))
    members = members.withColumn("part", F.pmod(F.xxhash64("bag"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    members = members.withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other"))
    group = F.when(small, F.pmod(F.xxhash64("root"), F.lit(max(1, n // 1024 + 1)))).otherwise(F.col("root"))
    links = members.withColumn("g", group).withColumn("small", small).groupBy("g", "small", "lo", "hi").applyInArrow(_verify, "a long, b long")
    roots = components(links)
    whole = roots.join(classes, roots["id"] == classes["bag"]).groupBy("root").agg(F.min("first").alias("class_id"))
    linked = roots.join(whole, "root").select(F.col("id").alias("bag"), "class_id", "root")
    of_bag = classes.filter("copies > 1").select("bag", "first").join(linked, "bag", "full_outer").select("bag", F.coalesce("class_id", "first").alias("class_id"), "root")
    keyed = base.select("doc_id", F.when(F.col("n") > 0, F.col("bag")).alias("bag"), "n")
    # texts without words have no bag, and all of them would meet in one task
    out = keyed.filter("bag is not null").join(of_bag, "bag", "left").unionByName(keyed.filter("bag is null"), allowMissingColumns=True)
    alone = F.col("doc_id").isNull() | F.col("class_id").isNull()
    class_id = F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    return out.select("doc_id", class_id, F.col("n").alias("n_shingles"), "bag", F.coalesce("root", "bag").alias("root"))


def _with_bag(text: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, c in text_chunks(b[text]):
                _, _, _, elements, at = _bags(c)
                bag = [_bag_id(elements[at[k] : at[k + 1]]) if at[k + 1] > at[k] else None for k in range(c.n)]
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, pa.array(bag, pa.int64())], [*b.schema.names, "bag"])

    return run


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, of each class the document with the smallest id; of repeated rows one.

    Where ids occur more than once, a row is told by its id and bag, so of
    different texts under one id each stays or goes with its own class.  Rows
    with a null id stay, and null or empty texts, one for each id.  Extra
    columns may have any names, also ones that clash; an empty table gives no rows.
    """
    plain, (key, text) = by_position(docs, id_col, text_col)
    of_id = F.col(key).cast("long")
    found = _classes(docs, id_col, text_col)
    if found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").limit(1).count():
        heads = found.filter("doc_id is not null and bag is not null").groupBy("root").agg(F.min(F.struct("doc_id", "bag")).alias("x")).select(F.col("x.doc_id").alias("id"), "x.bag")
        marked = plain.filter(of_id.isNotNull()).mapInArrow(_with_bag(text), T.StructType([*plain.schema.fields, T.StructField("bag", T.LongType())])).withColumn("id", of_id)
        out = marked.join(heads, ["id", "bag"], "left_semi").unionByName(marked.filter("bag is null"))
        out = out.dropDuplicates(["id", "bag"]).select(*plain.columns)
    else:
        heads = found.filter("class_id = doc_id").select(F.col("doc_id").alias("id"))
        out = plain.join(heads, of_id == F.col("id"), "left_semi")
    return out.unionByName(plain.filter(of_id.isNull())).toDF(*docs.columns)


def op8(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
