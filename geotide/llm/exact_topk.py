"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Vectors are integers (``floor(scale * x)``).  In a block of candidates a
dimension's term is how far a value lies above the block's smallest, so all
impacts are non-negative.  A term's values are written in digits to the base
of 8; a posting segment holds the rows that have a certain digit at a certain
place, and its quantised impact is what that digit stands for.  The segments
of a block are built for each batch that meets it.

Queries come in batches.  A batch reads segments by descending weight (the
largest of its queries') times impact.  The postings of a run of segments are
scattered once into the impacts they bring, and each query adds its weights
times those to its rows' scores.  What a query hasn't read can add or take
away at most the largest unread impacts of each term and place, so at any
time each row has a lower and an upper bound.  A
query stops only when the bounds prove that few rows may still belong to its
top k, and those are rescored exactly.  Nothing is dropped without that proof;
a query that never gets there has read every segment.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geotide.llm._frames import project

#: Rows of a candidate block and of a query block, and components of either: bound a task's arrays, whatever the table's size.
BLOCK_ROWS, QUERY_ROWS, BLOCK_VALUES = 8192, 2048, 1 << 20
DIGIT_BITS = 3
#: Queries that read segments together.
BATCH = 256
#: A query stops once no more than this share of a block's rows may belong to its top k: rescoring them costs less than reading on.
FEW = 1 / 16
_PACKED = "dim int, b long, ids binary, body binary, copies binary, q binary"
_HITS = "q long, query_id long, vec_id long, score long"


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, v array<long>, copies) of the vectors that take part: not null, all components finite; equal rows once."""
    d = project(df, {"vec_id": id_col, "v": vec_col}).withColumn("vec_id", F.col("vec_id").cast("long"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    d = d.filter(F.col("v").isNotNull() & ~bad & F.col("vec_id").isNotNull()).withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * scale)))
    return d.groupBy("vec_id", "v").agg(F.count("*").alias("copies"))


class Index:
    """The posting segments of one block of candidates: of each the term, its impact and its rows."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, m: np.ndarray):
        self.ids, self.copies, self.m = ids, copies, m
        self.n, self.dim = m.shape
        self.low = m.min(0)
        terms = np.ascontiguousarray((m - self.low).T)
        self.top = terms.max(1, initial=0)
        found, self.rows = [], []
        for place in range(0, int(self.top.max(initial=0)).bit_length(), DIGIT_BITS):
            digits = ((terms >> place) & ((1 << DIGIT_BITS) - 1)).astype(np.uint8)
            for digit in range(1, 1 << DIGIT_BITS):
                term, row = np.nonzero(digits == digit)
                at = np.flatnonzero(np.diff(term, prepend=-1))
                self.rows += np.split(row, at[1:]) if len(at) else []
                found += [(t, place, digit << place) for t in term[at].tolist()]
        cols = np.array(found, np.int64).reshape(-1, 3)
        self.term, place, self.impact = cols.T
        # how much less the unread rest of a term and place can weigh once a segment is read: down to the next smaller digit
        by = np.lexsort((self.impact, place, self.term))
        same = np.zeros(len(by), bool)
        same[1:] = (self.term[by[1:]] == self.term[by[:-1]]) & (place[by[1:]] == place[by[:-1]])
        self.step = self.impact.copy()
        self.step[by[1:]] -= np.where(same[1:], self.impact[by[:-1]], 0)

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (ids, scores) of its k best here, its own row left out; ties to the smaller id, a repeated row as often as it occurs."""
        own = [self._own(i, v) for i, v in zip(query_ids.tolist(), q, strict=True)]
        out: list = [None] * len(q)
        every = np.arange(self.n)

        def finish(i: int, rows: np.ndarray) -> None:
            out[i] = self._best(q[i], rows, own[i], k)

        if self.n <= k + 1:
            for i in range(len(q)):
                finish(i, every)
            return out
        weight = np.abs(q).max(0)
        use = np.flatnonzero(weight[self.term])
        use = use[np.argsort(-(weight[self.term[use]] * self.impact[use]), kind="stable")]
        unread = np.cumsum((weight[self.term[use]].astype(np.float64) * self.step[use])[::-1])[::-1]  # what all from here on weigh
        kind = np.float32 if float((np.abs(q) @ self.top.astype(np.float64)).max(initial=0)) < 2**24 else np.float64
        active, done = np.arange(len(q)), 0
        score, lead, part = np.zeros((len(q), self.n), kind), None, 1
        while len(active) and done < len(use):
            # read on until the rest weighs 2**-part of the whole, then look whom that proves
            part += 1
            end = max(done + 1, int(np.searchsorted(-unread, -unread[0] * 0.5**part)))
            # the impacts that these segments' postings bring, once for all queries, then each query's weights
            brought = np.zeros((self.dim, self.n), kind)
            for t, x, s in zip(self.term[use[done:end]].tolist(), self.impact[use[done:end]].tolist(), use[done:end].tolist(), strict=True):
                brought[t, self.rows[s]] += x
            some = np.flatnonzero(np.bincount(self.term[use[done:end]], minlength=self.dim))
            score += q[active][:, some].astype(kind) @ brought[some]
            done = end
            rest = np.bincount(self.term[use[done:]], self.step[use[done:]], self.dim)
            adds, takes = np.maximum(q[active], 0) @ rest, np.maximum(-q[active], 0) @ rest
            last = done == len(use)
            if not last and ((adds + takes) > 2 * (score.max(1) - score.mean(1))).all():
                continue  # far from any proof
            for j, i in enumerate(active.tolist()):
                if own[i][1]:
                    score[j, own[i][0]] = -np.inf
            if lead is None or last:  # rows that lead so far: the smallest of k bounds the k-th of all from below
                lead = np.argpartition(score, self.n - k, axis=1)[:, self.n - k :]
            kth = np.take_along_axis(score, lead, 1).min(1).astype(np.float64)
            slack = 0.0 if kind is np.float32 else 1e-9 * (np.abs(q[active]) @ self.top.astype(np.float64))
            may = score >= (kth - takes - adds - slack)[:, None]
            few = (may.sum(1) <= max(4 * k, FEW * self.n)) | last
            for j in np.flatnonzero(few).tolist():
                finish(int(active[j]), np.flatnonzero(may[j]))
            if few.any():
                active, score, lead = active[~few], score[~few], lead[~few]
        for i in active.tolist():  # queries of no weight at all
            finish(i, every)
        return out

    def _own(self, query_id: int, q: np.ndarray) -> tuple[np.ndarray, bool]:
        """The row that is the query's own (equal rows are one, with their number), and whether it is the only copy."""
        at = np.flatnonzero(self.ids == query_id)
        at = at[(self.m[at] == q).all(1)]
        return at, bool(len(at)) and bool(self.copies[at[0]] == 1)

    def _best(self, q: np.ndarray, rows: np.ndarray, own: tuple[np.ndarray, bool], k: int) -> tuple[np.ndarray, np.ndarray]:
        exact = self.m[rows] @ q
        copies = np.minimum(self.copies[rows] - np.isin(rows, own[0]), k)
        if len(rows) > 4 * k:  # only what reaches the k-th score, each row counted once
            some = copies > 0
            if some.sum() > k:
                kth = np.partition(exact[some], some.sum() - k)[some.sum() - k]
                near = some & (exact >= kth)
                rows, exact, copies = rows[near], exact[near], copies[near]
        rows, exact = np.repeat(rows, copies), np.repeat(exact, copies)
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows[best]], exact[best]


def _ints(body: bytes, dim: int) -> np.ndarray:
    """Components as ``_pack`` wrote them: the first byte is their width."""
    return np.frombuffer(body, f"<i{body[0]}", offset=1).astype(np.int64).reshape(-1, dim)


def _pair(k: int):
    def run(t: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 4]
        for r in t.to_pylist():
            m, q = _ints(r["body"], r["dim"]), _ints(r["q_body"], r["dim"])
            index = Index(np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["copies"], "<i8"), m)
            ids, tags = np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["q_tag"], "<i8")
            for lo in range(0, len(ids), BATCH):
                found = index.search(ids[lo : lo + BATCH], q[lo : lo + BATCH], k)
                for query_id, tag, (hit, score) in zip(ids[lo : lo + BATCH].tolist(), tags[lo : lo + BATCH].tolist(), found, strict=True):
                    out.append((np.full(len(hit), tag), np.full(len(hit), query_id), hit, score))
        return pa.table([pa.array(np.concatenate([x[c] for x in out]), pa.int64()) for c in range(4)], ["q", "query_id", "vec_id", "score"])

    return run


def _pack(t: pa.Table) -> pa.Table:
    """One row for each vector length: ids, copies, tags and components as packed integers, these as narrow as they fit."""
    t = t.combine_chunks()
    dims = t["dim"].to_numpy(zero_copy_only=False)
    rows = []
    for dim in np.unique(dims).tolist():
        sub = t.filter(pa.array(dims == dim))
        ids, copies, q = (sub[c].to_numpy(zero_copy_only=False).astype("<i8").tobytes() for c in ("vec_id", "copies", "q"))
        flat = sub["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        most = max(abs(int(flat.max(initial=0))), abs(int(flat.min(initial=0))))
        width = next(w for w in (1, 2, 4, 8) if w == 8 or most < 1 << (8 * w - 1))
        rows.append((dim, t["b"][0].as_py(), ids, bytes([width]) + flat.astype(f"<i{width}").tobytes(), copies, q))
    cols = list(zip(*rows, strict=True))
    return pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[2:])], [x.split()[0] for x in _PACKED.split(", ")])


def _blocks(df: DataFrame, n: int) -> DataFrame:
    """Vectors dealt into ``n`` blocks."""
    dealt = df.withColumn("dim", F.size("v")).filter("dim > 0").withColumn("q", F.xxhash64("v"))
    return dealt.withColumn("b", F.pmod(F.xxhash64("vec_id", "q"), F.lit(n)).cast("long")).groupBy("b").applyInArrow(_pack, _PACKED)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k highest integer inner products, ties to the smaller vec_id.

    Vectors (and queries) that are null, empty or hold a null or non-finite
    component, or have a null id, take no part.  A query's own row, one of those with
    its id and vector, isn't compared with it, nor are vectors of another
    length.  Repeated candidate rows each take a place; a repeated query row
    gets its result again.  Fewer than k candidates are all returned; extra
    columns are ignored; empty tables give no rows.

    Every candidate block meets every query block, as equi-joined rows of
    packed vectors; a task holds one pair.  Blocks are as large as a task's
    memory bears, since what is shuffled falls with their size.  Their lists
    are merged with a per-query rank limit that Spark applies before the
    shuffle as well.
    """
    shape = project(vectors, {"v": vec_col}).agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    widest = max(1, shape["dim"] or 1)
    rows = lambda most: max(64, min(most, BLOCK_VALUES // widest))
    n_blocks, n_queries = max(1, -(-shape["n"] // rows(BLOCK_ROWS))), max(1, -(-queries.count() // rows(QUERY_ROWS)))
    blocks = _blocks(quantised(vectors, id_col, vec_col, scale), n_blocks).drop("q")
    asked = quantised(queries, id_col, vec_col, scale)
    q_blocks = _blocks(asked, n_queries).select(F.col("dim").alias("q_dim"), F.col("b").alias("qb"), F.col("ids").alias("q_ids"), F.col("body").alias("q_body"), F.col("q").alias("q_tag"))
    each = blocks.withColumn("ask", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_queries - 1).cast("long"))))
    pairs = each.join(q_blocks, (F.col("ask") == F.col("qb")) & (F.col("dim") == F.col("q_dim"))).drop("ask", "q_dim")
    hits = pairs.groupBy("b", "qb", "dim").applyInArrow(_pair(k), _HITS)
    best = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    again = asked.filter("copies > 1").select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("q"), "copies")
    ranked = ranked.join(again, ["query_id", "q"], "left").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1)))))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


#: The same in SQL, for all rows.
ORACLE = """
WITH v AS (SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row_no, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.row_no <> c.row_no AND len(q.e) = len(c.e))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""
