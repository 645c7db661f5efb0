"""Toxicity by class-conditional Kneser-Ney models.

Two character models of words, one of toxic and one of ordinary text, with
n-grams of ORDER bytes within a word.  The highest order has counts of its own
in each class; all lower orders are Kneser-Ney continuation counts that the
classes share.  What a class hasn't seen is therefore judged alike by both and
says nothing, while an inflected or composed form of a toxic expression is
known by its stem.  The shared part cancels in the ratio of the two models, so
scoring needs one number for each known n-gram and one for each known context.

A text's evidence is the length-normalised difference of its log-likelihoods,
over the whole text, its most toxic window and its most toxic words (a long text with
one toxic passage is toxic).  A logistic function of these, fitted on a fold
of the training rows that the counts hadn't seen, gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotide.llm._frames import documents, project
from geotide.llm._text import Chunk, text_chunks

ORDER, DISCOUNT, WINDOW_WORDS = 5, 0.75, 8
#: Taken off each count of a class, and what the shared model weighs in a context besides.
CLASS_DISCOUNT, CLASS_BACKOFF = 2.0, 10.0
#: Share of a text's words, the most toxic ones, that are looked at alone.
TOP_WORDS = 0.02
#: Labelled training rows that the models are fitted on, at most (by hash order of their ids); the calibration uses as many of its fold.
TRAINING_ROWS, CALIBRATION_ROWS = 200_000, 20_000
THRESHOLD = 0.7

_WORD = np.zeros(256, bool)
_WORD[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_START, _END = 1, 2  # marks before and after a word


def _grams(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram as an integer of ORDER bytes, word) for every letter and the end of each word."""
    n = end - start + 1
    word = np.repeat(np.arange(len(start)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
    last, first = np.repeat(end, n), np.repeat(start, n)
    padded = np.append(_LOWER[buf], np.uint8(0))
    gram = np.zeros(len(at), np.int64)
    for k in range(ORDER - 1, -1, -1):
        p = at - k
        ch = np.where(p < first, _START, np.where(p == last, _END, padded[np.clip(p, 0, len(buf))])).astype(np.int64)
        gram = gram << 8 | ch
    return gram, word


def _vocabulary(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the distinct words of each text: a word counts once a text, so that none dominates by repetition."""
    start, end, of = c.words(_WORD)
    if not len(start):
        return start, end, of
    _, first = np.unique(c.span_hash(start, end) + of.astype(np.uint64) * np.uint64(0xA24BAED4963EE407), return_index=True)
    return start[first], end[first], of[first]


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by fold and label: (gram, fold, toxic, ordinary)."""
    for b in it:
        label, fold = (b[c].to_numpy(zero_copy_only=False) for c in ("toxic", "fold"))
        parts: dict[tuple[int, int], list[np.ndarray]] = {}
        for i, _, c in text_chunks(b["text"]):
            start, end, of = _vocabulary(c)
            gram, word = _grams(c.buf, start, end)
            row = i + of[word] if len(word) else word
            for f in (0, 2):
                for y in (0, 1):
                    parts.setdefault((f, y), []).append(np.stack(np.unique(gram[(label[row] == y) & (fold[row] == f)], return_counts=True)))
        for (f, y), found in parts.items():
            both = np.concatenate(found, axis=1)
            gram, at = np.unique(both[0], return_inverse=True)
            n = np.bincount(at, both[1], len(gram)).astype(np.int64)
            zero = np.zeros(len(gram), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(np.full(len(gram), f, np.int32)), pa.array(n if y else zero), pa.array(zero if y else n)], ["gram", "fold", "tox", "ord"])


def _kneser_ney(gram: np.ndarray, tox: np.ndarray, ordinary: np.ndarray) -> dict[str, np.ndarray]:
    """Log-likelihood ratios: of each known n-gram (keys, llr) and of what follows a known context unseen (contexts, back)."""
    by = np.argsort(gram)
    gram, counts = gram[by], [ordinary[by].astype(np.float64), tox[by].astype(np.float64)]
    # shared lower orders, from the shortest up: continuation counts are numbers of distinct one-byte-longer n-grams
    p = np.full(len(gram), 1 / 256.0)
    for k in range(1, ORDER):
        part = gram & ((1 << 8 * k) - 1)
        longer = np.unique(gram & ((1 << 8 * (k + 1)) - 1))
        keys, n = np.unique(longer & ((1 << 8 * k) - 1), return_counts=True)
        ctx, at, kinds = np.unique(keys >> 8, return_inverse=True, return_counts=True)
        total = np.bincount(at, n)
        i = np.searchsorted(keys, part)
        p = np.maximum(n[i] - DISCOUNT, 0) / total[at[i]] + DISCOUNT * kinds[at[i]] / total[at[i]] * p
    ctx, at = np.unique(gram >> 8, return_inverse=True)
    pooled = counts[0] + counts[1]
    total, kinds = np.bincount(at, pooled), np.bincount(at)
    p = np.maximum(pooled - DISCOUNT, 0) / total[at] + DISCOUNT * kinds[at] / total[at] * p  # all text, highest order
    logs, backs = [], []
    for c in counts:  # the classes' own discounted counts, backed off to all text
        taken = np.minimum(c, CLASS_DISCOUNT)
        total = np.bincount(at, c)
        back = (np.bincount(at, taken) + CLASS_BACKOFF) / (total + CLASS_BACKOFF)
        logs.append(np.log((c - taken) / (total[at] + CLASS_BACKOFF) + back[at] * p))
        backs.append(np.log(back))
    return {"keys": gram, "llr": logs[1] - logs[0], "contexts": ctx, "back": backs[1] - backs[0]}


def _word_ratios(model: dict[str, np.ndarray], buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    gram, word = _grams(buf, start, end)

    def find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
        return at, keys[at] == x

    at, known = find(model["keys"], gram)
    out = np.zeros(len(gram))
    out[known] = model["llr"][at[known]]
    ctx, seen = find(model["contexts"], gram[~known] >> 8)
    rest = np.zeros(len(ctx))
    rest[seen] = model["back"][ctx[seen]]
    out[~known] = rest
    return np.bincount(word, out, len(start))


def _evidence(model: dict[str, np.ndarray], texts: pa.Array) -> np.ndarray:
    """(texts x 4): length-normalised log-likelihood differences of the whole text, of its most toxic window and of its most toxic words, and its log length; 0 without words."""
    out = np.zeros((len(texts), 4))
    for i, _, c in text_chunks(texts):
        start, end, of = c.words(_WORD)
        if not len(start):
            continue
        _, first, at = np.unique(c.span_hash(start, end), return_index=True, return_inverse=True)
        ratio = _word_ratios(model, c.buf, start[first], end[first])[at]
        n = np.bincount(of, minlength=c.n)
        total = np.zeros(len(ratio) + 1)
        np.cumsum(ratio, out=total[1:])
        edge = np.concatenate([[0], np.cumsum(n)])
        has = np.flatnonzero(n)
        out[i + has, 0] = (total[edge[has + 1]] - total[edge[has]]) / n[has]
        lo = np.arange(len(ratio))
        hi = np.minimum(lo + WINDOW_WORDS, edge[1:][of])
        lo = np.maximum(edge[:-1][of], hi - WINDOW_WORDS)
        window = (total[hi] - total[lo]) / WINDOW_WORDS
        out[i + has, 1] = np.maximum.reduceat(window, edge[has])
        by = np.lexsort((-ratio, of))
        top = np.ceil(TOP_WORDS * n).astype(np.int64)
        total[1:] = np.cumsum(ratio[by])
        out[i + has, 2] = (total[edge[has] + top[has]] - total[edge[has]]) / top[has]
        out[i + has, 3] = np.log(n[has])
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (bias first) by Newton steps, classes weighted alike."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[0] = -3.0
        return w
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + penalty @ w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Labels:
    """A bounded table of training labels: sorted ids, their label, fold and whether they calibrate."""

    def __init__(self, known: DataFrame):
        """``known``: (doc_id, toxic, fold 0 or 2); of more than TRAINING_ROWS rows those first in hash order are taken."""
        rows = known.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(TRAINING_ROWS).toArrow()
        ids, toxic, fold = (rows[c].to_numpy() for c in ("doc_id", "toxic", "fold"))
        calibrate = np.zeros(len(ids), bool)
        calibrate[np.flatnonzero(fold == 2)[:CALIBRATION_ROWS]] = True
        by = np.argsort(ids)
        self.ids, self.toxic, self.fold, self.calibrate = ids[by], toxic[by], fold[by], calibrate[by]

    def pick(self, b: pa.RecordBatch, calibrating: bool) -> pa.RecordBatch:
        """The batch's labelled rows as (text, toxic, fold)."""
        known = np.asarray(b["doc_id"].is_valid())
        x = b["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(self.ids, x), max(len(self.ids) - 1, 0))
        hit = known & (self.ids[at] == x) if len(self.ids) else np.zeros(len(x), bool)
        if calibrating:
            hit[hit] &= self.calibrate[at[hit]]
        own = at[hit]
        return pa.RecordBatch.from_arrays([b["text"].filter(pa.array(hit)), pa.array(self.toxic[own]), pa.array(self.fold[own])], ["text", "toxic", "fold"])


def fit(docs: DataFrame, known: DataFrame) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Model and calibration from documents (doc_id, text) and labels (doc_id, toxic, fold 0 or 2).

    Only the bounded label table travels to the texts, not texts to labels.
    N-gram counts are summed on the cluster; the summed table of at most
    TRAINING_ROWS labelled texts comes to the driver.
    """
    sc = docs.sparkSession.sparkContext
    labels = sc.broadcast(Labels(known))
    table = docs.mapInArrow(lambda it: _count(labels.value.pick(b, False) for b in it), "gram long, fold int, tox long, ord long").groupBy("gram").agg(
        *[F.sum(F.when(F.col("fold") == f, F.col(c))).alias(f"{c}{f}") for f in (0, 2) for c in ("tox", "ord")]
    )
    got = table.fillna(0).toArrow()
    col = {c: got[c].to_numpy().astype(np.int64) for c in ("gram", "tox0", "ord0", "tox2", "ord2")}
    seen = (col["tox0"] + col["ord0"]) > 0
    half = _kneser_ney(col["gram"][seen], col["tox0"][seen], col["ord0"][seen])
    model = _kneser_ney(col["gram"], col["tox0"] + col["tox2"], col["ord0"] + col["ord2"])
    shared = sc.broadcast(half)

    def measured(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (labels.value.pick(b, True) for b in it):
            x = _evidence(shared.value, b["text"])
            yield pa.RecordBatch.from_arrays([b["toxic"], *[pa.array(v) for v in x.T.copy()]], ["toxic", "x0", "x1", "x2", "x3"])

    rows = docs.mapInArrow(measured, "toxic int, x0 double, x1 double, x2 double, x3 double").toArrow()
    x = np.column_stack([rows[f"x{k}"].to_numpy() for k in range(4)])
    return model, _logistic(x, rows["toxic"].to_numpy().astype(float))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, worst_window), one row for each input row.

    Learns from rows of ``labels`` (doc_id, toxic) whose crc32(doc_id) mod 3
    isn't 1; only texts enter a score.  A null or empty text has no evidence
    and gets the score of none; labels that are null, or of unknown ids, are
    ignored, of several labels of an id the larger counts; repeated rows get
    the same score; a null id is not held out.  Without labels of both kinds
    every score is low.  Long texts count whole; extra columns, with any
    names, are ignored; an empty table gives no rows.
    """
    d = documents(docs, id_col, text_col)
    rest = F.crc32(F.col("doc_id").cast("string")) % 3
    known = project(labels, {"doc_id": "doc_id", "toxic": "toxic"}).filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    model, weights = fit(d, known.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("fold", rest.cast("int")).filter("fold <> 1"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            x = _evidence(shared.value, b["text"])
            p = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
            cols = [b["doc_id"], b["held_out"], pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(x[:, 0].copy()), pa.array(x[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "score", "predicted", "evidence", "worst_window"])

    marked = d.withColumn("held_out", F.coalesce(rest == 1, F.lit(False)))
    return marked.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, evidence double, worst_window double")


def op7(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
