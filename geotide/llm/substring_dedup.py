"""Repeated byte windows across documents by a depth-limited radix sort of suffixes.

A byte goes if a window of ``WINDOW`` bytes over it also starts in a document
with a smaller id.  Windows are suffixes ordered only through WINDOW bytes, so
equal groups of such an order are exactly the repeated windows.  The order is
made in most-significant-digit passes, and a group that has come apart, or is
settled, is not looked at again:

1. First digit.  Each window is led by its anchor, the smallest hash among its
   GRAM-byte substrings, the same in every copy of the window.  About 7 % of the
   positions are anchors, and neighbouring windows share one.  A group of one
   anchor hash found in one block is done outside that block.
2. Second digit, for groups of several blocks: the context, all bytes that the
   windows of one anchor occurrence reach.  Contexts are ordered by a hash and
   compared byte by byte with the first of their group; one that an earlier
   block has too is settled with all its windows.
3. Last digit, for contexts that differ: their single windows, ordered by a
   hash and compared byte by byte as well.  Where a hash has deceived, all
   bytes are the digits.

The contexts of an anchor go to one task, but for anchors with more than
``HOT_CONTEXTS`` of them (a phrase with other text around it each time): their
windows are dealt singly, by a hash of their own, and each block sends a window
once.

Hashes only say what to compare; what counts as equal is equal byte by byte.

Documents are dealt into blocks by ranges of the id, so an earlier block means
a smaller id.  What leaves a block is packed: of every digit value one entry,
however many copies the block holds; what comes back is a status a value.  No
group of copies meets in a task: a digit found in all blocks has one entry a
block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotide.llm._frames import documents
from geotide.llm._text import Chunk, buffers, chunks, mix

WINDOW = 50
GRAM = 24
REACH = WINDOW - GRAM + 1
#: Text bytes of a block, and the fewest blocks.
BLOCK_BYTES, LEAST_BLOCKS = 6 << 20, 48
#: Contexts of an anchor beyond which its windows are dealt singly.
HOT_CONTEXTS = 2000
#: Shuffled bytes of first digits that a bucket takes beyond 2**14 buckets, and text bytes of a block for each bucket, so that what a block sends to a bucket is worth a row.
BUCKET_BYTES, BYTES_FOR_A_BUCKET = 256 << 20, 384

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)]

_PACKED = "block int, bucket int, body binary"
_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _anchors(c: Chunk) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, first window, last window) of each anchor occurrence."""
    n = len(c.buf)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    eight = np.ndarray((n - 7,), "<u8", np.ascontiguousarray(c.buf), strides=(1,)).copy()
    g = n - GRAM + 1
    h = eight[:g] * _ODD[0]
    for k in range(8, GRAM, 8):
        h += eight[k : k + g] * _ODD[k // 8]
    h ^= h >> np.uint64(32)
    h *= _ODD[3]
    low = h & np.uint64(0xFFFFFFFF00000000)
    low |= np.arange(g, dtype=np.uint64)  # ties: leftmost
    span = 1
    while span * 2 <= REACH:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < REACH:
        low = np.minimum(low[: len(low) - (REACH - span)], low[REACH - span :])
    lead = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ok = np.ones(len(lead) + 1, bool)
    ok[-1] = False
    for e in c.offs[1:].tolist():  # a window must end within its text
        ok[max(0, e - WINDOW + 1) : e] = False
    cut = np.flatnonzero(lead[1:] != lead[:-1]) + 1
    first = ok[:-1].copy()
    first[1:] = ok[1:-1] & ~ok[:-2]
    first[cut] |= ok[cut]
    last = ok[:-1] & ~ok[1:]
    last[cut - 1] |= ok[cut - 1]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    m = lead[a]
    # the context a..b+WINDOW: WINDOW-2 bytes from the front and what REACH - 1 more can add from the back
    ctx = mix((m - a).astype(np.uint64) * np.uint64(256) + (b - a).astype(np.uint64))
    for at in (*(a + k for k in range(0, WINDOW - 8, 8)), *(b + WINDOW - k for k in range(8, REACH + 15, 8))):
        ctx = mix(ctx * _ODD[0] + eight[at])
    return mix(h[m]), ctx, a, b  # smallest hashes crowd at the low end; buckets are ranges of even ones


def _ordered(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Two radix passes: order by the first digit, then by the second (then position) only where the first repeats."""
    by = np.argsort(first)
    f = first[by]
    same = np.zeros(len(by) + 1, bool)
    same[1:-1] = f[1:] == f[:-1]
    tied = np.flatnonzero(same[1:] | same[:-1])
    sub = by[tied]
    by[tied] = sub[np.lexsort((sub, second[sub], first[sub]))]
    return by


class _Block:
    """The anchors of a block's texts, and which entry of the digit passes each belongs to."""

    def __init__(self, table: pa.Table, bits: int):
        table = table.sort_by("doc_id").combine_chunks()
        ids = table["doc_id"].to_numpy(zero_copy_only=False)
        self.ids = np.asarray(pd.Series(ids).fillna(-(2**63)).astype("int64")) if table["doc_id"].null_count else ids.astype(np.int64)
        self.null = np.asarray(table["doc_id"].is_null().combine_chunks()) if table["doc_id"].null_count else np.zeros(len(ids), bool)
        self.raw_ids, self.bits = table["doc_id"], bits
        self.buf, self.offs = buffers(table["text"])
        self.parts = []
        found = []
        for i, j in chunks(self.offs):
            base = self.offs[i]
            c = Chunk(self.buf[base : self.offs[j]], self.offs[i : j + 1] - base)
            h, ctx, a, b = _anchors(c)
            found.append((h, ctx, a + base, b + base, c.text_of(a) + i))
        h, ctx, a, b, of = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
        if self.null.any():
            keep = ~self.null[of]
            h, ctx, a, b, of = h[keep], ctx[keep], a[keep], b[keep], of[keep]
        by = _ordered(h, ctx)
        self.h, self.ctx, self.a, self.b, self.of = h[by], ctx[by], a[by], b[by], of[by]
        n = len(by)
        new_h = np.ones(n, bool)
        new_h[1:] = self.h[1:] != self.h[:-1]
        new_c = new_h.copy()
        new_c[1:] |= self.ctx[1:] != self.ctx[:-1]
        while True:  # equal contexts are compared by their bytes; one that differs is a context of its own
            rep = np.maximum.accumulate(np.where(new_c, np.arange(n), 0)) if n else np.zeros(0, np.int64)
            other = np.flatnonzero(~new_c)
            other = other[~self._same_context(other, rep[other])]
            if not len(other):
                break
            new_c[other] = True
        self.group = np.cumsum(new_h) - 1
        self.new_c, self.rep = new_c, rep
        doc = self.ids[self.of]
        self.covered = doc > doc[rep] if n else np.zeros(0, bool)  # equal context in a smaller document of this block
        at = np.flatnonzero(new_h)
        self.n_contexts = np.bincount(self.group[new_c], minlength=len(at))
        self.many = self.n_contexts > 1
        self.values = self.h[at]

    def _eight(self) -> np.ndarray:
        """The eight bytes from each position on, as integers."""
        return np.ndarray((max(len(self.buf) - 7, 0),), "<u8", np.ascontiguousarray(self.buf), strides=(1,))

    def _same_context(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        eight, a, b = self._eight(), self.a, self.b
        same = b[x] - a[x] == b[y] - a[y]
        for at in range(0, WINDOW + REACH - 8, 8):  # a short context is read to its end again and again
            off = np.minimum(at, b[x] - a[x] + WINDOW - 8)
            same &= eight[a[x] + off] == eight[np.minimum(a[y] + off, len(eight) - 1)]
        last = b[x] - a[x] + WINDOW - 8
        return same & (eight[a[x] + last] == eight[np.minimum(a[y] + last, len(eight) - 1)])

    def contexts(self, status: np.ndarray) -> np.ndarray:
        """The anchors whose contexts go to the next digits: one of each context of the groups that other blocks have too, but for hot ones."""
        return np.flatnonzero((status[self.group] == 1) & self.new_c) if len(self.group) else np.zeros(0, np.int64)

    def hot_windows(self, status: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The windows of hot groups: of each distinct one its start and its hash, by hash; and for each window of their contexts the anchor, its place in the context, and which distinct one it is."""
        pick = np.flatnonzero((status[self.group] == 2) & self.new_c) if len(self.group) else np.zeros(0, np.int64)
        n = self.b[pick] - self.a[pick] + 1
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(self.a[pick], n) + nth
        eight = self._eight()
        first = _equal_windows(eight, start, start)
        lead = np.unique(first)
        h = np.zeros(len(lead), np.uint64)
        for k in (*range(0, WINDOW - 8, 8), WINDOW - 8):
            h = mix(h * _ODD[1] + eight[start[lead] + k])
        by = np.lexsort((lead, h))
        rank = np.empty(len(lead), np.int64)
        rank[by] = np.arange(len(by))
        return start[lead[by]], h[by], np.repeat(pick, n), nth, rank[np.searchsorted(lead, first)]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """The single windows of the groups whose contexts differ here: where they start, and which are in a smaller document of this block."""
        pick = np.flatnonzero(self.many[self.group] & ~self.covered) if len(self.group) else np.zeros(0, np.int64)
        n = self.b[pick] - self.a[pick] + 1
        start = np.sort(np.repeat(self.a[pick], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        group = _equal_windows(self._eight(), start, start)
        doc = self.ids[np.searchsorted(self.offs, start, "right") - 1]
        return start, doc > doc[group]


def _equal_windows(eight: np.ndarray, start: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each window the index of the first one (by ``order``) of the same bytes."""
    if not len(start):
        return np.zeros(0, np.int64)
    at = [*range(0, WINDOW - 8, 8), WINDOW - 8]
    h = np.zeros(len(start), np.uint64)
    for k in at:
        h = mix(h * _ODD[0] + eight[start + k])
    by = _ordered(h, order)
    first = _first_of(by, h)
    same = np.ones(len(start), bool)
    for k in at:
        same &= eight[start + k] == eight[start[first] + k]
    if not same.all():  # different windows of one hash: order by all bytes
        digits = [eight[start + k] for k in at]
        by = np.lexsort((order, *reversed(digits)))
        first = _first_of(by, *digits)
    return first


def _first_of(by: np.ndarray, *digits: np.ndarray) -> np.ndarray:
    new = np.zeros(len(by), bool)
    new[0] = True
    for d in digits:
        new[1:] |= d[by[1:]] != d[by[:-1]]
    out = np.empty(len(by), np.int64)
    out[by] = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    return out


def _low_bytes(x: np.ndarray, k: int) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k])


def _pack(block: int, values: np.ndarray, contexts: np.ndarray, bits: int, k: int) -> Iterator[tuple[int, int, bytes]]:
    """Sorted values by bucket, which is their top ``bits``: their number, of each the next k bytes, and which have more than one context, and how many."""
    edge = np.searchsorted(values, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    edge = np.append(edge, len(values))
    body = _low_bytes(values >> np.uint64(64 - bits - 8 * k), k)
    more = np.flatnonzero(contexts > 1)
    cut = np.searchsorted(more, edge)
    for i in np.flatnonzero(np.diff(edge)).tolist():
        some = more[cut[i] : cut[i + 1]]
        extra = np.stack([some - edge[i], contexts[some]], axis=1).astype("<u4")
        yield block, i, np.uint32(edge[i + 1] - edge[i]).tobytes() + body[edge[i] : edge[i + 1]].tobytes() + extra.tobytes()


def _unpack(body: bytes, k: int) -> np.ndarray:
    raw = np.frombuffer(body, np.uint8).reshape(-1, k)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, :k] = raw
    return full.view("<u8").ravel()


def _rows(rows: list[tuple], schema: str = _PACKED) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.table({name: pa.array(col, kinds[kind]) for (name, kind), col in zip(fields, cols, strict=True)})


def _settle(k: int, most: int):
    """Per bucket: for each block's values whether another block has them too (1), and more than ``most`` contexts of them there are (2)."""

    def run(table: pa.Table) -> pa.Table:
        blocks, got, counts = table["block"].to_numpy(), [], []
        for x in table["body"]:
            raw = x.as_py()
            n = int.from_bytes(raw[:4], "little")
            got.append(_unpack(raw[4 : 4 + n * k], k))
            contexts = np.ones(n, np.int64)
            extra = np.frombuffer(raw[4 + n * k :], "<u4").reshape(-1, 2)
            contexts[extra[:, 0]] = extra[:, 1]
            counts.append(contexts)
        size = np.array([len(x) for x in got])
        v, contexts = np.concatenate(got), np.concatenate(counts)
        by = np.argsort(v)
        again = np.zeros(len(v) + 1, bool)
        again[1:-1] = v[by[1:]] == v[by[:-1]]
        begins = np.flatnonzero(~again[:-1])
        total = np.add.reduceat(contexts[by], begins) if len(begins) else contexts
        hot = np.repeat(total > most, np.diff(np.append(begins, len(by))))
        status = np.zeros(len(v), np.uint8)
        status[by] = (again[1:] | again[:-1]) * (1 + hot.astype(np.uint8))
        ends = np.cumsum(size)
        bucket = table["bucket"][0].as_py()
        return _rows([(int(b), bucket, status[e - n : e].tobytes()) for b, n, e in zip(blocks, size, ends, strict=True)])

    return run


def _pack_contexts(x: _Block, block: int, pick: np.ndarray, bits: int) -> Iterator[tuple[int, int, bytes]]:
    """Contexts by bucket of their anchor: their number, how many windows each has, and their bytes."""
    n = (x.b[pick] - x.a[pick] + 1).astype(np.int64)
    bucket = (x.h[pick] >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    for i, j in pairwise([*cuts.tolist(), len(pick)]):
        size = n[i:j] + WINDOW - 1
        at = np.repeat(x.a[pick[i:j]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        yield block, int(bucket[i]), np.uint32(j - i).tobytes() + n[i:j].astype(np.uint8).tobytes() + x.buf[at].tobytes()


def _settle_contexts(table: pa.Table) -> pa.Table:
    """Per bucket: for each block's contexts a bit for each window (from the lowest) that an earlier block has too."""
    blocks, counts, texts = table["block"].to_numpy(), [], []
    for body in table["body"]:
        raw = np.frombuffer(body.as_buffer(), np.uint8)
        k = int(raw[:4].view("<u4")[0])
        counts.append(raw[4 : 4 + k].astype(np.int64))
        texts.append(raw[4 + k :])
    n, buf = np.concatenate(counts), np.concatenate(texts)
    eight = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    per = np.array([len(c) for c in counts])
    blk = np.repeat(blocks, per)
    size = n + WINDOW - 1
    at = np.cumsum(size) - size
    # second digit: whole contexts
    reads = [at + np.minimum(k, size - 8) for k in range(0, WINDOW + REACH - 1, 8)]
    h = n.astype(np.uint64)
    for r in reads:
        h = mix(h * _ODD[0] + eight[r])
    lead = _first_of(_ordered(h, blk.astype(np.uint64)), h)
    same = n == n[lead]
    for r in reads:
        same &= eight[r] == eight[r[lead]]
    whole = same & (blk > blk[lead])
    bits = np.where(whole, (np.uint32(1) << n.astype(np.uint32)) - np.uint32(1), np.uint32(0)).astype(np.uint32)
    # last digit: windows of the contexts that are left
    rest = np.flatnonzero(~whole)
    m = n[rest]
    first = np.cumsum(m) - m
    nth = np.arange(m.sum()) - np.repeat(first, m)
    w_blk = np.repeat(blk[rest], m)
    w_lead = _equal_windows(eight, np.repeat(at[rest], m) + nth, w_blk.astype(np.uint64))
    bits[rest] = np.bitwise_or.reduceat((w_blk > w_blk[w_lead]).astype(np.uint32) << nth.astype(np.uint32), first)
    ends = np.cumsum(per)
    bucket = table["bucket"][0].as_py()
    return _rows([(int(b), bucket, bits[e - k : e].astype("<u4").tobytes()) for b, k, e in zip(blocks, per, ends, strict=True)])


def _pack_windows(block: int, x: _Block, status: np.ndarray, bits: int) -> Iterator[tuple[int, int, bytes]]:
    """The distinct windows of hot groups by bucket of their hash, as bytes."""
    start, h, *_ = x.hot_windows(status)
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    for i, j in pairwise([*cuts.tolist(), len(start)]):
        yield block, int(bucket[i]), x.buf[(start[i:j, None] + np.arange(WINDOW)).ravel()].tobytes()


def _settle_windows(table: pa.Table) -> pa.Table:
    """Per bucket: for each block's windows whether an earlier block has them too."""
    blocks, texts = table["block"].to_numpy(), [x.as_py() for x in table["body"]]
    size = np.array([len(t) // WINDOW for t in texts])
    buf = np.frombuffer(b"".join(texts), np.uint8)
    eight = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    blk = np.repeat(blocks, size)
    lead = _equal_windows(eight, np.arange(len(blk)) * WINDOW, blk.astype(np.uint64))
    gone = (blk > blk[lead]).astype(np.uint8)
    ends = np.cumsum(size)
    bucket = table["bucket"][0].as_py()
    return _rows([(int(b), bucket, gone[e - n : e].tobytes()) for b, n, e in zip(blocks, size, ends, strict=True)])


def _statuses(replies: pa.Table, kind: str = "u1") -> np.ndarray:
    """A block's replies in the order of its sorted values."""
    replies = replies.sort_by("bucket")
    return np.frombuffer(b"".join(x.as_py() for x in replies["body"]), kind)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary]), one row for each input row.

    Null texts are empty.  Rows with the same id aren't smaller than one
    another, so repeated rows leave each other alone and meet the same fate.
    Rows with a null id take no part: nothing is removed from them or because
    of them.  Texts under WINDOW bytes stay as they are; long ones count whole,
    a block holds one at least.  Extra columns, with any names, are ignored; an
    empty table gives an empty result.
    """
    d = documents(docs, id_col, text_col)
    total = d.agg(F.sum(F.octet_length("text")).alias("n"), F.count("doc_id").alias("ids")).first()
    n_bytes = total["n"] or 0
    most_bits = max(14, int(0.35 * n_bytes / BUCKET_BYTES).bit_length())
    n_blocks = max(LEAST_BLOCKS, -(-n_bytes // max(BLOCK_BYTES, BYTES_FOR_A_BUCKET << most_bits)))
    bits = min(most_bits, max(6, (n_blocks - 1).bit_length()))
    cuts = d.select(F.percentile_approx("doc_id", [i / n_blocks for i in range(1, n_blocks)], 20 * n_blocks).alias("q")).first()["q"]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.fillna(0).astype("int64"), "left").astype("int32"))

    anywhere = F.pmod(F.xxhash64("text"), F.lit(n_blocks)).cast("int")  # rows without an id take no part
    d = d.withColumn("block", F.when(F.col("doc_id").isNull(), anywhere).otherwise(block_of("doc_id")))
    digit = 5

    def digits(table: pa.Table) -> pa.Table:
        x = _Block(table, bits)
        return _rows(list(_pack(table["block"][0].as_py(), x.values, x.n_contexts, bits, digit)))

    def contexts(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table) or not len(replies):
            return _rows([])
        status = _statuses(replies)
        if not status.any():
            return _rows([])
        x, block = _Block(table, bits), table["block"][0].as_py()
        windows = _pack_windows(block, x, status, bits) if (status == 2).any() else ()
        whole = _pack_contexts(x, block, x.contexts(status), bits)
        # windows have the buckets behind those of contexts
        return _rows([*whole, *((b, k + (1 << bits), body) for b, k, body in windows)])

    def settle(table: pa.Table) -> pa.Table:
        return (_settle_windows if table["bucket"][0].as_py() >> bits else _settle_contexts)(table)

    out_schema = _OUT + (", kept binary" if with_text else "")

    def result(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(table):
            return _rows([], out_schema)
        x = _Block(table, bits)
        tag = replies["pass_no"].to_numpy()
        status = _statuses(replies.filter(pa.array(tag == 1)))
        whole = x.covered
        start, gone = x.windows()
        single = [start[gone]]
        pick = x.contexts(status)
        if status.any():
            found = np.zeros(len(x.group), np.uint32)
            single_reply = replies["bucket"].to_numpy() >> bits == 1
            found[pick] = _statuses(replies.filter(pa.array((tag == 2) & ~single_reply)), "<u4")
            if (status == 2).any():
                _, _, anchor, nth, which = x.hot_windows(status)
                hit = _statuses(replies.filter(pa.array((tag == 2) & single_reply)))[which]
                np.bitwise_or.at(found, anchor, hit.astype(np.uint32) << nth.astype(np.uint32))
            found = found[x.rep]  # equal contexts share a reply
            for k in range(REACH):
                single.append(x.a[(found >> np.uint32(k)) & 1 == 1] + k)
        single = np.concatenate(single)
        up = np.sort(np.concatenate([x.a[whole], single]))
        down = np.sort(np.concatenate([x.b[whole], single]) + WINDOW)
        removed, spans, kept = [], [], []
        for i, j in chunks(x.offs):
            lo, hi = x.offs[i], x.offs[j]
            depth = np.zeros(hi - lo + 1, np.int32)
            np.add.at(depth, up[slice(*np.searchsorted(up, (lo, hi)))] - lo, 1)
            np.subtract.at(depth, down[slice(*np.searchsorted(down, (lo + 1, hi + 1)))] - lo, 1)
            gone = np.cumsum(depth[:-1], dtype=np.int32) > 0
            rises = gone.copy()
            rises[1:] &= ~gone[:-1]
            for s, e in zip((x.offs[i:j] - lo).tolist(), (x.offs[i + 1 : j + 1] - lo).tolist(), strict=True):
                body, out = x.buf[lo + s : lo + e], gone[s:e]
                n = int(np.count_nonzero(out))
                removed.append(n)
                spans.append(int(np.count_nonzero(rises[s:e])) + int(n > 0 and s > 0 and out[0] and gone[s - 1]))
                kept.append((body[~out] if n else body).tobytes() if with_text else hashlib.sha256(body[~out] if n else body).hexdigest())
        cols = {
            "doc_id": x.raw_ids, "n_bytes": pa.array(np.diff(x.offs)), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept] if with_text else kept, pa.string()),
        }
        if with_text:
            cols["kept"] = pa.array(kept, pa.binary())
        return pa.table(cols)

    blocks = d.groupBy("block")
    first = blocks.applyInArrow(digits, _PACKED).groupBy("bucket").applyInArrow(_settle(digit, hot_contexts), _PACKED)
    last = blocks.cogroup(first.groupBy("block")).applyInArrow(contexts, _PACKED).groupBy("bucket").applyInArrow(settle, _PACKED)
    replies = first.withColumn("pass_no", F.lit(1)).unionByName(last.withColumn("pass_no", F.lit(2)))
    return blocks.cogroup(replies.groupBy("block")).applyInArrow(result, out_schema)


def op10(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
