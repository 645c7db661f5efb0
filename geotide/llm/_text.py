"""Vectorised text primitives over Arrow string buffers.

A batch of texts is one byte buffer with offsets, so words, lines and n-grams
of thousands of texts are found with a few numpy passes and no Python loop
over texts.  The word separators are ASCII (space and U+0009..U+000D), hence
splitting UTF-8 bytes splits code points correctly.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# what a batch frees goes back to the machine: a Python worker lives as long as its executor
pa.set_memory_pool(pa.system_memory_pool())
try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.mallopt(-3, 16 << 20)  # blocks of 16 MB and more are mapped, and unmapped when freed
    _libc.mallopt(-1, 64 << 20)  # free memory at the end of the heap goes back from 64 MB on
except (OSError, AttributeError):  # another C library
    _libc = None


def trim() -> None:
    """Gives free memory in the middle of the heap back as well."""
    if _libc is not None:
        _libc.malloc_trim(0)

#: Bytes of text worked on at once; keeps the arrays within the processor's caches.
CHUNK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 2**64))
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

_up = np.ones(1, np.uint64)
_down = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _up, _down
    if len(_up) < n:
        size = max(n, CHUNK_BYTES + 4096)
        up, down = np.full(size, _P, np.uint64), np.full(size, _P_INV, np.uint64)
        up[0] = down[0] = 1
        _up, _down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _up[:n], _down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) and not pa.types.is_large_binary(texts.type) else b"")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offs[0] : offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of texts of about ``size`` bytes together; a longer text stands alone."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Chunk:
    """Some whole texts: ``buf`` bytes, ``offs`` text offsets, prefix hashes on demand."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.buf, self.offs, self.n = buf, offs, len(offs) - 1
        self._prefix = None

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans, each in constant time."""
        if self._prefix is None:
            up, _ = _powers(len(self.buf) + 1)
            self._prefix = np.zeros(len(self.buf) + 1, np.uint64)
            np.cumsum(BYTE_CODE[self.buf] * up[: len(self.buf)], out=self._prefix[1:])
        _, down = _powers(len(self.buf) + 1)
        return mix((self._prefix[end] - self._prefix[start]) * down[start] + (end - start).astype(np.uint64))

    def words(self, keep: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text index) of the maximal runs of bytes in ``keep``."""
        start, end = self.runs(keep)
        return start, end, self.text_of(start)

    def runs(self, keep: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the maximal runs of bytes in ``keep``, in order; none goes across texts."""
        buf, offs = self.buf, self.offs
        if not len(buf):
            return (np.zeros(0, np.int64),) * 2
        on = keep[buf]
        before = np.empty(len(on), bool)
        before[0], before[1:] = False, on[:-1]
        edge = offs[:-1][np.diff(offs) > 0]
        before[edge] = False
        after = np.empty(len(on), bool)
        after[-1], after[:-1] = False, on[1:]
        after[edge[1:] - 1] = False
        return np.flatnonzero(on & ~before), np.flatnonzero(on & ~after) + 1

    def text_of(self, at: np.ndarray) -> np.ndarray:
        """Which text each byte position is in."""
        return np.searchsorted(self.offs, at, "right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text index) of the newline-separated lines; an empty text has one empty line."""
        cuts = np.flatnonzero(self.buf == 10)
        of = self.text_of(cuts)
        start = np.concatenate([self.offs[:-1], cuts + 1])
        end = np.concatenate([self.offs[1:], cuts])
        text = np.concatenate([np.arange(self.n), of])
        by = np.lexsort((start, text))
        start, text = start[by], text[by]
        by = np.lexsort((end, np.concatenate([np.arange(self.n), of])))
        return start, end[by], text

    def count(self, table: np.ndarray) -> np.ndarray:
        """How many bytes of each text ``table`` marks."""
        total = np.zeros(len(self.buf) + 1, np.int64)
        np.cumsum(table[self.buf], out=total[1:])
        return total[self.offs[1:]] - total[self.offs[:-1]]


def grams(h: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows and the index of their first word; windows stay within one text."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[k : len(h) - n + 1 + k]
    first = np.flatnonzero(of[: len(h) - n + 1] == of[n - 1 :])
    return mix(out[first]), first


def order_within(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Indices that order by (group, value), of which equal pairs may come in any order.

    One sort of 64-bit numbers holds the group and the value's upper bits; where
    those leave a tie between different values, or groups don't fit, two sorts.
    """
    if len(group) and int(group.max()) >> 20 == 0:
        packed = (group.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20))
        by = np.argsort(packed)
        p, v = packed[by], value[by]
        tied = np.flatnonzero(p[1:] == p[:-1])
        if (v[tied] == v[tied + 1]).all():
            return by
    return np.lexsort((value, group))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Marks the keys that occur twice or more."""
    by = np.argsort(keys)
    k = keys[by]
    same = k[1:] == k[:-1]
    hit = np.zeros(len(keys), bool)
    hit[by[1:][same]] = True
    hit[by[:-1][same]] = True
    return hit


def text_chunks(texts: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Chunk]]:
    """(i, j, chunk) for runs of texts [i, j) of a batch."""
    buf, offs = buffers(texts)
    for i, j in chunks(offs, size):
        yield i, j, Chunk(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
    if len(buf) > 8 * size:
        trim()
