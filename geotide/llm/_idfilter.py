"""A Bloom filter over row ids that a scan can apply before anything is shuffled.

Its size follows the number of ids up to a fixed bound, beyond which it only
lets more through; whoever uses it joins exactly afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotide.llm._text import mix

LEAST_BITS, MOST_BITS = 20, 29  # 2**29 bits are 64 MB
_SLICE = 1 << 19  # bits of a slice


def _slots(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(ids.astype(np.int64).view(np.uint64))
    return ((h >> np.uint64(64 - bits)).astype(np.int64), (mix(h) >> np.uint64(64 - bits)).astype(np.int64))


class IdFilter:
    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits = table, bits

    def may_hold(self, ids: pa.Array) -> np.ndarray:
        known = np.asarray(ids.is_valid())
        x = ids.fill_null(0).to_numpy(zero_copy_only=False)
        hit = known
        for s in _slots(x, self.bits):
            hit = hit & ((self.table[s >> 3] >> (s & 7).astype(np.uint8)) & 1).astype(bool)
        return hit


def build(ids: DataFrame, n: int) -> IdFilter:
    """The filter of a one-column table of ``n`` long ids; bitmaps are made and merged on the executors."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * max(n, 1)).bit_length()))
    name = ids.columns[0]

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: dict[int, np.ndarray] = {}
        for b in it:
            for s in _slots(b[name].drop_null().to_numpy(zero_copy_only=False), bits):
                for k in np.unique(s // _SLICE).tolist():
                    own = s[s // _SLICE == k] % _SLICE
                    m = marks.setdefault(k, np.zeros(_SLICE, bool))
                    m[own] = True
        for k, m in marks.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(m, bitorder="little").tobytes()], pa.binary())], ["slice", "body"])

    def merge(t: pa.Table) -> pa.Table:
        out = np.zeros(_SLICE // 8, np.uint8)
        for x in t["body"]:
            out |= np.frombuffer(x.as_py(), np.uint8)
        return pa.table([t["slice"].slice(0, 1), pa.array([out.tobytes()], pa.binary())], ["slice", "body"])

    table = np.zeros((1 << bits) // 8, np.uint8)
    merged = ids.select(F.col(name).cast("long").alias(name)).mapInArrow(part, "slice int, body binary").groupBy("slice").applyInArrow(merge, "slice int, body binary")
    for r in merged.collect():  # the filter of bounded size
        table[r["slice"] * _SLICE // 8 : (r["slice"] + 1) * _SLICE // 8] = np.frombuffer(r["body"], np.uint8)
    return IdFilter(table, bits)
