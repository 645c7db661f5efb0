"""Quality rules by repetition coverage.

Per text: word and symbol counts, repeated lines, and how many characters lie
inside duplicated word n-grams (several lengths) and duplicated lines.  All
n-grams of a batch are hashed and compared in numpy; a longer n-gram can only
repeat where the shorter one does, so each length looks only at what the
length before left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotide.llm._frames import by_position, documents
from geotide.llm._text import IS_WORD, Chunk, grams, repeated, text_chunks

#: n-gram length -> largest share of a text's word characters inside duplicated n-grams of that length.
GRAM_LIMITS = {5: 0.5, 6: 0.48, 7: 0.46, 8: 0.44, 9: 0.42, 10: 0.4}
#: Largest share of word characters in lines equal to an earlier line.
LINE_LIMIT = 0.5
#: Largest number of symbols for each word.
SYMBOL_LIMIT = 0.25

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_chars long, " + ", ".join(f"dup_chars_{n} long" for n in GRAM_LIMITS)
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False


def _measure(c: Chunk) -> dict[str, np.ndarray]:
    start, end, of = c.words()
    out = {
        "n_words": np.bincount(of, minlength=c.n),
        "word_chars": c.count(IS_WORD & _LEAD),
        "n_symbols": c.count(_SYMBOL),
    }
    chars = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum((IS_WORD & _LEAD)[c.buf], out=chars[1:])

    l_start, l_end, l_of = c.lines()
    some = np.searchsorted(start, l_end) > np.searchsorted(start, l_start)
    l_start, l_end, l_of = l_start[some], l_end[some], l_of[some]
    key = c.span_hash(l_start, l_end) + l_of.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    _, first = np.unique(key, return_index=True)
    later = np.ones(len(key), bool)
    later[first] = False
    out["n_dup_lines"] = np.bincount(l_of[later], minlength=c.n)
    out["dup_line_chars"] = np.bincount(l_of[later], chars[l_end[later]] - chars[l_start[later]], c.n).astype(np.int64)

    word_chars = chars[end] - chars[start]
    h = c.span_hash(start, end) if len(start) else np.zeros(0, np.uint64)
    salt = of.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    alive = np.ones(len(h) + 1, bool)  # first words at which the next shorter n-gram repeats
    for n in (3, *GRAM_LIMITS):
        g, first = grams(h, of, n)
        if n > 3:
            keep = alive[first] & alive[first + (1 if n > 5 else 2)]
            g, first = g[keep], first[keep]
        first = first[repeated(g + salt[first])]
        alive = np.zeros(len(h) + 1, bool)
        alive[first] = True
        depth = np.zeros(len(h) + 1, np.int64)
        depth[first] += 1
        np.subtract.at(depth, first + n, 1)
        covered = np.cumsum(depth[:-1]) > 0
        if n == 3:
            out["n_repeat_words"] = np.bincount(of[covered], minlength=c.n)
        else:
            out[f"dup_chars_{n}"] = np.bincount(of[covered], word_chars[covered], c.n).astype(np.int64)
    return out


def _batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for b in it:
        for i, j, c in text_chunks(b["text"]):
            m = _measure(c)
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), *[pa.array(m[k], pa.int64()) for k in names[1:]]], names)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts for each input row (see ``SCHEMA``).

    A null or empty text has zero for every count.  A null id stays null,
    repeated rows are measured each for itself, long texts whole; other
    columns, with any names, are ignored; an empty table gives no rows.
    """
    return documents(docs, id_col, text_col).mapInArrow(_batches, SCHEMA)


def verdicts(measured: DataFrame) -> DataFrame:
    """Adds base_failed and kept to what ``measure`` returns."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    bad = F.col("n_symbols") > SYMBOL_LIMIT * F.col("n_words")
    bad |= F.col("dup_line_chars") > LINE_LIMIT * F.col("word_chars")
    for n, most in GRAM_LIMITS.items():
        bad |= F.col(f"dup_chars_{n}") > most * F.col("word_chars")
    return measured.withColumn("base_failed", base).withColumn("kept", ~base & ~bad)


def keep(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that the rules reject; the verdict is found in the same scan.

    Null and empty texts have no words and are rejected; repeated rows are
    each judged.  Extra columns may have any names, also ones that clash; an
    empty table gives no rows.
    """
    plain, (text,) = by_position(docs, text_col)
    fields = [x.split() for x in SCHEMA.split(", ")[1:]]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, c in text_chunks(b[text]):
                m = _measure(c)
                own = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*own.columns, *[pa.array(m[k], pa.int64()) for k, _ in fields]], [*own.schema.names, *[k for k, _ in fields]])

    schema = T.StructType([*plain.schema.fields, *[T.StructField(k, T.LongType()) for k, _ in fields]])
    kept = verdicts(plain.mapInArrow(run, schema)).filter("kept")
    return kept.select(*plain.columns).toDF(*docs.columns)


def op6(spark, sf_dir: str) -> DataFrame:
    return verdicts(measure(spark.read.parquet(f"{sf_dir}/documents.parquet")))
