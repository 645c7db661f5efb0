"""Spelling variants: words one edit apart, found by merging the light subtrees of a trie.

The words are the terminals of a trie.  At every node the child with most
words is heavy, the others (and a word that ends there) are light; a word
passes few light edges.  Each light word is re-rooted at its node with one
character replaced by the heavy one, skipped, or with the heavy one put before
it; where it then coincides with a terminal, the two are one edit apart.
Light words that agree behind their edges are one edit apart as well.  Each
pair is met at the node where its words part, and only there.

On Spark the sorted words are dealt in blocks.  A node whose words are all in
one block is merged there; only nodes that go across blocks (prefixes of a
block's first or last word) need the others: their heavy children come from
counts over all blocks, and their re-rooted words meet the terminals in a
shuffle.  Any rule by which all blocks agree on the heavy child gives the same
pairs, so hashed node names need no check.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from geotide.llm._frames import documents, durable
from geotide.llm._text import Chunk, text_chunks

LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR, SPOILT = 7, 2, 10, 31
#: Words that a counting task holds before it hands them on, and the words and bytes of a block.
HELD_WORDS, BLOCK_WORDS, BLOCK_BYTES = 400_000, 100_000, 8 << 20
#: Runs up to so many bytes have their checksums taken side by side, byte by byte.
SIDE_BY_SIDE = 48

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def _checksums(low: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte spans, each after what ``begun`` is the CRC-32 of."""
    size = end - start
    out = begun.copy()
    short = np.flatnonzero(size <= SIDE_BY_SIDE)
    short = short[np.argsort(-size[short], kind="stable")]
    state, at, n = ~begun[short], start[short], size[short]
    for k in range(int(n[0]) if len(n) else 0):
        live = int(np.searchsorted(-n, -k, "left"))  # spans longer than k
        state[:live] = _CRC[(state[:live] ^ low[at[:live] + k]) & 0xFF] ^ (state[:live] >> 8)
    out[short] = ~state
    for i in np.flatnonzero(size > SIDE_BY_SIDE).tolist():
        out[i] = zlib.crc32(low[start[i] : end[i]], int(begun[i]))
    return out


def _words(c: Chunk, ids: pa.Array) -> pa.Array:
    """The words of some texts: maximal runs of letters up to U+00FF in lower case, some of them with one code point gone."""
    lead = c.buf == 0xC3  # what follows it is U+00C0 to U+00FF
    as_letters = c.buf.copy()
    as_letters[lead] = 97
    second = np.flatnonzero(lead[:-1]) + 1
    as_letters[second] = 97
    start, end = Chunk(as_letters, c.offs).runs(_LETTER)
    first_bytes = np.flatnonzero((c.buf & 0xC0) != 0x80)
    points = lambda at: np.searchsorted(first_bytes, at)
    length = points(end) - points(start)
    long = np.flatnonzero(length >= LEAST_LENGTH)
    start, end, length = start[long], end[long], length[long]
    low = _LOWER[c.buf]
    prefix = np.array([zlib.crc32(b"%s:" % ("" if i is None else str(i)).encode()) for i in ids.to_pylist()], np.uint32)
    h = _checksums(low, start, end, prefix[c.text_of(start)])
    spoilt = np.flatnonzero(h % SPOILT == 0)
    gone = first_bytes[points(start[spoilt]) + h[spoilt] % length[spoilt]]
    wide = lead[gone]
    keep = np.zeros(len(low) + 1, np.int8)
    kept = np.ones(len(start), bool)
    kept[spoilt[length[spoilt] <= LEAST_LENGTH]] = False
    np.add.at(keep, start[kept], 1)
    np.add.at(keep, end[kept], -1)
    keep = np.cumsum(keep[:-1]).astype(bool)
    keep[gone] = False
    keep[gone[wide] + 1] = False
    size = end - start
    size[spoilt] -= 1 + wide
    offsets = np.zeros(int(kept.sum()) + 1, np.int32)
    np.cumsum(size[kept], out=offsets[1:])
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(low[keep]))


def _counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their numbers, added up as far as a task holds them."""
    held: list[pa.Table] = []
    rows = 0
    names = ["word", "n"]

    def together() -> pa.Table:
        out = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
        return out.select(["word", "n_sum"]).rename_columns(names)

    for b in it:
        for i, j, c in text_chunks(b["text"]):
            found = _words(c, b["doc_id"].slice(i, j - i)).value_counts()
            held.append(pa.table([found.field("values"), found.field("counts").cast(pa.int64())], names=names))
            rows += len(found)
            if rows > 2 * HELD_WORDS:
                held = [together()]
                rows = len(held[0])
                if rows > HELD_WORDS:
                    yield from held[0].combine_chunks().to_batches(max_chunksize=50_000)
                    held, rows = [], 0
    if held:
        yield from together().combine_chunks().to_batches(max_chunksize=50_000)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of all texts that have ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences or more."""
    counts = documents(docs, id_col, text_col).mapInArrow(_counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _blocks(it: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted words with the number of their block, which has ``most`` words."""
    block, words, size = TaskContext.get().partitionId() << 32, 0, 0
    for b in it:
        numbers = []
        for w in pc.binary_length(b["word"]).to_pylist():
            if words and (words >= most or size + w > BLOCK_BYTES):
                block, words, size = block + 1, 0, 0
            words, size = words + 1, size + w
            numbers.append(block)
        yield pa.RecordBatch.from_arrays([b["word"], b["n"], pa.array(numbers, pa.int64())], ["word", "n", "block"])


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    if n > 64:  # halve what is long
        low, high = 0, n
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
        return low
    return next(i for i in range(n) if a[i] != b[i])


def _names(word: str) -> list[int]:
    """The names of the nodes on the way to a word, the root first."""
    x = xxhash.xxh3_64()
    out = [0]
    for c in word:
        x.update(c.encode())
        out.append(x.intdigest() - (1 << 63))
    return out


class _Trie:
    """The sorted words of a block, and where neighbours part."""

    def __init__(self, table: pa.Table):
        rows = sorted(zip(table["word"].to_pylist(), table["n"].to_pylist(), strict=True))  # code points sort as UTF-8 does
        self.words, self.n = [w for w, _ in rows], [n for _, n in rows]
        self.parts = [0, *map(_common, self.words, self.words[1:]), 0]

    def children(self, low: int, high: int, depth: int) -> list[tuple[str, int, int]]:
        """(character, from, to) of the children of the node that words ``low`` to ``high`` share at ``depth``; '' for a word that ends there."""
        cuts = [low, *(k for k in range(low + 1, high) if self.parts[k] == depth), high]
        return [(self.words[a][depth : depth + 1], a, b) for a, b in zip(cuts, cuts[1:], strict=False)]

    def edges(self) -> Iterator[tuple[int, int, int]]:
        """(depth, from, to) of the nodes that are prefixes of the first or last word and may go on in other blocks."""
        m = len(self.words)
        low, high, depth = 0, m, 0
        for end, step in ((0, 1), (m - 1, -1)):
            word, near, far = self.words[end], end, end  # words near..far share the prefix
            for depth in range(len(word), -1, -1):
                while 0 <= far + step < m and self.parts[far + (step > 0)] >= depth:
                    far += step
                low, high = min(near, far), max(near, far) + 1
                if step > 0 or low > 0:  # else met from the first word already
                    yield depth, low, high


def _edge_counts(_key: tuple, table: pa.Table) -> pa.Table:
    """(block, node, char, words) of the nodes that may go across blocks."""
    trie, block = _Trie(table), table["block"][0].as_py()
    names = {end: _names(trie.words[end]) for end in (0, len(trie.words) - 1)}
    out = []
    for depth, low, high in trie.edges():
        node = names[0 if low == 0 else len(trie.words) - 1][depth]
        out += [(block, node, c, b - a) for c, a, b in trie.children(low, high, depth)]
    cols = list(zip(*out, strict=True))
    return pa.table({"block": pa.array(cols[0], pa.int64()), "node": pa.array(cols[1], pa.int64()), "char": pa.array(cols[2], pa.string()), "words": pa.array(cols[3], pa.int64())})


_MERGED = "kind string, key string, word string, n long, n_near long, best_n long, best string"


class _Merge:
    """Merges light subtrees of a block; what is met in the block is counted, the rest is sent to where it may be met."""

    def __init__(self, trie: _Trie, shared: dict[int, str]):
        self.trie, self.shared = trie, shared
        self.at = {w: i for i, w in enumerate(trie.words)}
        self.n_near, self.best = [0] * len(trie.words), [-1] * len(trie.words)
        self.sent: list[tuple[str, str, int]] = []  # kind, key, word

    def link(self, i: int, j: int) -> None:
        n, best = self.trie.n, self.best
        for a, b in ((i, j), (j, i)):
            self.n_near[a] += 1
            if best[a] < 0 or (n[b], best[a]) > (n[best[a]], b):  # the first of equals is the smallest
                best[a] = b

    def rerooted(self, i: int, depth: int, heavy: str) -> Iterator[str]:
        """The words that light word ``i`` becomes at a node: one character replaced by the heavy one, skipped, and the heavy one put in."""
        w = self.trie.words[i]
        if depth < len(w):
            if heavy:
                yield w[:depth] + heavy + w[depth + 1 :]
            if w[depth] != w[depth + 1 : depth + 2]:  # the words part at this node
                yield w[:depth] + w[depth + 1 :]
        if heavy:
            yield w[:depth] + heavy + w[depth:]

    def node(self, depth: int, low: int, high: int, heavy: str, here: bool) -> None:
        """Re-roots the light words at a node; ``here``: all of its words are in this block."""
        rest: dict[str, list[int]] = {}
        children = self.trie.children(low, high, depth)
        alone = here and len(children) <= 2
        for char, a, b in children:
            if char == heavy and char:
                continue
            for i in range(a, b):
                for word in self.rerooted(i, depth, heavy):
                    if not here:
                        self.sent.append(("word", word, i))
                    elif (j := self.at.get(word)) is not None:
                        self.link(i, j)
                if char and not alone:
                    w = self.trie.words[i]
                    if here:
                        same = rest.setdefault(w[depth + 1 :], [])
                        for j in same:
                            self.link(i, j)
                        same.append(i)
                    else:
                        self.sent.append(("rest", f"{w[:depth]}\0{w[depth + 1 :]}", i))

    def run(self) -> None:
        trie, done = self.trie, set()
        ends = {0: _names(trie.words[0]), len(trie.words) - 1: _names(trie.words[-1])}
        for depth, low, high in trie.edges():
            node = ends[0 if low == 0 else len(trie.words) - 1][depth]
            if node in self.shared:
                done.add((low, high, depth))
                self.node(depth, low, high, self.shared[node], here=False)
        work = [(0, len(trie.words), 0)]
        while work:
            low, high, depth = work.pop()
            if high - low < 2:
                continue
            depth = min(trie.parts[low + 1 : high])
            children = trie.children(low, high, depth)
            if (low, high, depth) not in done:
                char, a, b = max((x for x in children if x[0]), key=lambda x: (x[2] - x[1], x[0]))
                self.node(depth, low, high, char, here=True)
            work += [(a, b, depth + 1) for c, a, b in children if c]

    def table(self) -> pa.Table:
        words, n = self.trie.words, self.trie.n
        near = [i for i, k in enumerate(self.n_near) if k]
        kind = ["near"] * len(near) + [k for k, _, _ in self.sent]
        of = near + [i for _, _, i in self.sent]
        none = [None] * len(self.sent)
        cols = [kind, [None] * len(near) + [k for _, k, _ in self.sent], [words[i] for i in of], [n[i] for i in of], [self.n_near[i] for i in near] + none, [n[self.best[i]] for i in near] + none, [words[self.best[i]] for i in near] + none]
        return pa.table([pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()], strict=True)], names=[f.split()[0] for f in _MERGED.split(", ")])


def _merged(_key: tuple, words: pa.Table, shared: pa.Table) -> pa.Table:
    m = _Merge(_Trie(words), dict(zip(shared["node"].to_pylist(), shared["heavy"].to_pylist(), strict=True))) if len(words) else None
    if m is None:
        return pa.table([pa.array([], t) for t in (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())], names=[f.split()[0] for f in _MERGED.split(", ")])
    m.run()
    return m.table()


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n, n_near, best_n, best) of every (word, n), words distinct: how many others are one edit apart, and the most frequent of them.

    Of equally frequent ones the smallest counts.  Words without such have
    n_near 0 and nulls.
    """
    spark = words.sparkSession
    words = durable(words)
    parts = max(spark.sparkContext.defaultParallelism, -(-words.count() // max(block_words, BLOCK_WORDS)))
    blocks = durable(words.repartitionByRange(parts, "word").sortWithinPartitions("word").mapInArrow(lambda it: _blocks(it, block_words), "word string, n long, block long"))
    counts = durable(blocks.groupBy("block").applyInArrow(_edge_counts, "block long, node long, char string, words long"))
    # a node in one block only is that block's own affair
    chars = counts.groupBy("node", "char").agg(F.sum("words").alias("words"), F.min("block").alias("low"), F.max("block").alias("high"))
    heavy = F.max_by(F.col("char"), F.struct(F.when(F.col("char") == "", 0).otherwise(F.col("words")), "char")).alias("heavy")
    shared = chars.groupBy("node").agg(heavy, F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("node", "heavy")
    shared = counts.select("block", "node").distinct().join(shared, "node")
    merged = durable(blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_merged, _MERGED))
    own = words.select("word", F.col("n").alias("own_n"), F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<down:long,word:string>").alias("best"))
    found = lambda n_near, best_n, best: (F.lit(None).cast("long").alias("own_n"), F.lit(n_near).cast("long").alias("n_near"), F.struct((-F.col(best_n)).alias("down"), F.col(best).alias("word")).alias("best"))
    here = merged.filter("kind = 'near'").select("word", F.lit(None).cast("long").alias("own_n"), "n_near", F.struct((-F.col("best_n")).alias("down"), F.col("best").alias("word")).alias("best"))
    # a re-rooted word that is a word: both learn of one another
    met = merged.filter("kind = 'word'").select(F.col("key").alias("other"), "word", "n").join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    there, back = met.select("word", *found(1, "other_n", "other")), met.select(F.col("other").alias("word"), *found(1, "n", "word"))
    # light words with one rest differ in the character before it: at most as many as there are letters
    same = merged.filter("kind = 'rest'").groupBy("key").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("down"), "word"))).alias("all")).filter(F.size("all") > 1)
    same = same.select("all", F.explode("all").alias("me"))
    other = F.when(F.col("all")[0]["word"] == F.col("me.word"), F.col("all")[1]).otherwise(F.col("all")[0])
    same = same.select(F.col("me.word").alias("word"), F.lit(None).cast("long").alias("own_n"), (F.size("all") - 1).cast("long").alias("n_near"), other.alias("best"))
    out = own.unionByName(here).unionByName(there).unionByName(back).unionByName(same).groupBy("word").agg(F.max("own_n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return out.select("word", "n", "n_near", (-F.col("best.down")).alias("best_n"), F.col("best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by doubling; every form is at least ``FORM_FACTOR`` times as frequent, so the rounds are few."""
    out, changed = durable(forms.select("word", F.col("form").alias("root"))), 1
    while changed:
        seen = Observation()
        further = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = out.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        out = durable(step.observe(seen, F.count_if("moved").alias("n"))).drop("moved")
        changed = seen.get.get("n", 0)
    return out


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the vocabulary of all texts.

    ``form``: of the words one edit apart the most frequent one, if it is
    ``FORM_FACTOR`` times as frequent as the word, else null; ``root``: where
    forms end.  A null text has no words, a null id is an empty one; repeated
    rows count again; of equally frequent forms the smallest counts; words of
    any length are taken whole; other columns, with any names, are ignored; an
    empty table gives no rows.
    """
    near = durable(near_words(vocabulary(docs, id_col, text_col)))
    is_form = F.col("best_n") >= FORM_FACTOR * F.col("n")
    near = near.select("word", F.when(is_form, F.col("best")).alias("form"), "n", "n_near", F.when(is_form, F.col("best_n")).alias("form_n"))
    last = roots(near.filter("form is not null"))
    return near.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: CRC-32 bit by bit, deletion neighbourhoods for pairs, and forms followed row by row.
ORACLE = f"""
WITH RECURSIVE d AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
r AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM d WHERE length(run) >= {LEAST_LENGTH}),
g AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS h FROM r GROUP BY id, run),
c AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda k: ('0x' || substr(h, (2 * k + 1)::BIGINT, 2))::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS crc FROM g),
s AS (SELECT CASE WHEN crc % {SPOILT} = 0 THEN substr(run, 1, (crc % length(run))::BIGINT) || substr(run, (crc % length(run) + 2)::BIGINT) ELSE run END AS word, n FROM c),
w AS (SELECT word, sum(n)::BIGINT AS n FROM s WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
x AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS hole FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.i = b.i AND a.hole = b.hole AND a.word <> b.word
      UNION SELECT x.word, w.word, w.n FROM x JOIN w ON x.hole = w.word UNION SELECT w.word, x.word, x.n FROM x JOIN w ON x.hole = w.word),
b AS (SELECT word, count(*) AS n_near, min((-near_n, near)) AS best FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= {FORM_FACTOR} * w.n THEN best[2] END AS form, CASE WHEN -best[1] >= {FORM_FACTOR} * w.n THEN -best[1] END AS form_n FROM w LEFT JOIN b USING (word)),
t AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT t.word, f.form, k + 1 FROM t JOIN f ON f.word = t.root WHERE f.form IS NOT NULL)
SELECT word, form, arg_max(root, k) AS root, n, n_near, form_n FROM f JOIN t USING (word) GROUP BY ALL
"""
