"""Byte-level BPE encoding by prefix-sharing trie traversal, and decoding.

The last token of a string's BPE encoding, and the encoding of what stands
before that token, determine each other: token ``t`` ends the encoding of a
prefix exactly if ``t`` is a suffix of it and BPE leaves the pair (last token
before it, ``t``) apart.  So one "last token" a prefix describes all
encodings.  New distinct words are visited in sorted order, which is a
depth-first walk of their trie: states of the shared prefix are on the stack
already and only the rest of the path is computed.

The vocabulary file is a parameter; the driver reads it and sends its content,
which each Python worker parses once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from geotide.llm._frames import documents
from geotide.llm._text import buffers, chunks

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Words, and pairs of tokens, that a worker remembers; beyond, it forgets all and computes them again.
WORDS_KEPT, PAIRS_KEPT = 400_000, 400_000
#: Bytes of text between two visits of the trie.
STEP_BYTES = 1 << 20
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def _classes() -> dict[str, list[int]]:
    """Code points of the letter, number and space classes, as the tokenizers library has them.

    The Unicode versions of the two libraries differ, so code points that are
    new in one of them are put to the library's own pre-tokeniser.
    """
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    found = {k: {ord(c) for c in regex.findall(p, text)} for k, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\p{White_Space}"))}
    new = sorted(c for c in found["L"] | found["N"] if unicodedata.category(chr(c)) == "Cn")
    pre = ByteLevel(add_prefix_space=False, use_regex=True)
    for i in range(0, len(new), 4000):
        block = new[i : i + 4000]
        for k, before in (("L", "a"), ("N", "1")):
            cuts = {x for _, (x, _) in pre.pre_tokenize_str("".join(f"{before}{chr(c)}!\n" for c in block))}
            found[k].difference_update(c for j, c in enumerate(block) if 4 * j + 1 in cuts)
    return {k: sorted(v) for k, v in found.items()}


@lru_cache(1)
def _splitters() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """The byte-level pre-tokeniser as standard-library patterns, for ASCII, the basic plane, and all code points.

    The first two are the third one restricted; character sets that stay
    within the basic plane are bitmaps, hence much faster.
    """
    classes = _classes()

    def pattern(top: int) -> re.Pattern:
        sets = {}
        for k, points in classes.items():
            spans: list[list[int]] = []
            for c in points:
                if c < top:
                    if spans and spans[-1][1] == c - 1:
                        spans[-1][1] = c
                    else:
                        spans.append([c, c])
            sets[k] = "".join(f"\\U{x:08x}-\\U{y:08x}" for x, y in spans)
        L, N, S = sets["L"], sets["N"], sets["S"]
        return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+")

    return pattern(0x80), pattern(0x10000), pattern(0x110000)


class Bpe:
    """A byte-level BPE vocabulary with its word and pair memories."""

    def __init__(self, content: str):
        spec = json.loads(content)
        # printable stand-ins of bytes in such files: printable Latin-1 stands for itself, the rest follow from 256 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        stand_in = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        vocab = {bytes(map(stand_in.__getitem__, t)): i for t, i in spec["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: list[bytes] = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for t, i in vocab.items():
            self.tokens[i] = t
        self.special = {s: array("I", [i]).tobytes() for s, i in special.items()}
        for s, i in special.items():
            self.tokens[i] = s.encode()
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.ids = vocab
        self.longest = max(map(len, vocab))
        self.rank: dict[int, int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            a, b = bytes(map(stand_in.__getitem__, a)), bytes(map(stand_in.__getitem__, b))
            pair = vocab[a], vocab[b]
            self.rank[pair[0] << 32 | pair[1]] = r
            made.setdefault(vocab[a + b], (r, *pair))
        self.made = made
        self.words: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.spines: dict[int, list[tuple[int, float]]] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one edge of ``token`` from its outermost byte up, each with the rank of the merge that ends it."""
        key = token * 2 + side - 1
        out = self.spines.get(key)
        if out is None:
            out, until = [], float("inf")
            while True:
                out.append((token, until))
                if token not in self.made:
                    break
                until, token = self.made[token][0], self.made[token][side]
            out.reverse()
            self.spines[key] = out
        return out

    def apart(self, left: int, right: int) -> bool:
        """Whether BPE keeps these neighbours: no merge across their border comes before those that build them up."""
        a, b = self._spine(left, 2), self._spine(right, 1)
        i, j, m, n, rank = 0, 0, len(a) - 1, len(b) - 1, self.rank
        ok = True
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            r = rank.get(x << 32 | y)
            if r is not None and r < x_until and r <= y_until:
                ok = False
                break
            if i == m and j == n:
                break
            if x_until <= y_until:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        self.pairs[left << 32 | right] = ok
        return ok

    def learn(self, new: set[str]) -> None:
        """Encodes words that aren't known yet, along their trie."""
        ids, apart, longest, tokens, pairs = self.ids, self.apart, self.longest, self.tokens, self.pairs
        before, last = b"", [-1]  # last[k]: last token of the encoding of the first k bytes on the path
        for word in sorted([w.encode() for w in new]):
            k, most = 0, min(len(word), len(before))
            while k < most and word[k] == before[k]:
                k += 1
            del last[k + 1 :]
            for end in range(k + 1, len(word) + 1):
                for start in range(end - 1, end - longest - 1 if end > longest else -1, -1):
                    t = ids.get(word[start:end])
                    if t is not None:
                        if start:
                            ok = pairs.get(last[start] << 32 | t)
                            if ok is None:
                                ok = apart(last[start], t)
                            if not ok:
                                continue
                        last.append(t)
                        break
                else:
                    raise ValueError(f"no encoding of {word[:end]!r}")
            before, at, out = word, len(word), array("I")
            while at:
                t = last[at]
                out.append(t)
                at -= len(tokens[t])
            out.reverse()
            self.words[word.decode()] = out.tobytes()

    @staticmethod
    def _split(text: str) -> list[str]:
        ascii_, basic, whole = _splitters()
        if text.isascii():
            return ascii_.findall(text)
        return (whole if _ASTRAL.search(text) else basic).findall(text)

    def pieces(self, text: str) -> list[str]:
        if self.special_at is None or "<|" not in text and not self.special_at.search(text):
            return self._split(text)
        out: list[str] = []
        for k, part in enumerate(self.special_at.split(text)):
            if k % 2:
                out.append(part)
            else:
                out += self._split(part)
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as unsigned 32-bit integers in native (little-endian) order."""
        split = [self.pieces(t) for t in texts]
        need = set().union(*split)
        new = need.difference(self.words)
        if len(self.words) + len(new) > WORDS_KEPT:
            self.words.clear()
            new = need
        self.words.update(self.special)
        self.learn(new.difference(self.special))
        get = self.words.__getitem__
        return [b"".join(map(get, s)) for s in split]

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the tokens, with what isn't UTF-8 replaced as decoders do."""
        tokens = self.tokens
        raw = b"".join([tokens[i] for i in memoryview(ids).cast("I")])
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
        return raw


@lru_cache(2)
def _parsed(content: str) -> Bpe:
    return Bpe(content)


def vocabulary(path: str) -> Bpe:
    return _parsed(Path(path).read_text(encoding="utf-8"))


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row for each input row; ``with_ids`` adds ids array<int>.

    A null text is empty: no tokens, the hashes of nothing.  Repeated rows
    give repeated results, a null id stays null, other columns are ignored.
    Special tokens written out in a text become those tokens, as the
    tokenizers library has it by default.  Texts are encoded whole; a word of
    any length costs its bytes times the longest token's.  Extra columns may
    have any names; an empty table gives no rows.  Rows are independent: the
    plan has no exchange.  ``vocab_path`` is read by the driver alone.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(vocab_path).read_text(encoding="utf-8"))
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _parsed(content.value)
        for b in it:
            _, offs = buffers(b["text"])
            for i, j in chunks(offs, STEP_BYTES):
                texts = [t or "" for t in b["text"].slice(i, j - i).to_pylist()]
                coded = bpe.encode_batch(texts)
                cols = [
                    b["doc_id"].slice(i, j - i),
                    pa.array([len(x) // 4 for x in coded], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in coded]),
                    pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in coded]),
                ]
                if with_ids:
                    cols.append(pa.array([list(memoryview(x).cast("I")) for x in coded], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names)

    return documents(docs, id_col, text_col).mapInArrow(run, schema)


def default_vocabulary() -> str:
    """The public 50k byte-level vocabulary; GEOTIDE_BPE_VOCAB names another."""
    own = os.environ.get("GEOTIDE_BPE_VOCAB")
    if own:
        return own
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op9(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
