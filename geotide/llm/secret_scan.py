"""Secret scan with a recursive decoding worklist.

A text is scanned for secrets, and every encoded piece in it (percent escapes,
Unicode escapes, base64, compressed bytes) is decoded into a new layer, which
goes through the same scan, until no layer yields another.  Layers keep for
every code point the span of the original text it came from, so what is found
in any depth is reported as a span of the original.  A layer seen before (same
text from the same place) is not visited again.

Escapes within escapes are undone to their end in one pass with a stack, so a
chain of them takes time in proportion to its length; the text with one level
undone is a layer too.  Of decoded bytes that aren't text, only the runs of
text are kept.

Texts without any sign of a secret or an encoding, the great majority, are
told by numpy and byte searches over whole batches and cost no regular
expression.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from geotide.llm._frames import documents
from geotide.llm._text import Chunk, text_chunks

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long"
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that are long enough
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: The lines of base64 after a run, and the parts of a run between the punctuation of its alphabets.
NEXT_LINES = re.compile(r"(?:[ \t]*(?:\r\n?|\n)[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
BASE64_PART = re.compile(r"[A-Za-z0-9+]{16,}={0,2}")
PERCENT_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"((?:\\u[0-9A-Fa-f]{4})+)|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}")
#: What a chain of escapes is made of.
CHAIN = re.compile(r"[%\\][%\\uUx{}0-9A-Fa-f]+")
_HEX = {ord(c): int(c, 16) for c in "0123456789abcdefABCDEF"}
#: Bytes as source code writes them: the hexadecimal, octal and short escapes.
BYTE_ESCAPE = re.compile(r"""\\(?:x([0-9A-Fa-f]{2})|u00([0-9A-Fa-f]{2})|([0-3][0-7]{2}|[0-7]{1,2})|([abefnrtv\\'"/]))""")
SHORT = dict(zip("abefnrtv\\'\"/", [b"\a", b"\b", b"\x1b", b"\f", b"\n", b"\r", b"\t", b"\v", b"\\", b"'", b'"', b"/"], strict=True))
#: What gzip, zlib, bzip2 and xz streams start with.
_FLAGS = lambda c: b"".join(re.escape(bytes([f])) for f in range(256) if (c * 256 + f) % 31 == 0 and not f & 32)
_OTHERS = {b"BZh": bz2.BZ2Decompressor, b"\xfd7z": lzma.LZMADecompressor}
HEADER = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|" + b"|".join(re.escape(bytes([c])) + b"[" + _FLAGS(c) + b"]" for c in range(8, 128, 16)))
#: Text among other bytes, in ASCII and its wider forms: secrets and runs of base64 take at least 16 characters, compressed streams in escapes 10.
TEXT_RUN = re.compile(rb"[\t\n\r -~]{10,}+")
WIDE_RUN = re.compile(rb"(?:[\t\n\r -~]\x00{3}){9,}[\t\n\r -~]()|(?:[\t\n\r -~]\x00){9,}[\t\n\r -~]?")
#: Bytes of compressed input read at once, and about how many unpacked ones are looked at together.
READ_BYTES, WINDOW_BYTES = 1 << 16, 1 << 22
#: A place that no secret and no encoded piece goes across: after a byte that is part of none, or between words neither of which ends in an escape.
BREAK = re.compile(rb"""[^0-9A-Za-z+/_.=:"'\s%\\~\x00-]|\s[^\s%\\]*[0-9A-Za-z]\x00{0,3}\x20(?=\x00{0,3}[0-9A-Za-z])""")
#: Compressed streams in escapes may hold any byte, so nothing is cut behind the start of one.
ESCAPED_HEADER = re.compile(rb"(?:%|\\x|\\u00)1f(?:%|\\x|\\u00)8b|\\0?37\\213|(?:[8HXhx(\x08\x18]|(?:%|\\x|\\u00)[0-7]8|\\b)(?:%|\\x|\\u00|\\[0-3])[0-9a-f]{2}", re.I)

_RUN = np.zeros(256, bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True
_ALPHABET = frozenset(map(chr, np.flatnonzero(_RUN).tolist()))
_STANDARD = bytes.maketrans(b"-_", b"+/")
_NOT_PRINTABLE = bytes(b for b in range(32) if b not in (9, 10, 13)) + b"\x7f"


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets written out in ``text``; leftmost, non-overlapping within a kind."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


Where = "np.ndarray | int | None"  # for each code point or byte its bound in the original; an int: the same for all; None: itself
Layer = tuple  # text, and where each code point starts and ends; True after them if its escapes have been looked at


def _at(layer: Layer, start: int, end: int) -> tuple[int, int]:
    starts, ends = layer[1:3]
    if starts is None:
        return start, end
    return (starts, ends) if isinstance(starts, int) else (int(starts[start]), int(ends[end - 1]))


def _places(layer: Layer, first: np.ndarray, last: np.ndarray) -> tuple[Where, Where]:
    """Where the pieces from code point ``first`` to ``last`` of a layer start and end in the original."""
    starts, ends = layer[1:3]
    if starts is None:
        return first, last + 1
    return (starts, ends) if isinstance(starts, int) else (starts[first], ends[last])


def _sizes(text: str) -> np.ndarray:
    """Bytes of each code point."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where((c >= 0xDC80) & (c < 0xDD00), 1, 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)).astype(np.int64)


def _encoded(text: str, start: int, end: int) -> tuple[bytes, np.ndarray]:
    """The bytes of ``text[start:end]`` and each one's code point."""
    part = text[start:end]
    if part.isascii():
        return part.encode(), np.arange(start, end)
    return part.encode("utf-8", "surrogateescape"), np.repeat(np.arange(start, end), _sizes(part))


def _clean(raw: bytes) -> bool:
    """Whether all of the bytes are text."""
    if not raw or len(raw.translate(None, _NOT_PRINTABLE)) < len(raw):
        return False
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


def _texts(raw: bytes, starts: Where, ends: Where) -> Iterator[Layer]:
    """Decoded bytes as layers: read as UTF-8 if all of them are, else their runs of text (what is looked for takes ten characters in a row); and as UTF-16 or UTF-32."""
    one = isinstance(starts, int)
    if _clean(raw):
        text = raw.decode()
        if one:
            yield text, starts, ends
        else:
            size = _sizes(text)
            end = np.cumsum(size)
            yield text, starts[end - size], ends[end - 1]
    elif runs := [m.span() for m in TEXT_RUN.finditer(raw)]:
        text = "\ufffd".join(raw[a:b].decode() for a, b in runs)
        if one:
            yield text, starts, ends
        else:
            at = np.concatenate([np.arange(a, b + 1) for a, b in runs])[:-1]  # with the byte after each run for what lies between
            yield text, starts[at], ends[at]
    for m in WIDE_RUN.finditer(raw) if b"\0" in raw else ():
        at = np.arange(*m.span(), m.lastindex and 4 or 2)
        yield m.group().replace(b"\0", b"").decode("ascii"), *((starts, ends) if one else (starts[at], ends[at]))


def _unpacked(raw: bytes, start: int) -> Iterator[tuple[bytes, int, bool]]:
    """The compressed streams that follow one another from ``start`` on, in pieces: (unpacked bytes, end of what has been read, whether a stream ends there).

    Of a damaged stream, what comes before the damage.
    """
    end, ended = start, True
    while ended and HEADER.match(raw, end):
        if other := _OTHERS.get(raw[end : end + 3]):
            ended = False
            for out, end, ended in _unpacked_whole(raw, end, other()):
                yield out, end, ended
            continue
        z, at, rest, ended = zlib.decompressobj(47), end, b"", False
        while not z.eof:
            if not rest:
                rest = raw[at : at + READ_BYTES]
                at += len(rest)
            last, before = not rest, z.copy()
            try:
                out = z.decompress(rest, READ_BYTES << 4)
            except zlib.error:
                for k in range(len(rest)):
                    try:
                        out = before.decompress(rest[k : k + 1])
                    except zlib.error:
                        return
                    yield out, at - len(rest) + k + 1, False
                return
            rest = z.unconsumed_tail
            end = at - len(rest) - len(z.unused_data)
            if last and not out:
                break
            yield out, end, z.eof
        ended = z.eof


def _unpacked_whole(raw: bytes, at: int, z: bz2.BZ2Decompressor | lzma.LZMADecompressor) -> Iterator[tuple[bytes, int, bool]]:
    """One bzip2 or xz stream, as ``_unpacked``."""
    while not z.eof:
        piece = raw[at : at + READ_BYTES] if z.needs_input else b""
        if z.needs_input and not piece:
            return
        at += len(piece)
        try:
            out = z.decompress(piece, READ_BYTES << 4)
        except (OSError, EOFError, lzma.LZMAError):
            return
        yield out, at - len(z.unused_data), z.eof


def _raw_deflate(raw: bytes) -> Iterator[bytes]:
    """What a deflate stream without a header unpacks to, in pieces; an error if it is none."""
    z, rest = zlib.decompressobj(-15), raw
    while not z.eof:
        out = z.decompress(rest, READ_BYTES << 4)
        rest = z.unconsumed_tail
        if not out and not rest:
            break
        yield out
    if not z.eof or z.unused_data:
        raise zlib.error("not one whole stream")


def _is_raw_deflate(raw: bytes) -> bool:
    """Whether ``raw`` is a deflate stream without a header from end to end, of which the first piece is text."""
    try:
        pieces = _raw_deflate(raw)
        first = next(pieces, b"")
        return len(first) >= 10 and any(_clean(first[: len(first) - k]) for k in range(4)) and sum(map(len, pieces)) >= 0
    except zlib.error:
        return False


def _extent(raw: bytes, start: int) -> tuple[int, bool, bool]:
    """End of the streams from ``start`` on, whether the last whole one ends there, and whether one is cut off by the end of the bytes."""
    end, last, ended = start, start, False
    for _, last, ended in _unpacked(raw, start):
        end = last if ended else end
    return (end, True, False) if ended else (max(end, last), end > start, last == len(raw))


def _last_break(raw: bytes, end: int) -> int:
    """The last place up to ``end`` that no secret and no encoded piece goes across; 0: none."""
    for size in (1 << 12, 1 << 16, end):
        low, cut = max(0, end - size), 0
        for m in BREAK.finditer(raw, low, end):
            cut = m.end()
        if cut or not low:
            return cut
    return 0


def _cut(raw: bytes) -> int:
    """Where unpacked bytes that go on may be cut; 0: nowhere yet."""
    cut = _last_break(raw, len(raw))
    if (b"%" in raw or b"\\" in raw) and (m := ESCAPED_HEADER.search(raw, 0, cut)):
        cut = _last_break(raw, m.start())
    k = 0
    while (m := HEADER.search(raw, k)) and m.start() < cut:
        end, whole, cut_off = _extent(raw, m.start())
        k = max(end, m.end()) if whole else m.start() + 1
        if cut_off or whole and end > cut:
            return _last_break(raw, m.start())
    return cut


def _windows(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Unpacked bytes in parts of about WINDOW_BYTES, cut only between secrets and encoded pieces; longer where there is no such place."""
    held, least = bytearray(), WINDOW_BYTES
    for piece in pieces:
        held += piece
        if len(held) >= least:
            raw = bytes(held)
            if cut := _cut(raw):
                yield raw[:cut]
                del held[:cut]
            least = max(WINDOW_BYTES, 2 * len(held))
    if held:
        yield bytes(held)


def _found(raw: bytes) -> list[tuple[int, int, bool]]:
    """(start, end, whether it is whole) of the compressed streams in ``raw``."""
    out, k = [], 0
    while m := HEADER.search(raw, k):
        q, whole, _ = _extent(raw, m.start())
        if q > m.start():
            out.append((m.start(), q, whole))
        k = q if whole else m.start() + 1
    return out


def _inner(raw: bytes, streams: list[tuple[int, int, bool]], starts: Where, ends: Where, span: tuple[int, int], seen: set) -> Iterator[tuple]:
    """The bytes that compressed streams in ``raw`` unpack to, window by window."""
    for p, q, whole in streams:
        s, e = span if isinstance(starts, int) else (span[0] if p == 0 else int(starts[p]), span[1] if q == len(raw) else int(ends[q - 1]))
        key = (hashlib.blake2b(raw[p:q], digest_size=16).digest(), s, e)
        if key not in seen:
            seen.add(key)
            for w in _windows(x for x, _, _ in _unpacked(raw, p)):
                yield w, s, e, (s, e), whole


def _layers(raw: bytes, starts: Where, ends: Where, span: tuple[int, int], own: bool = True, looked_at: bool = False) -> Iterator[Layer]:
    """The texts that decoded bytes hold: their own (``own``; ``looked_at``: its escapes have been), and those of compressed streams in them at any depth.

    ``span``: where the whole piece lies in the original.  One window of each
    depth is held at a time; a stream met again in the same place is skipped.
    """
    seen, stack = set(), [iter([(raw, starts, ends, span, own)])]
    while stack:
        piece = next(stack[-1], None)
        if piece is None:
            stack.pop()
            continue
        raw, starts, ends, span, whole = piece
        streams, plain = _found(raw), raw
        if any(ended for *_, ended in streams):  # compressed bytes are no text
            plain = bytearray(raw)
            for p, q, ended in streams:
                if ended:
                    plain[p:q] = b"\xff" * (q - p)
            plain = bytes(plain)
        # what only begins like a stream by chance gives no short texts
        if whole or len(stack) > 1 and (TEXT_RUN.search(plain) or WIDE_RUN.search(plain)):
            yield from ((*x, True) if looked_at and len(stack) == 1 else x for x in _texts(plain, starts, ends))
        stack.append(_inner(raw, streams, starts, ends, span, seen))


def _first_line(text: str, k: int, least: int) -> int:
    """Where the lines of base64 begin whose last one begins at ``k``; not before ``least``."""
    while True:
        j = k
        while j > least and text[j - 1] in " \t":
            j -= 1
        if j == least or text[j - 1] not in "\r\n":
            return k
        j -= 2 if text[max(j - 2, least) : j] == "\r\n" else 1
        while j > least and text[j - 1] in " \t":
            j -= 1
        end = j
        while j > least and text[j - 1] in _ALPHABET:
            j -= 1
        if j == end:
            return k
        k = j


def _base64(layer: Layer) -> Iterator[Layer]:
    """Lines of base64 that follow one another are one run; those that aren't clean together are also read alone."""
    text, done = layer[0], 0
    for m in BASE64.finditer(text):
        if m.start() < done:
            continue
        start, more = _first_line(text, m.start(), done), None if m.group()[-1] == "=" else NEXT_LINES.match(text, m.end())
        done = more.end() if more else m.end()
        clean = yield from _run(layer, start, done)
        if not clean and (start, done) != m.span():
            for r in BASE64.finditer(text, start, done):
                yield from _run(layer, *r.span())


def _run(layer: Layer, start: int, end: int) -> Generator[Layer, None, bool]:
    """The layers of one run; returns whether it is clean: text or a compressed stream from its first character on.

    A run that isn't may have taken in neighbours, so its parts between the
    alphabet's punctuation and its four alignments are decoded as well.
    """
    if (yield from _decoded(layer, start, end, 0)):
        return True
    for p in BASE64_PART.finditer(layer[0], start, end):
        if p.span() != (start, end):
            yield from _decoded(layer, *p.span(), 0, only_clean=True)
    for skip in (1, 2, 3):
        yield from _decoded(layer, start, end, skip)
    return False


def _decoded(layer: Layer, start: int, end: int, skip: int, only_clean: bool = False) -> Generator[Layer, None, bool]:
    """The layers of a run without its first ``skip`` characters; returns whether it is clean."""
    codes = layer[0][start:end].encode().translate(_STANDARD, b"= \t\r\n")[skip:]
    codes = codes[: len(codes) - (len(codes) % 4 == 1)]
    raw = base64.b64decode(codes + b"=" * (-len(codes) % 4))
    text = _clean(raw)
    if not text and not only_clean and _is_raw_deflate(raw):
        place = _at(layer, start, end)
        for w in _windows(_raw_deflate(raw)):
            yield from _layers(w, *place, place)
        return True
    if not (text and not skip or TEXT_RUN.search(raw) or WIDE_RUN.search(raw) or HEADER.search(raw)):
        return False
    clean = text or _extent(raw, 0)[1]
    if clean or not only_clean:
        at = start + np.flatnonzero(_RUN[np.frombuffer(layer[0][start:end].encode(), np.uint8)])[skip:]
        i = np.arange(len(raw))
        yield from _layers(raw, *_places(layer, at[i * 4 // 3], at[(i * 8 + 7) // 6]), _at(layer, int(at[0]), end))
    return clean


def _percent(layer: Layer) -> Iterator[Layer]:
    """The whole text with its percent escapes replaced in place, once."""
    n = len(layer[0])
    raw, first, last = _unescaped(layer[0], 0, n, PERCENT_ESCAPE, lambda e: (bytes.fromhex(e.group().replace("%", "")), 3))
    yield from _layers(raw, *_places(layer, first, last), _at(layer, 0, n), looked_at=True)


def _chain(text: str, start: int, percent: bool, unicode: bool) -> tuple[list[int], list[int], list[int]]:
    """What a run of escapes comes to when no escape is left: code points (bytes of percent escapes from 0x80 on: below 0), and the first and last code point of each.

    The characters go on a stack; an escape that its last character completes
    is replaced by what it stands for, which may complete another one.
    """
    value, first, last = [], [], []
    for k, c in enumerate(map(ord, text), start):
        value.append(c)
        first.append(k)
        last.append(k)
        while True:
            n, top = 0, value[-1]
            if top in _HEX:
                if percent and len(value) > 2 and value[-3] == 37 and value[-2] in _HEX:
                    n, code = 3, 16 * _HEX[value[-2]] + _HEX[top]
                    code = code if code < 128 else -code
                elif unicode:
                    for size, mark in ((4, 120), (6, 117), (10, 85)):
                        if len(value) >= size and value[-size] == 92 and value[1 - size] == mark and all(v in _HEX for v in value[2 - size :]):
                            n, code = size, 0
                            for v in value[2 - size :]:
                                code = 16 * code + _HEX[v]
            elif unicode and top == 125:
                d = next((d for d in range(1, 7) if len(value) >= d + 4 and value[-d - 2] == 123), 0)
                if d and value[-d - 4 : -d - 2] == [92, 117] and all(v in _HEX for v in value[-d - 1 : -1]):
                    n, code = d + 4, 0
                    for v in value[-d - 1 : -1]:
                        code = 16 * code + _HEX[v]
            if not n:
                break
            code = code if code < 0x110000 else 0xFFFD
            begin = first[-n]
            del value[-n:], first[-n:], last[-n:]
            if 0xDC00 <= code < 0xE000 and value and 0xD800 <= value[-1] < 0xDC00:
                code = 0x10000 + ((value.pop() - 0xD800) << 10) + code - 0xDC00
                begin = first.pop()
                last.pop()
            value.append(code)
            first.append(begin)
            last.append(k)
    return value, first, last


def _to_the_end(layer: Layer, percent: bool, unicode: bool) -> Iterator[Layer]:
    """The whole text with escapes of some kinds replaced in place until none is left."""
    old, n = layer[0], len(layer[0])
    raw, first, last, k = [], [], [], 0
    for m in CHAIN.finditer(old):
        plain, at = _encoded(old, k, m.start())
        raw.append(plain)
        first.append(at)
        last.append(at)
        value, start, end = _chain(m.group(), m.start(), percent, unicode)
        pieces = [bytes([-v]) if v < 0 else (chr(v) if not 0xD800 <= v < 0xE000 else "\ufffd").encode() for v in value]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw += pieces
        first.append(np.repeat(np.array(start, np.int64), sizes))
        last.append(np.repeat(np.array(end, np.int64), sizes))
        k = m.end()
    plain, at = _encoded(old, k, n)
    first, last = np.concatenate([*first, at]), np.concatenate([*last, at])
    yield from _layers(b"".join([*raw, plain]), *_places(layer, first, last), _at(layer, 0, n), looked_at=True)


def _unescaped(text: str, start: int, end: int, escape: re.Pattern, value) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The bytes of ``text[start:end]`` with escapes replaced, and each one's first and last code point.

    ``value(match)``: the bytes of an escape, and how many code points stand for each.
    """
    raw, first, last, k = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], start
    for e in escape.finditer(text, start, end):
        plain, at = _encoded(text, k, e.start())
        body, width = value(e)
        where = e.start() + width * np.arange(len(body))
        raw += [plain, body]
        first += [at, where]
        last += [at, where + width - 1]
        k = e.end()
    plain, at = _encoded(text, k, end)
    return b"".join([*raw, plain]), np.concatenate([*first, at]), np.concatenate([*last, at])


def _byte_escape(e: re.Match) -> tuple[bytes, int]:
    code, short = e.group(1) or e.group(2), e.group(4)
    body = bytes([int(code, 16)]) if code else bytes([int(e.group(3), 8)]) if e.group(3) else SHORT[short]
    return body, len(e.group())


def _escapes(layer: Layer) -> Iterator[Layer]:
    """The whole text with its Unicode escapes replaced in place, once."""
    old, n = layer[0], len(layer[0])
    text, first, last, k = [], [], [], 0
    for e in ESCAPE.finditer(old):
        if e.group(1):
            units = bytes.fromhex(e.group(1).replace("\\u", ""))
            piece = units.decode("utf-16-be", "replace")
            wide = np.fromiter((12 if c > "\uffff" else 6 for c in piece), np.int64, len(piece))
            end = e.start() + np.cumsum(wide)
            start = end - wide
        else:
            code = int(e.group(2) or e.group(3) or e.group(4), 16)
            piece = chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"
            start, end = np.array([e.start()]), np.array([e.end()])
        same = np.arange(k, e.start())
        text += [old[k : e.start()], piece]
        first += [same, start]
        last += [same, end - 1]
        k = e.end()
    if text:
        same = np.arange(k, n)
        yield "".join([*text, old[k:]]), *_places(layer, np.concatenate([*first, same]), np.concatenate([*last, same])), True


def _escaped_bytes(layer: Layer) -> Iterator[Layer]:
    """The streams in bytes that are written as escapes."""
    n = len(layer[0])
    raw, first, last = _unescaped(layer[0], 0, n, BYTE_ESCAPE, _byte_escape)
    yield from _layers(raw, *_places(layer, first, last), _at(layer, 0, n), own=False)


def _pieces(layer: Layer) -> Iterator[Layer]:
    """The layers within a layer.  Those that only undo its escapes hold none that have to be undone again."""
    text = layer[0]
    yield from _base64(layer)
    if "\\" in text:
        yield from _escaped_bytes(layer)
    if len(layer) > 3:
        return
    percent, unicode = bool(PERCENT_ESCAPE.search(text)), bool(ESCAPE.search(text))
    if percent:
        yield from _percent(layer)
    if unicode:
        yield from _escapes(layer)
    for kinds in {(percent, False), (False, unicode), (percent or unicode, percent or unicode)} - {(False, False)}:
        yield from _to_the_end(layer, *kinds)


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """(base spans, all spans, number of decoded layers), sorted by start and kind; each window of a long stream is a layer."""
    order = lambda x: (x[1], KINDS.index(x[0]), x[2])
    base = find(text)
    every, seen, work, layers = set(base), set(), [_pieces((text, None, None))], 0
    while work:
        new = next(work[-1], None)
        if new is None:
            work.pop()
            continue
        if not new[0]:
            continue
        key = (hashlib.blake2b(new[0].encode("utf-8", "surrogateescape"), digest_size=16).digest(), *_at(new, 0, len(new[0])))
        if key in seen:
            continue
        seen.add(key)
        layers += 1
        every.update((kind, *_at(new, s, e)) for kind, s, e in find(new[0]))
        work.append(_pieces(new))
    return sorted(base, key=order), sorted(every, key=order), layers


def _suspects(c: Chunk) -> np.ndarray:
    """Marks the texts that may hold a secret or an encoded piece; all others hold none."""
    hit = np.zeros(c.n, bool)
    start, end, of = c.words(_RUN)
    hit[of[end - start >= 16]] = True  # base64, hex and access keys are such runs
    raw = c.buf.tobytes()
    at: list[int] = []
    low = raw.lower()
    for body, words in ((low, KEYWORDS), (raw, (b"\\",))):
        for w in words:
            k = body.find(w)
            while k >= 0:
                at.append(k)
                k = body.find(w, k + 1)
    pct = np.flatnonzero(c.buf == 0x25)
    pct = pct[pct < len(c.buf) - 2]
    is_hex = np.zeros(256, bool)
    is_hex[list(b"0123456789abcdefABCDEF")] = True
    pct = pct[is_hex[c.buf[pct + 1]] & is_hex[c.buf[pct + 2]]]
    hit[c.text_of(np.concatenate([np.array(at, np.int64), pct]).astype(np.int64))] = True
    return hit


def _batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    join = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for b in it:
        for i, j, c in text_chunks(b["text"]):
            n = j - i
            counts = np.zeros((4, n), np.int64)
            digest, spans = [nothing] * n, [""] * n
            hit = np.flatnonzero(_suspects(c))
            for k, text in zip(hit.tolist(), b["text"].slice(i, n).take(pa.array(hit)).to_pylist(), strict=True):
                base, every, layers = scan(text)
                for kind, _, _ in base:
                    counts[KINDS.index(kind), k] += 1
                counts[3, k] = layers
                if base:
                    digest[k] = hashlib.sha256(join(base).encode()).hexdigest()
                spans[k] = join(every)
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, n), *map(pa.array, counts[:3]), pa.array(digest), pa.array(spans), pa.array(counts[3])], names)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: counts and digest of the secrets written out, and the spans of all that decoding shows.

    Offsets are code points, end exclusive.  A null text is empty and yields
    no spans; repeated rows give repeated results, ties (spans at one place)
    come in the order of the kinds; other columns, with any names, are
    ignored; an empty table gives no rows.  Long texts are scanned whole in
    time that grows with their length, and compressed pieces in windows, so a
    bomb takes time but not memory.  Rows are independent, the plan has no exchange.
    """
    return documents(docs, id_col, text_col).mapInArrow(_batches, SCHEMA)


def op2(spark, sf_dir: str) -> DataFrame:
    return secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
