"""Personal data, written out or disguised, found without losing its place.

Transducers rewrite a text step by step and keep for every character the part
of the original that it stands for: one makes homoglyphs plain, one undoes
"at" and "dot", one undoes spelled digits and signs and letters set for
digits.  The same detectors then run over the original and over what each
transducer made of it, and what they find is mapped back.

Detectors and transducers take time in proportion to the text: repetitions
don't backtrack, and no pattern looks for its end from every place of a run.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from geotide.llm._frames import documents
from geotide.llm._text import Chunk, text_chunks

SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: Takes single numbers as well, so that it doesn't start again within one.
IP = re.compile(r"([0-9]++)(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

# Characters of other scripts that look like a Latin letter or a sign, beside those that Unicode itself calls compatible.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕԁһӏԛԝАВЕКМНОРСТУХІЈЅαινορυκχΑΒΕΖΗΙΚΜΝΟΡΤΥΧıİɑɡօսհ。∙−⁻﹣",
        "aeopcyxijsdhlqwABEKMHOPCTYXIJSaivopukxABEZHIKMNOPTYXiIagouh..---",
        strict=True,
    )
)
# The digits in English, German, French and Spanish.
SPELLED = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "fuenf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
AT = ("at", "ät", "arroba", "arobase", "klammeraffe")
DOT = ("dot", "punkt", "point", "punto")
DASH = ("dash", "hyphen", "minus", "strich", "tiret", "guion")
CONFUSED = str.maketrans("OoIl", "0011")

_any = lambda words: "|".join(sorted(map(re.escape, words), key=len, reverse=True))
_OPEN, _CLOSE, _GAP = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}", r"[\s_]{1,3}"
_DOT_HIDDEN = rf"(?:{_OPEN}(?:{_any(DOT)}|\.){_CLOSE}|{_GAP}(?:{_any(DOT)}){_GAP}|\s{{1,3}}\.\s{{1,3}})"
MAIL_DOT = re.compile(rf"(?<=[A-Za-z0-9]){_DOT_HIDDEN}(?=[A-Za-z0-9])", re.I)
#: In brackets it is always meant; as a mere word only before a domain whose dot is hidden too, or in capitals after a small letter.
MAIL_AT = re.compile(
    rf"(?<=[A-Za-z0-9])(?:{_OPEN}(?i:{_any(AT)}|@){_CLOSE}(?=[A-Za-z0-9])|\s{{1,3}}@\s{{1,3}}(?=[A-Za-z0-9])"
    rf"|{_GAP}(?i:{_any(AT)}){_GAP}(?=[A-Za-z0-9-]{{1,63}}(?i:{_DOT_HIDDEN})[A-Za-z0-9])|(?<=[a-z0-9])\s{{1,3}}AT\s{{1,3}}(?=[a-z0-9-]{{1,63}}\.[a-z]))"
)
TOP_LEVEL = re.compile(r"\.[A-Za-z]{2,}\Z")
_ITEM = rf"(?<![A-Za-z0-9À-ÿ])(?:(double|triple)\s{{1,3}})?({_any(SPELLED)})(?![A-Za-z0-9À-ÿ])"
ITEM = re.compile(rf"{_ITEM}(?:[\s,;-]{{1,3}}(?={_ITEM}))?", re.I)
PLUS = re.compile(r"(?:(?<![A-Za-z0-9])plus|[\[(]\s?\+\s?[\])])\s{0,3}(?=[0-9(])", re.I)
_SIGN = rf"(?:({_DOT_HIDDEN})|{_GAP}(?:{_any(DASH)}){_GAP})(?=[0-9])"
NUMBER_SIGN = re.compile(rf"(?<=[0-9]){_SIGN}", re.I)
#: Quick looks at whether there is anything to undo.
HAS_PLUS, HAS_SIGN, HAS_CONFUSED = re.compile(r"[pP][lL][uU][sS]|\+\s?[\])]"), re.compile(rf"[0-9]{_SIGN}", re.I), re.compile(r"[0-9](?:[OoIl]|(?<=[OoIl][0-9]))")
CONFUSED_TOKEN = re.compile(r"(?<![A-Za-z0-9])(?:[0-9]++[OoIl]|[OoIl]++[0-9])[0-9OoIl]*+(?![A-Za-z0-9])")


def _emails(text: str) -> Iterator[Span]:
    done, before, at = 0, -1, text.find("@")
    while at >= 0:
        head = text[max(done, before + 1) : at]
        local = len(head) - len(head.rstrip(LOCAL))
        if local and (m := DOMAIN.match(text, at + 1)):
            yield "email", at - local, m.end()
            done = m.end()
        before, at = at, text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def _numbers(text: str) -> Iterator[Span]:
    for m in IP.finditer(text):
        if m.lastindex == 4 and all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.groups()):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := m.group().replace(" ", "").replace("-", "")) <= 19 and _luhn(digits):
            yield "card", *m.span()
    for m in PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(m.group())) <= 15:
            yield "phone", *m.span()


def find(text: str) -> list[Span]:
    """(kind, start, end) of what is written out in ``text``; leftmost, non-overlapping within a kind."""
    return [*_emails(text), *_numbers(text)]


class View:
    """A text and, for every code point, where the part of the original that it stands for starts and ends (None: itself)."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def span(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.starts is None else (int(self.starts[start]), int(self.ends[end - 1]))

    def rewritten(self, pattern: re.Pattern, value: Callable[[re.Match], str]) -> View:
        """Each match replaced; all characters of a replacement stand for the whole match.  Itself, if there is no match."""
        text, first, last, k = [], [], [], 0
        for m in pattern.finditer(self.text):
            new, same = value(m), np.arange(k, m.start())
            text += [self.text[k : m.start()], new]
            first += [same, np.full(len(new), m.start())]
            last += [same, np.full(len(new), m.end() - 1)]
            k = m.end()
        if not text:
            return self
        same = np.arange(k, len(self.text))
        at, to = np.concatenate([*first, same]), np.concatenate([*last, same])
        starts, ends = (at, to + 1) if self.starts is None else (self.starts[at], self.ends[to])
        return View("".join([*text, self.text[k:]]), starts, ends)


@functools.lru_cache(1 << 16)
def _plain(c: str) -> str:
    """What a character is taken for: a Latin letter, digit or sign, nothing, or itself."""
    if c < "\x80":
        return c
    kind = unicodedata.category(c)
    if kind == "Cf":  # of no width
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if kind == "Zs":
        return " "
    if kind == "Pd":
        return "-"
    if kind == "Nd":
        return str(unicodedata.decimal(c))
    like = unicodedata.normalize("NFKC", c)
    return like if c > "\xff" and len(like) == 1 and like < "\x7f" else c


def homoglyphs(view: View) -> View:
    """Every character that looks like a Latin letter, digit or sign made plain; characters of no width gone."""
    if view.text.isascii():
        return view
    change = {ord(c): p for c in set(view.text) if (p := _plain(c)) != c}
    if not change:
        return view
    text = view.text.translate(change)
    if len(text) == len(view.text):
        return View(text, view.starts, view.ends)
    code = np.frombuffer(view.text.encode("utf-32-le", "surrogatepass"), "<u4")
    at = np.flatnonzero(~np.isin(code, [c for c, p in change.items() if not p]))
    return View(text, *((at, at + 1) if view.starts is None else (view.starts[at], view.ends[at])))


def mail_signs(view: View) -> View:
    """Hidden "at" and "dot" undone."""
    out = view.rewritten(MAIL_AT, lambda m: "@")
    return out.rewritten(MAIL_DOT, lambda m: ".") if "@" in out.text else view


def digits(view: View, spelled: bool = True) -> View:
    """Spelled digits (if there are any), "plus", "dot" and "dash" among digits, and letters set for digits undone."""
    times = {"double": 2, "triple": 3}
    if spelled:
        view = view.rewritten(ITEM, lambda m: str(SPELLED[m.group(2).lower()]) * times.get((m.group(1) or "").lower(), 1))
    for there, pattern, value in (
        (HAS_CONFUSED, CONFUSED_TOKEN, lambda m: m.group().translate(CONFUSED)),
        (HAS_PLUS, PLUS, lambda m: "+"),
        (HAS_SIGN, NUMBER_SIGN, lambda m: "." if m.group(1) else "-"),
    ):
        if there.search(view.text):
            view = view.rewritten(pattern, value)
    return view


def scan(text: str, mail: bool = True, spelled: bool = True) -> tuple[list[Span], list[Span]]:
    """(spans written out, all spans), each by kind and start; ``mail``, ``spelled``: whether there may be a hidden "at", a spelled digit."""
    order = lambda x: (KINDS.index(x[0]), x[1], x[2])
    base = sorted(find(text), key=order)
    every = set(base)
    original = View(text)
    plain = homoglyphs(original)
    views = [(plain, _emails), (mail_signs(plain), _emails)] if mail else [(plain, _emails)]
    for view, finds in (*views, (plain, _numbers), (digits(plain, spelled), _numbers)):
        if view is not original:
            every.update((kind, *view.span(s, e)) for kind, s, e in finds(view.text) if kind != "email" or TOP_LEVEL.search(view.text, s, e))
    return base, sorted(every, key=order)


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


_IS_DIGIT, _IS_SPACE = _table((48, 57)), _table((9, 13), (28, 32), (95, 95))
_IS_TOKEN = _table((48, 57), (65, 90), (97, 122), (128, 255))
_FOREIGN = _table((0xC2, 0xC2), (0xC4, 0xFF))
_IS_OPEN = np.zeros(256, bool)
_IS_OPEN[list(b"[({<")] = True
_SMALL = np.uint64(0x2020202020202020)  # turns capitals into small letters, those from U+00C0 on as well
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _word_keys(words) -> np.ndarray:
    """Each word's first eight bytes in small letters, and 0 for one of another length."""
    code = [int.from_bytes(w.encode()[:8], "little") for w in words]
    return np.unique((np.array(code, np.uint64) | _SMALL) & np.array([_KEEP[min(8, len(w.encode()))] for w in words]))


_SPELLED_KEYS, _AT_KEYS, _DOT_KEYS = map(_word_keys, (SPELLED, AT, DOT))


def _before(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The byte before each place, white space skipped."""
    at = at - 1
    for _ in range(3):
        at = np.where(_IS_SPACE[buf[at]], at - 1, at)
    return buf[at]


def _signs(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks the texts that may hold something, a hidden "at", and a spelled digit; what isn't marked holds nothing.

    An address needs an "@" or an "at", and this in brackets, in capitals, or
    with a hidden dot; a number needs four digits, spelled or not; and
    characters of other scripts may stand for any of them.
    """
    buf = np.concatenate([np.zeros(8, np.uint8), c.buf, np.zeros(8, np.uint8)])
    start, end = c.runs(_IS_TOKEN)
    size = end - start
    some = np.flatnonzero((size > 1) & (size < 13))
    start, size = start[some], np.minimum(size[some], 8)
    first = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))[start + 8]
    key = (first | _SMALL) & _KEEP[size]

    def per_text(at: np.ndarray) -> np.ndarray:
        return np.bincount(c.text_of(at), minlength=c.n)

    spelled, at, dot = (np.isin(key, keys) for keys in (_SPELLED_KEYS, _AT_KEYS, _DOT_KEYS))
    shown = at & (_IS_OPEN[_before(buf, start + 8)] | (first & _KEEP[2] == int.from_bytes(b"AT", "little")))
    points = np.flatnonzero(c.buf == 0x2E)
    points = points[_IS_SPACE[buf[points + 7]] & _IS_SPACE[buf[points + 9]] | _IS_OPEN[_before(buf, points + 8)]]
    foreign, spelled = c.count(_FOREIGN) > 0, per_text(start[spelled])
    mail = foreign | (c.count(_table((0x40, 0x40))) > 0) | (per_text(start[shown]) > 0) | (per_text(start[at]) > 0) & (per_text(np.concatenate([start[dot], points])) > 0)
    plain = c.count(_IS_DIGIT)
    return mail | (plain >= 4) | (spelled > 0) & (plain + 3 * spelled >= 4), mail, foreign | (spelled > 0)


def _batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    join = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for b in it:
        for i, j, c in text_chunks(b["text"]):
            n = j - i
            counts = np.zeros((len(KINDS), n), np.int64)
            digest, spans = [nothing] * n, [""] * n
            any_sign, mail, spelled = _signs(c)
            hit = np.flatnonzero(any_sign)
            for k, text in zip(hit.tolist(), b["text"].slice(i, n).take(pa.array(hit)).to_pylist(), strict=True):
                base, every = scan(text, bool(mail[k]), bool(spelled[k]))
                for kind, _, _ in base:
                    counts[KINDS.index(kind), k] += 1
                if base:
                    digest[k] = hashlib.sha256(join(base).encode()).hexdigest()
                spans[k] = join(every)
            yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, n), *map(pa.array, counts), pa.array(digest), pa.array(spans)], names)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: counts and digest of the personal data written out, and the spans of all that is found, disguised or not.

    Offsets are code points, end exclusive; ties (spans of one kind at one
    start) come by their ends.  A null text is empty and has no spans;
    repeated rows give repeated results; long texts are scanned whole, in time
    that grows with their length; other columns, with any names, are ignored;
    an empty table gives no rows.  Rows are independent, the plan has no
    exchange.
    """
    return documents(docs, id_col, text_col).mapInArrow(_batches, SCHEMA)


def op11(spark, sf_dir: str) -> DataFrame:
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
