"""Personal data: what is written out against plain patterns, what is disguised against hand-made and random texts."""

import hashlib
import random
import re
import time

import pyarrow as pa
import pytest

from geotide.llm import pii


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    plain = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(plain(m)) <= 19 and luhn(plain(m))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(plain(m)) <= 15]
    return out


ALPHABET = [
    "@", ".", "1", "2", "25", "4", "+", "-", " ", "(", ")", "a", "b_", "%", "é", "\n", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 555-0199", "a@b.co", "٤", "x@y", " at ", " AT ", " dot ", "[at]", "{ dot }",
    "one ", "two ", "six.", "double ", "O", "l", "(dot)", "plus ", "​", "а", " . ", "_at_", "\xa0", "\xad", "fünf,", "ZÉRO-", "0.0.0.1", "\x1c", "\U0001F600",
]


def texts(n):
    rng = random.Random(n)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_written_out():
    for t in texts(5000):
        assert sorted(pii.find(t)) == sorted(brute(t)), t


DISGUISED = [
    ("mail jane dot doe at example dot com now", "email", "jane dot doe at example dot com"),
    ("to jane.doe [at] example [dot] com.", "email", "jane.doe [at] example [dot] com"),
    ("jane(at)example.com", "email", "jane(at)example.com"),
    ("jane AT example.com", "email", "jane AT example.com"),
    ("juan arroba correo punto es", "email", "juan arroba correo punto es"),
    ("ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("an jаne@exаmple.com.", "email", "jаne@exаmple.com"),
    ("us​er@exa­mple.com", "email", "us​er@exa­mple.com"),
    ("call plus one five five five two zero one nine eight seven six", "phone", "plus one five five five two zero one nine eight seven six"),
    ("+١ ٥٥٥ ٥٥٥ ٠١٩٩", "phone", "+١ ٥٥٥ ٥٥٥ ٠١٩٩"),
    ("vier eins eins eins, eins eins eins eins eins eins eins eins eins eins eins eins!", "card", "vier eins eins eins, eins eins eins eins eins eins eins eins eins eins eins eins"),
    ("pay 4l11 1111 1111 1111 now", "card", "4l11 1111 1111 1111"),
    ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("on one nine two dot one six eight dot one dot one up", "ip", "one nine two dot one six eight dot one dot one"),
    ("192[.]168 dot 1 . 1", "ip", "192[.]168 dot 1 . 1"),
]


@pytest.mark.parametrize(("text", "kind", "what"), DISGUISED)
def test_disguised(text, kind, what):
    base, every = pii.scan(text)
    assert not base and [(k, text[s:e]) for k, s, e in every] == [(kind, what)]


@pytest.mark.parametrize("text", ["look at example.com today", "un point sur six, deux ou trois", "one two three", "follow us @example.com", "in 2005 I saw 12 of 4", "plus one dot com", "meet at dot"])
def test_clean(text):
    assert pii.scan(text) == ([], [])


def test_plain_ones_stay():
    for t in texts(3000):
        base, every = pii.scan(t)
        assert set(base) <= set(every) and all(0 <= s < e <= len(t) for _, s, e in every)


def test_marks_leave_nothing_out():
    """The rows of a batch are those of ``scan``, text by text."""
    rows = texts(8000) + [t for t, _, _ in DISGUISED] + [None, ""]
    out = pa.Table.from_batches(list(pii._batches(iter(pa.table({"doc_id": range(len(rows)), "text": rows}).to_batches(max_chunksize=700)))))
    text = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    for t, r in zip(rows, out.to_pylist(), strict=True):
        base, every = pii.scan(t or "")
        assert r["spans"] == text(every), t
        assert r["base_sha256"] == hashlib.sha256(text(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(k == b[0] for b in base) for k in pii.KINDS]


@pytest.mark.parametrize("piece", ["a", "1", "1.", "a@", "+1", "+(", "one ", "0O", "O", " ", "(", "a at ", "b-", "1 ", "double ", "_", "a dot ", "zero-", "[ at", ". ", "​", "plus "])
def test_time_grows_with_the_text(piece):
    def took(n):
        t = "a at " + piece * (n // len(piece))
        return min((pii.scan(t), time.perf_counter() - at)[1] for at in [time.perf_counter()] for _ in range(1))

    took(20_000)
    small, large = min(took(60_000) for _ in range(3)), min(took(240_000) for _ in range(3))
    assert large < 4 * 2.5 * small + 0.05


def test_rows(spark):
    rows = [(1, "a@b.co", "x", 1), (1, "a@b.co", "x", 1), (None, "1.2.3.4", None, 2), (2, None, None, None), (3, "", "", 3), (4, "x" * 300_000 + " a@b.co", "", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, TEXT string, Doc_Id int")
    got = {(r.doc_id, r.n_email, r.n_ip, r.spans) for r in pii.personal_data(docs).collect()}
    assert got == {(1, 1, 0, "email:0:6"), (None, 0, 1, "ip:0:7"), (2, 0, 0, ""), (3, 0, 0, ""), (4, 1, 0, "email:300001:300007")}
    assert pii.personal_data(docs).count() == len(rows)
    assert pii.personal_data(docs.filter("false")).count() == 0
