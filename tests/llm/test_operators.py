"""Each corpus operator against brute force on small tables, with nulls, empties, ties, repeats and clashing columns."""

import base64
import gzip
import hashlib
import random
import re
import urllib.parse
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geotide.llm import bag_minhash, bpe, exact_topk, importance, line_dedup, mixing, quality_rules, secret_scan, substring_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, score double"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7))) for _ in range(300)]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\n", "\t"]) for _ in range(n))
    bases = [text(rng.randrange(20, 200)) for _ in range(25)]
    out = []
    for i in range(90):
        t = rng.choice(bases)
        if i % 3 == 0:
            words = t.split(" ")
            words[rng.randrange(len(words))] = "edit"
            t = " ".join(words)
        if i % 7 == 0:
            t = text(30) + t[: len(t) // 2]
        out.append((i, t))
    out += [(200, None), (201, ""), (202, " \n\t "), (203, "one"), (204, "x" * 3000), (205, "a b " * 800), (None, out[0][1]), (5, out[5][1]), (5, out[5][1]), (206, "<|endoftext|> y\U0001F600\x85z")]
    return [(d, t, "en", [None, "a", "b", "é", "c"][k % 5], 1, "clash", 0.5) for k, (d, t) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_quality_rules(docs, rows, spark):
    def brute(t):
        words, seen, dup = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        tri = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {j for i in range(len(words) - 2) if tri[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)

    got = quality_rules.verdicts(quality_rules.measure(docs))
    want = sorted(((d, *brute(t or "")) for d, t, *_ in rows), key=str)
    assert as_rows(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
    for r in got.collect():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"])
    kept = quality_rules.keep(spark.createDataFrame([r[:5] for r in rows], SCHEMA.split(", TEXT")[0]))
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got.filter("kept").collect())
    assert quality_rules.measure(docs.limit(0)).count() == 0


def test_mixing(docs, rows):
    sizes = [len(WORD.findall(t or "")) for _, t, *_ in rows]
    source = defaultdict(int)
    for (_, _, _, s, *_), n in zip(rows, sizes, strict=True):
        source[s] += n
    order = sorted(source, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    free, target, left = set(order), {}, sum(sizes)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * source[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s], left = 3.0 * source[s], left - 3 * source[s]
            free.discard(s)
    got = mixing.mix(docs).collect()
    assert sorted(r["size"] for r in got) == sorted(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == source[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6 and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = max(sizes)
    assert all(abs(taken[s] - target[s]) <= largest / 2 for s in order)
    assert as_rows(mixing.mix(docs)) == sorted((tuple(r) for r in got), key=str)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_secrets(docs, rows):
    secret = 'password = "hunter2hunter2x"'
    enc = {
        "plain": secret, "b64": base64.b64encode(secret.encode()).decode(), "url": urllib.parse.quote(secret), "uni": "".join(f"\\u{ord(c):04x}" for c in secret),
        "zip": base64.b64encode(zlib.compress(secret.encode())).decode(), "deep": urllib.parse.quote(base64.b64encode(base64.b64encode(secret.encode())).decode()),
    }
    for name, e in enc.items():
        text = "é☃ " + e + " end"
        base, every, _ = secret_scan.scan(text)
        assert len(base) == (name == "plain"), name
        kind, s, t = every[0]
        assert kind == "assign" and 3 <= s and t <= 3 + len(e), name
    assert secret_scan.find("ſecret=abcdefghijklmnop Token: 'abcdefghijkl' token=short AKIA" + "A" * 14 + " AKIAB 0123456789abcdef 0123") == [("assign", 24, 44), ("access", 58, 76), ("hex", 83, 99)]
    one = secret_scan.secrets(docs.sparkSession.createDataFrame([(1, "x token=abcdefghijkl"), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert one[0]["base_sha256"] == hashlib.sha256(b"assign:2:20").hexdigest() and one[0]["spans"] == "assign:2:20" and one[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert secret_scan.secrets(docs).count() == len(rows)


def _kinds(text):
    return {k for k, _, _ in secret_scan.scan(text)[1]}


def test_secrets_in_nested_compression():
    secret = b'password = "hunter2hunter2x"'
    for body in (gzip.compress(gzip.compress(secret)), gzip.compress(zlib.compress(secret)), zlib.compress(gzip.compress(zlib.compress(secret)))):
        assert _kinds("x " + base64.b64encode(body).decode()) == {"assign"}
        assert _kinds("x " + "".join(f"%{b:02X}" for b in body) + " y") == {"assign"}
        assert _kinds("x q=" + urllib.parse.quote(body) + " y") == {"assign"}
        assert _kinds("x " + "".join(f"\\x{b:02x}" for b in body) + " y") == {"assign"}
        assert _kinds(f"x = {body!r}") == {"assign"}


def test_secrets_among_undecodable_bytes():
    text = "x /q?n=%E9&password%3Dhunter2hunter2 y"
    assert secret_scan.scan(text)[1] == [("assign", 11, 36)]
    secret = 'Schlüssel: password = "hunter2hunter2x"'
    bodies = [secret.encode(c) for c in ("utf-16-le", "utf-16-be", "utf-16", "utf-32-le", "utf-32-be", "latin-1")]
    bodies += [b"\0" + secret.encode(), secret.encode() + b"\xff\x00\x01", b"\x80\x81\xfe" * 20 + secret.encode()]
    for body in bodies:
        for packed in (body, zlib.compress(body), zlib.compress(base64.b64encode(body))):
            assert _kinds("x " + base64.b64encode(packed).decode() + " y") == {"assign"}
            assert _kinds("x " + "".join(f"%{b:02x}" for b in packed) + " y") == {"assign"}
def test_secrets_in_wrapped_and_misaligned_base64():
    rng = random.Random(5)
    noise = "".join(rng.choice("qwertzuiopasdfghjklyxcvbnm ,.") for _ in range(600))
    secret = 'password = "hunter2hunter2x"'
    for body in ((noise + secret + noise).encode(), zlib.compress((noise + secret).encode()), (noise[:50] + secret).encode()):
        for wrapped in (base64.encodebytes(body).decode(), base64.encodebytes(body).decode().replace("\n", "\r\n  ")):
            assert _kinds("Key: x\n\n" + wrapped + "end") == {"assign"}
            assert _kinds("-----BEGIN X-----\n" + wrapped + "-----END X-----") == {"assign"}
    for body in (secret.encode(), zlib.compress(secret.encode())):
        e = base64.b64encode(body).decode().rstrip("=")
        for before in ("https://host.example/path/", "name_", "name-", "a/", "ab_", "abc-", "x", "xy", "xyz"):
            for after in ("", "/more", "_x", " end"):
                text = before + e + after
                base, every, _ = secret_scan.scan(text)
                assert not base and "assign" in {k for k, _, _ in every}
                assert all(len(before) - 1 <= s and t <= len(before + e + after) for _, s, t in every)


def test_secrets_partly_escaped():
    for text in ("é password%3A hunter2hunter2 z", "é password\\u003a hunter2hunter2 z", "é password \\x3a hunter2hunter2 z", "é pass\\u0077ord%20 %3d hunter2hunter2 z"):
        s, e = text.index("password" if "password" in text else "pass"), text.index(" z")
        assert secret_scan.scan(text)[1] == [("assign", s, e)], text
    assert secret_scan.scan("\\ud83d\\ude00 \\ud800\\u0041 token\\U0000003d abcdefghijkl \\u00e9")[1] == [("assign", 26, 54)]


def test_secrets_in_long_and_joined_streams(monkeypatch):
    secret, e = b'password = "hunter2hunter2x"', lambda body: base64.b64encode(body).decode()
    long = b"\xff" * (65 << 20)
    assert secret_scan.scan("x " + e(zlib.compress(long + secret)))[1][0][:2] == ("assign", 2)
    assert _kinds(e(gzip.compress(b"first") + gzip.compress(b"second pass") + gzip.compress(secret))) == {"assign"}
    assert _kinds(e(gzip.compress(b"first passw") + gzip.compress(secret[5:] + b" AKIA" + b"A" * 16))) == {"assign", "access"}
    damaged = zlib.compress(secret * 3)[:-4] + b"\0\0\0\0"
    assert _kinds(e(damaged)) == {"assign"}
    body = gzip.compress(secret)
    for _ in range(1100):
        body = zlib.compress(body)
    assert _kinds(e(body)) == {"assign"}
    # windows that are much shorter than what has to stay together
    monkeypatch.setattr(secret_scan, "WINDOW_BYTES", 64)
    monkeypatch.setattr(secret_scan, "READ_BYTES", 4)
    rng = random.Random(8)
    words = b" ".join(rng.choice([b"alpha", b"be,ta", b"gamma.", b"x\xff", b"12"]) for _ in range(200))
    inner = [secret, base64.b64encode(zlib.compress(words + secret)), zlib.compress(words + secret), base64.encodebytes(gzip.compress(words + secret)), repr(gzip.compress(words + secret)).encode()]
    inner += [urllib.parse.quote(zlib.compress(words + secret)).encode(), (words.decode("latin-1") + secret.decode()).encode("utf-16"), b"password%3A hunter2hunter2", b"password" + b" " * 300 + b"= hunter2hunter2"]
    for x in inner:
        for n in (0, 50, 101, 400):
            assert "assign" in _kinds(e(zlib.compress(words[:n] + b"\n" + x + b"\n" + words))), (x, n)


def test_line_dedup(docs, rows):
    lines = [(d, n, frozenset(WORD.findall(x))) for d, t, *_ in {(r[0], r[1]) for r in rows} if d is not None for n, x in enumerate((t or "").split("\n")) if WORD.search(x)]
    gone = {(d, n) for d, n, w in lines if any((e, m) < (d, n) and 9 * len(v & w) >= 4 * (len(v) + len(w)) for e, m, v in lines)}
    original = {d: t for d, t, *_ in rows}
    got = {(r["doc_id"], r["line_no"]) for r in line_dedup.decisions(docs).collect()}
    assert got == gone
    for r in line_dedup.remove_lines(docs).toDF("doc_id", "text", *"abcde").collect():
        left = [x for n, x in enumerate(original[r["doc_id"]].split("\n")) if (r["doc_id"], n) not in gone] if r["text"] is not None and r["doc_id"] is not None else None
        assert left is None or r["text"] == "\n".join(left)
    assert line_dedup.decisions(docs.limit(0)).count() == 0


def test_near_duplicates(docs, rows):
    bags = {}
    for d, t, *_ in rows:
        w = WORD.findall(t or "")
        if d is not None and w:
            bags[d] = Counter(zip(*[w[i:] for i in range(5)], strict=False)) if len(w) >= 5 else Counter([tuple(w)])
    root = {d: d for d in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(bags)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 9 * (bags[a] & bags[b]).total() >= 4 * (bags[a].total() + bags[b].total()) and (x := find(a)) != (y := find(b)):
                root[max(x, y)] = min(x, y)
    got = bag_minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["class_id"] == (find(r["doc_id"]) if r["doc_id"] in bags else r["doc_id"])
    assert bag_minhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_with_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, c), (5, a), (5, b), (5, b), (5, c), (5, a + " more"), (6, a), (7, ""), (7, None), (None, a), (8, b)]
    got = bag_minhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    kept = sorted(((r["doc_id"], r["text"]) for r in got if r["doc_id"] not in (None, 7)), key=str)
    assert kept in [sorted([(1, c), (5, x), (5, b)]) for x in (a, a + " more")]
    assert sum(r["doc_id"] == 7 for r in got) == 1 and sum(r["doc_id"] is None for r in got) == 1


def test_bag_minhash_is_unbiased():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 40).astype(np.uint64)
    a, b = rng.integers(0, 12, 40), rng.integers(0, 12, 40)
    b = np.where(rng.random(40) < 0.7, a, b)
    sig = bag_minhash.signatures(np.concatenate([h[a > 0], h[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()]), 2, 10_000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.02


def test_large_component_is_cut(spark, monkeypatch):
    monkeypatch.setattr(bag_minhash, "BLOCK", 8)
    rng = random.Random(3)
    base = [str(rng.randrange(10**6)) for _ in range(200)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(i % 6):
            w[rng.randrange(200)] = f"e{rng.random()}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: r["class_id"] for r in bag_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    bags = [Counter(zip(*[t.split()[i:] for i in range(5)], strict=False)) for _, t in rows]
    root = list(range(40))
    for _ in range(40):
        for a in range(40):
            for b in range(a + 1, 40):
                if 9 * (bags[a] & bags[b]).total() >= 4 * (bags[a].total() + bags[b].total()):
                    root[a] = root[b] = min(root[a], root[b])
    assert got == dict(enumerate(root))


@pytest.mark.parametrize("hot_contexts", [0, 3, 2000])
def test_substring_dedup(docs, rows, hot_contexts):
    seen = {}
    for d, t, *_ in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49 if d is not None else 0):
            w = b[i : i + 50]
            seen[w] = min(seen.get(w, d), d)
    want = []
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49 if d is not None else 0):
            if seen[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    assert as_rows(substring_dedup.remove_repeats(docs, hot_contexts=hot_contexts)) == sorted(want, key=str)
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_a_phrase_in_other_text_each_time_is_spread():
    """One phrase in every text: what meets in a bucket doesn't grow with the number of texts."""
    import pyarrow as pa

    def largest(n_blocks, most):
        rng, bits, sent = random.Random(1), 8, {}
        phrase = "this licence line stands in each and every text here"
        tables = []
        for b in range(n_blocks):
            noise = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(80))  # noqa: B023, E731
            tables.append(pa.table({"doc_id": [b * 1000 + i for i in range(100)], "text": [noise() + phrase + noise() for _ in range(100)], "block": pa.array([b] * 100, pa.int32())}))
        first = {}
        for b, t in enumerate(tables):
            x = substring_dedup._Block(t, bits)
            for block, bucket, body in substring_dedup._pack(b, x.values, x.n_contexts, bits, 5):
                first.setdefault(bucket, []).append((block, bucket, body))
        replies = {}
        for rows in first.values():
            for r in substring_dedup._settle(5, most)(substring_dedup._rows(rows)).to_pylist():
                replies.setdefault(r["block"], []).append(r)
        for b, t in enumerate(tables):
            x = substring_dedup._Block(t, bits)
            status = np.frombuffer(b"".join(r["body"] for r in sorted(replies[b], key=lambda r: r["bucket"])), "u1")
            assert (status == 2).any()
            for _, bucket, body in [*substring_dedup._pack_windows(b, x, status, bits), *substring_dedup._pack_contexts(x, b, x.contexts(status), bits)]:
                sent[bucket] = sent.get(bucket, 0) + len(body)
        return max(sent.values())

    one, four = largest(2, 20), largest(8, 20)
    assert four < 8000 and four < 4 * one


def test_substring_dedup_with_deceiving_hashes(docs, rows, monkeypatch):
    """Where all hashes agree, the bytes decide."""
    want = as_rows(substring_dedup.remove_repeats(docs))
    import pyarrow as pa

    texts = sorted({(d, t) for d, t, *_ in rows if d is not None and t}, key=str)
    eight = lambda b: np.ndarray((len(b) - 7,), "<u8", b, strides=(1,))
    buf = np.frombuffer("".join(t for _, t in texts).encode()[:6000], np.uint8)
    start = np.arange(0, len(buf) - 50)
    real = substring_dedup._equal_windows(eight(buf), start, start)
    monkeypatch.setattr(substring_dedup, "mix", lambda x: x * np.uint64(0))
    assert (substring_dedup._equal_windows(eight(buf), start, start) == real).all()
    seen = {}
    assert [seen.setdefault(bytes(buf[i : i + 50]), i) for i in start.tolist()] == real.tolist()
    # a task with blocks of contexts, all of one hash
    body = lambda parts: np.uint32(len(parts)).tobytes() + bytes(len(p) - 49 for p in parts) + b"".join(parts)
    a, b = bytes(buf[:60]), bytes(buf[100:165])
    table = pa.table({"block": pa.array([0, 1, 2], pa.int32()), "bucket": pa.array([5, 5, 5], pa.int32()), "body": pa.array([body([a, b]), body([b[:55], a]), body([b"x" * 51])], pa.binary())})
    got = {r["block"]: np.frombuffer(r["body"], "<u4").tolist() for r in substring_dedup._settle_contexts(table).to_pylist()}
    assert got == {0: [0, 0], 1: [(1 << 6) - 1, (1 << 11) - 1], 2: [0]} and want


def test_bpe(docs, rows):
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    lib = Tokenizer.from_file(path)
    want = []
    for d, t, *_ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert as_rows(bpe.encode(docs, path)) == sorted(want, key=str)
    rng = random.Random(7)
    own = bpe.vocabulary(path)
    odd = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(40)) for _ in range(300)]
    odd += ["".join(rng.choice(["'s", "'LL", " ", "  ", "\n", "don't", "12", "½", "٣", "é", "\x1c", "\x85", "\u3000"]) for _ in range(30)) for _ in range(300)]
    for text, ids in zip(odd, own.encode_batch(odd), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def _topk_brute(rows, k=20):
    """Over all rows, repeated ones too: of each query the best k rows but its own."""
    good = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    out = []
    for n, (q, x) in enumerate(good):
        if q % 20 == 0:
            score = sorted((-int(x @ v), i) for m, (i, v) in enumerate(good) if m != n and len(v) == len(x))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(score, 1)]
    return sorted(out)


def test_exact_topk(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((300, 8)).round(2))]
    rows += [(300, None), (320, [1.0, None]), (340, [float("nan")] * 8), (360, [float("inf")] * 8), (400, [0.5] * 8), (401, [0.5] * 8), (380, [1.0] * 3), (None, [0.1] * 8), (420, [])]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, EMBEDDING string, q double")
    for block in (8192, 64):
        monkeypatch.setattr(exact_topk, "BLOCK_ROWS", block)
        got = exact_topk.top_k(df, df.filter("vec_id % 20 = 0"))
        assert sorted(tuple(r) for r in got.collect()) == _topk_brute(rows)
    assert exact_topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_exact_topk_with_repeated_ids(spark):
    rng = np.random.default_rng(6)
    vec = lambda: [float(x) for x in rng.standard_normal(6).round(2)]
    same = vec()
    # the query's id on 30 rows of which 25 are equal, a query row twice, a candidate 30 times, ties
    rows = [(i, vec()) for i in range(1, 120)] + [(0, same)] * 25 + [(0, vec()) for _ in range(5)] + [(40, vec())] * 2 + [(7, [3.0] * 6)] * 30 + [(i, [3.0] * 6) for i in (200, 201, 203)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = exact_topk.top_k(df, df.filter("vec_id % 20 = 0"))
    assert sorted(tuple(r) for r in got.collect()) == _topk_brute(rows)


def test_exact_topk_stops_on_proof_only():
    rng = np.random.default_rng(9)
    m = rng.integers(-400, 400, (900, 12))
    m[:300] += 5000  # an outlying group makes the first digits decide
    ids = np.arange(900)
    copies = np.ones(900, np.int64)
    copies[[3, 30]] = 2
    index = exact_topk.Index(ids, copies, m)
    asked = np.arange(0, 900, 30)
    rows = [(i, r) for r, i in enumerate(ids.tolist()) for _ in range(copies[r])]
    for got_ids, got, q in [(*x, q) for x, q in zip(index.search(asked, m[asked], 20), asked.tolist(), strict=True)]:
        others = list(rows)
        others.remove((q, q))
        want = sorted((-int(m[r] @ m[q]), i) for i, r in others)[:20]
        assert list(zip((-got).tolist(), got_ids.tolist(), strict=True)) == want
    # every component is the sum of its postings' impacts
    back = np.zeros((12, 900), np.int64)
    for t, i, r in zip(index.term, index.impact, index.rows, strict=True):
        back[t, r] += i
    assert (back.T + m.min(0) == m).all()


def test_toxicity(spark, docs, rows):
    rng = random.Random(8)
    words = ["".join(rng.choice("lmnoprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(200)]
    data, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        t = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        for _ in range(len(t) // 30 + 1 if bad else 0):
            t[rng.randrange(len(t))] = "vile" + rng.choice(words)
        data.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    df, known = spark.createDataFrame([*data, (5000, ""), (5001, None)], "doc_id long, text string"), spark.createDataFrame([*labels, (7, None), (9999, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(df, known).collect()}
    test = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r["held_out"]} - {5000, 5001} == set(test)
    assert sum(got[i]["predicted"] == labels[i][1] for i in test) >= 0.95 * len(test)
    assert got[5000]["score"] == got[5001]["score"] < 0.7 and all(r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    assert toxicity.score(docs, known.limit(0)).count() == len(rows)


def test_importance(spark):
    rng = random.Random(6)
    good, bad = [f"g{i}" for i in range(50)], [f"b{i}" for i in range(50)]
    data = [(i, " ".join(rng.choice(bad if i % 5 == 0 else good) for _ in range(rng.randrange(5, 60)))) for i in range(1000)] + [(2000, ""), (2001, None)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(0, 1000, 3)] + [(1, None)], "doc_id long, quality int")
    got = importance.resample(df, labels, 0.7)
    kept = {r["doc_id"] for r in got.collect()}
    assert len(kept) == 702 and sum(i % 5 == 0 for i in kept if i < 1000) < 20
    assert {r["doc_id"] for r in importance.resample(df, labels, 0.7).collect()} == kept


def test_importance_brute_force(spark, docs, rows):
    """The two models, the weights and the sample, from the features of single texts."""
    import pyarrow as pa

    from geotide.llm._text import text_chunks

    labels = [(d, d % 2) for d in range(60)] + [(61, None), (999, 1), (4, 1)]
    good = {d for d, q in labels if q == 1 and d != 4}  # of two labels the smaller counts
    features = []
    for _, t, *_ in rows:
        [(_, _, c)] = text_chunks(pa.array([t], pa.string()))
        features.append(Counter(importance._features(c)[0].tolist()))
    half = 1 << importance.BUCKET_BITS
    total = [[Counter(), Counter()], [Counter(), Counter()]]
    for (d, *_), f in zip(rows, features, strict=True):
        for bucket, n in f.items():
            total[bucket >= half][0][bucket] += n
            total[bucket >= half][1][bucket] += n * (d in good)
    want = []
    for (d, *_), f in zip(rows, features, strict=True):
        w = 0.0
        for bucket, n in f.items():
            raw, target = total[bucket >= half]
            w += n * np.log((target[bucket] * raw.total() / target.total() + 1) / (raw[bucket] + 1))
        want.append((d, w))
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    ids = known.groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")
    weighed = importance.weights(docs, ids).collect()
    got = sorted(((r["doc_id"], r["log_weight"]) for r in weighed), key=str)
    assert [d for d, _ in got] == [d for d, _ in sorted(want, key=str)]
    assert np.allclose(sorted(w for _, w in got), sorted(w for _, w in want))
    kept = importance.resample(docs, known, 0.6).collect()
    keys = sorted((r["key"] for r in weighed), reverse=True)
    assert sorted((r["key"] for r in kept), reverse=True) == keys[: -(-6 * len(rows) // 10)]
    assert importance.resample(docs.limit(0), known).count() == 0


def test_top_share_with_ties(spark, monkeypatch):
    keyed = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 10).cast("double").alias("key"))
    order = sorted(range(1000), key=lambda i: (-(i % 10), i))
    for most in (5000, 20):
        monkeypatch.setattr(importance, "_BIN_ROWS", most)
        for k in (0, 1, 150, 999, 1000, 2000):
            assert sorted(r["doc_id"] for r in importance.top_share(keyed, k).collect()) == sorted(order[:k])
    same = spark.range(300).select(F.when(F.col("id") < 200, 7).otherwise(F.col("id")).cast("long").alias("doc_id"), F.lit(1.5).alias("key")).repartition(5)
    for k in (1, 57, 199, 200, 201, 260):
        got = Counter(r["doc_id"] for r in importance.top_share(same, k).collect())
        assert got[7] == min(k, 200) and got.total() == k and max(got, default=0) == (7 if k <= 200 else k - 1)


def test_kneser_ney_brute_force():
    """Every n-gram's and context's ratio by the textbook formulas over dictionaries."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    counts = [Counter(), Counter()]
    for c in (0, 1):
        for w in rng.choices(words, k=150):
            raw = b"\x01" * 4 + w.encode() + b"\x02"
            for i in range(len(raw) - 4):
                counts[c][raw[i : i + 5]] += 1
    grams = sorted(set(counts[0]) | set(counts[1]))
    suffixes = {k: {g[-k:] for g in grams} for k in range(1, 6)}

    def lower(x):
        if not x:
            return 1 / 256
        k = len(x)
        n = Counter(y[-k:] for y in suffixes[k + 1])
        beside = [y for y in suffixes[k] if y[:-1] == x[:-1]]
        total = sum(n[y] for y in beside)
        d = toxicity.DISCOUNT
        return max(n[x] - d, 0) / total + d * len(beside) / total * lower(x[1:])

    def ratio(g):
        beside = [y for y in grams if y[:-1] == g[:-1]]
        pooled = {y: counts[0][y] + counts[1][y] for y in beside}
        d, total = toxicity.DISCOUNT, sum(pooled.values())
        p = max(pooled[g] - d, 0) / total + d * len(beside) / total * lower(g[1:])
        logs, backs = [], []
        for c in counts:
            own = sum(c[y] for y in beside)
            back = (sum(min(c[y], toxicity.CLASS_DISCOUNT) for y in beside) + toxicity.CLASS_BACKOFF) / (own + toxicity.CLASS_BACKOFF)
            logs.append(np.log(max(c[g] - toxicity.CLASS_DISCOUNT, 0) / (own + toxicity.CLASS_BACKOFF) + back * p))
            backs.append(np.log(back))
        return logs[1] - logs[0], backs[1] - backs[0]

    number = lambda g: int.from_bytes(g, "big")
    model = toxicity._kneser_ney(np.array([number(g) for g in grams]), np.array([counts[1][g] for g in grams]), np.array([counts[0][g] for g in grams]))
    llr = dict(zip(model["keys"].tolist(), model["llr"].tolist(), strict=True))
    back = dict(zip(model["contexts"].tolist(), model["back"].tolist(), strict=True))
    for g in grams:
        a, b = ratio(g)
        assert abs(llr[number(g)] - a) < 1e-9 and abs(back[number(g[:-1])] - b) < 1e-9


def test_toxic_evidence_brute_force(rows):
    import pyarrow as pa

    token = re.compile(rb"(?:[0-9A-Za-z]|[\x80-\xff])+")
    texts = [r[1] for r in rows]
    rng = np.random.default_rng(2)
    seen = sorted({b"\x01" * 4 + w.lower() + b"\x02" for t in texts for w in token.findall((t or "").encode())})
    grams = sorted({w[i : i + 5] for w in seen for i in range(len(w) - 4)})[::2]
    keys = np.array([int.from_bytes(g, "big") for g in grams])
    contexts = np.unique(keys >> 8)
    model = {"keys": keys, "llr": rng.normal(size=len(keys)), "contexts": contexts, "back": rng.normal(size=len(contexts))}
    llr, back = dict(zip(keys.tolist(), model["llr"], strict=True)), dict(zip(contexts.tolist(), model["back"], strict=True))

    def word(w):
        raw, out = b"\x01" * 4 + w.lower() + b"\x02", 0.0
        for i in range(len(raw) - 4):
            g = int.from_bytes(raw[i : i + 5], "big")
            out += llr[g] if g in llr else back.get(g >> 8, 0.0)
        return out

    got = toxicity._evidence(model, pa.array(texts, pa.string()))
    for t, x in zip(texts, got, strict=True):
        r = [word(w) for w in token.findall((t or "").encode())]
        if not r:
            assert not x.any()
            continue
        k, top = toxicity.WINDOW_WORDS, int(np.ceil(toxicity.TOP_WORDS * len(r)))
        windows = [sum(r[i : i + k]) / k for i in range(max(len(r) - k, 0) + 1)]
        assert np.allclose(x, [np.mean(r), max(windows), np.mean(sorted(r, reverse=True)[:top]), np.log(len(r))], atol=1e-9)


def test_repetition_coverage_brute_force(docs, rows):
    """The method's own columns and the verdict."""
    want = {}
    for d, t, *_ in rows:
        words, lines, seen, dup_line = WORD.findall(t or ""), (t or "").split("\n"), set(), 0
        for line in lines:
            if WORD.search(line):
                dup_line += sum(map(len, WORD.findall(line))) if line in seen else 0
                seen.add(line)
        row, covered3 = {"dup_line_chars": dup_line}, set()
        for n in (3, *quality_rules.GRAM_LIMITS):
            grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
            count = Counter(grams)
            inside = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + n)}
            if n == 3:
                covered3 = inside
            else:
                row[f"dup_chars_{n}"] = sum(len(words[j]) for j in inside)
        chars = sum(map(len, words))
        base = len(words) < 50 or 100 * len(covered3) > 50 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        bad = symbols > quality_rules.SYMBOL_LIMIT * len(words) or dup_line > quality_rules.LINE_LIMIT * chars
        bad = bad or any(row[f"dup_chars_{n}"] > most * chars for n, most in quality_rules.GRAM_LIMITS.items())
        want.setdefault(d, []).append({**row, "base_failed": base, "kept": not base and not bad})
    for r in quality_rules.verdicts(quality_rules.measure(docs)).collect():
        assert any(all(r[k] == v for k, v in w.items()) for w in want[r["doc_id"]]), r


def test_base_secrets_brute_force(spark, docs, rows):
    assign = re.compile(r"""(?P<k>password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?P<v>[A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    texts = [(r[0], r[1]) for r in rows]
    texts += [(i, t) for i, t in enumerate(["API_KEY='abcdefghijkl' apikey: abcdefghijkl0 token=short", "AKIA" + "B" * 14 + "AKIA" + "C" * 13, "0" * 15 + "g" + "a" * 16, "passwd  =  \"x1234567890ab\"", "ſecret=abcdefghijklm", "é" * 5 + "secret=abcdefghijklm"], 300)]
    tables = "/root/testdata/sf0.001/documents.parquet"
    import os

    if os.path.exists(tables):
        texts += [(r["doc_id"] + 1000, r["text"]) for r in spark.read.parquet(tables).collect()]
    want = []
    for d, t in texts:
        found = [("assign", *m.span()) for m in assign.finditer(t or "") if len(m["v"]) >= 12]
        found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t or "") if len(m[0]) >= 18]
        found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t or "") if len(m[0]) >= 16]
        n = Counter(k for k, *_ in found)
        order = sorted(found, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in order)
        want.append((d, n["assign"], n["access"], n["hex"], hashlib.sha256(text.encode()).hexdigest()))
    got = secret_scan.secrets(spark.createDataFrame(texts, "doc_id long, text string"))
    assert as_rows(got.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")) == sorted(want, key=str)
    for r in got.collect():  # the method adds spans, the base ones stay
        assert len((r["spans"] or "").split(",")) >= r["n_assign"] + r["n_access"] + r["n_hex"]


def test_secret_scan_is_linear():
    import time

    for text in ("x" * 1_000_000 + " %41", "x" * 1_000_000 + "\\u0041", "%41" * 200_000, "a\n" * 300_000, "\\" * 500_000, "token" * 100_000 + " " * 500_000 + "=", ("A" * 15 + "\n") * 40_000):
        t = time.perf_counter()
        secret_scan.scan(text)
        assert time.perf_counter() - t < 20, text[:20]


def test_registered_queries_on_the_smallest_tables(spark):
    """op1 to op10 as registered: a row (or its place) for each document, and reruns that agree."""
    import os

    from geotide.llm import queries

    tables = "/root/testdata/sf0.001"
    if not os.path.isdir(tables):
        pytest.skip("no driver tables here")
    ids = sorted(r["doc_id"] for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id").collect())
    for name, run in queries.queries().items():
        got = as_rows(run(spark, tables))
        assert got == as_rows(run(spark, tables)), name
        if name.startswith(("op1_", "op2", "op3", "op6", "op7", "op8", "op9", "op10")):
            assert sorted(r["doc_id"] for r in run(spark, tables).select("doc_id").collect()) == ids, name


def test_line_dedup_columns(spark):
    base = [f"w{i}" for i in range(20)]
    a, b = " ".join(base), " ".join([*base[:-1], "other"])
    rows = [(1, f"{a}\n\nx y"), (2, f"{a}\n{b}\nnew words"), (3, " ".join(reversed(base))), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in line_dedup.summaries(docs).collect()}
    assert (found[2]["n_equal"] + found[2]["n_similar"], [g["line_no"] for g in found[2]["gone"]]) == (2, [0, 1]) and [g["line_no"] for g in found[3]["gone"]] == [0] and set(found) == {2, 3}


def test_hot_lines_are_settled_apart(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LEAST", 3)
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 0.0)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    near = [" ".join(words[:20] + [x]) for x in ("p", "q")]
    rows = []
    for i in range(60):
        own = [" ".join(rng.choices(words, k=8)), near[i % 2], "a b c d", "a b c d"]
        rng.shuffle(own)
        rows.append((i // 2 if i < 10 else i, "\n".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lines = [(d, n, frozenset(x.split())) for d, t in rows for n, x in enumerate(t.split("\n"))]
    gone = {(d, n, w) for d, n, w in lines if any((e, m) < (d, n) and 9 * len(v & w) >= 4 * (len(v) + len(w)) for e, m, v in lines)}
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(t.split("\n"))
    got = {(r["doc_id"], r["line_no"]) for r in line_dedup.decisions(docs).collect()}
    assert got == {(d, n) for d, n, _ in gone}


def test_remove_repeats_with_text(docs, rows):
    for r in substring_dedup.remove_repeats(docs, with_text=True).collect():
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]


STAGES = {"quality": quality_rules.keep, "lines": line_dedup.remove_lines, "near": bag_minhash.one_of_each, "mix": mixing.mixed}


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_carry_all_columns(spark, docs, rows, name):
    """Nulls, empties, ties and repeated rows with extra columns of clashing names: the same rows as without them."""
    stage = STAGES[name]
    odd = docs.withColumnsRenamed({"score": "_id"}).withColumn("id", F.lit(1)).withColumn("gone", F.lit("g")).withColumn("copies", F.lit(2)).withColumn("key", F.lit(0)).withColumn("bag", F.lit(0))
    plain = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got, want = stage(odd), stage(plain)
    assert got.columns == odd.columns and want.columns == plain.columns
    assert Counter((r[0], r[1]) for r in got.collect()) == Counter((r[0], r[1]) for r in want.collect())
    assert stage(plain.limit(0)).count() == 0


def test_pipeline_brute_force(spark, tmp_path):
    """run() against each stage's own rules, one after the other, on a small table with an extra clashing column."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    rng = random.Random(21)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    shared = [line(25) for _ in range(4)]
    rows = []
    for i in range(60):
        t = "\n".join([line(30), shared[i % 4] if i % 3 == 0 else line(12), line(40)])
        if i % 10 == 9:  # a near copy whose lines are cut differently, so that it survives the line stage
            words = rows[-1][1].split()
            words[5] = "edited"
            t = "\n".join([" ".join(words[:55]), " ".join(words[55:])])
        rows.append((i, t, "en", [None, "a", "b", "c"][i % 4], len(t)))
    rows += [(100, None, "en", "a", 0), (101, "", "en", "a", 0), (102, "too short", "en", "b", 9), (103, "same words again " * 60, "en", "b", 1020)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    odd = docs.select("*", F.lit("x").alias("Doc_ID"), F.lit(1).alias("TEXT"))
    names = corpus_pipeline.COLUMNS
    out = {name: stage(spark, odd, "") for name, stage in corpus_pipeline.STAGES}
    assert all(d.columns == names for n, d in out.items() if n != "bpe_encode") and [d.count() for d in out.values()][1] == len(rows)

    text = {i: t for i, t, *_ in rows}
    kept = [i for i in range(60)]
    assert sorted(r["doc_id"] for r in out["quality_rules"].collect()) == kept
    lines = [(i, n, frozenset(WORD.findall(x))) for i in kept for n, x in enumerate(text[i].split("\n"))]
    gone = {(i, n) for i, n, w in lines if any((j, m) < (i, n) and 9 * len(v & w) >= 4 * (len(v) + len(w)) for j, m, v in lines)}
    text = {i: "\n".join(x for n, x in enumerate(text[i].split("\n")) if (i, n) not in gone) for i in kept}
    bags = {i: Counter(zip(*[text[i].split()[k:] for k in range(5)], strict=False)) for i in kept}
    first = {i: min([j for j in kept if 9 * (bags[i] & bags[j]).total() >= 4 * (bags[i].total() + bags[j].total())], default=i) for i in kept}
    left = [i for i in kept if first[i] == i]
    assert gone and len(left) < len(kept)
    source = {i: s for i, _, _, s, _ in rows}
    plan = mixing.mix(spark.createDataFrame([(i, text[i], source[i]) for i in left], "doc_id long, text string, source string"))
    copies = {r["doc_id"]: r["copies"] for r in plan.collect()}
    lib = Tokenizer.from_file(bpe.default_vocabulary())
    want = []
    for i in left:
        ids = lib.encode(text[i], add_special_tokens=False).ids
        row = (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        want += [row] * copies[i]
    assert as_rows(corpus_pipeline.run(spark, str(tmp_path))) == sorted(want, key=str)


def _each_operator(df, labels):
    """Every operator over one table: name -> DataFrame with a row (or fewer) for each document."""
    return {
        "mix": mixing.mix(df), "secrets": secret_scan.secrets(df), "lines": line_dedup.remove_lines(df), "sample": importance.resample(df, labels), "quality": quality_rules.verdicts(quality_rules.measure(df)),
        "toxicity": toxicity.score(df, labels), "near": bag_minhash.near_duplicates(df), "bpe": bpe.encode(df, bpe.default_vocabulary()), "repeats": substring_dedup.remove_repeats(df),
    }


def test_empty_tables(spark, docs):
    labels = spark.createDataFrame([(1, 1, 1, 2), (2, 0, 0, 2)], "doc_id long, quality int, toxic int, DOC_ID int")
    for name, df in _each_operator(docs.limit(0), labels).items():
        assert df.count() == 0, name


def test_labels_with_clashing_columns(spark, docs, rows):
    plain = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(80)], "doc_id long, quality int, toxic int")
    odd = plain.select("*", F.lit("x").alias("Quality"), F.lit("y").alias("DOC_ID"), F.lit(None).cast("int").alias("TOXIC"))
    assert as_rows(importance.resample(docs, odd)) == as_rows(importance.resample(docs, plain))
    assert as_rows(toxicity.score(docs, odd)) == as_rows(toxicity.score(docs, plain))


def test_long_texts(spark):
    long = [(1, "word " * 60_000), (2, "x" * 150_000), (3, "a b\n" * 40_000), (4, " ".join(f"w{i}" for i in range(40_000))), (5, " ".join(f"w{i}" for i in range(39_999)) + " end")]
    df = spark.createDataFrame([(i, t, "s") for i, t in long], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = {name: {r["doc_id"]: r for r in x.collect()} for name, x in _each_operator(df, labels).items()}
    assert all(set(x) == {1, 2, 3, 4, 5} for name, x in got.items() if name != "sample")
    assert got["near"][5]["class_id"] == 4 and got["lines"][5]["text"] == "" and got["lines"][3]["text"] == "a b\n" + "" * 39_999
    assert got["quality"][4]["n_words"] == 40_000 and got["mix"][1]["size"] == 60_000
    assert got["repeats"][5]["n_removed"] == len(" ".join(f"w{i}" for i in range(39_999)) + " ")
