"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from geotide.llm import spelling

SMALL = {c: c + 32 for c in range(65, 91)}


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= 7
    return {w: k for w, k in n.items() if k >= 2}


def brute(n):
    near, by_hole = defaultdict(set), defaultdict(list)
    for w in n:
        for i in range(len(w)):
            by_hole[i, w[:i] + w[i + 1 :]].append(w)
            if (d := w[:i] + w[i + 1 :]) in n:
                near[w].add(d)
                near[d].add(w)
    for same in by_hole.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def test_words(spark):
    rng = random.Random(2)
    vocab = ["".join(rng.choice("abCDÉéÿ×") for _ in range(rng.randrange(1, 15))) for _ in range(200)] + ["a" * 100, "É" * 60]
    rows = [(rng.choice([None, 1, 22, 333, -4]), "".join(rng.choice(vocab) + rng.choice([" ", "1", "-", "Ā", "\n"]) for _ in range(300))) for _ in range(60)] + [(3, None), (4, ""), (5, "abcdefg"), (5, "ABCDEFG")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, TEXT string").repartition(3)
    assert {r.word: r.n for r in spelling.vocabulary(docs).collect()} == brute_words(rows)
    assert sorted((tuple(r) for r in spelling.variants(docs).collect())) == brute(brute_words(rows))


def test_counting_hands_on_what_it_holds(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(spelling, "HELD_WORDS", 5)
    rows = [(k, f"wordsofmany{chr(97 + k % 26)} wordsofmore{chr(97 + k % 7)}") for k in range(200)]
    batches = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}).to_batches(max_chunksize=10)
    total = Counter()
    for b in spelling._counted(iter(batches)):
        total.update(dict(zip(b["word"].to_pylist(), b["n"].to_pylist(), strict=True)))
    assert {w: k for w, k in total.items() if k >= 2} == brute_words(rows)


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_near_words(spark, size):
    """Whatever the blocks: with one word each, all nodes are shared; with all in a few, most are merged where they are."""
    rng = random.Random(size)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(7, 11))) for _ in range(400)} | {"abc" * 50, "abc" * 50 + "d", "abc" * 49 + "bc", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "baaaaaaa", "éaaaaaa", "ÿaaaaaaa"}
    n = {w: rng.choice([2, 3, 20, 20, 200, 3000]) for w in words}
    df = spark.createDataFrame([(w, k) for w, k in n.items()], "word string, n long")
    got = {r.word: (r.n, r.n_near, r.best_n, r.best) for r in spelling.near_words(df, block_words=size).collect()}
    want = {}
    for w in n:
        near = [x for x in n if x != w and _one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        want[w] = (n[w], len(near), n[best] if best else None, best)
    assert got == want


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def test_roots_and_empty(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(13)], "word string, form string")
    assert {r.root for r in spelling.roots(forms).collect()} == {"w13"}
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(docs).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "short"), (3, "onlyonce")], "doc_id long, text string")).count() == 0


def test_long_words(spark):
    long = "abcdefghij" * 20_000
    rows = [(1, long), (2, long), (3, long[:-1] + "k"), (4, long[:-1] + "k"), (5, f"{long}x {long}x")]
    n = brute_words(rows)
    got = {r.word: r.n_near for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {w: sum(_one_edit(w, x) for x in n) for w in n}
