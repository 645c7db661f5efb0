"""The registered queries in SQL, over the same tables, where SQL can say the same.

Each is a statement of its own of what comes out: whole sorts, windows over
every byte, joins on every prefix word.  They are meant for small tables.
"""

from __future__ import annotations

from geotide.llm import exact_topk, merkle, quality_rules, spelling

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Water-filling over the sources, whole copies, and the documents in seeded order that make up the rest.
MIX_SOURCES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, len({_WORDS})::BIGINT AS size, md5('17:' || coalesce(doc_id::VARCHAR, '')) AS u, md5(coalesce(text, '')) AS tie FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM s),
x AS (SELECT *, total - coalesce(sum(cap) OVER o, 0) AS remains, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS w_left FROM w
      WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, remains * w >= cap::HUGEINT * w_left AS clamped FROM x),
t AS (SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE
      ELSE ((total - coalesce(sum(cap) FILTER (clamped) OVER (), 0)) * w)::DOUBLE / coalesce(sum(w) FILTER (NOT clamped) OVER (), 1)::DOUBLE END AS target FROM c),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
q AS (SELECT *, CASE WHEN source_size > 0 THEN target - whole * source_size ELSE 0.0 END AS rest FROM p),
j AS (SELECT d.*, q.source_size, q.target, q.whole, q.rest, sum(d.size) OVER (PARTITION BY d.source ORDER BY u, tie, size, r) AS upto FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
e AS (SELECT *, upto <= rest AS extra, coalesce(max(CASE WHEN upto <= rest THEN upto END) OVER (PARTITION BY source), 0) AS got FROM j),
l AS (SELECT *, CASE WHEN NOT extra AND size > 0 AND abs(size - (rest - got)) < rest - got
      THEN row_number() OVER (PARTITION BY source, NOT extra AND size > 0 AND abs(size - (rest - got)) < rest - got ORDER BY abs(size - (rest - got)), u, tie, size, r) END AS n FROM e)
SELECT doc_id, size, source_size, target, (CASE WHEN size > 0 THEN (whole + CASE WHEN extra OR n = 1 THEN 1 ELSE 0 END) * size ELSE 0 END)::BIGINT AS taken FROM l
"""

#: Every line's set of words; similar ones are found by any word among the rarest fifth and a bit.
LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no FROM d),
x AS (SELECT doc_id, line_no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM l WHERE doc_id IS NOT NULL),
k AS (SELECT doc_id, line_no, array_to_string(words, ' ') AS key, list_distinct(words) AS words FROM x WHERE len(words) > 0),
f AS (SELECT key, any_value(words) AS words, min((doc_id, line_no)) AS place, count(*) AS copies FROM k GROUP BY key),
e AS (SELECT key, len(words) AS n, unnest(words) AS word FROM f),
c AS (SELECT *, count(*) OVER (PARTITION BY word) AS freq FROM e),
o AS (SELECT key, word, n, row_number() OVER (PARTITION BY key ORDER BY freq, word) AS i FROM c),
p AS (SELECT * FROM o WHERE i <= n - (4 * n + 4) // 5 + 1),
m AS (SELECT DISTINCT a.key AS key, b.key AS other FROM p a JOIN p b ON a.word = b.word AND a.key <> b.key AND 4 * a.n <= 5 * b.n AND 4 * b.n <= 5 * a.n),
s AS (SELECT DISTINCT m.key FROM m JOIN f a ON a.key = m.key JOIN f b ON b.key = m.other
      WHERE b.place < a.place AND 9 * len(list_intersect(a.words, b.words)) >= 4 * (len(a.words) + len(b.words))),
g AS (SELECT DISTINCT k.doc_id, k.line_no, CASE WHEN s.key IS NOT NULL THEN 'similar' ELSE 'equal' END AS kind
      FROM k JOIN f USING (key) LEFT JOIN s USING (key) WHERE s.key IS NOT NULL OR (k.doc_id, k.line_no) <> f.place),
n AS (SELECT doc_id, count(*) FILTER (kind = 'equal') AS n_equal, count(*) FILTER (kind = 'similar') AS n_similar, array_to_string(list(DISTINCT line_no::INTEGER ORDER BY line_no::INTEGER), ',') AS gone FROM g GROUP BY doc_id)
SELECT d.doc_id, len(d.lines)::INTEGER AS n_lines, coalesce(n_equal, 0) AS n_equal, coalesce(n_similar, 0) AS n_similar, coalesce(gone, '') AS removed_lines
FROM d LEFT JOIN n ON d.doc_id = n.doc_id
"""


def quality_rules_sql() -> str:
    """Every n-gram of every text, and which words lie in one that occurs again."""
    lengths = (3, *quality_rules.GRAM_LIMITS)
    gram = lambda n: " || ' ' || ".join(["word", *[f"lead(word, {k}) OVER o" for k in range(1, n)]])
    grams = ", ".join(f"{gram(n)} AS g{n}" for n in lengths)
    again = ", ".join(f"(g{n} IS NOT NULL AND count(*) OVER (PARTITION BY r, g{n}) > 1)::INTEGER AS a{n}" for n in lengths)
    inside = ", ".join(f"max(a{n}) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in lengths)
    chars = ", ".join(f"coalesce(sum(length(word)) FILTER (c{n} = 1), 0)::BIGINT AS dup_chars_{n}" for n in quality_rules.GRAM_LIMITS)
    zero = ", ".join(f"coalesce(dup_chars_{n}, 0)::BIGINT AS dup_chars_{n}" for n in quality_rules.GRAM_LIMITS)
    bad = " OR ".join(f"dup_chars_{n} > {most} * word_chars" for n, most in quality_rules.GRAM_LIMITS.items())
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
g AS (SELECT r, i, word, {grams} FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
a AS (SELECT r, i, word, {again} FROM g),
c AS (SELECT r, word, {inside} FROM a),
n AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (c3 = 1) AS n_repeat_words, {chars} FROM c GROUP BY r),
s AS (SELECT r, string_split(text, chr(10)) AS lines FROM d),
l AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM s),
m AS (SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY i) AS nth FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
u AS (SELECT r, count(*) AS n_dup_lines, sum(length(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ''))) AS dup_line_chars FROM m WHERE nth > 1 GROUP BY r),
v AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars, {zero}
      FROM d LEFT JOIN n USING (r) LEFT JOIN u USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM v)
SELECT *, NOT base_failed AND NOT (n_symbols > {quality_rules.SYMBOL_LIMIT} * n_words OR dup_line_chars > {quality_rules.LINE_LIMIT} * word_chars OR {bad}) AS kept FROM b
"""


#: Every window of 50 bytes (in hexadecimal, from pieces of 1,000 bytes) with the smallest document that it starts in.
SUBSTRING_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
c AS (SELECT r, doc_id, n, unnest(range(0, n, 1000)) AS base, h FROM d),
k AS (SELECT r, doc_id, n, base, substr(h, 2 * base + 1, 2098) AS piece FROM c),
b AS (SELECT r, doc_id, n, base + o AS i, substr(piece, 2 * o + 1, 100) AS window_50, substr(piece, 2 * o + 1, 2) AS byte FROM (SELECT *, unnest(range(0, least(1000, n - base))) AS o FROM k)),
f AS (SELECT window_50, min(doc_id) AS first FROM b WHERE i <= n - 50 GROUP BY window_50),
s AS (SELECT b.*, coalesce(f.first < b.doc_id, false)::INTEGER AS starts FROM b LEFT JOIN f ON b.window_50 = f.window_50 AND b.i <= b.n - 50),
g AS (SELECT r, i, byte, max(starts) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM s),
e AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY r ORDER BY i) AS before FROM g),
t AS (SELECT r, sum(gone)::BIGINT AS n_removed, count(*) FILTER (gone = 1 AND before = 0) AS n_spans, string_agg(byte, '' ORDER BY i) FILTER (gone = 0) AS kept FROM e GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN t USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": MIX_SOURCES,
        "op3_line_dedup": LINE_DEDUP,
        "op5_exact_topk": exact_topk.ORACLE,
        "op6_quality_rules": quality_rules_sql(),
        "op10_substring_dedup": SUBSTRING_DEDUP,
        "op12_merkle_manifest": merkle.oracle_sql(),
        "op13_spelling_variants": spelling.ORACLE,
    }
