"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH u AS (
  SELECT page_id, url,
    {LOWERED.format(r"coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
n AS (SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html?|/)\z', '') AS name FROM u),
l AS (SELECT DISTINCT name FROM n WHERE regexp_matches(url, '[?&]utm_[a-z]+=') AND name > ''),
r AS (
  SELECT n.*, l.name IS NOT NULL AS listed,
    CASE
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM n LEFT JOIN l ON n.name = l.name)
SELECT page_id, host, path, rule, listed,
  CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

#: Common tables up to ``judged`` (documents with counts, base_failed, kept), from a table ``documents``.
OP5_TABLES = r"""
w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (
  SELECT doc_id, sum(least(5, coalesce(later - i, 5)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS later FROM rep) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN cov USING (doc_id)),
m AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    [coalesce(word_chars * 100 // nullif(n_words, 0), 0), coalesce(n_symbols * 1000 // nullif(n_words, 0), 0),
     coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0), coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0)] AS v
  FROM c),
h AS (
  SELECT lang, source, k, CASE WHEN x < 64 THEN x ELSE (len(bin(x)) - 6) * 64 + (x >> (len(bin(x)) - 6)) END AS b, count(*) AS n
  FROM (SELECT lang, source, unnest([1, 2, 3, 4]) AS k, unnest(v) AS x FROM m WHERE NOT base_failed) GROUP BY ALL),
q0 AS (
  SELECT lang, source, k, b, n, 'own' AS lvl FROM h
  UNION ALL SELECT lang, NULL, k, b, sum(n), 'lang' FROM h GROUP BY ALL
  UNION ALL SELECT NULL, NULL, k, b, sum(n), 'all' FROM h GROUP BY ALL),
q1 AS (
  SELECT *, sum(n) OVER (PARTITION BY lvl, lang, source, k ORDER BY b) AS upto, sum(n) OVER (PARTITION BY lvl, lang, source, k) AS texts FROM q0),
q2 AS (
  SELECT lvl, lang, source, k, texts, t, min(b) FILTER (upto * 20 >= texts * t) AS b
  FROM q1, (SELECT unnest([3, 5, 10, 15, 17]) AS t) GROUP BY ALL),
q AS (
  SELECT lvl, lang, source, k, texts, t, CASE WHEN b < 64 THEN b ELSE (b - ((b - 32) >> 6) * 64) << ((b - 32) >> 6) END AS s FROM q2),
p AS (
  SELECT o.lang, o.source, o.k, o.t, (o.texts * o.s + 100 * ((l.texts * l.s + 100 * e.s) // (l.texts + 100))) // (o.texts + 100) AS s
  FROM q o JOIN q l ON l.lvl = 'lang' AND l.k = o.k AND l.t = o.t AND l.lang IS NOT DISTINCT FROM o.lang
  JOIN q e ON e.lvl = 'all' AND e.k = o.k AND e.t = o.t
  WHERE o.lvl = 'own'),
z AS (
  SELECT lang, source, k, max(s) FILTER (t = 5) - 6 * greatest((max(s) FILTER (t = 10) - max(s) FILTER (t = 3)) // 2, 60) AS low,
    max(s) FILTER (t = 15) + 6 * greatest((max(s) FILTER (t = 17) - max(s) FILTER (t = 10)) // 2, [100, 20, 60, 30][k]) AS high
  FROM p GROUP BY lang, source, k),
f AS (
  SELECT lang, source, max(low) FILTER (k = 1) AS low1, max(high) FILTER (k = 1) AS high1, max(high) FILTER (k = 2) AS high2,
    max(high) FILTER (k = 3) AS high3, max(high) FILTER (k = 4) AS high4
  FROM z GROUP BY ALL),
judged AS (
  SELECT m.*, NOT base_failed AND coalesce(v[1] >= low1 AND v[1] <= high1 AND v[2] <= high2 AND v[3] <= high3 AND v[4] <= high4, true) AS kept
  FROM m LEFT JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source)
"""

OP5 = f"WITH {OP5_TABLES} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"

OP6 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
g AS (SELECT page_id, b, min(page_id) OVER (PARTITION BY b) AS first_id, CAST(unhex(sha1(b)) AS BIT)::VARCHAR AS bits FROM p)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + substr(bits, 5 * i + 1, 1)::INT * 16 + substr(bits, 5 * i + 2, 1)::INT * 8 + substr(bits, 5 * i + 3, 1)::INT * 4
      + substr(bits, 5 * i + 4, 1)::INT * 2 + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM g
"""


def near_groups(documents: str, size: int, percent: int) -> str:
    """Common tables up to ``grouped`` (doc_id, n_shingles, component_id) of a table."""
    lowered = LOWERED.format("coalesce(text, '')")
    return rf"""
nw AS (SELECT doc_id, regexp_extract_all({lowered}, '[^\x20\x09-\x0D]+') AS ws FROM {documents}),
ns AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + {size - 1}], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {size - 2}, 2))) AS i FROM nw WHERE len(ws) > 0)),
nn AS (SELECT doc_id, count(*) AS n FROM ns GROUP BY doc_id),
nc AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS rep, n FROM (SELECT doc_id, count(*) AS n, string_agg(s, chr(10) ORDER BY s) AS k FROM ns GROUP BY doc_id)),
nr AS (SELECT s, doc_id AS rep FROM ns WHERE doc_id IN (SELECT rep FROM nc)),
np AS (SELECT x.rep AS a, y.rep AS b, count(*) AS shared FROM nr x JOIN nr y ON x.s = y.s AND x.rep < y.rep GROUP BY ALL),
nl AS (
  SELECT a, b FROM np JOIN nn x ON x.doc_id = a JOIN nn y ON y.doc_id = b WHERE 100 * shared >= {percent} * (x.n + y.n - shared)),
ne AS (SELECT a, b FROM nl UNION SELECT b, a FROM nl),
nk(a, b) AS (SELECT DISTINCT rep, rep FROM nc UNION SELECT nk.a, ne.b FROM nk JOIN ne ON nk.b = ne.a),
nm AS (SELECT a, min(b) AS c FROM nk GROUP BY a),
grouped AS (
  SELECT d.doc_id, coalesce(nn.n, 0) AS n_shingles, coalesce(nm.c, d.doc_id) AS component_id
  FROM {documents} d LEFT JOIN nn USING (doc_id) LEFT JOIN nc USING (doc_id) LEFT JOIN nm ON nm.a = nc.rep)
"""


OP8 = f"WITH RECURSIVE {near_groups('documents', 3, 85)} SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM grouped"

OP10 = f"""
WITH n AS (SELECT doc_id, {LOWERED.format("coalesce(text, '')")} AS t FROM documents),
g AS (SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, sha256(t) AS text_sha256 FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

# the cyclic redundancy check bit by bit, of the digits of a number
_CRC = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split_regex(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda s, x: list_reduce(list_prepend(xor(s, x), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384)))"

OP11 = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS txt,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({{'role': role, 'txt': txt}} ORDER BY pos) AS ts FROM t GROUP BY c),
h AS (SELECT c, ts, (xor({_CRC}, 4294967295) % 9)::BIGINT AS h FROM o),
r AS (SELECT h.c, list_concat(coalesce(o.ts[1:h.h], []), h.ts[h.h + 1:]) AS ts FROM h LEFT JOIN o ON o.c = h.c - h.c % 5),
p AS (SELECT c, d, len(ts) = d AS is_end, ts[1:d] AS k FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM r)),
n AS (
  SELECT k, d, min(c) AS c, count(*) AS n, (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(k[d].txt) END AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '')) AS ends
  FROM p GROUP BY k, d),
ch AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (k, d)),
u AS (SELECT k[1:e] AS k, e AS d, saved, n_children FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM f)),
s AS (SELECT k, d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM u GROUP BY ALL)
SELECT f.c AS conv_id, f.d AS depth, q.c AS parent_conv_id, f.n AS n_convs, f.n_children, n_leaves, saved_tokens, f.ends AS ends_sha256
FROM f JOIN s USING (k, d) LEFT JOIN n q ON q.d = f.d - 1 AND q.k = f.k[1:f.d - 1]
"""

OP12 = """
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS r, doc_id, hex(encode(coalesce(text, ''))) AS x,
    strlen(coalesce(text, '')) AS n
  FROM documents),
s AS (
  SELECT r, p, x[2 * p - 1:2 * p + 198] AS g FROM (SELECT r, x, unnest(range(1, n - 98)) AS p FROM d WHERE n >= 100)),
m AS (SELECT r, p FROM (SELECT r, p, row_number() OVER (PARTITION BY g ORDER BY r, p) AS k FROM s) WHERE k > 1),
c AS (SELECT r, p, coalesce(p - lag(p) OVER (PARTITION BY r ORDER BY p) > 100, true) AS head FROM m),
i AS (SELECT r, p, sum(head::INT) OVER (PARTITION BY r ORDER BY p) AS run FROM c),
e AS (SELECT r, run, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY r, run),
k AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 1) AS since, lead(a) OVER (PARTITION BY r ORDER BY a) AS next FROM e),
o AS (
  SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
    string_agg(x[2 * since - 1:2 * a - 2] || CASE WHEN next IS NULL THEN x[2 * b - 1:] ELSE '' END, '' ORDER BY a) AS kept
  FROM k JOIN d USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN o USING (r)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{_TERM}') AS ts FROM documents),
i AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{_TERM}') AS ts FROM benchmark),
g AS (SELECT count(*) FILTER (len(ts) > 0) AS nd, sum(len(ts))::BIGINT AS nt FROM d),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, g GROUP BY term, nd),
v AS (
  SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(ts) * nd) // nt))) AS v
  FROM f JOIN d USING (r) JOIN w USING (term), g),
a AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(ts) AS term FROM i) GROUP BY ALL),
s AS (SELECT q, item_id, r, sum(times * v)::BIGINT AS score FROM a JOIN v USING (term) GROUP BY ALL),
k AS (
  SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM s JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 20
"""

ORACLE: dict[str, str] = {
    "op4_url_filters": OP4,
    "op5_quality_rules": OP5,
    "op6_warc": OP6,
    "op8_minhash_dedup": OP8,
    "op10_exact_dedup": OP10,
    "op11_prefix_trie": OP11,
    "op12_suffix_dedup": OP12,
    "op13_ranked_search": OP13,
}
