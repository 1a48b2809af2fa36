"""DuckDB SQL for the queries op1 to op11 that SQL can express; it goes by the definition, not by the operator's method."""

from __future__ import annotations

from quern.llm.licenses import LEAST, MARKS, TEMPLATES
from quern.llm.mixing import BLOCK_WORDS, GROUP, SHARD_ROWS

_WORD = r"[^\x20\x09-\x0D]+"
_EITHER = "".join
_KEYS = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace("'", "''")


def _spans(kind: str, number: int, pattern: str, group: int, least: int) -> str:
    return f"""list_filter(list_transform(range(1, len(m_{kind}) + 1), lambda i: struct_pack(
  s := CAST(list_sum(list_transform(g_{kind}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m_{kind}[1:i-1], lambda x: length(x))), 0) AS BIGINT),
  k := {number},
  e := CAST(list_sum(list_transform(g_{kind}[1:i], lambda x: length(x))) + list_sum(list_transform(m_{kind}[1:i], lambda x: length(x))) AS BIGINT),
  n := length(v_{kind}[i]), name := '{kind}')), lambda z: z.n >= {least})"""


_RULES = (("assign", 0, _ASSIGN, 2, 6), ("access", 1, "AKIA[A-Z0-9]+", 0, 20), ("hex", 2, "[0-9a-f]{24,}", 0, 24))

SECRETS = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS (SELECT doc_id, {", ".join(
    f"regexp_extract_all(text, '{p}', 0) AS m_{k}, regexp_extract_all(text, '{p}', {g}) AS v_{k}, string_split_regex(text, '{p}') AS g_{k}"
    for k, _, p, g, _ in _RULES)} FROM t),
s AS (SELECT doc_id, {", ".join(f"{_spans(*r)} AS s_{r[0]}" for r in _RULES)} FROM f),
j AS (SELECT *, coalesce(array_to_string(list_transform(list_sort(list_transform(
  list_concat(list_concat(s_assign, s_access), s_hex), lambda z: struct_pack(s := z.s, k := z.k, e := z.e))),
  lambda z: concat(CASE z.k WHEN 0 THEN 'assign' WHEN 1 THEN 'access' ELSE 'hex' END, ':', z.s, ':', z.e)), ','), '') AS spans FROM s)
SELECT doc_id, CAST(len(s_assign) AS BIGINT) AS n_assign, CAST(len(s_access) AS BIGINT) AS n_access,
  CAST(len(s_hex) AS BIGINT) AS n_hex, sha256(spans) AS base_sha256, spans FROM j
"""

_VECTORS = """
v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

TOP_K = f"""
WITH {_VECTORS},
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
    CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
o AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
r AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM o JOIN p USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5
"""

SUBSTRINGS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM w WHERE len(w) >= 20),
h AS (SELECT doc_id, s, array_to_string(w[s:s+19], ' ') AS gram FROM g),
d AS (SELECT doc_id, s, row_number() OVER (PARTITION BY gram ORDER BY doc_id, s) AS n FROM h),
c AS (SELECT DISTINCT doc_id, s + j AS pos FROM d, range(0, 20) AS r(j) WHERE n > 1),
k AS (SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(coalesce(gone, []), i)), lambda i: w[i]), ' '), '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""


def _seats(table: str, group: str, votes: str, house: str, order: str, out: str) -> str:
    return f"""
{out}_b AS (SELECT *, sum({votes}) OVER (PARTITION BY {group}) AS _v, count(*) OVER (PARTITION BY {group}) AS _n FROM {table}),
{out}_l AS (SELECT *, CASE WHEN _v > 0 THEN {votes} / CAST(_v AS DOUBLE) ELSE 0 END AS _share FROM {out}_b),
{out}_r AS (SELECT *, greatest(0, CAST(ceil(_share * ({house} - _n / 2.0) - 0.5) AS BIGINT) - 1) AS _low,
  CAST(floor(_share * ({house} + _n / 2.0) + 0.5) AS BIGINT) + 1 AS _high FROM {out}_l),
{out}_o AS (SELECT *, {house} - sum(_low) OVER (PARTITION BY {group}) AS _open FROM {out}_r),
{out}_k AS (SELECT {group}, {order}, unnest(range(_low, _high)) AS _k, {votes} AS _votes, _open FROM {out}_o WHERE {votes} > 0),
{out}_w AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY CAST(_votes AS DOUBLE) / (2 * _k + 1) DESC, {order}, _k) <= _open AS won FROM {out}_k),
{out}_c AS (SELECT {group}, {order}, count(*) FILTER (won) AS more FROM {out}_w GROUP BY ALL),
{out} AS (SELECT o.*, o._low + coalesce(c.more, 0) AS seats FROM {out}_o o LEFT JOIN {out}_c c ON o.{group} = c.{group} AND o.{order} = c.{order})"""


MIXING = rf"""
WITH d AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS sk,
  CAST(coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS BIGINT) AS size, md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS m FROM documents),
s0 AS (SELECT sk, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS source_rows FROM d GROUP BY sk),
s1 AS (SELECT *, 1 AS _one, row_number() OVER (ORDER BY source NULLS LAST) AS _at FROM s0),
s2 AS (SELECT *, [3, 1, 2][(_at - 1) % 3 + 1] AS _w, 2 * source_size AS _cap FROM s1),
s3 AS (SELECT *, CAST(_cap AS DOUBLE) / _w AS _ratio, sum(source_size) OVER () AS _all FROM s2),
s4 AS (SELECT *, (CAST(1.5 AS DOUBLE) * CAST(_all AS DOUBLE)
   - coalesce(sum(_cap) OVER (ORDER BY _ratio, _at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(_w) OVER (ORDER BY _ratio, _at ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS _level FROM s3),
s5 AS (SELECT *, (SELECT _level FROM s4 WHERE _level <= _ratio ORDER BY _ratio, _at LIMIT 1) AS _lv FROM s4),
s6 AS (SELECT *, least(CAST(_cap AS DOUBLE), coalesce(_lv, CAST('inf' AS DOUBLE)) * _w) AS target FROM s5),
s7 AS (SELECT *, CAST(floor(sum(target) OVER () + 0.5) AS BIGINT) AS _house FROM s6),
{_seats("s7", "_one", "target", "_house", "_at", "s8").strip()},
s9 AS (SELECT sk, source_size, target, seats AS q, CAST(ceil(source_rows / {SHARD_ROWS}.0) AS BIGINT) AS shards FROM s8),
e AS (SELECT d.*, source_size, target, q, CAST('0x' || substr(m, 1, 8) AS BIGINT) % shards AS shard FROM d JOIN s9 USING (sk)),
t0 AS (SELECT sk, shard, sk || '/' || (shard // {GROUP}) AS sg, CAST(sum(size) AS BIGINT) AS words, any_value(q) AS _q FROM e GROUP BY sk, shard),
g0 AS (SELECT sk, sg, CAST(sum(words) AS BIGINT) AS words, any_value(_q) AS _gq, min(shard) AS first_shard FROM t0 GROUP BY sk, sg),
{_seats("g0", "sk", "words", "_gq", "first_shard", "g1").strip()},
g2 AS (SELECT t0.sk, shard, t0.sg, t0.words, g1.seats AS _sq FROM t0 JOIN g1 ON t0.sg = g1.sg),
{_seats("g2", "sg", "words", "_sq", "shard", "t1").strip()},
t2 AS (SELECT sk, shard, words, least(seats, 2 * words) AS take FROM t1),
t3 AS (SELECT sk, shard, words, CASE WHEN words > 0 THEN take // words ELSE 0 END AS whole, CASE WHEN words > 0 THEN take % words ELSE 0 END AS rest FROM t2),
b0 AS (SELECT sk, shard, words, rest, unnest(range(0, (words + {BLOCK_WORDS - 1}) // {BLOCK_WORDS})) AS j FROM t3 WHERE rest > 0),
b1 AS (SELECT sk, shard, j, rest, least({BLOCK_WORDS}, words - j * {BLOCK_WORDS}) AS len, substr(md5('mix-1|' || sk || '|' || shard || '|' || j), 1, 7) AS h FROM b0),
b2 AS (SELECT *, sum(len) OVER (PARTITION BY sk, shard ORDER BY h, j ROWS UNBOUNDED PRECEDING) - len AS before FROM b1),
w AS (SELECT sk, shard, j, j * {BLOCK_WORDS} AS w0, j * {BLOCK_WORDS} + least(len, rest - before) AS w1 FROM b2 WHERE before < rest),
p AS (SELECT *, row_number() OVER () AS rid, CAST(sum(size) OVER (PARTITION BY sk, shard ORDER BY m, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS b FROM e),
k AS (SELECT rid, sk, shard, b - size AS a, b, unnest(range((b - size) // {BLOCK_WORDS}, (b + {BLOCK_WORDS - 1}) // {BLOCK_WORDS})) AS j FROM p WHERE size > 0),
x AS (SELECT rid, sum(greatest(0, least(b, w1) - greatest(a, w0))) AS part FROM k JOIN w USING (sk, shard, j) GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(whole * size + coalesce(part, 0) AS BIGINT) AS taken
FROM p JOIN t3 USING (sk, shard) LEFT JOIN x USING (rid)
"""


def _base32() -> str:
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = [
        f"substr('{alphabet}', ((CAST('0x' || substr(h, {10 * i + 1}, 10) AS BIGINT) >> {35 - 5 * j}) & 31) + 1, 1)"
        for i in range(4) for j in range(8)
    ]
    return " || ".join(parts)


_N = "chr(13) || chr(10)"
WARC = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, octet_length(encode(html)) AS n, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p),
d AS (SELECT *, {_base32()} AS digest, page_id <> first AS again,
  'HTTP/1.1 200 OK' || {_N} || 'Content-Type: text/html; charset=utf-8' || {_N} || 'Content-Length: ' || n || {_N} || {_N} AS http,
  CASE WHEN regexp_matches(url, '[\\x00-\\x20\\x7F]') THEN array_to_string(list_transform(string_split(url, ''),
    lambda c: CASE WHEN ascii(c) <= 32 OR ascii(c) = 127 THEN printf('%%%02X', ascii(c)) ELSE c END), '') ELSE url END AS uri FROM h),
r AS (SELECT *, 'WARC/1.1' || {_N} || 'WARC-Type: ' || CASE WHEN again THEN 'revisit' ELSE 'response' END || {_N}
  || 'WARC-Record-ID: <urn:page:' || page_id || '>' || {_N} || 'WARC-Date: 2020-01-01T00:00:00Z' || {_N}
  || coalesce('WARC-Target-URI: ' || uri || {_N}, '') || 'WARC-Payload-Digest: sha1:' || digest || {_N}
  || CASE WHEN again THEN 'WARC-Refers-To: <urn:page:' || first || '>' || {_N}
    || 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || {_N} ELSE '' END
  || 'Content-Type: application/http;msgtype=response' || {_N}
  || 'Content-Length: ' || (octet_length(encode(http)) + CASE WHEN again THEN 0 ELSE n END) || {_N} || {_N} || http
  || CASE WHEN again THEN '' ELSE html END || {_N} || {_N} AS record FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to, CAST(octet_length(encode(record)) AS BIGINT) AS record_bytes, sha256(record) AS record_sha256 FROM r
"""

_quoted = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in sorted(TEMPLATES.items()))
_odd = "".join(MARKS).replace("'", "''")
_marks = f"translate(lower(coalesce(text, '')), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || '{_odd}', '{' ' * (5 + len(MARKS))}')"
_grams = """list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)"""

LICENSES = f"""
WITH t AS (SELECT name, {_grams} AS g FROM (SELECT name, list_filter(string_split({_marks}, ' '), lambda x: x <> '') AS w
  FROM (VALUES {_quoted}) v(name, text))),
d AS (SELECT doc_id, {_grams} AS g FROM (SELECT doc_id, list_filter(string_split({_marks}, ' '), lambda x: x <> '') AS w FROM documents)),
u AS (SELECT name, len(g) AS total, unnest(g) AS gram FROM t),
e AS (SELECT doc_id, unnest(g) AS gram FROM d),
m AS (SELECT doc_id, name, any_value(total) AS total, count(*) AS found FROM e JOIN u USING (gram) GROUP BY doc_id, name),
k AS (SELECT doc_id, count(*) AS n, string_agg(concat(name, ':', found, '/', total), ',' ORDER BY name) AS s FROM m WHERE found >= {LEAST} * total GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_licenses, coalesce(s, '') AS licenses FROM d LEFT JOIN k USING (doc_id)
"""
