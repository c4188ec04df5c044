"""DuckDB SQL for the queries of this subpackage that SQL can express, over whole tables."""

from __future__ import annotations

DECONTAMINATION = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s : s + 12], ' ') AS win
  FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS t(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, s, n, array_to_string(w[s : s + n - 1], ' ') AS win
  FROM d, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(s)),
hit AS (SELECT rid, s, n, item_id FROM dw JOIN bw USING (n, win)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY rid),
ids AS (
  SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN ids USING (rid)
"""

_QUINTET = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {5 * i + 1}, 5) AS INTEGER) >> {shift}) & 31), 1)"
    for i in range(8) for shift in (15, 10, 5, 0))

WARC = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS h FROM pages),
own AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, {_QUINTET} AS payload_digest,
       CASE WHEN top IS NULL OR page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top IS NULL OR page_id IS NOT DISTINCT FROM top THEN NULL ELSE top END AS refers_to
FROM p JOIN own USING (h)
"""

SUBSTRING = r"""
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT rid, s, md5(array_to_string(w[s : s + 19], ' ')) AS k
  FROM d, unnest(range(1, greatest(len(w) - 18, 1))) AS t(s)),
late AS (SELECT rid, s FROM (SELECT rid, s, row_number() OVER (PARTITION BY k ORDER BY rid, s) AS nth FROM win) WHERE nth > 1),
gone AS (SELECT DISTINCT rid, p FROM late, unnest(range(s, s + 20)) AS t(p)),
word AS (SELECT rid, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (
  SELECT rid, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS line
  FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

MIXING = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CAST((rank - 1) % 3 + 1 AS DOUBLE) AS w, CAST(source_size * 3 AS DOUBLE) AS cap
  FROM (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM s)),
l AS (
  SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (SELECT source, source_size, rank, least(max(level) OVER () * w, cap) AS target FROM l),
p AS (
  SELECT rid, doc_id, size, source_size, target, rank,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id NULLS FIRST, size, rid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT rid, size, rank, upto + e * source_size AS place, (upto + e * source_size) / target AS finish
  FROM p, (SELECT unnest([0, 1, 2]) AS e) WHERE size > 0),
r AS (SELECT rid, size, sum(size) OVER (ORDER BY finish, rank, place ROWS UNBOUNDED PRECEDING) AS run FROM c),
k AS (SELECT rid, sum(size) AS taken FROM r WHERE run <= (SELECT sum(size) FROM d) GROUP BY rid)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM p LEFT JOIN k USING (rid)
"""

#: name, pattern, and what a match must have besides; ``h`` is the match.
_SECRETS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
     r"""length(regexp_extract(h, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)) >= 8"""),
    ("access", "AKIA[A-Z0-9]+", "length(h) >= 16"),
    ("hex", "[0-9a-f]+", "length(h) >= 32"),
    ("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", "true"),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", "true"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", "true"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "true"),
)
_SECRET_SPANS = "\nUNION ALL ".join(
    f"""SELECT rid, {k} AS kind, '{name}' AS label, a, a + length(h) AS z FROM (
  SELECT rid, hits[i] AS h, CAST(list_sum(list_transform(gaps[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1 : i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM (SELECT rid, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS gaps FROM d), unnest(range(1, len(hits) + 1)) AS t(i)
) WHERE {good}"""
    for k, (name, pattern, good) in enumerate(_SECRETS))

SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({_SECRET_SPANS}),
per AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(label || ':' || a || ':' || z, ',' ORDER BY a, kind) FILTER (kind < 3) AS base,
         string_agg(label || ':' || a || ':' || z, ',' ORDER BY a, kind) AS every
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN per USING (rid)
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT u, u AS w FROM links UNION SELECT reach.u, links.w FROM reach JOIN links ON reach.w = links.u),
comp AS (SELECT u, min(w) AS c FROM reach GROUP BY u),
degree AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(vec_id = coalesce(c, vec_id), false) AS kept
FROM v LEFT JOIN comp ON comp.u = v.vec_id LEFT JOIN degree ON degree.u = v.vec_id
"""

SQL = {
    "op1_decontamination": DECONTAMINATION, "op3_warc": WARC, "op4_substring": SUBSTRING, "op7_mixing": MIXING, "op8_secrets": SECRETS,
    "op10_embeddings": EMBEDDINGS,
}
