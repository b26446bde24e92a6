"""SQL for DuckDB that gives the rows of the registered queries which SQL can express, on whole tables and by plainer means.

Spans follow from the pieces between matches; the look-around of weak patterns is expressed by maximal runs and a consumed
character before the match. No SQL stands for queries with a tokenizer, a learned model, an index or the ring's rounds.
"""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"
_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"

OP1 = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda j: substr({_BASE32},
         (((('0x' || substr(h, (j // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (j % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p
"""


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGN = (
    "(" + "|".join(map(_either, ("password", "passwd", "secret", "token"))) + "|" + _either("api") + "_?" + _either("key")
    + r""")[""'']?\x20*[:=]\x20*[""'']?([A-Za-z0-9+/_.=-]+)""".replace('""', '"')
)
_ENDPOINT = r"(?:^|[^A-Za-z0-9.-])((?i:(?:https?://)?[a-z0-9.-]+\.amazonaws\.com)(?:/[A-Za-z0-9._/-]*)?)"
#: A maximal run and the mark behind it, which rules it out.
_RUN = "[A-Za-z0-9+/]+=?"


def _hits(kind: int, pattern: str, group: int) -> str:
    return f"""
  SELECT doc_id, {kind} AS k, unnest(regexp_split_to_array(t, '{pattern}')[:-2]) AS piece,
         unnest(regexp_extract_all(t, '{pattern}')) AS hit, unnest(regexp_extract_all(t, '{pattern}', {group})) AS part,
         unnest(range(len(regexp_extract_all(t, '{pattern}')))) AS i
  FROM d WHERE regexp_matches(t, '{pattern}')"""


def _op2(documents: str) -> str:
    return f"""
WITH d AS ({documents}),
hits AS ({" UNION ALL ".join([
        _hits(0, _ASSIGN, 2), _hits(1, "AKIA[A-Z0-9]+", 0), _hits(2, "[0-9a-f]+", 0), _hits(3, _RUN, 0), _hits(4, _ENDPOINT, 1)])}),
placed AS (
  SELECT *, (sum(length(piece) + length(hit)) OVER (PARTITION BY doc_id, k ORDER BY i))::BIGINT AS e FROM hits),
spans AS (
  SELECT doc_id, k, e - length(CASE WHEN k = 4 THEN part ELSE hit END) AS s, e FROM placed
  WHERE CASE k WHEN 0 THEN length(part) >= 6 WHEN 1 THEN length(hit) >= 20 WHEN 2 THEN length(hit) >= 24
    WHEN 3 THEN length(hit) = 40 AND NOT contains(hit, '=') AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-z]')
      AND regexp_matches(hit, '[A-Z]') ELSE true END),
kept AS (
  SELECT * FROM spans WHERE k < 3 UNION ALL
  SELECT * FROM spans w WHERE k >= 3 AND EXISTS (
    SELECT 1 FROM spans a WHERE a.doc_id = w.doc_id AND (
      (a.k = 1 AND ((a.s <= w.s AND w.s - a.e <= 300) OR (a.s >= w.s AND a.s - w.e <= 300)))
      OR (a.k = 7 - w.k AND ((a.e <= w.s AND w.s - a.e <= 300) OR (a.s >= w.e AND a.s - w.e <= 300)))))),
named AS (
  SELECT *, ['assign', 'access', 'hex', 'secret', 'endpoint'][k + 1] || ':' || s || ':' || e AS name FROM kept),
each AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(name, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg(name, ',' ORDER BY s, k, e) AS spans
  FROM named GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN each ON d.doc_id = each.doc_id
"""


OP2 = _op2("SELECT doc_id, coalesce(text, '') AS t FROM documents")
#: The same over texts with parts of credentials at distances that depend on the document.
PLANTED_SECRETS = _op2("""
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'é' || repeat('pad ', (doc_id % 90)::INTEGER) END
    || CASE WHEN doc_id % 2 = 0 THEN 'AKIA' || upper(substr(md5(doc_id::VARCHAR), 1, 16)) ELSE '' END || repeat(' 漢', (doc_id % 160)::INTEGER)
    || CASE WHEN doc_id % 5 < 3 THEN ' aws_secret_access_key=aB' || substr(md5(doc_id::VARCHAR) || md5(doc_id || 'x'), 1, 37) || '/ ' ELSE ' ' END
    || repeat('filler', (doc_id % 70)::INTEGER)
    || CASE WHEN doc_id % 7 < 4 THEN ' https://Box' || doc_id || '.S3.amazonaws.com/a ' ELSE '' END || coalesce(text, '') AS t
  FROM documents""")

OP3 = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS size,
         (('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 12))::BIGINT::DOUBLE + 0.5)
           / 281474976710656.0::DOUBLE AS u
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sizes),
filled AS (
  SELECT *, row_number() OVER w AS turn,
         1.5::DOUBLE * (SELECT sum(source_size) FROM sizes) - 2 * (sum(source_size) OVER w - source_size) AS rest,
         (SELECT sum(weight) FROM weighed) - (sum(weight) OVER w - weight) AS open
  FROM weighed WINDOW w AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (SELECT * FROM filled WHERE rest * weight <= 2 * source_size * open ORDER BY turn LIMIT 1),
targets AS (
  SELECT f.source, f.source_size,
         CASE WHEN l.turn IS NULL OR f.turn < l.turn THEN (2 * f.source_size)::DOUBLE ELSE l.rest * f.weight / l.open::DOUBLE END AS target
  FROM filled f LEFT JOIN level l ON true),
expected AS (
  SELECT s.*, source_size, target,
         floor(CASE WHEN source_size > 0 THEN least(2.0::DOUBLE, target / source_size::DOUBLE) ELSE 0 END)::BIGINT AS whole
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
running AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS need,
         coalesce(sum(CASE WHEN whole < 2 THEN size ELSE 0 END) OVER (
           PARTITION BY source ORDER BY u, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM expected),
taken AS (
  SELECT *, whole + CASE WHEN whole < 2 AND before + size / 2.0::DOUBLE <= need THEN 1 ELSE 0 END AS copies FROM running)
SELECT doc_id, size::BIGINT AS size, source_size, target, (copies * size)::BIGINT AS taken, source, copies::BIGINT AS copies FROM taken
"""

OP7 = f"""
WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM lists WHERE len(w) >= 5),
shingles AS (
  SELECT DISTINCT * FROM (
    SELECT doc_id, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' '
      || lead(word, 4) OVER o AS s FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE s IS NOT NULL
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM lists WHERE len(w) BETWEEN 1 AND 4),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least_ AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT l.doc_id, coalesce(n, 0) AS n_shingles, least(l.doc_id, coalesce(r.b, l.doc_id)) AS component_id
FROM lists l LEFT JOIN sizes s ON s.doc_id = l.doc_id LEFT JOIN least_ r ON r.a = l.doc_id
"""

OP12 = """
WITH moved AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256::DOUBLE * x::DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT * FROM moved WHERE label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score, anchor_label FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""

SQL: dict[str, str] = {"op1_warc_archive": OP1, "op2_secret_links": OP2, "secret_links_planted": PLANTED_SECRETS, "op3_source_mix": OP3, "op7_ngram_components": OP7, "op12_hard_negatives": OP12}
