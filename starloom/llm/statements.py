"""DuckDB statements with the rows that the registered queries must return."""

from __future__ import annotations

from starloom.llm.secret_index import RULES

SPACE = r"[\x20\x09-\x0D]"

OP6 = f"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp,
         sha256(regexp_replace(coalesce(text, ''), '{SPACE}+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id)
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER q AS k,
         (SELECT sum(size) FROM d) - coalesce(sum(3 * source_size) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
         sum(weight) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM s WINDOW q AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
c AS (SELECT k, words::BIGINT AS words, rest::BIGINT AS rest FROM o WHERE 3 * source_size * rest > words * weight ORDER BY k LIMIT 1),
t AS (
  SELECT o.source, source_size, weight,
         CASE WHEN c.k IS NULL OR o.k < c.k THEN 3.0::DOUBLE * source_size
              ELSE c.words::DOUBLE * weight / c.rest::DOUBLE END AS target
  FROM o LEFT JOIN c ON true),
q AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.weight,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS until
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY (turn * source_size + until) * (10 // weight), source NULLS FIRST, turn, doc_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM (SELECT *, unnest(range(3)) AS turn FROM q WHERE size > 0)),
k AS (
  SELECT doc_id, sum(greatest(0, least(size, (SELECT sum(size) FROM d) - before)))::BIGINT AS taken FROM f GROUP BY doc_id)
SELECT q.doc_id, q.size::BIGINT AS size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN k USING (doc_id)
"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _rule_cte(n: int) -> str:
    """Start and length of the matches of a rule, from the pieces between its matches."""
    r = RULES[n]
    p = _quoted(r.pattern)
    return f"""m{n} AS (
  SELECT doc_id, string_split_regex(t, '{p}') AS a, regexp_extract_all(t, '{p}') AS b,
         regexp_extract_all(t, '{p}', {r.tested}) AS c FROM d WHERE regexp_matches(t, '{p}')),
e{n} AS (SELECT doc_id, a, b, c, unnest(range(1, len(b) + 1)) AS i FROM m{n}),
f{n} AS (
  SELECT doc_id, {n} AS k, length(b[i]) AS n,
         list_sum([length(x) for x in a[1:i]]) + coalesce(list_sum([length(x) for x in b[1:i-1]]), 0) AS s
  FROM e{n} WHERE length(c[i]) >= {r.least})"""


_ALL = " UNION ALL ".join(f"SELECT * FROM f{n}" for n in range(len(RULES)))
_KIND = " ".join(f"WHEN {n} THEN '{r.kind}'" for n, r in enumerate(RULES))
_COUNTS = ", ".join(f"count(*) FILTER (WHERE k = {n}) AS n_{r.kind}" for n, r in enumerate(RULES))
OP10 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{', '.join(_rule_cte(n) for n in range(len(RULES)))},
g AS (SELECT *, CASE k {_KIND} END || ':' || s::BIGINT || ':' || (s + n)::BIGINT AS part FROM ({_ALL})),
h AS (SELECT doc_id, {_COUNTS}, string_agg(part, ',' ORDER BY s, k) AS spans FROM g GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in RULES)},
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN h ON d.doc_id = h.doc_id
"""

OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
         ELSE list_distinct([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] for i in range(1, len(words) - 1)]) END AS s
  FROM w),
n AS MATERIALIZED (SELECT doc_id, len(s)::BIGINT AS n_shingles FROM g),
t AS MATERIALIZED (SELECT doc_id, unnest(s) AS t FROM g),
l AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n_both
        FROM t p JOIN t q ON p.t = q.t AND p.doc_id <> q.doc_id GROUP BY ALL) o
  JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b
  WHERE 100 * n_both >= 90 * (x.n_shingles + y.n_shingles - n_both)),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.c = l.a)
SELECT n.doc_id, n_shingles, min(c) AS component_id FROM n JOIN r ON n.doc_id = r.doc_id GROUP BY ALL
"""

OP2 = """
WITH d AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
e AS (
  SELECT page_id, payload_bytes, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)
    for i in range(32)], '') AS payload_digest
  FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM e)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

OP4 = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM p)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 10
"""

OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, vec_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS n
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, n::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE n <= 5
"""

OP12 = r"""
WITH c AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS tab
  FROM (SELECT unnest(range(256)) AS i)),
w AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark)),
f AS MATERIALIZED (
  SELECT side, id, unnest(words || [words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) AS f FROM w),
h AS MATERIALIZED (
  SELECT f, xor(list_reduce([4294967295] || [('0x' || substr(hex(f), 2 * i + 1, 2))::BIGINT for i in range(strlen(f))],
                            lambda x, b: xor(x >> 8, tab[(xor(x, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM f), c),
g AS (
  SELECT bucket,
         floor(1000 * ln((count(*) FILTER (WHERE side = 't') + 1)::DOUBLE * ((SELECT count(*) FROM f WHERE side = 'd') + 10000)
               / ((count(*) FILTER (WHERE side = 'd') + 1)::DOUBLE * ((SELECT count(*) FROM f WHERE side = 't') + 10000))))::BIGINT AS gain
  FROM f JOIN h USING (f) GROUP BY bucket),
m AS (SELECT id, floor(sum(gain) / count(*))::BIGINT AS weight FROM f JOIN h USING (f) JOIN g USING (bucket) WHERE side = 'd' GROUP BY id),
s AS (
  SELECT id AS doc_id, len(words) AS n, greatest(0, 2 * len(words) - 1)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN m USING (id) WHERE side = 'd'),
r AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) AS k, count(*) FILTER (WHERE n >= 20) OVER () AS fit FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN n >= 20 AND k <= 25 * fit // 100 THEN k END AS rank FROM r
"""

STATEMENTS = {
    "op2_arc_convert": OP2,
    "op3_signature_join": OP3,
    "op4_pivot_topk": OP4,
    "op6_exact_dedup": OP6,
    "op8_fair_mix": OP8,
    "op10_secret_index": OP10,
    "op11_residue_negatives": OP11,
    "op12_importance_resample": OP12,
}
