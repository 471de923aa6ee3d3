"""SQL for the parts of the operators' results that SQL can express.

A model's own columns (scores, posteriors, shards) have no SQL; each query here is its
operator's result without them, and the SQL computes the same from the tables alone.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

#: CRC-32 of a number's digits.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda z: 0::BIGINT)), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295)"""

LM_BASE = rf"""
WITH d AS (SELECT doc_id, coalesce({_CRC} % 5 = 1, false) AS held_out, list_concat(regexp_extract_all({_LOWER}, '{_WORD}'), ['<end of text>']) AS w FROM documents),
t AS (SELECT doc_id, held_out, unnest(w) AS w FROM d), c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY 1), n AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM c)
SELECT t.doc_id, any_value(t.held_out) AS held_out, count(*)::BIGINT AS n_tokens, count(c.c)::BIGINT AS n_known, any_value(n.n) AS train_tokens,
       round(sum(log10((coalesce(c.c, 0) + 0.5) / (n.n + 0.5 * (n.v + 1)))), 4) AS base_score
FROM t LEFT JOIN c ON t.w = c.w CROSS JOIN n GROUP BY t.doc_id"""

COMPONENTS = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * c >= 80 * (a.n + b.n - c)), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(node, seen) AS (SELECT x, x FROM e UNION SELECT e.y, r.seen FROM r JOIN e ON r.node = e.x), k AS (SELECT node, min(seen) AS component FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(k.component, w.doc_id) AS component_id FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN k ON w.doc_id = k.node"""

SIZES = "SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 8 AS size, 'bytes' AS law FROM documents"

SHARDS = """
SELECT count(*)::BIGINT AS rows, (sum(coalesce(strlen(text), 0)) + 8 * count(*))::BIGINT AS bytes, least(24, count(*))::BIGINT AS shards, true AS gapless, true AS near_equal, true AS groups_together FROM documents"""

RULES_BASE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), w AS (SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)), t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM t WHERE n > 1) GROUP BY 1),
o AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words FROM w LEFT JOIN c ON w.doc_id = c.doc_id)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM o"""

# The base kinds of secrets with their patterns, checks and order.
_KINDS = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "length(regexp_extract(m, '{p}', 2)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "[0-9a-f]+", "length(m) >= 24"),
)


def _spans(place: int) -> str:
    """Matches of a kind with their places: the texts between matches are what a split leaves."""
    kind, p, check = _KINDS[place]
    return f"""SELECT doc_id, {place} AS k, '{kind}' AS kind, (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS a, m
 FROM (SELECT doc_id, gaps, ms, i, ms[i] AS m FROM (SELECT doc_id, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}') AS ms, unnest(range(1, len(regexp_extract_all(text, '{p}')) + 1)) AS i FROM documents)) WHERE {check.format(p=p)}"""


SECRETS_BASE = f"""
WITH s AS ({' UNION ALL '.join(_spans(k) for k in range(len(_KINDS)))}), f AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
 string_agg(kind || ':' || a || ':' || (a + length(m)), ',' ORDER BY a, k) AS spans FROM s GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256 FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id"""

FILL_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS k FROM d),
f AS (SELECT *, len(w) AS n, least(k[1] % (len(w) + 1), k[2] % (len(w) + 1)) AS a, greatest(k[1] % (len(w) + 1), k[2] % (len(w) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR k[3] % 100 >= 50 THEN 'plain' WHEN k[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS suf FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""

HARD_NEGATIVES = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, a.label = b.label AS same, a.r = b.r AS own, b.r, b.vec_id, list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score FROM e a JOIN e b ON a.vec_id % 100 = 0),
p AS (SELECT ar, anchor_id, r AS pr, vec_id AS positive_id, score AS positive_score FROM s WHERE same AND NOT own QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.ar, pr ORDER BY score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS b FROM pages),
d AS (SELECT page_id, strlen(b)::BIGINT AS payload_bytes, sha1(b) AS h, row_number() OVER w AS k, first_value(page_id) OVER w AS best FROM p WINDOW w AS (PARTITION BY b ORDER BY page_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (i // 4 * 5 + 1)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN best END AS refers_to FROM d"""
