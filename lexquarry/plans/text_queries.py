"""Queries over texts and pages: scans, predicates, tokens, markup, tags and ranked search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.functions import scoring, text
from lexquarry.functions.chunking import MOST_CHARS, paragraph_chunks
from lexquarry.operators import joins, ranking
from lexquarry.plans.registry import Tables, query

_NORM = "trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))"
_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
_TOKENS = f"list_filter(string_split({_NORM}, ' '), lambda t: length(t) >= 3 AND t NOT IN ({_STOP}))"


def _has(term: str, norm: str = _NORM) -> str:
    return f"contains(' ' || {norm} || ' ', ' {term} ')"


@query(f"""
SELECT doc_id, {_NORM} AS norm,
       trim(regexp_replace(regexp_replace(lower(text), '[.,_\\-]', ' ', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g')) AS alias_norm
FROM documents""")
def scan_docs_normalize(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.normalize("text").alias("norm"), text.normalize_alias("text").alias("alias_norm"))


@query(f"SELECT doc_id FROM documents WHERE {_has('licensed')}")
def filter_whole_word(t: Tables) -> DataFrame:
    return t.documents.where(text.contains_term(text.normalize("text"), "licensed")).select("doc_id")


@query("""
SELECT d.doc_id, d.lang, d.source FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality = 1 AND l.toxic = 0 AND d.lang IN ('en', 'de') AND d.n_chars >= 200 AND d.source NOT IN ('src0', 'src3')""")
def filter_facets(t: Tables) -> DataFrame:
    docs = t.documents.where(F.col("lang").isin("en", "de") & (F.col("n_chars") >= 200) & ~F.col("source").isin("src0", "src3"))
    good = t.labels.where("quality = 1 AND toxic = 0").select("doc_id")
    return docs.join(good, "doc_id").select("doc_id", "lang", "source")


@query(f"""
SELECT token, count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS n_docs
FROM (SELECT doc_id, unnest({_TOKENS}) AS token FROM documents) GROUP BY token""")
def token_frequency(t: Tables) -> DataFrame:
    words = t.documents.select("doc_id", F.explode(text.tokens(text.normalize("text"))).alias("token"))
    per_doc = words.groupBy("token", "doc_id").agg(F.count("*").alias("n"))
    return per_doc.groupBy("token").agg(F.sum("n").alias("n"), F.count("*").alias("n_docs"))


_LINES = "list_filter(list_transform(string_split_regex(text, '\\r\\n|[\\n\\r\\f]'), lambda l: trim(regexp_replace(l, '[ \\t]+', ' ', 'g'))), lambda l: l <> '')"


@query(f"""
WITH l AS (SELECT doc_id, list_transform({_LINES}, lambda x: {{'c': [x], 'n': length(x) + 1}}) AS l FROM documents),
 p AS (SELECT doc_id, list_reduce(l, lambda a, x: CASE WHEN a.n + x.n > {MOST_CHARS} THEN {{'c': list_append(a.c, x.c[1]), 'n': x.n}} ELSE {{'c': list_append(a.c[:-2], a.c[-1] || chr(10) || chr(10) || x.c[1]), 'n': a.n + x.n}} END) AS r FROM l WHERE len(l) > 0)
SELECT doc_id, i - 1 AS chunk_index, r.c[i] AS chunk FROM (SELECT doc_id, r, unnest(range(1, len(r.c) + 1)) AS i FROM p)""")
def chunk_paragraphs(t: Tables) -> DataFrame:
    return paragraph_chunks(t.documents)


@query("""
SELECT 'document' AS kind, doc_id AS id, len(regexp_extract_all(text, '\\b\\d{1,2} CCR \\d{3,4}-\\d{1,4}(?:-\\d{1,4})?\\b'))::BIGINT AS n_ccr,
       len(regexp_extract_all(text, '\\b\\d{1,2}(?:\\.\\d+)?-\\d{1,3}(?:\\.\\d+)?-\\d{3,4}(?:\\.\\d+)?\\b'))::BIGINT AS n_crs,
       len(regexp_extract_all(text, '\\b\\d{1,2} CFR \\d{1,4}(?:\\.\\d+)?\\b'))::BIGINT AS n_cfr FROM documents
UNION ALL
SELECT 'page', page_id, len(regexp_extract_all(html, '\\b\\d{1,2} CCR \\d{3,4}-\\d{1,4}(?:-\\d{1,4})?\\b'))::BIGINT,
       len(regexp_extract_all(html, '\\b\\d{1,2}(?:\\.\\d+)?-\\d{1,3}(?:\\.\\d+)?-\\d{3,4}(?:\\.\\d+)?\\b'))::BIGINT,
       len(regexp_extract_all(html, '\\b\\d{1,2} CFR \\d{1,4}(?:\\.\\d+)?\\b'))::BIGINT FROM pages""")
def citation_extract(t: Tables) -> DataFrame:
    docs = t.documents.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = t.pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return docs.unionByName(pages).select("kind", "id", *(F.size(text.citations("text", k)).cast("long").alias(f"n_{k}") for k in text.CITATIONS))


_HIDDEN_SQL = "(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->|<[^>]*>"


@query(f"SELECT page_id, trim(regexp_replace(regexp_replace(html, '{_HIDDEN_SQL}', ' ', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g')) AS visible FROM pages")
def html_visible_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.visible_text("html").alias("visible"))


@query("""
SELECT page_id, (i - 1)::BIGINT AS pos, l[i] AS href
FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '(?i)<a\\b[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1) AS l FROM pages))""")
def html_links(t: Tables) -> DataFrame:
    found = t.pages.select("page_id", F.posexplode(text.links("html")).alias("pos", "href"))
    return found.select("page_id", F.col("pos").cast("long").alias("pos"), "href")


@query("""
WITH p AS (SELECT doc_id, text, list_min(list_filter([instr(lower(text), 'licen'), instr(lower(text), 'http'), instr(lower(text), 'password')], lambda x: x > 0)) AS f FROM documents),
     q AS (SELECT doc_id, text, greatest(1, coalesce(f, 1) - 160) AS s FROM p)
SELECT doc_id, (CASE WHEN s > 1 THEN '...' ELSE '' END) || trim(substring(text, s, 460)) || (CASE WHEN length(text) >= s + 460 THEN '...' ELSE '' END) AS excerpt FROM q""")
def excerpt_first_hit(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.excerpt(F.col("text"), ["licen", "http", "password"]).alias("excerpt"))


@query("""
SELECT doc_id, i - 1 AS pos, trim(s[i]) AS sentence,
       CASE WHEN regexp_matches(lower(trim(s[i])), '\\b(must|shall) not\\b') THEN 'prohibition' WHEN regexp_matches(lower(trim(s[i])), '\\b(must|shall)\\b') THEN 'obligation'
            WHEN regexp_matches(lower(trim(s[i])), '\\bmay\\b') THEN 'permission' ELSE 'statement' END AS rule_type
FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (
  SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.;])[ \\t\\n\\r\\f]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) BETWEEN 45 AND 720) AS s FROM documents))""")
def sentence_units(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.posexplode(text.sentences("text")).alias("pos", "sentence"))
    low = F.lower("sentence")
    kind = text.ladder((low.rlike(r"\b(must|shall) not\b"), "prohibition"), (low.rlike(r"\b(must|shall)\b"), "obligation"), (low.rlike(r"\bmay\b"), "permission"), otherwise="statement")
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "sentence", kind.alias("rule_type"))


@query("""
SELECT conv_id, turn, greatest(1, coalesce(list_sum(list_transform(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\n\\r\\f]'),
       lambda p: CASE WHEN regexp_matches(p, '^[A-Za-z0-9_]') THEN ceil(length(p) / 4.0)::BIGINT ELSE 1 END)), 0))::BIGINT AS n_tokens FROM conversations""")
def token_estimates(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", text.token_count("text").alias("n_tokens"))


@query(f"""
WITH n AS (SELECT doc_id, text, source, lang, {_NORM} AS norm FROM documents)
SELECT doc_id, CASE WHEN source = 'src7' THEN 0 WHEN {_has('licensed under', 'norm')} THEN 1 ELSE 2 END AS rank, lang
FROM n WHERE source = 'src7' OR {_has('licensed under', 'norm')} OR contains(norm, 'apache')
ORDER BY rank, doc_id LIMIT 100""")
def search_cte_ranked(t: Tables) -> DataFrame:
    norm = text.normalize("text")
    phrase, own = text.contains_term(norm, "licensed under"), F.col("source") == "src7"
    found = t.documents.where(own | phrase | norm.contains("apache"))
    return ranking.top_k(found.select("doc_id", text.ladder((own, 0), (phrase, 1), otherwise=2).alias("rank"), "lang"), 100, F.col("rank"), F.col("doc_id"))


_TERMS = ("license", "password", "token", "version")


def _occurrences(norm: str, term: str) -> str:
    return f"((length({norm}) - length(replace({norm}, '{term}', ''))) // {len(term)})"


@query(f"""
WITH n AS (SELECT doc_id, source, lang, {_NORM} AS norm FROM documents),
     s AS (SELECT doc_id, source, lang, {' + '.join(_has(w, 'norm') + '::INT' for w in _TERMS)} AS hits,
                  40 + {' + '.join(f'least({_occurrences("norm", w)}, 12)' for w in _TERMS)} AS body FROM n)
SELECT s.doc_id, s.lang, hits::BIGINT AS hits, (24 * hits + body + CASE WHEN l.quality = 1 THEN 14 ELSE 0 END)::BIGINT AS score
FROM s LEFT JOIN labels l ON s.doc_id = l.doc_id WHERE hits > 0 ORDER BY score DESC, s.doc_id LIMIT 20""")
def search_scored(t: Tables) -> DataFrame:
    """Ranked search: whole-word hits admit and score, occurrences in the text (12 a term at most) and a good label add points."""
    n = t.documents.select("doc_id", "lang", text.normalize("text").alias("norm"))
    norm = F.col("norm")
    hits = sum((text.contains_term(norm, w).cast("long") for w in _TERMS), F.lit(0))
    count = [F.least(F.floor((F.length(norm) - F.length(F.replace(norm, F.lit(w), F.lit("")))) / len(w)), F.lit(12)) for w in _TERMS]
    scored = n.select("doc_id", "lang", hits.alias("hits"), (F.lit(40) + sum(count[1:], count[0])).alias("body")).where("hits > 0")
    boosted = scored.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    score = (24 * F.col("hits") + F.col("body") + F.when(F.col("quality") == 1, 14).otherwise(0)).cast("long")
    return ranking.top_k(boosted.select("doc_id", "lang", "hits", score.alias("score")), 20, F.desc("score"), F.col("doc_id"))


@query("""
WITH b AS (SELECT source, arg_max(doc_id, (n_chars, -doc_id)) AS best FROM documents GROUP BY source)
SELECT d.source, d.doc_id, d.n_chars, (d.doc_id = b.best)::INT AS leads FROM documents d JOIN b ON d.source = b.source
ORDER BY leads DESC, d.n_chars DESC, d.doc_id LIMIT 50""")
def diversify_rank(t: Tables) -> DataFrame:
    return ranking.diversified(t.documents.select("source", "doc_id", "n_chars"), "source", "n_chars", "doc_id", 50)


# Example rules of this catalogue: tags with their terms and weights.
TAGS = {
    "secrets": (("password", "secret", "token"), 0.5),
    "license": (("license", "licensed", "apache"), 0.6),
    "web": (("http", "https", "www"), 0.3),
    "insult": (("idiot", "stupid", "moron", "trash"), 0.7),
}
_RULES_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{tag}' AS tag, {' + '.join(_has(w, 'norm') + '::INT' for w in terms)} AS hits, {weight}::DOUBLE AS weight FROM n" for tag, (terms, weight) in TAGS.items()
)


@query(f"WITH n AS (SELECT doc_id, {_NORM} AS norm FROM documents), r AS ({_RULES_SQL}) SELECT doc_id, tag, hits::BIGINT AS hits, weight FROM r WHERE hits > 0")
def theta_keyword_tags(t: Tables) -> DataFrame:
    n = t.documents.select("doc_id", text.normalize("text").alias("norm"))
    return joins.keyword_rules(n, "doc_id", F.col("norm"), TAGS)


@query(f"""
WITH n AS (SELECT doc_id, {_NORM} AS norm FROM documents), r AS ({_RULES_SQL})
SELECT doc_id, count(*)::BIGINT AS n, string_agg(tag, ',' ORDER BY tag) AS tags,
       least(round(max(weight) + least(0.08::DOUBLE, 0.02::DOUBLE * (count(*) - 1)), 3), 0.99::DOUBLE) AS confidence
FROM r WHERE hits > 0 GROUP BY doc_id""")
def tag_confidence(t: Tables) -> DataFrame:
    found = theta_keyword_tags(t)
    return found.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("tag")), ",").alias("tags"), scoring.match_confidence(F.max("weight"), F.count("*")).alias("confidence")
    )


@query(f"""
WITH n AS (SELECT doc_id, source, {_NORM} AS norm FROM documents)
SELECT source, min(CASE WHEN {_has('licensed', 'norm')} THEN doc_id END) AS mandatory, min(CASE WHEN {_has('idiot', 'norm')} THEN doc_id END) AS prohibited
FROM n GROUP BY source HAVING mandatory IS NOT NULL AND prohibited IS NOT NULL""")
def conflict_groups(t: Tables) -> DataFrame:
    n = t.documents.select("doc_id", "source", text.normalize("text").alias("norm"))
    first = lambda w: F.min(F.when(text.contains_term(F.col("norm"), w), F.col("doc_id")))
    return n.groupBy("source").agg(first("licensed").alias("mandatory"), first("idiot").alias("prohibited")).where("mandatory IS NOT NULL AND prohibited IS NOT NULL")


@query(f"""
WITH w AS (SELECT DISTINCT conv_id, turn, role, unnest({_TOKENS}) AS token FROM conversations)
SELECT c.conv_id, c.turn, c.n AS n_tokens, coalesce(max(s.shared), 0)::BIGINT AS best_shared, (coalesce(max(s.shared), 0) >= 2) AS grounded
FROM (SELECT conv_id, turn, count(*)::BIGINT AS n FROM w WHERE role = 'assistant' GROUP BY ALL) c
LEFT JOIN (SELECT a.conv_id, a.turn, b.turn AS other, count(*) AS shared FROM w a JOIN w b ON a.conv_id = b.conv_id AND a.token = b.token AND b.turn < a.turn AND b.role = 'user'
           WHERE a.role = 'assistant' GROUP BY ALL) s ON c.conv_id = s.conv_id AND c.turn = s.turn
GROUP BY c.conv_id, c.turn, c.n""")
def grounding_gate(t: Tables) -> DataFrame:
    """Is an answer supported: does some earlier user turn of its conversation share two tokens with it?"""
    words = t.conversations.select("conv_id", "turn", "role", F.explode(F.array_distinct(text.tokens(text.normalize("text")))).alias("token")).distinct()
    claims = words.where("role = 'assistant'").select("conv_id", "turn", "token")
    evidence = words.where("role = 'user'").select("conv_id", F.col("turn").alias("other"), "token")
    shared = claims.join(evidence, ["conv_id", "token"]).where("other < turn").groupBy("conv_id", "turn", "other").agg(F.count("*").alias("shared"))
    best = shared.groupBy("conv_id", "turn").agg(F.max("shared").alias("best"))
    sizes = claims.groupBy("conv_id", "turn").agg(F.count("*").alias("n_tokens"))
    best_shared = F.coalesce("best", F.lit(0)).cast("long")
    return sizes.join(best, ["conv_id", "turn"], "left").select("conv_id", "turn", "n_tokens", best_shared.alias("best_shared"), (best_shared >= 2).alias("grounded"))


@query(f"""
WITH w AS (SELECT conv_id, turn, list_sort(list_distinct({_TOKENS})) AS toks FROM conversations),
     p AS (SELECT conv_id, turn, toks, lag(toks) OVER (PARTITION BY conv_id ORDER BY turn, array_to_string(toks, ' ')) AS prior FROM w)
SELECT conv_id, turn, len(list_intersect(toks, prior))::BIGINT AS shared,
       round(len(list_intersect(toks, prior)) / greatest(len(list_distinct(list_concat(toks, prior))), 1)::DOUBLE, 4) AS jaccard
FROM p WHERE prior IS NOT NULL""")
def jaccard_tokens(t: Tables) -> DataFrame:
    """Token sets of consecutive turns."""
    sets = t.conversations.select("conv_id", "turn", F.array_sort(F.array_distinct(text.tokens(text.normalize("text")))).alias("toks"))
    prior = F.lag("toks").over(Window.partitionBy("conv_id").orderBy("turn", F.array_join("toks", " ")))
    shared = F.size(F.array_intersect("toks", "prior")).cast("long")
    return sets.withColumn("prior", prior).where("prior IS NOT NULL").select(
        "conv_id", "turn", shared.alias("shared"), F.round(shared / F.greatest(F.size(F.array_union("toks", "prior")), F.lit(1)), 4).alias("jaccard")
    )


@query("""
WITH l AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS item FROM conversations),
     k AS (SELECT DISTINCT conv_id, turn FROM conversations),
     o AS (SELECT l.conv_id, l.turn + 1 AS turn, item, count(*) AS a FROM l JOIN k ON l.conv_id = k.conv_id AND l.turn + 1 = k.turn GROUP BY ALL),
     n AS (SELECT conv_id, turn, item, count(*) AS b FROM l GROUP BY ALL),
     j AS (SELECT coalesce(o.conv_id, n.conv_id) AS conv_id, coalesce(o.turn, n.turn) AS turn, coalesce(a, 0) AS a, coalesce(b, 0) AS b
           FROM o FULL JOIN n ON o.conv_id = n.conv_id AND o.turn = n.turn AND o.item = n.item)
SELECT conv_id, turn, sum(greatest(b - a, 0))::BIGINT AS added, sum(greatest(a - b, 0))::BIGINT AS removed, sum(least(a, b))::BIGINT AS shared,
       round(sum(least(a, b)) / greatest(sum(a), 1)::DOUBLE, 4) AS preservation, (sum(least(a, b)) / greatest(sum(a), 1)::DOUBLE >= 0.95) AS passed
FROM j GROUP BY conv_id, turn""")
def word_bag_diff(t: Tables) -> DataFrame:
    """Words of each turn against those of the turn before, as bags, with the share of the earlier ones preserved."""
    words = t.conversations.select("conv_id", "turn", F.explode(F.split("text", " ")).alias("item"))
    turns = t.conversations.select("conv_id", "turn").distinct()
    old = words.withColumn("turn", F.col("turn") + 1).join(turns, ["conv_id", "turn"], "left_semi")
    found = joins.bag_difference(old, words, ["conv_id", "turn"], "item")
    share = F.col("shared") / F.greatest(F.col("shared") + F.col("removed"), F.lit(1))
    return found.select("*", F.round(share, 4).alias("preservation"), (share >= 0.95).alias("passed"))


_COST = """greatest(1, coalesce(list_sum(list_transform(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\n\\r\\f]'),
       lambda p: CASE WHEN regexp_matches(p, '^[A-Za-z0-9_]') THEN ceil(length(p) / 4.0)::BIGINT ELSE 1 END)), 0))::BIGINT"""


@query(f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, cost, row_number() OVER (PARTITION BY conv_id ORDER BY turn, cost) AS i FROM (SELECT conv_id, turn, {_COST} AS cost FROM conversations)),
 r AS (SELECT conv_id, turn, cost, i, cost <= 64 AS kept, 64 - CASE WHEN cost <= 64 THEN cost ELSE 0 END AS left_over FROM c WHERE i = 1
  UNION ALL SELECT c.conv_id, c.turn, c.cost, c.i, c.cost <= r.left_over, r.left_over - CASE WHEN c.cost <= r.left_over THEN c.cost ELSE 0 END FROM r JOIN c ON c.conv_id = r.conv_id AND c.i = r.i + 1)
SELECT conv_id, turn, cost, kept FROM r""")
def budget_pick(t: Tables) -> DataFrame:
    """Turns of each conversation that fit a budget of 64 tokens, in order."""
    costs = t.conversations.select("conv_id", "turn", text.token_count("text").alias("cost"))
    return ranking.budget_pick(costs, "conv_id", "turn", "cost", 64)


@query("""
SELECT sha256(text) AS value, count(*)::BIGINT AS n, max(doc_id) AS kept, min(doc_id) AS first, (count(*) - 1)::BIGINT AS excess FROM documents GROUP BY 1 HAVING count(*) > 1""")
def dup_groups(t: Tables) -> DataFrame:
    from lexquarry.operators.reports import duplicate_groups

    return duplicate_groups(t.documents, F.sha2("text", 256), "doc_id")


@query("SELECT sha256(text) AS value, max(doc_id) AS doc_id, arg_max(lang, doc_id) AS lang, arg_max(source, doc_id) AS source FROM documents GROUP BY 1")
def dedup_keep_last(t: Tables) -> DataFrame:
    return ranking.latest(t.documents.select(F.sha2("text", 256).alias("value"), "doc_id", "lang", "source"), "value", "doc_id")


@query("""
SELECT * FROM (SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS field, unnest([a, b, c, d, e]) AS populated,
       unnest([n - a, n - b, n - c, n - d, n - e]) AS missing,
       unnest([round(a / n::DOUBLE, 4), round(b / n::DOUBLE, 4), round(c / n::DOUBLE, 4), round(d / n::DOUBLE, 4), round(e / n::DOUBLE, 4)]) AS ratio
FROM (SELECT greatest(count(*), 1) AS n, count(doc_id) AS a, count(CASE WHEN length(trim(text)) > 0 THEN 1 END) AS b, count(CASE WHEN length(trim(lang)) > 0 THEN 1 END) AS c,
             count(CASE WHEN length(trim(source)) > 0 THEN 1 END) AS d, count(n_chars) AS e FROM documents))""")
def field_coverage(t: Tables) -> DataFrame:
    from lexquarry.operators.reports import field_coverage as report

    return report(t.documents)
