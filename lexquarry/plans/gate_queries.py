"""Queries over votes, quality levels, gates, queues and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.functions import gates, text
from lexquarry.operators import ranking, reports
from lexquarry.plans.registry import Tables, query

_A, _B, _P = "o_orderstatus", "CASE WHEN o_orderkey % 3 = 0 THEN 'X' WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END", "CASE WHEN o_orderkey % 5 = 0 THEN 'X' WHEN o_orderkey % 2 = 0 THEN o_orderstatus END"


def _vote_sql(a: str, b: str, p: str) -> str:
    return f"""CASE WHEN {a} = {b} THEN 0.99 WHEN {a} = {p} OR {b} = {p} THEN 0.9 ELSE 0 END::DOUBLE AS confidence, CASE WHEN {a} = {b} OR {a} = {p} THEN {a} WHEN {b} = {p} THEN {b} END AS value"""


@query(f"""
WITH v AS (SELECT o_orderkey, {_A} AS a, {_B} AS b, {_P} AS p FROM orders), s AS (SELECT o_orderkey, {_vote_sql('a', 'b', 'p')} FROM v)
SELECT o_orderkey, CASE WHEN confidence > 0 THEN 'ACCEPT' ELSE 'QUARANTINE' END AS status, value, confidence FROM s""")
def exact_vote(t: Tables) -> DataFrame:
    v = t.orders.select("o_orderkey", F.expr(_A).alias("a"), F.expr(_B).alias("b"), F.expr(_P).alias("p"))
    return v.select("o_orderkey", gates.exact_vote(F.col("a"), F.col("b"), F.col("p")).alias("v")).select("o_orderkey", "v.*")


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber, (l_quantity::BIGINT * 2) / 100.0 AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN s > 0.9 THEN 'ACCEPT' WHEN s >= 0.7 THEN 'FLAG' ELSE 'QUARANTINE' END AS status FROM s""")
def similarity_vote(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", gates.similarity_vote(F.col("l_quantity").cast("long") * 2 / 100).alias("status"))


@query("""
WITH g AS (SELECT l_orderkey, l_linenumber, l_quantity >= 20 AS a, l_discount >= 0.05 AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN a OR b THEN 'ACCEPT' ELSE 'REJECT' END AS status, CASE WHEN a THEN 'a' WHEN b THEN 'b' END AS choice, CASE WHEN a AND b THEN 0.9 WHEN a OR b THEN 0.8 ELSE 0 END::DOUBLE AS confidence FROM g""")
def text_vote(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", gates.text_vote(F.col("l_quantity") >= 20, F.col("l_discount") >= 0.05).alias("v")).select("l_orderkey", "l_linenumber", "v.*")


@query("""
WITH s AS (SELECT l_orderkey, max(CASE WHEN l_quantity >= 45 THEN 1 WHEN l_quantity >= 10 THEN 2 WHEN l_quantity >= 2 THEN 3 ELSE 4 END) AS m FROM lineitem GROUP BY 1)
SELECT l_orderkey, ['ACCEPT', 'FLAG', 'QUARANTINE', 'REJECT'][m] AS status FROM s""")
def ensemble_route(t: Tables) -> DataFrame:
    """The worst status of a record's fields."""
    q = F.col("l_quantity")
    status = text.ladder((q >= 45, "ACCEPT"), (q >= 10, "FLAG"), (q >= 2, "QUARANTINE"), otherwise="REJECT")
    kinds = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(status).alias("s"))  # four values at most
    return kinds.select("l_orderkey", gates.worst(F.col("s")).alias("status"))


@query("""
WITH f AS (SELECT p_partkey, p_size >= 5 AS has_text, p_partkey % 4 <> 0 AS identity, length(p_name) AS hits, p_size / 50.0 AS ratio, p_partkey % 9 = 0 AS missing FROM part)
SELECT p_partkey, CASE WHEN missing THEN 'missing' WHEN NOT has_text THEN 'no_text' WHEN NOT identity AND ratio < 0.2 THEN 'low' WHEN NOT identity THEN 'identity_unclear' WHEN hits >= 2 AND ratio >= 0.5 THEN 'high'
 WHEN hits >= 2 AND ratio >= 0.3 THEN 'medium' WHEN hits >= 1 THEN 'medium_low' ELSE 'low' END AS level FROM f""")
def accuracy_level(t: Tables) -> DataFrame:
    """How far a record's text bears it out."""
    ratio, hits, known = F.col("p_size") / 50, F.length("p_name"), F.col("p_partkey") % 4 != 0
    steps = (
        (F.col("p_partkey") % 9 == 0, "missing"), (F.col("p_size") < 5, "no_text"), (~known & (ratio < 0.2), "low"), (~known, "identity_unclear"),
        ((hits >= 2) & (ratio >= 0.5), "high"), ((hits >= 2) & (ratio >= 0.3), "medium"), (hits >= 1, "medium_low"),
    )
    return t.part.select("p_partkey", text.ladder(*steps, otherwise="low").alias("level"))


@query("""
WITH w AS (SELECT conv_id, turn, lower(text) AS x, list_sort(list_distinct(string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ')))[1:20] AS terms, lead(lower(text)) OVER (PARTITION BY conv_id ORDER BY turn, text) AS next FROM conversations)
SELECT conv_id, turn, len(list_filter(terms, lambda t: contains(next, t)))::BIGINT AS hits, len(list_filter(terms, lambda t: NOT contains(next, t)))::BIGINT AS misses FROM w WHERE next IS NOT NULL""")
def evidence_terms(t: Tables) -> DataFrame:
    """Terms of a turn (20 at most, as the feature asks) that the next turn has."""
    from pyspark.sql import Window

    following = F.lead(F.lower("text")).over(Window.partitionBy("conv_id").orderBy("turn", "text"))
    terms = F.slice(F.array_sort(F.array_distinct(F.split(text.normalize("text"), " "))), 1, 20)
    w = t.conversations.select("conv_id", "turn", terms.alias("terms"), following.alias("next")).where("next IS NOT NULL")
    hits = F.size(F.filter("terms", lambda x: F.contains("next", x))).cast("long")
    return w.select("conv_id", "turn", hits.alias("hits"), (F.size("terms") - hits).cast("long").alias("misses"))


@query("""
SELECT page_id, CASE WHEN starts_with(url, 'https://') AND contains(url, '.gov') THEN 'official' WHEN starts_with(url, 'https://') AND regexp_matches(url, '[.]org[/:]') THEN 'archive' WHEN starts_with(url, 'https://') THEN 'secure' WHEN starts_with(url, 'http://') THEN 'plain'
  WHEN length(trim(url)) > 0 THEN 'other' ELSE 'none' END AS strength, CASE WHEN starts_with(url, 'https://') AND contains(url, '.gov') THEN 1.0 WHEN starts_with(url, 'https://') AND regexp_matches(url, '[.]org[/:]') THEN 0.8 WHEN starts_with(url, 'https://') THEN 0.6 WHEN starts_with(url, 'http://') THEN 0.4
  WHEN length(trim(url)) > 0 THEN 0.2 ELSE 0 END::DOUBLE AS score FROM pages""")
def source_strength(t: Tables) -> DataFrame:
    """Six levels of a source with their scores."""
    url = F.col("url")
    secure = url.startswith("https://")
    steps = (
        (secure & url.contains(".gov"), "official", 1.0), (secure & url.rlike("[.]org[/:]"), "archive", 0.8), (secure, "secure", 0.6), (url.startswith("http://"), "plain", 0.4), (text.populated("url"), "other", 0.2),
    )
    return t.pages.select(
        "page_id", text.ladder(*((c, n) for c, n, _ in steps), otherwise="none").alias("strength"), text.ladder(*((c, s) for c, _, s in steps), otherwise=0.0).cast("double").alias("score")
    )


@query("""
SELECT page_id, starts_with(url, 'https://') AND (lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) IN ('example.com', 'www.example.org') OR lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) LIKE '%.gov') AS official FROM pages""")
def official_hosts(t: Tables) -> DataFrame:
    """Secure addresses whose host is listed or lies under a listed suffix."""
    host = F.lower(F.regexp_extract("url", "^[A-Za-z]+://([^/?#:]*)", 1))
    return t.pages.select("page_id", (F.col("url").startswith("https://") & (host.isin("example.com", "www.example.org") | host.endswith(".gov"))).alias("official"))


@query("""
WITH s AS (SELECT doc_id, n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT CASE WHEN quality IS NULL AND n_chars < 50 THEN 'empty' WHEN quality IS NULL THEN 'unlabelled' WHEN toxic = 1 AND quality = 1 THEN 'conflicted' WHEN toxic = 1 THEN 'rejected' WHEN quality = 0 THEN 'weak' WHEN n_chars < 200 THEN 'short' ELSE 'ready' END AS stage, count(*)::BIGINT AS n FROM s GROUP BY 1""")
def quality_stages(t: Tables) -> DataFrame:
    """Seven stages of a record, counted."""
    s = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    q, bad = F.col("quality"), F.col("toxic") == 1
    steps = ((q.isNull() & (F.col("n_chars") < 50), "empty"), (q.isNull(), "unlabelled"), (bad & (q == 1), "conflicted"), (bad, "rejected"), (q == 0, "weak"), (F.col("n_chars") < 200, "short"))
    return s.groupBy(text.ladder(*steps, otherwise="ready").alias("stage")).agg(F.count("*").alias("n"))


_CHECKS = {"official": "o_orderkey % 17 <> 0", "retrieved": "o_totalprice > 2000", "text": "o_orderstatus <> 'P'", "identity": "o_custkey % 10 <> 0", "jurisdiction": "o_orderpriority <> '5-LOW'", "fresh": "o_orderdate >= DATE '1993-01-01'", "unique": "o_orderkey % 4 <> 0"}
_SCORE = " + ".join(f"CASE WHEN {c} THEN {round(100 * gates.CHECKS[n])} ELSE 0 END" for n, c in _CHECKS.items())
_FAILED = "list_filter([" + ", ".join(f"CASE WHEN NOT ({_CHECKS[n]}) THEN '{n}' END" for n in gates.HARD) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT o_orderkey, ({_SCORE}) / 100 AS score, array_to_string({_FAILED}, '|') AS failures, len({_FAILED}) = 0 AND {_SCORE} >= 95 AS approved FROM orders")
def review_gate(t: Tables) -> DataFrame:
    """Seven weighted checks, three of which must hold."""
    g = t.orders.select("o_orderkey", gates.gate({n: F.expr(c) for n, c in _CHECKS.items()}).alias("g"))
    return g.select("o_orderkey", "g.score", F.array_join("g.failures", "|").alias("failures"), "g.approved")


_SCORES = {"fidelity": "CAST(l_quantity AS BIGINT) * 2", "entity": "100 - CAST(l_linenumber AS BIGINT) * 10", "atomic": "CAST(l_orderkey % 60 AS BIGINT) + 40", "exceptions": "CASE WHEN l_returnflag = 'N' THEN 92 ELSE 35 END", "temporal": "CASE WHEN l_linestatus = 'O' THEN 100 ELSE 40 END"}


@query(f"""
WITH s AS (SELECT l_orderkey, l_linenumber, {', '.join(f'{c} AS {n}' for n, c in _SCORES.items())} FROM lineitem), o AS (SELECT *, round(({' + '.join(_SCORES)}) / 500, 2) AS overall,
 array_to_string(list_filter([{', '.join(f"CASE WHEN {n} < 60 THEN '{n}' END" for n in _SCORES)}], lambda x: x IS NOT NULL), '|') AS issues FROM s)
SELECT l_orderkey, l_linenumber, overall, CASE WHEN fidelity <= 30 OR entity <= 55 THEN 'needs_review' WHEN overall >= 0.86 AND issues = '' THEN 'high' WHEN overall >= 0.68 THEN 'medium' ELSE 'needs_review' END AS level, issues FROM o""")
def unit_quality(t: Tables) -> DataFrame:
    scores = {n: F.expr(c) for n, c in _SCORES.items()}
    return t.lineitem.select("l_orderkey", "l_linenumber", gates.text_quality(scores, "fidelity", "entity").alias("q")).select("l_orderkey", "l_linenumber", "q.*")


@query(f"""
WITH s AS (SELECT {', '.join(f'{c} AS {n}' for n, c in _SCORES.items())} FROM lineitem), o AS (SELECT *, round(({' + '.join(_SCORES)}) / 500, 2) AS overall, least({', '.join(_SCORES)}) >= 60 AS clean FROM s)
SELECT count(*) FILTER (NOT (fidelity <= 30 OR entity <= 55) AND overall >= 0.86 AND clean)::BIGINT AS high, count(*) FILTER (NOT (fidelity <= 30 OR entity <= 55) AND NOT (overall >= 0.86 AND clean) AND overall >= 0.68)::BIGINT AS medium,
 count(*) FILTER (fidelity <= 30 OR entity <= 55 OR overall < 0.68)::BIGINT AS needs_review FROM o""")
def quality_counts(t: Tables) -> DataFrame:
    level = F.col("level")
    return unit_quality(t).agg(*(F.count_if(level == x).alias(x) for x in ("high", "medium", "needs_review")))


@query("""
SELECT count(*) FILTER (l_quantity < 10)::BIGINT AS keep, count(*) FILTER (l_discount > 0.05)::BIGINT AS replace, count(*) FILTER (l_tax > 0.05)::BIGINT AS remove, count(*) FILTER (l_quantity >= 10 AND l_discount <= 0.05 AND l_tax <= 0.05)::BIGINT AS none FROM lineitem""")
def review_summary(t: Tables) -> DataFrame:
    """Rows for which each outcome is suggested; a row may have several."""
    kinds = {"keep": F.col("l_quantity") < 10, "replace": F.col("l_discount") > 0.05, "remove": F.col("l_tax") > 0.05}
    outcomes = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in kinds.items())), lambda x: x.isNotNull())
    rows = t.lineitem.select(outcomes.alias("o"))
    return rows.agg(*(F.count_if(F.array_contains("o", n)).alias(n) for n in kinds), F.count_if(F.size("o") == 0).alias("none"))


# ---- gates over evidence ----------------------------------------------------


@query("""
WITH s AS (SELECT doc_id, sha256(trim(regexp_replace(text, '[ \t\n\r\f]+', ' ', 'g'))) AS sha FROM documents), c AS (SELECT l.doc_id, CASE WHEN l.doc_id % 5 = 0 THEN 'x' ELSE s.sha END AS sha, toxic FROM labels l LEFT JOIN s ON l.doc_id = s.doc_id
  UNION ALL SELECT -1 - doc_id, 'x', 0 FROM labels WHERE doc_id % 7 = 0)
SELECT c.doc_id, CASE WHEN s.doc_id IS NULL THEN 'absent' WHEN s.sha <> c.sha THEN 'hash_mismatch' WHEN toxic = 1 THEN 'not_safe' ELSE 'kept' END AS verdict FROM c LEFT JOIN s ON c.doc_id = s.doc_id""")
def citation_gate(t: Tables) -> DataFrame:
    """Citations whose source is gone, has changed or is not safe to answer from are stripped."""
    sources = t.documents.select("doc_id", F.sha2(F.trim(F.regexp_replace("text", r"[ \t\n\r\f]+", " ")), 256).alias("now"))
    cited = t.labels.join(sources, "doc_id", "left").select("doc_id", F.when(F.col("doc_id") % 5 == 0, "x").otherwise(F.col("now")).alias("sha"), "toxic")
    lost = t.labels.where("doc_id % 7 = 0").select((-1 - F.col("doc_id")).alias("doc_id"), F.lit("x").alias("sha"), F.lit(0).alias("toxic"))
    verdict = text.ladder((F.col("now").isNull(), "absent"), (F.col("now") != F.col("sha"), "hash_mismatch"), (F.col("toxic") == 1, "not_safe"), otherwise="kept")
    return cited.unionByName(lost).join(sources, "doc_id", "left").select("doc_id", verdict.alias("verdict"))


@query("SELECT o_orderkey, o_orderstatus AS status, 'not_current' AS flag FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority <> '4-NOT SPECIFIED'")
def currency_gate(t: Tables) -> DataFrame:
    """Evidence that a question about the present cannot rest on."""
    rows = t.orders.where(F.col("o_orderstatus").isin("F", "P") & (F.col("o_orderpriority") != "4-NOT SPECIFIED"))
    return rows.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.lit("not_current").alias("flag"))


@query("""
WITH need AS (SELECT DISTINCT user_id, k FROM events, (VALUES ('click'), ('purchase'), ('signup')) v(k)), have AS (SELECT DISTINCT user_id, event_type AS k FROM events WHERE value >= 150)
SELECT user_id, k AS missing FROM need ANTI JOIN have USING (user_id, k)""")
def completeness_gate(t: Tables) -> DataFrame:
    """Required categories for which a user has no evidence."""
    need = t.events.select("user_id").distinct().withColumn("k", F.explode(F.array(*(F.lit(x) for x in ("click", "purchase", "signup")))))
    have = t.events.where("value >= 150").select("user_id", F.col("event_type").alias("k"))
    return need.join(have, ["user_id", "k"], "left_anti").withColumnRenamed("k", "missing")


@query("""
WITH required AS (SELECT o_custkey, l_returnflag AS k, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT c_custkey, coalesce(round(count(k) FILTER (n >= 3) / nullif(count(k), 0)::DOUBLE, 4), 1.0) AS share FROM customer LEFT JOIN required ON c_custkey = o_custkey GROUP BY 1""")
def coverage_share(t: Tables) -> DataFrame:
    """The share of required categories that are found; 1 where none is required."""
    lines = t.orders.select("o_custkey", F.col("o_orderkey").alias("l_orderkey")).join(t.lineitem.select("l_orderkey", "l_returnflag"), "l_orderkey")
    required = lines.groupBy(F.col("o_custkey").alias("c_custkey"), "l_returnflag").agg(F.count("*").alias("n")).groupBy("c_custkey").agg(F.count_if(F.col("n") >= 3).alias("found"), F.count("*").alias("all"))
    return t.customer.select("c_custkey").join(required, "c_custkey", "left").select("c_custkey", F.coalesce(F.round(F.col("found") / F.col("all"), 4), F.lit(1.0)).alias("share"))


_TOK = "list_filter(string_split(trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: length(t) >= 3)"


@query(f"""
WITH a AS (SELECT conv_id, turn, unnest(string_split_regex(text, '[.;][ \t\n\r\f]+')) AS s FROM conversations WHERE role = 'assistant'), e AS (SELECT DISTINCT conv_id, unnest({_TOK.format('text')}) AS w FROM conversations WHERE role <> 'assistant'),
 w AS (SELECT DISTINCT conv_id, turn, s, unnest({_TOK.format('s')}) AS w FROM a)
SELECT conv_id, turn, s AS sentence, count(*)::BIGINT AS shared FROM w JOIN e USING (conv_id, w) GROUP BY 1, 2, 3 HAVING count(*) >= 2""")
def faithfulness_gate(t: Tables) -> DataFrame:
    """Sentences of answers that share two words or more with what the others said."""
    words = lambda c: F.filter(F.split(text.normalize(c), " "), lambda x: F.length(x) >= 3)
    said = t.conversations.where("role = 'assistant'").select("conv_id", "turn", F.explode(F.split("text", r"[.;][ \t\n\r\f]+")).alias("sentence"))
    own = said.select("conv_id", "turn", "sentence", F.explode(F.array_distinct(words("sentence"))).alias("w")).distinct()
    heard = t.conversations.where("role <> 'assistant'").select("conv_id", F.explode(words("text")).alias("w")).distinct()
    return own.join(heard, ["conv_id", "w"]).groupBy("conv_id", "turn", "sentence").agg(F.count("*").alias("shared")).where("shared >= 2")


@query("""
WITH l AS (SELECT o_custkey, o_orderpriority AS topic, CASE o_orderstatus WHEN 'F' THEN 'federal' WHEN 'O' THEN 'state' ELSE 'county' END AS level, o_orderkey FROM orders), r AS (SELECT *, CASE level WHEN 'federal' THEN 4 WHEN 'state' THEN 3 ELSE 2 END AS rank FROM l),
 g AS (SELECT o_custkey, topic, max(rank) AS top, min(rank) AS low, arg_max(o_orderkey, (rank, -o_orderkey)) AS winner, count(*) AS n FROM r GROUP BY 1, 2)
SELECT o_custkey, topic, CASE WHEN top > low THEN winner END AS winner, CASE WHEN top > low THEN 'higher_authority' ELSE 'unresolved' END AS resolution FROM g WHERE n > 1""")
def conflict_ranks(t: Tables) -> DataFrame:
    """Of rules that conflict, the one of the higher authority wins; equals stay unresolved."""
    level = text.ladder((F.col("o_orderstatus") == "F", "federal"), (F.col("o_orderstatus") == "O", "state"), otherwise="county")
    rows = t.orders.select("o_custkey", F.col("o_orderpriority").alias("topic"), "o_orderkey", gates.authority_rank(level).alias("rank"))
    g = rows.groupBy("o_custkey", "topic").agg(F.max("rank").alias("top"), F.min("rank").alias("low"), F.max_by("o_orderkey", F.struct(F.col("rank"), -F.col("o_orderkey"))).alias("w"), F.count("*").alias("n"))
    settled = F.col("top") > F.col("low")
    return g.where("n > 1").select("o_custkey", "topic", F.when(settled, F.col("w")).alias("winner"), F.when(settled, "higher_authority").otherwise("unresolved").alias("resolution"))


# ---- decisions and queues ---------------------------------------------------


@query("""
WITH d AS (SELECT user_id AS k, arg_max(event_type, (ts, event_id)) AS decision FROM events GROUP BY 1), ready AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 200000)
SELECT CASE WHEN d.k IS NULL THEN 'pending' WHEN ready.k IS NOT NULL THEN 'change_ready' ELSE 'decided_' || decision END AS status, count(*)::BIGINT AS n FROM customer LEFT JOIN d ON c_custkey = d.k LEFT JOIN ready ON c_custkey = ready.k GROUP BY 1""")
def decision_queue(t: Tables) -> DataFrame:
    """The queue with each item's latest decision, counted by status."""
    decided = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("decision"))
    ready = t.orders.where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("ready")).distinct()
    status = text.ladder((F.col("decision").isNull(), "pending"), (F.col("ready"), "change_ready"), otherwise=F.concat(F.lit("decided_"), F.col("decision")))
    return t.customer.select("c_custkey").join(decided, "c_custkey", "left").join(ready, "c_custkey", "left").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query("""
WITH d AS (SELECT user_id AS k, arg_max(event_type, (ts, event_id)) AS decision FROM events GROUP BY 1)
SELECT c_custkey AS id, c_mktsegment AS body, 'kept' AS origin FROM customer LEFT JOIN d ON c_custkey = d.k WHERE decision IS NULL OR decision NOT IN ('error', 'signup')
UNION ALL SELECT c_custkey * 10 + i, c_mktsegment || '/' || i, 'proposed' FROM customer JOIN d ON c_custkey = d.k, (VALUES (1), (2)) v(i) WHERE decision = 'signup'""")
def apply_decisions(t: Tables) -> DataFrame:
    """Latest decisions applied: "error" removes a row, "signup" puts two in its place, others keep it."""
    decided = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("decision"))
    rows = t.customer.select("c_custkey", "c_mktsegment").join(decided, "c_custkey", "left")
    kept = rows.where("decision IS NULL OR decision NOT IN ('error', 'signup')").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("body"), F.lit("kept").alias("origin"))
    parts = rows.where("decision = 'signup'").withColumn("i", F.explode(F.array(F.lit(1), F.lit(2))))
    return kept.unionByName(parts.select((F.col("c_custkey") * 10 + F.col("i")).alias("id"), F.concat_ws("/", "c_mktsegment", F.col("i").cast("string")).alias("body"), F.lit("proposed").alias("origin")))


@query("""
WITH q AS (SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_quantity > 45), m AS (SELECT DISTINCT p_partkey, p_size FROM part)
SELECT q.l_orderkey, q.l_partkey, coalesce(p_size, 0)::BIGINT AS weight FROM q LEFT JOIN m ON l_partkey = p_partkey WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)""")
def conditional_evidence(t: Tables) -> DataFrame:
    """Queued evidence, without what maps to units that are ready already."""
    queue = t.lineitem.where("l_quantity > 45").select("l_orderkey", F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    ready = t.supplier.where("s_acctbal > 5000").select("s_suppkey")
    found = queue.join(ready, "s_suppkey", "left_anti").join(t.part.select("p_partkey", "p_size"), "p_partkey", "left")
    return found.select("l_orderkey", F.col("p_partkey").alias("l_partkey"), F.coalesce("p_size", F.lit(0)).cast("long").alias("weight"))


@query("""
SELECT CASE WHEN sum((event_type IN ('error'))::INT) > 0 THEN 'WARN' ELSE 'PASS' END AS status, user_id, count(*) FILTER (event_type = 'error')::BIGINT AS failed, count(*) FILTER (event_type = 'signup')::BIGINT AS newer FROM events GROUP BY user_id""")
def official_check(t: Tables) -> DataFrame:
    failed = F.count_if(F.col("event_type") == "error")
    return t.events.groupBy("user_id").agg(failed.alias("failed"), F.count_if(F.col("event_type") == "signup").alias("newer")).withColumn("status", F.when(F.col("failed") > 0, "WARN").otherwise("PASS"))


@query("""
WITH r AS (SELECT o_orderkey AS id, o_orderpriority AS category, year(o_orderdate) AS year, o_orderstatus = 'F' AS done FROM orders)
SELECT category, year::BIGINT AS year, count(*)::BIGINT AS scope, count(*) FILTER (done)::BIGINT AS repaired, round(100.0 * count(*) FILTER (done) / count(*), 1)::DOUBLE AS percent FROM r GROUP BY ROLLUP (category, year)""")
def repair_progress(t: Tables) -> DataFrame:
    """Repaired share of the scope, by category and year, with totals."""
    r = t.orders.select(F.col("o_orderpriority").alias("category"), F.year("o_orderdate").cast("long").alias("year"), (F.col("o_orderstatus") == "F").alias("done"))
    done = F.count_if("done")
    return r.rollup("category", "year").agg(F.count("*").alias("scope"), done.alias("repaired"), F.round(100.0 * done / F.count("*"), 1).cast("double").alias("percent"))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'ocr' WHEN l_quantity > 40 THEN 'semantic' WHEN l_discount = 0 THEN 'recovery' ELSE 'none' END AS queue FROM lineitem)
SELECT queue, count(*)::BIGINT AS n, min(l_orderkey) AS first FROM r GROUP BY queue""")
def review_queues(t: Tables) -> DataFrame:
    """Rows routed to one queue each."""
    queue = text.ladder((F.col("l_returnflag") == "R", "ocr"), (F.col("l_quantity") > 40, "semantic"), (F.col("l_discount") == 0, "recovery"), otherwise="none")
    return t.lineitem.groupBy(queue.alias("queue")).agg(F.count("*").alias("n"), F.min("l_orderkey").alias("first"))


@query("""
WITH s AS (SELECT 'high' AS kind, o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS place FROM orders WHERE o_totalprice >= 300000 UNION ALL SELECT 'low', o_orderkey, row_number() OVER (ORDER BY o_orderkey) FROM orders WHERE o_totalprice < 20000
 UNION ALL SELECT 'quarantine', o_orderkey, row_number() OVER (ORDER BY o_orderkey) FROM orders WHERE o_orderstatus = 'P') SELECT kind, o_orderkey FROM s WHERE place <= 25""")
def review_samples(t: Tables) -> DataFrame:
    """The first 25 rows of each kind, as the report asks."""
    kinds = {"high": F.col("o_totalprice") >= 300000, "low": F.col("o_totalprice") < 20000, "quarantine": F.col("o_orderstatus") == "P"}
    parts = [ranking.top_k(t.orders.where(c).select(F.lit(n).alias("kind"), "o_orderkey"), 25, F.col("o_orderkey")) for n, c in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
WITH b AS (SELECT o_orderkey, o_orderpriority, n, refs FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS refs FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)
SELECT o_orderkey AS key, unnest(list_filter([CASE WHEN length(trim(o_orderpriority)) = 0 THEN 'no_title' END, CASE WHEN n IS NULL THEN 'no_sections' END, CASE WHEN refs < n THEN 'repeated_reference' END, CASE WHEN n > 6 THEN 'too_many_sections' END], lambda x: x IS NOT NULL)) AS issue FROM b""")
def record_completeness(t: Tables) -> DataFrame:
    """What a record of several sections lacks."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.count_distinct("l_partkey").alias("refs"))
    rows = t.orders.select("o_orderkey", "o_orderpriority").join(lines, "o_orderkey", "left").withColumnRenamed("o_orderkey", "key")
    checks = {"no_title": ~text.populated("o_orderpriority"), "no_sections": F.col("n").isNull(), "repeated_reference": F.col("refs") < F.col("n"), "too_many_sections": F.col("n") > 6}
    return reports.issues(rows, "key", checks)


@query("SELECT p_partkey, p_size FROM part WHERE p_size NOT IN (SELECT DISTINCT l_linenumber * 7 FROM lineitem)")
def unknown_references(t: Tables) -> DataFrame:
    """References to titles outside the list of known ones."""
    known = t.lineitem.select((F.col("l_linenumber") * 7).alias("p_size")).distinct()
    return t.part.select("p_partkey", "p_size").join(known, "p_size", "left_anti").select("p_partkey", "p_size")
