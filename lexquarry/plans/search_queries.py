"""Queries of ranked search, the index behind it, and evidence retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.functions import text
from lexquarry.operators import joins, ranking, search
from lexquarry.plans.registry import Tables, query

# Rules of the example corpus, whose texts are invented prose with licence lines, secrets and insults.
RULES = search.Rules(
    expansions={"license": ("licensed", "apache"), "secret": ("password", "token"), "insult": ("idiot", "stupid")},
    anchors={"license": ("license", "licensed"), "secret": ("password", "token", "secret")},
    domains={"legal": ("license", "licensed"), "safety": ("secret", "password"), "web": ("http", "link")},
    boosts=(("legal", "version", 14), ("legal", "idiot", -52), ("safety", "key", 28), ("web", "https", 14)),
    preferred=(("english", "en", 120), ("german", "de", 60)),
)
_NORM = "trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))"


def _has(term: str) -> str:
    return f"contains(' ' || norm || ' ', ' {term} ')"


def _sql(request: search.Request) -> str:
    """The SQL of a request's scored documents."""
    hits = " + ".join(f"{_has(w)}::INT" for w in request.terms)
    count = " + ".join(f"least((length(norm) - length(replace(norm, '{w}', ''))) // {len(w)}, 12)" for w in request.terms)
    points = "".join(f" + CASE WHEN {_has(t)} THEN {p} ELSE 0 END" for d, t, p in RULES.boosts if d in request.domains)
    points += "".join(f" + CASE WHEN lang = '{k}' THEN {p} ELSE 0 END" for k, p in request.preferred)
    anchors = " OR ".join(_has(a) for a in request.anchors) or "true"
    return f"""n AS (SELECT doc_id, lang, source, {_NORM} AS norm FROM documents), h AS (SELECT *, ({hits})::BIGINT AS hits FROM n WHERE {anchors}),
 f AS (SELECT doc_id, lang, source, hits, (40 + 24 * hits + {count}{points})::BIGINT AS score FROM h WHERE hits >= {request.least})"""


_LICENSE = search.understand("Which license holds for this english text?", RULES)
_SECRET = search.understand("secret", RULES)
_BOTH = search.understand("license or secret of german texts", RULES)


def _docs(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source", text.normalize("text").alias("norm"))


def _found(t: Tables, request: search.Request) -> DataFrame:
    return search.score_chunks(_docs(t), request, RULES, kind="lang").select("doc_id", "lang", "source", "hits", "score")


@query(f"WITH {_sql(_LICENSE)} SELECT doc_id, lang, hits, score FROM f WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 20")
def search_request(t: Tables) -> DataFrame:
    """A request in words: expanded, anchored, boosted by domain and preferred language; the top 20."""
    return ranking.top_k(_found(t, _LICENSE), 20, F.desc("score"), F.col("doc_id")).select("doc_id", "lang", "hits", "score")


@query(f"WITH {_sql(_SECRET)} SELECT source, count(*)::BIGINT AS n, max(score) AS best FROM f WHERE score > 0 GROUP BY source")
def search_counts(t: Tables) -> DataFrame:
    return _found(t, _SECRET).groupBy("source").agg(F.count("*").alias("n"), F.max("score").alias("best"))


@query(f"""
WITH {_sql(_BOTH)}, d AS (SELECT f.*, CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'legal' WHEN source IN ('src4', 'src5') THEN 'safety' ELSE 'other' END AS domain FROM f WHERE score > 0),
 b AS (SELECT domain, arg_max(doc_id, (score, -doc_id)) AS top FROM d WHERE domain IN ('legal', 'safety') GROUP BY 1), r AS (SELECT d.*, CASE WHEN doc_id = top THEN CASE d.domain WHEN 'legal' THEN 0 ELSE 1 END ELSE 2 END AS first FROM d LEFT JOIN b ON d.domain = b.domain)
SELECT doc_id, domain, score, first < 2 AS leads FROM r ORDER BY first, score DESC, doc_id LIMIT 10""")
def search_spread(t: Tables) -> DataFrame:
    """The top ten, with the best of each domain that the request needs going first."""
    domain = text.ladder((F.col("source").isin("src1", "src2", "src3"), "legal"), (F.col("source").isin("src4", "src5"), "safety"), otherwise="other")
    return search.spread(_found(t, _BOTH).withColumn("domain", domain), "domain", "doc_id", 10, _BOTH.domains).select("doc_id", "domain", "score", "leads")


_TERMS = ", ".join(f"'{w}'" for w in _BOTH.terms)


@query(f"""
WITH p AS (SELECT DISTINCT doc_id, unnest(list_filter(string_split({_NORM}, ' '), lambda w: length(w) >= 3)) AS token FROM documents)
SELECT doc_id, count(*)::BIGINT AS hits FROM p WHERE token IN ({_TERMS}) GROUP BY doc_id HAVING count(*) >= {_BOTH.least}""")
def search_postings(t: Tables) -> DataFrame:
    """Candidates from the inverted index, which a service would write once."""
    return search.candidates(search.postings(_docs(t), "doc_id"), _BOTH, "doc_id")


@query(f"""
WITH {_sql(_SECRET)}, r AS (SELECT source, count(*) AS n FROM documents GROUP BY 1)
SELECT doc_id, score + 6 * least(n // 10, 5) + CASE WHEN n > 40 THEN 28 ELSE 0 END + 14 * least(hits, 5) AS boosted FROM f JOIN r ON f.source = r.source WHERE score > 0""")
def search_related(t: Tables) -> DataFrame:
    """Points for relations (6 each, five at most; 28 for a connected one) and for topics (14 each, five at most)."""
    n = t.documents.groupBy("source").agg(F.count("*").alias("n"))
    related = 6 * F.least(F.floor(F.col("n") / 10), F.lit(5)) + F.when(F.col("n") > 40, 28).otherwise(0) + 14 * F.least("hits", F.lit(5))
    return _found(t, _SECRET).join(n, "source").select("doc_id", (F.col("score") + related).cast("long").alias("boosted"))


# ---- the index --------------------------------------------------------------

_LINES = "list_filter(list_transform(string_split_regex(text, '\\r\\n|[\\n\\r]'), lambda l: trim(regexp_replace(l, '[ \\t\\f]+', ' ', 'g'))), lambda l: l <> '')"


@query(f"""
WITH c AS (SELECT conv_id, turn, {_LINES} AS l FROM conversations) SELECT c_custkey, c_mktsegment, l[1] AS first_chunk FROM customer LEFT JOIN c ON c_custkey = conv_id AND turn = 0""")
def entity_first_chunk(t: Tables) -> DataFrame:
    """Every entity with its first chunk, if it has one."""
    lines = F.filter(F.transform(F.split("text", r"\r\n|[\n\r]"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\f]+", " "))), lambda x: x != "")
    first = t.conversations.where("turn = 0").select(F.col("conv_id").alias("c_custkey"), F.get(lines, F.lit(0)).alias("first_chunk"))
    return t.customer.select("c_custkey", "c_mktsegment").join(first, "c_custkey", "left")


@query("""
WITH c AS (SELECT conv_id, turn, text FROM conversations WHERE contains(lower(text), 'the') ORDER BY conv_id, turn, text LIMIT 2000)
SELECT conv_id, turn, c_name, ((length(lower(text)) - length(replace(lower(text), 'the', ''))) // 3)::BIGINT AS n FROM c JOIN customer ON conv_id = c_custkey""")
def chunk_entities(t: Tables) -> DataFrame:
    """Chunks of a term, the first 2,000 by id as the search has it, with their entities and counts."""
    hit = t.conversations.where(F.lower("text").contains("the")).select("conv_id", "turn", "text")
    first = ranking.top_k(hit, 2000, F.col("conv_id"), F.col("turn"), F.col("text"))
    low = F.lower("text")
    n = F.floor((F.length(low) - F.length(F.replace(low, F.lit("the"), F.lit("")))) / 3)
    return first.join(t.customer.select(F.col("c_custkey").alias("conv_id"), "c_name"), "conv_id").select("conv_id", "turn", "c_name", n.cast("long").alias("n"))


@query("""
WITH i AS (SELECT o_custkey AS id, arg_max(o_orderpriority, o_orderkey) AS title, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1), s AS (SELECT c_custkey AS id, c_name AS title, c_mktsegment AS segment FROM customer WHERE c_custkey % 3 = 0), m AS (SELECT DISTINCT user_id AS id FROM events)
SELECT coalesce(i.id, s.id) AS id, coalesce(i.title, s.title) AS title, i.status, s.segment, 'index' AS origin FROM i FULL JOIN s ON i.id = s.id
UNION ALL SELECT id, 'user ' || id, NULL, NULL, 'markdown' FROM m WHERE id NOT IN (SELECT id FROM i) AND id NOT IN (SELECT id FROM s)""")
def entity_collection(t: Tables) -> DataFrame:
    """Index rows (the last of each id), filled up from side records; plain files only where the id is new."""
    best = F.max_by(F.struct(F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("status")), "o_orderkey")
    index = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(best.alias("r")).select("id", "r.*")
    side = t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("side_title"), F.col("c_mktsegment").alias("segment"))
    both = index.join(side, "id", "full_outer").select("id", F.coalesce("title", "side_title").alias("title"), "status", "segment", F.lit("index").alias("origin"))
    files = t.events.select(F.col("user_id").alias("id")).distinct().join(both, "id", "left_anti")
    return both.unionByName(files.select("id", F.concat(F.lit("user "), F.col("id").cast("string")).alias("title"), F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("segment"), F.lit("markdown").alias("origin")))


@query("""
SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'record' WHEN n_chars <= 2000 THEN 'file' WHEN p.page_id IS NOT NULL THEN 'sidecar' ELSE 'metadata' END AS origin,
 length(CASE WHEN l.quality = 1 THEN text WHEN n_chars <= 2000 THEN text WHEN p.page_id IS NOT NULL THEN html ELSE source || ' ' || lang END)::BIGINT AS size
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN pages p ON d.doc_id = p.page_id""")
def text_preference(t: Tables) -> DataFrame:
    """The text of an entity: its record, a file below the size cap, a side record, or what the metadata say."""
    rows = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left").join(t.pages.select(F.col("page_id").alias("doc_id"), "html"), "doc_id", "left")
    steps = ((F.col("quality") == 1, "record", F.col("text")), (F.col("n_chars") <= 2000, "file", F.col("text")), (F.col("html").isNotNull(), "sidecar", F.col("html")))
    body = text.ladder(*((c, x) for c, _, x in steps), otherwise=F.concat_ws(" ", "source", "lang"))
    return rows.select("doc_id", text.ladder(*((c, n) for c, n, _ in steps), otherwise="metadata").alias("origin"), F.length(body).cast("long").alias("size"))


@query("""
WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '_rules/' || p_partkey || '.md' END AS rule, CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE NULL END AS path, 'content/' || p_partkey AS content FROM part), files AS (SELECT '_rules/' || s_suppkey || '.md' AS f FROM supplier)
SELECT p_partkey, CASE WHEN f IS NOT NULL THEN f ELSE coalesce(nullif(trim(path), ''), content) END AS path FROM r LEFT JOIN files ON rule = f""")
def preferred_path(t: Tables) -> DataFrame:
    """The rule's own file where the listing has it, else the first path stated."""
    k = F.col("p_partkey")
    r = t.part.select("p_partkey", F.when(k % 2 == 0, F.concat(F.lit("_rules/"), k.cast("string"), F.lit(".md"))).alias("rule"), F.when(k % 3 == 0, " ").alias("path"), F.concat(F.lit("content/"), k.cast("string")).alias("content"))
    files = t.supplier.select(F.concat(F.lit("_rules/"), F.col("s_suppkey").cast("string"), F.lit(".md")).alias("rule"), F.lit(True).alias("there"))
    return r.join(files, "rule", "left").select("p_partkey", F.coalesce(F.when(F.col("there"), F.col("rule")), text.first_present("path", "content")).alias("path"))


@query("""
WITH u AS (SELECT 'order' AS layer, o_orderkey AS id, o_orderpriority || ' | ' || o_orderstatus AS body FROM orders UNION ALL SELECT 'part', p_partkey, p_name || ' | ' || p_brand FROM part UNION ALL SELECT 'customer', c_custkey, c_name || ' | ' || c_mktsegment FROM customer)
SELECT layer, count(*)::BIGINT AS records, sum(length(body))::BIGINT AS chars, max(body) AS last FROM u GROUP BY layer""")
def retrieval_catalog(t: Tables) -> DataFrame:
    """All index rows as one compact record each, counted by layer."""
    compact = lambda d, layer, key, *parts: d.select(F.lit(layer).alias("layer"), F.col(key).alias("id"), F.concat_ws(" | ", *parts).alias("body"))
    u = compact(t.orders, "order", "o_orderkey", "o_orderpriority", "o_orderstatus").unionByName(compact(t.part, "part", "p_partkey", "p_name", "p_brand")).unionByName(compact(t.customer, "customer", "c_custkey", "c_name", "c_mktsegment"))
    return u.groupBy("layer").agg(F.count("*").alias("records"), F.sum(F.length("body")).alias("chars"), F.max("body").alias("last"))


# ---- filters of retrieval ---------------------------------------------------


@query("SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') OR p_brand = 'Brand#17'")
def domain_filter(t: Tables) -> DataFrame:
    """A broad name stands for the precise tags under it."""
    domains = {"first": ("Brand#1", "Brand#2", "Brand#3")}
    wanted = [tag for name in ("first", "Brand#17") for tag in domains.get(name, (name,))]
    return t.part.where(F.col("p_brand").isin(*wanted)).select("p_partkey")


_LEVEL = "CASE c_mktsegment WHEN 'BUILDING' THEN 'federal' WHEN 'MACHINERY' THEN 'county' WHEN 'FURNITURE' THEN NULL ELSE 'state' END"


@query(f"""
WITH c AS (SELECT c_custkey, {_LEVEL} AS level, v.req FROM customer, (VALUES ('state'), ('county')) v(req)) SELECT req, count(*)::BIGINT AS n, min(c_custkey) AS first FROM c WHERE level = req OR (level IS NULL AND req NOT IN ('county', 'municipal')) GROUP BY req""")
def authority_filter(t: Tables) -> DataFrame:
    """Rows of the requested level; a row without level answers requests that are not local."""
    rows = t.customer.select("c_custkey", F.expr(_LEVEL).alias("level"), F.explode(F.array(F.lit("state"), F.lit("county"))).alias("req"))
    fits = F.coalesce(F.col("level") == F.col("req"), ~F.col("req").isin("county", "municipal"))
    return rows.where(fits).groupBy("req").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first"))


@query("""
WITH s AS (SELECT s_suppkey, n_name, lower(n_name) AS district, [r_name, n_name] AS counties, s_acctbal > 0 AS local FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT s_suppkey FROM s WHERE contains(district, 'nation_1') OR contains('nation_1', district) OR (local AND list_has_any(counties, ['ASIA', 'EUROPE']))""")
def location_filter(t: Tables) -> DataFrame:
    """The district's name in the request's or the other way, or, for local rows, one of its counties."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "r_name")
    s = t.supplier.join(places, "s_nationkey")
    district, asked = F.lower("n_name"), F.lit("nation_1")
    member = (F.col("s_acctbal") > 0) & F.arrays_overlap(F.array("r_name", "n_name"), F.array(F.lit("ASIA"), F.lit("EUROPE")))
    return s.where(district.contains(asked) | asked.contains(district) | member).select("s_suppkey")


@query("""
WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity::BIGINT * 2 AS score, l_returnflag = 'R' AS review FROM lineitem WHERE l_linestatus = 'O')
SELECT l_orderkey, l_linenumber, l_partkey, score FROM u WHERE NOT review AND score >= 60 ORDER BY score DESC, l_orderkey, l_linenumber, l_partkey LIMIT 50""")
def ready_units(t: Tables) -> DataFrame:
    """The 50 best units that are ready, of the level asked for."""
    u = t.lineitem.where("l_linestatus = 'O' AND l_returnflag <> 'R'").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity").cast("long") * 2).alias("score"))
    return ranking.top_k(u.where("score >= 60"), 50, F.desc("score"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"))


@query("""
SELECT c_custkey, p_partkey FROM customer JOIN part ON (c_mktsegment = 'BUILDING' AND p_brand = 'Brand#1') OR p_partkey = c_custkey OR contains(p_name, 'ring ' || c_custkey)""")
def category_or_target(t: Tables) -> DataFrame:
    """Rows of a category, of a target, or named in an id: the category is all pairs, the others are keys, and no pair is made twice."""
    c, p = t.customer.select("c_custkey", "c_mktsegment"), t.part.select("p_partkey", "p_brand", "p_name")
    building, brand = F.col("c_mktsegment") == "BUILDING", F.col("p_brand") == "Brand#1"
    category = joins.all_pairs(c.where(building).select("c_custkey"), p.where(brand).select("p_partkey"))
    starts = F.expr(r"flatten(transform(regexp_extract_all(p_name, r'ring (-?\d+)', 1), d -> transform(sequence(1, length(d)), i -> left(d, i))))")
    own = F.array(F.col("p_partkey").cast("string"))
    keyed = p.withColumn("key", F.explode(F.array_distinct(F.concat(own, F.coalesce(starts, F.array().cast("array<string>"))))))
    others = c.join(keyed, F.col("c_custkey").cast("string") == F.col("key")).where(~F.coalesce(building & brand, F.lit(False)))
    return category.unionByName(others.select("c_custkey", "p_partkey"))


# ---- planning of evidence ---------------------------------------------------


@query("""
WITH r AS (SELECT * FROM (VALUES (1, 'the', 'article'), (2, 'and', 'joint'), (3, 'der', 'german')) v(pos, term, rule))
SELECT conv_id, turn, arg_min(rule, pos) AS rule FROM conversations JOIN r ON contains(lower(text), term) GROUP BY conv_id, turn, text""")
def first_rule(t: Tables) -> DataFrame:
    """The first rule of which the request has a term."""
    low = F.lower("text")
    hit = text.ladder((low.contains("the"), "article"), (low.contains("and"), "joint"), (low.contains("der"), "german"))
    return t.conversations.select("conv_id", "turn", hit.alias("rule")).where("rule IS NOT NULL")


@query("""
WITH a AS (SELECT n_name AS county, lower(n_name) AS alias FROM nation UNION ALL SELECT n_name, lower(replace(n_name, '_', ' ')) FROM nation), q AS (SELECT s_suppkey, lower('permit in ' || CASE WHEN s_suppkey % 2 = 0 THEN n_name ELSE replace(n_name, '_', ' ') END || ' county') AS q FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, arg_max(county, (length(alias), county)) AS county FROM q JOIN a ON contains(' ' || q || ' ', ' ' || alias || ' ') GROUP BY s_suppkey""")
def jurisdictions(t: Tables) -> DataFrame:
    """The county a request names by any alias; the longest alias wins."""
    n = F.col("n_name")
    aliases = t.nation.select(n.alias("county"), F.explode(F.array_distinct(F.array(F.lower(n), F.lower(F.replace(n, F.lit("_"), F.lit(" ")))))).alias("alias"))
    said = F.when(F.col("s_suppkey") % 2 == 0, n).otherwise(F.replace(n, F.lit("_"), F.lit(" ")))
    q = t.supplier.join(t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey").select("s_suppkey", F.lower(F.concat(F.lit("permit in "), said, F.lit(" county"))).alias("q"))
    spaced = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    found = q.join(F.broadcast(aliases), spaced(F.col("q")).contains(spaced(F.col("alias"))))  # two aliases of each of 25 names
    return found.groupBy("s_suppkey").agg(F.max_by("county", F.struct(F.length("alias"), "county")).alias("county"))


_TEMPLATE = (("click", True, "alias"), ("purchase", True, "graph"), ("error", False, "scan"))
_TEMPLATE_SQL = ", ".join(f"({i}, '{c}', {str(r).lower()}, '{s}')" for i, (c, r, s) in enumerate(_TEMPLATE))


@query(f"""
WITH t AS (SELECT * FROM (VALUES {_TEMPLATE_SQL}) v(step, category, required, strategy)), h AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), u AS (SELECT DISTINCT user_id FROM events)
SELECT u.user_id, step::BIGINT AS step, category, CASE WHEN u.user_id % 10 = 0 THEN false ELSE required END AS required, strategy, coalesce(n, 0)::BIGINT AS found FROM u CROSS JOIN t LEFT JOIN h ON h.user_id = u.user_id AND event_type = category""")
def retrieval_plan(t: Tables) -> DataFrame:
    """The categories a place must cover (its own exemptions go before the template), as ordered steps with strategies."""
    steps = F.array(*(F.struct(F.lit(c).alias("category"), F.lit(r).alias("required"), F.lit(s).alias("strategy")) for c, r, s in _TEMPLATE))
    plan = t.events.select("user_id").distinct().select("user_id", F.posexplode(steps).alias("step", "s"))
    required = F.when(F.col("user_id") % 10 == 0, False).otherwise(F.col("s.required"))
    seen = t.events.groupBy("user_id", F.col("event_type").alias("category")).agg(F.count("*").alias("n"))
    rows = plan.select("user_id", F.col("step").cast("long").alias("step"), "s.category", required.alias("required"), "s.strategy")
    return rows.join(seen, ["user_id", "category"], "left").select("user_id", "step", "category", "required", "strategy", F.coalesce("n", F.lit(0)).cast("long").alias("found"))


@query("""
WITH c AS (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_returnflag) AS l, string_agg('  ' || l_linestatus || ' ' || chr(10), '' ORDER BY l_linenumber, l_linestatus) AS note FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '>') AS chain, trim(regexp_replace(note, '\\s+', ' ', 'g')) AS note FROM c""")
def evidence_packet(t: Tables) -> DataFrame:
    """The chain of sources of an answer, distinct in order, and its text with single spaces."""
    inner = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", c))), lambda x: x[c])  # noqa: E731  (the lines of one order)
    rows = t.lineitem.groupBy("l_orderkey").agg(inner("l_returnflag").alias("l"), inner("l_linestatus").alias("s"))
    note = F.array_join(F.transform("s", lambda x: F.concat(F.lit("  "), x, F.lit(" \n"))), "")
    return rows.select("l_orderkey", F.array_join(F.array_distinct("l"), ">").alias("chain"), F.trim(F.regexp_replace(note, r"\s+", " ")).alias("note"))


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_brand) = 'brand#5' OR lower(p_name) = 'brand#5' ORDER BY p_partkey LIMIT 1")
def statute_lookup(t: Tables) -> DataFrame:
    """One row by id or citation, case aside."""
    asked = "Brand#5".lower()
    return ranking.top_k(t.part.where((F.lower("p_brand") == asked) | (F.lower("p_name") == asked)).select("p_partkey", "p_name"), 1, F.col("p_partkey"))


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('signup', 'error') ORDER BY event_id DESC LIMIT 1")
def latest_run(t: Tables) -> DataFrame:
    return ranking.top_k(t.events.where(F.col("event_type").isin("signup", "error")).select("event_id", "event_type"), 1, F.desc("event_id"))
