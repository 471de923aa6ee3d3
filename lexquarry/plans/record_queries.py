"""Queries over records: indexes, differences, ladders, passages, outlines and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.functions import text
from lexquarry.operators import graph, ranking
from lexquarry.plans.registry import Tables, query
from lexquarry.plans.relational_queries import _EDGES_SQL, shared_key_graph
from lexquarry.streaming.events import sliding_counts

# ---- pages -----------------------------------------------------------------


@query("""
SELECT lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS host, count(*)::BIGINT AS n, count(*) FILTER (starts_with(url, 'https:'))::BIGINT AS n_https FROM pages GROUP BY 1""")
def page_hosts(t: Tables) -> DataFrame:
    host = F.lower(F.regexp_extract("url", "^[A-Za-z]+://([^/?#:]*)", 1))
    return t.pages.groupBy(host.alias("host")).agg(F.count("*").alias("n"), F.count_if(F.col("url").startswith("https:")).alias("n_https"))


@query("""
SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1)) AS title, len(regexp_extract_all(html, '(?i)<h[1-6]\\b'))::BIGINT AS n_headings,
       len(regexp_extract_all(html, '(?i)<td\\b'))::BIGINT AS n_cells, len(regexp_extract_all(html, '(?i)<p\\b'))::BIGINT AS n_paragraphs FROM pages""")
def page_outline(t: Tables) -> DataFrame:
    count = lambda p: F.regexp_count("html", F.lit(p)).cast("long")
    title = F.trim(F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title", 1))
    return t.pages.select("page_id", title.alias("title"), count(r"(?i)<h[1-6]\b").alias("n_headings"), count(r"(?i)<td\b").alias("n_cells"), count(r"(?i)<p\b").alias("n_paragraphs"))


# ---- texts -----------------------------------------------------------------

_SENTENCES = "list_filter(list_transform(string_split(regexp_replace(text, '([.;])[ \\t\\n\\r\\f]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) BETWEEN 20 AND 720)"


@query(f"""
WITH s AS (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents)),
     c AS (SELECT doc_id, greatest(0.2, round(1 - CASE WHEN len(regexp_extract_all(lower(s[i]), '\\b(must|shall|may)\\b')) > 1 THEN 0.35 ELSE 0 END
                  - CASE WHEN contains(s[i], ';') THEN 0.2 ELSE 0 END - CASE WHEN length(s[i]) > 420 THEN 0.2 ELSE 0 END, 2))::DOUBLE AS v FROM s)
SELECT doc_id, count(*)::BIGINT AS n, round(sum(round(v * 100)) / 100 / count(*), 4) AS atomicity FROM c GROUP BY doc_id""")
def sentence_atomicity(t: Tables) -> DataFrame:
    s = t.documents.select("doc_id", F.explode(text.sentences("text", 20)).alias("s"))
    modals = F.regexp_count(F.lower("s"), F.lit(r"\b(must|shall|may)\b"))
    score = 100 - F.when(modals > 1, 35).otherwise(0) - F.when(F.col("s").contains(";"), 20).otherwise(0) - F.when(F.length("s") > 420, 20).otherwise(0)
    return s.groupBy("doc_id").agg(F.count("*").alias("n"), F.round(F.sum(F.greatest(score, F.lit(20))) / 100 / F.count("*"), 4).alias("atomicity"))


@query(f"""
WITH s AS (SELECT conv_id, turn, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT conv_id, turn, {_SENTENCES} AS s FROM conversations)),
     h AS (SELECT conv_id, turn, i, s[i] AS passage, contains(lower(s[i]), 'the')::INT + contains(lower(s[i]), 'and')::INT + contains(lower(s[i]), 'der')::INT AS hits FROM s)
SELECT conv_id, turn, max(hits)::BIGINT AS hits, arg_max(passage, (hits, -i, passage)) AS passage FROM h GROUP BY conv_id, turn""")
def best_passage(t: Tables) -> DataFrame:
    s = t.conversations.select("conv_id", "turn", F.posexplode(text.sentences("text", 20)).alias("i", "passage"))
    hits = sum((F.lower("passage").contains(w).cast("int") for w in ("and", "der")), F.lower("passage").contains("the").cast("int"))
    rows = s.withColumn("hits", hits)
    return rows.groupBy("conv_id", "turn").agg(F.max("hits").cast("long").alias("hits"), F.max_by("passage", F.struct(F.col("hits"), -F.col("i"), F.col("passage"))).alias("passage"))


@query("""
SELECT doc_id, list_max(list_transform(regexp_extract_all(text, '\\b(?:19|20)\\d\\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\\d)\\b'), lambda x: x)) AS latest_date,
       len(regexp_extract_all(text, '\\b(?:19|20)\\d\\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\\d)\\b'))::BIGINT AS n_dates FROM documents""")
def date_markers(t: Tables) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"\b(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d)\b"), F.lit(0))
    return t.documents.select("doc_id", F.array_max(found).alias("latest_date"), F.size(found).cast("long").alias("n_dates"))


# ---- indexes and summaries -------------------------------------------------


@query("SELECT p_brand, string_agg(p_type, '|' ORDER BY p_type) AS types, count(*)::BIGINT AS n FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY p_brand")
def theme_index(t: Tables) -> DataFrame:
    """Types of each brand; both are code lists."""
    kinds = t.part.select("p_brand", "p_type").distinct()
    return kinds.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list("p_type")), "|").alias("types"), F.count("*").alias("n"))


@query("""
SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F')::BIGINT AS f, count(*) FILTER (l_linestatus = 'O')::BIGINT AS o FROM lineitem GROUP BY l_returnflag""")
def layer_pivot(t: Tables) -> DataFrame:
    found = t.lineitem.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).count().fillna(0)
    return found.select("l_returnflag", F.col("F").alias("f"), F.col("O").alias("o"))


@query("SELECT coalesce(event_type, 'total') AS family, count(*)::BIGINT AS n FROM events GROUP BY ROLLUP (event_type)")
def per_source_total(t: Tables) -> DataFrame:
    return t.events.rollup("event_type").count().select(F.coalesce("event_type", F.lit("total")).alias("family"), F.col("count").alias("n"))


@query("""
SELECT user_id, count(*)::BIGINT AS n, count(*) FILTER (event_type = 'error')::BIGINT AS errors, round(count(*) FILTER (event_type = 'error') / count(*)::DOUBLE, 4) AS error_rate,
       sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents FROM events GROUP BY user_id""")
def run_report(t: Tables) -> DataFrame:
    errors = F.count_if(F.col("event_type") == "error")
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    return t.events.groupBy("user_id").agg(F.count("*").alias("n"), errors.alias("errors"), F.round(errors / F.count("*"), 4).alias("error_rate"), cents.alias("cents"))


@query("""
SELECT field, value, count(*)::BIGINT AS n FROM (SELECT 'returnflag' AS field, l_returnflag AS value FROM lineitem UNION ALL SELECT 'linestatus', l_linestatus FROM lineitem) GROUP BY 1, 2""")
def value_histogram(t: Tables) -> DataFrame:
    both = F.explode(F.array(*(F.struct(F.lit(c[2:]).alias("field"), F.col(c).alias("value")) for c in ("l_returnflag", "l_linestatus")))).alias("r")
    return t.lineitem.select(both).groupBy("r.field", "r.value").agg(F.count("*").alias("n"))


@query("SELECT year(o_orderdate)::BIGINT AS year, quarter(o_orderdate)::BIGINT AS quarter, count(*)::BIGINT AS n FROM orders GROUP BY 1, 2")
def quarter_counts(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.groupBy(F.year(d).cast("long").alias("year"), F.quarter(d).cast("long").alias("quarter")).agg(F.count("*").alias("n"))


@query("""
SELECT s_nationkey, coalesce(max(TRY_CAST(regexp_extract(s_name, '(\\d+)$', 1) AS BIGINT)), 0) + 1 AS next_id FROM supplier GROUP BY s_nationkey""")
def next_ids(t: Tables) -> DataFrame:
    number = F.regexp_extract("s_name", r"(\d+)$", 1).try_cast("long")
    return t.supplier.groupBy("s_nationkey").agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_id"))


# ---- best and ranked rows --------------------------------------------------


@query("SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS o_orderkey, max(o_totalprice) AS o_totalprice FROM orders GROUP BY o_custkey")
def keep_best(t: Tables) -> DataFrame:
    best = F.max_by("o_orderkey", F.struct(F.col("o_totalprice"), -F.col("o_orderkey")))
    return t.orders.groupBy("o_custkey").agg(best.alias("o_orderkey"), F.max("o_totalprice").alias("o_totalprice"))


@query("""
SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY year(o_orderdate) DESC, o_orderkey) AS rank FROM orders WHERE o_orderstatus = 'F'""")
def repair_queue(t: Tables) -> DataFrame:
    open_ = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("year"))
    return ranking.numbered(open_, "o_orderpriority", F.desc("year"), F.col("o_orderkey")).select("o_orderkey", "o_orderpriority", "rank")


@query("""
SELECT l_suppkey, l_partkey, arg_max(l_orderkey, (l_shipdate, l_orderkey, l_linenumber)) AS l_orderkey, strftime(max(l_shipdate), '%Y-%m-%d') AS day FROM lineitem GROUP BY 1, 2""")
def inverse_edges(t: Tables) -> DataFrame:
    """Part-to-supplier edges turned round, the last of each pair."""
    last = F.max_by("l_orderkey", F.struct("l_shipdate", "l_orderkey", "l_linenumber"))
    return t.lineitem.groupBy("l_suppkey", "l_partkey").agg(last.alias("l_orderkey"), F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("day"))


# ---- differences -----------------------------------------------------------


@query("SELECT o_custkey AS k, strftime(o_orderdate, '%Y-%m') AS month FROM orders EXCEPT SELECT user_id, strftime(ts, '%Y-%m') FROM events")
def completeness_difference(t: Tables) -> DataFrame:
    seen = t.events.select(F.col("user_id").alias("k"), F.date_format("ts", "yyyy-MM").alias("month"))
    return t.orders.select(F.col("o_custkey").alias("k"), F.date_format("o_orderdate", "yyyy-MM").alias("month")).subtract(seen)


@query("""
SELECT 'no_orders' AS issue, c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'no_events', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
UNION ALL SELECT 'unknown_user', user_id FROM (SELECT DISTINCT user_id FROM events) WHERE user_id NOT IN (SELECT c_custkey FROM customer)""")
def two_way_difference(t: Tables) -> DataFrame:
    known, ordered, seen = (d.select(F.col(c).alias("k")).distinct() for d, c in ((t.customer, "c_custkey"), (t.orders, "o_custkey"), (t.events, "user_id")))
    parts = (("no_orders", known, ordered), ("no_events", known, seen), ("unknown_user", seen, known))
    rows = [a.join(b, "k", "left_anti").select(F.lit(name).alias("issue"), "k") for name, a, b in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("""
SELECT c_custkey, CASE WHEN n = 1 THEN s END AS s_suppkey, CASE WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'linked' ELSE 'ambiguous' END AS status
FROM customer LEFT JOIN (SELECT s_nationkey, count(*) AS n, min(s_suppkey) AS s FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) ON c_nationkey = s_nationkey""")
def unique_mapping(t: Tables) -> DataFrame:
    """A link only where exactly one candidate exists."""
    rich = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.count("*").alias("n"), F.min("s_suppkey").alias("s"))
    status = text.ladder((F.col("n").isNull(), "unmatched"), (F.col("n") == 1, "linked"), otherwise="ambiguous")
    return t.customer.join(rich, "c_nationkey", "left").select("c_custkey", F.when(F.col("n") == 1, F.col("s")).alias("s_suppkey"), status.alias("status"))


@query("""
SELECT coalesce(o_orderkey, k) AS id, CASE WHEN k IS NULL THEN 'missing_file' WHEN o_orderkey IS NULL THEN 'repaired' WHEN n >= 4 THEN 'downloaded' ELSE 'discovered' END AS state
FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') FULL JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY 1) ON o_orderkey = k""")
def state_reconcile(t: Tables) -> DataFrame:
    listed = t.orders.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("id"), F.lit(True).alias("listed"))
    files = t.lineitem.where("l_quantity > 10").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("n"))
    state = text.ladder((F.col("n").isNull(), "missing_file"), (F.col("listed").isNull(), "repaired"), (F.col("n") >= 4, "downloaded"), otherwise="discovered")
    return listed.join(files, "id", "full_outer").select("id", state.alias("state"))


# ---- ladders, taxonomies and coercions -------------------------------------

# Example tables of this catalogue: sectors of part types, with a default by first word.
SECTORS = {"STANDARD BRASS": "11", "PROMO STEEL": "21", "ECONOMY TIN": "22"}
DEFAULTS = {"STANDARD": "31", "PROMO": "42", "ECONOMY": "44", "SMALL": "51"}


def _case(c: str, table: dict[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {c} = '{k}' THEN '{v}'" for k, v in table.items()) + " END"


@query(f"""
SELECT p_partkey, coalesce({_case('p_type', SECTORS)}, {_case("string_split(p_type, ' ')[1]", DEFAULTS)}, 'none') AS sector,
       CASE WHEN {_case('p_type', SECTORS)} IS NOT NULL THEN 3 WHEN {_case("string_split(p_type, ' ')[1]", DEFAULTS)} IS NOT NULL THEN 1 ELSE 0 END::BIGINT AS weight FROM part""")
def taxonomy_fallback(t: Tables) -> DataFrame:
    """The type's own sector (weight 3), else its first word's (weight 1), else none."""
    pick = lambda c, table: text.ladder(*((c == k, v) for k, v in table.items()))
    exact, default = pick(F.col("p_type"), SECTORS), pick(F.substring_index("p_type", " ", 1), DEFAULTS)
    weight = text.ladder((exact.isNotNull(), 3), (default.isNotNull(), 1), otherwise=0).cast("long")
    return t.part.select("p_partkey", F.coalesce(exact, default, F.lit("none")).alias("sector"), weight.alias("weight"))


@query("""
SELECT l_suppkey, n AS sectors, CASE WHEN n >= 5 THEN 'universal' WHEN n >= 3 THEN 'broad' WHEN n >= 1 THEN 'narrow' ELSE 'none' END AS scope
FROM (SELECT l_suppkey, count(DISTINCT p_brand)::BIGINT AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)""")
def scope_classify(t: Tables) -> DataFrame:
    pairs = t.lineitem.select("l_suppkey", F.col("l_partkey").alias("p_partkey")).distinct()
    n = pairs.join(t.part.select("p_partkey", "p_brand"), "p_partkey").groupBy("l_suppkey").agg(F.count_distinct("p_brand").alias("sectors"))
    s = F.col("sectors")
    return n.withColumn("scope", text.ladder((s >= 5, "universal"), (s >= 3, "broad"), (s >= 1, "narrow"), otherwise="none"))


@query("""
SELECT event_id, least(greatest(coalesce(TRY_CAST(props AS DOUBLE), TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100, 0), 0), 1) AS confidence FROM events""")
def confidence_coercion(t: Tables) -> DataFrame:
    """A scalar, or a field of an object, kept to 0..1."""
    value = F.coalesce(F.col("props").try_cast("double"), F.get_json_object("props", "$.k").try_cast("double") / 100, F.lit(0.0))
    return t.events.select("event_id", F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)).alias("confidence"))


@query("""
SELECT o_orderkey, CASE c WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS level FROM (
  SELECT o_orderkey, CASE WHEN s >= 80000 THEN 0 WHEN s >= 60000 THEN 1 ELSE 2 END AS c FROM (
    SELECT o_orderkey, 2000 * CASE o_orderstatus WHEN 'F' THEN 10 WHEN 'O' THEN 9 ELSE 5 END + 1500 * least(n, 3) * 10 // 3 + 4000 * 10 + 1000 * 10 AS s
    FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey))""")
def answer_confidence(t: Tables) -> DataFrame:
    """Authority, number of items, currency and conflicts, blended in whole numbers."""
    n = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    rank = text.ladder((F.col("o_orderstatus") == "F", 10), (F.col("o_orderstatus") == "O", 9), otherwise=5)
    s = 2000 * rank + F.floor(1500 * F.least(F.col("n"), F.lit(3)) * 10 / 3) + 50_000
    level = text.ladder((F.col("s") >= 80_000, "HIGH"), (F.col("s") >= 60_000, "MEDIUM"), otherwise="LOW")
    return t.orders.join(n, "o_orderkey").select("o_orderkey", s.alias("s")).select("o_orderkey", level.alias("level"))


# ---- records, search, graphs, windows ---------------------------------------


@query("""
SELECT c_custkey, c_name, n_name, r_name, coalesce(o.n, 0)::BIGINT AS n_orders, o.last_day, coalesce(e.n, 0)::BIGINT AS n_events
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS n, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM orders GROUP BY 1) o ON c_custkey = o_custkey
LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e ON c_custkey = user_id""")
def detail_record(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_day"))
    e = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n_events"))
    rows = t.customer.join(places, "c_nationkey").join(o, "c_custkey", "left").join(e, "c_custkey", "left")
    return rows.fillna(0, ["n_orders", "n_events"]).select("c_custkey", "c_name", "n_name", "r_name", "n_orders", "last_day", "n_events")


@query("""
SELECT p_partkey, min(phase)::BIGINT AS phase FROM (SELECT p_partkey, 0 AS phase FROM part WHERE lower(p_brand) = 'brand#12'
  UNION ALL SELECT p_partkey, 1 FROM part WHERE contains(lower(p_type), 'steel') UNION ALL SELECT p_partkey, 2 FROM part WHERE p_name LIKE '%1%2%') GROUP BY p_partkey""")
def search_phases(t: Tables) -> DataFrame:
    """Alias hits, then metadata hits, then pattern hits; each entity once, at its first phase."""
    phase = text.ladder((F.lower("p_brand") == "brand#12", 0), (F.lower("p_type").contains("steel"), 1), (F.col("p_name").like("%1%2%"), 2))
    return t.part.select("p_partkey", phase.cast("long").alias("phase")).where("phase IS NOT NULL")


@query(f"""
WITH {_EDGES_SQL} SELECT 'out' AS direction, dst AS other, weight FROM e WHERE src = 7 UNION ALL SELECT 'in', src, weight FROM e WHERE dst = 7""")
def relation_list(t: Tables, node: int = 7) -> DataFrame:
    """One supplier's relations, both ways, found from its own parts alone."""
    pairs = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    own = pairs.where(F.col("l_suppkey") == node).select("l_partkey")
    others = pairs.where(F.col("l_suppkey") != node).join(own, "l_partkey", "left_semi").groupBy(F.col("l_suppkey").alias("other")).agg(F.count("*").alias("weight"))
    return others.select(F.when(F.col("other") > node, "out").otherwise("in").alias("direction"), "other", "weight")


@query(f"""
WITH RECURSIVE {_EDGES_SQL}, b AS (SELECT src AS a, dst AS b FROM e UNION ALL SELECT dst, src FROM e),
 r(node, seen) AS (SELECT a, a FROM b UNION SELECT b.b, r.seen FROM r JOIN b ON r.node = b.a), c AS (SELECT node, min(seen) AS k FROM r GROUP BY node)
SELECT (SELECT count(*) FROM supplier)::BIGINT AS nodes, (SELECT count(*) FROM e)::BIGINT AS edges, count(DISTINCT k)::BIGINT AS components,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM c GROUP BY k))::BIGINT AS largest, ((SELECT count(*) FROM supplier) - count(*))::BIGINT AS isolated FROM c""")
def graph_summary(t: Tables) -> DataFrame:
    edges = shared_key_graph(t)
    sizes = graph.connected_components(graph.shared_key_links(t.lineitem, "l_suppkey", "l_partkey")).groupBy("component").agg(F.count("*").alias("n"))
    inside = sizes.agg(F.count("*").alias("components"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"), F.coalesce(F.sum("n"), F.lit(0)).alias("linked"))
    whole = t.supplier.agg(F.count("*").alias("nodes")).join(edges.agg(F.count("*").alias("edges")), F.lit(True)).join(inside, F.lit(True))  # one row each
    return whole.select("nodes", "edges", "components", "largest", (F.col("nodes") - F.col("linked")).alias("isolated"))


@query("""
SELECT event_type, strftime(w, '%Y-%m-%d %H:%M') AS start, count(*)::BIGINT AS n FROM (
  SELECT event_type, unnest([time_bucket(INTERVAL 5 MINUTE, ts), time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS w FROM events) GROUP BY 1, 2""")
def sliding_window(t: Tables) -> DataFrame:
    found = sliding_counts(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "event_type")
    return found.select("event_type", F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n")
