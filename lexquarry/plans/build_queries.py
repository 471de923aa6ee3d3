"""Queries that build records from sources and report on them: addresses, bags of metadata, spans, tables, tags, ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.functions import markup, outline, scoring, text
from lexquarry.operators import joins, ranking, reports
from lexquarry.plans.registry import Tables, query

# ---- addresses, bags, vocabularies ------------------------------------------


@query(r"""
WITH u AS (SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '[?&](?:ref|utm_[a-z]+)=[^&]*', '', 'g') AS u FROM pages)
SELECT page_id, lower(regexp_extract(u, '^([A-Za-z]+://[^/?]*)', 1)) || regexp_replace(regexp_replace(substring(u, length(regexp_extract(u, '^([A-Za-z]+://[^/?]*)', 1)) + 1), '/+$', ''), '^$', '/') AS url FROM u""")
def url_canonical(t: Tables) -> DataFrame:
    """Addresses with a lower-case host, and without fragment, tracking values and closing slash."""
    u = F.regexp_replace(F.regexp_replace("url", "#.*$", ""), r"[?&](?:ref|utm_[a-z]+)=[^&]*", "")
    rows = t.pages.select("page_id", u.alias("u")).withColumn("h", F.regexp_extract("u", "^([A-Za-z]+://[^/?]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(F.expr("substring(u, length(h) + 1)"), "/+$", ""), "^$", "/")
    return rows.select("page_id", F.concat(F.lower("h"), rest).alias("url"))


@query(r"""
SELECT page_id, coalesce(nullif(regexp_extract(html, '(?i)<html[^>]*\blang="([a-z-]+)"', 1), ''), 'none') AS lang, coalesce(nullif(regexp_extract(html, '(?i)<meta charset="([^"]+)"', 1), ''), 'none') AS charset, contains(html, '<script') AS scripted, length(html)::BIGINT AS size FROM pages""")
def metadata_bag(t: Tables) -> DataFrame:
    """What a page says of itself, by patterns."""
    got = lambda p: F.coalesce(F.nullif(F.regexp_extract("html", p, 1), F.lit("")), F.lit("none"))
    return t.pages.select("page_id", got(r'(?i)<html[^>]*\blang="([a-z-]+)"').alias("lang"), got(r'(?i)<meta charset="([^"]+)"').alias("charset"), F.col("html").contains("<script").alias("scripted"), F.length("html").cast("long").alias("size"))


@query("SELECT o_orderpriority AS value, count(*)::BIGINT AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1")
def vocabulary_check(t: Tables) -> DataFrame:
    """Values outside a closed vocabulary."""
    known = ("1-URGENT", "2-HIGH", "3-MEDIUM")
    return t.orders.where(~F.col("o_orderpriority").isin(*known)).groupBy(F.col("o_orderpriority").alias("value")).agg(F.count("*").alias("n"))


# Example tags of this catalogue, by pattern.
SUBJECTS = {"metal": r"\b(bolt|nut|gear)\b", "small": r"\bsmall\b", "red": r"\bred\b"}


@query(f"""
SELECT p_partkey, array_to_string(list_filter([{', '.join(f"CASE WHEN regexp_matches(lower(p_name), '{p}') THEN '{k}' END" for k, p in SUBJECTS.items())}], lambda x: x IS NOT NULL), '|') AS tags FROM part""")
def subject_tags(t: Tables) -> DataFrame:
    tags = F.filter(F.array(*(F.when(F.lower("p_name").rlike(p), F.lit(k)) for k, p in SUBJECTS.items())), lambda x: x.isNotNull())
    return t.part.select("p_partkey", F.array_join(tags, "|").alias("tags"))


@query("""WITH w AS (SELECT unnest(string_split(lower(p_name), ' ')) AS tag, p_brand FROM part) SELECT tag, count(*)::BIGINT AS n, count(DISTINCT p_brand)::BIGINT AS brands FROM w GROUP BY tag""")
def tag_histogram(t: Tables) -> DataFrame:
    w = t.part.select(F.explode(F.split(F.lower("p_name"), " ")).alias("tag"), "p_brand").groupBy("tag", "p_brand").agg(F.count("*").alias("n"))
    return w.groupBy("tag").agg(F.sum("n").alias("n"), F.count("*").alias("brands"))


# ---- joins ------------------------------------------------------------------


@query("""
WITH base AS (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0), o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), e AS (SELECT user_id, max(value) AS top FROM events GROUP BY 1)
SELECT c_custkey, coalesce(n, 0)::BIGINT AS orders, top FROM base LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN e ON c_custkey = user_id WHERE coalesce(n, 0) >= 12 OR top > 100""")
def cte_two_joins(t: Tables) -> DataFrame:
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    e = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.max("value").alias("top"))
    rows = t.customer.where("c_acctbal > 0").select("c_custkey").join(o, "c_custkey", "left").join(e, "c_custkey", "left").fillna(0, ["orders"])
    return rows.where("orders >= 12 OR top > 100").select("c_custkey", "orders", "top")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS name, c_mktsegment, coalesce(o.status, 'none') AS status FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderstatus) AS status FROM orders GROUP BY 1) o ON c_custkey = o_custkey""")
def enriched(t: Tables) -> DataFrame:
    """Rows with what a side table knows, where the side table goes before the row's own value."""
    own = t.customer.select("c_custkey", F.col("c_name").alias("name"), "c_mktsegment")
    side = t.customer.where("c_custkey % 2 = 0").select("c_custkey", F.upper("c_name").alias("name"))
    status = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("status"))
    both = joins.merged(side, own, "c_custkey")
    return both.join(status, "c_custkey", "left").select("c_custkey", "name", "c_mktsegment", F.coalesce("status", F.lit("none")).alias("status"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10) AS part_known, l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AS supplier_known FROM lineitem""")
def known_endpoints(t: Tables) -> DataFrame:
    """Are both ends of an edge known?"""
    parts = t.part.where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("p"))
    supps = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.lit(True).alias("s"))
    rows = t.lineitem.join(parts, "l_partkey", "left").join(supps, "l_suppkey", "left")
    no = F.lit(False)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.coalesce("p", no).alias("part_known"), F.coalesce("s", no).alias("supplier_known"))


@query("""
WITH e AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS outcome, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1)
SELECT c_custkey, outcome, CASE WHEN outcome IS NULL THEN 'never_run' WHEN outcome = 'error' THEN 'failing' WHEN c_acctbal < 0 THEN 'registry_closed' ELSE 'ok' END AS verdict FROM customer LEFT JOIN e ON c_custkey = user_id""")
def outcome_against_registry(t: Tables) -> DataFrame:
    e = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("outcome"))
    o = F.col("outcome")
    verdict = text.ladder((o.isNull(), "never_run"), (o == "error", "failing"), (F.col("c_acctbal") < 0, "registry_closed"), otherwise="ok")
    return t.customer.join(e, "c_custkey", "left").select("c_custkey", "outcome", verdict.alias("verdict"))


@query("""
SELECT 'lineitem.part' AS reference, count(*)::BIGINT AS broken FROM lineitem ANTI JOIN (SELECT p_partkey FROM part WHERE p_size < 45) ON l_partkey = p_partkey
UNION ALL SELECT 'orders.customer', count(*) FROM orders ANTI JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > -500) ON o_custkey = c_custkey""")
def referential_report(t: Tables) -> DataFrame:
    lost = lambda name, a, b, on: a.join(b, on, "left_anti").agg(F.count("*").alias("broken")).select(F.lit(name).alias("reference"), "broken")
    parts = t.part.where("p_size < 45").select(F.col("p_partkey").alias("l_partkey"))
    known = t.customer.where("c_acctbal > -500").select(F.col("c_custkey").alias("o_custkey"))
    return lost("lineitem.part", t.lineitem, parts, "l_partkey").unionByName(lost("orders.customer", t.orders, known, "o_custkey"))


@query("""
WITH h AS (SELECT l_partkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS wrong FROM lineitem GROUP BY 1)
SELECT p_partkey, CASE WHEN n IS NULL THEN 'unaudited' WHEN wrong * 4 > n THEN 'low' WHEN wrong > 0 THEN 'medium' ELSE 'high' END AS accuracy FROM part LEFT JOIN h ON p_partkey = l_partkey""")
def accuracy_lookup(t: Tables) -> DataFrame:
    """Each record with the verdict of its audit."""
    h = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("wrong"))
    level = text.ladder((F.col("n").isNull(), "unaudited"), (F.col("wrong") * 4 > F.col("n"), "low"), (F.col("wrong") > 0, "medium"), otherwise="high")
    return t.part.select("p_partkey").join(h, "p_partkey", "left").select("p_partkey", level.alias("accuracy"))


# ---- scores -----------------------------------------------------------------


@query("""
SELECT o_orderkey, 30 * (o_orderstatus = 'F')::INT + 25 * (o_totalprice > 100000)::INT + 25 * (o_orderpriority <= '2')::INT + 20 * (o_orderdate >= DATE '1996-01-01')::INT AS points,
  round(0.6 * least(o_totalprice / 500000, 1) + 0.4 * (o_orderkey % 10) / 10, 4) AS blend FROM orders""")
def weighted_points(t: Tables) -> DataFrame:
    """A sum of weighted checks, and a linear blend of two measures."""
    checks = ((F.col("o_orderstatus") == "F", 30), (F.col("o_totalprice") > 100000, 25), (F.col("o_orderpriority") <= "2", 25), (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp"), 20))
    points = sum((F.when(c, w).otherwise(0) for c, w in checks), F.lit(0))
    blend = F.round(0.6 * F.least(F.col("o_totalprice") / 500000, F.lit(1.0)) + 0.4 * (F.col("o_orderkey") % 10) / 10, 4)
    return t.orders.select("o_orderkey", points.alias("points"), blend.alias("blend"))


@query("""
SELECT o_custkey, round(sum(CASE o_orderstatus WHEN 'F' THEN 100 WHEN 'O' THEN 90 WHEN 'P' THEN 70 ELSE 50 END) / 100 / count(*), 4) AS authority FROM orders GROUP BY 1""")
def authority_mean(t: Tables) -> DataFrame:
    w = text.ladder((F.col("o_orderstatus") == "F", 100), (F.col("o_orderstatus") == "O", 90), (F.col("o_orderstatus") == "P", 70), otherwise=50)
    return t.orders.groupBy("o_custkey").agg(F.round(F.sum(w) / 100 / F.count("*"), 4).alias("authority"))


_TOK = "list_filter(string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: length(t) >= 3)"


@query(f"""
WITH w AS (SELECT DISTINCT conv_id, turn, role, unnest({_TOK}) AS w FROM conversations), n AS (SELECT conv_id, turn, count(*) AS n FROM w WHERE role = 'assistant' GROUP BY 1, 2), u AS (SELECT DISTINCT conv_id, w FROM w WHERE role <> 'assistant'),
 s AS (SELECT w.conv_id, turn, count(*) AS k FROM w JOIN u ON w.conv_id = u.conv_id AND w.w = u.w WHERE role = 'assistant' GROUP BY 1, 2)
SELECT n.conv_id, n.turn, round(coalesce(k, 0) / n::DOUBLE, 4) AS support, coalesce(k, 0) * 10 >= n * 7 AS supported FROM n LEFT JOIN s ON n.conv_id = s.conv_id AND n.turn = s.turn""")
def claim_support(t: Tables) -> DataFrame:
    """The share of an answer's words that the evidence has; from .70 the claim is supported."""
    words = t.conversations.select("conv_id", "turn", "role", F.explode(F.filter(F.split(text.normalize("text"), " "), lambda x: F.length(x) >= 3)).alias("w")).distinct()
    said = words.where("role = 'assistant'").select("conv_id", "turn", "w").distinct()
    heard = words.where("role <> 'assistant'").select("conv_id", "w", F.lit(1).alias("there")).distinct()
    k = said.join(heard, ["conv_id", "w"], "left").groupBy("conv_id", "turn").agg(F.count("*").alias("n"), F.count("there").alias("k"))
    return k.select("conv_id", "turn", F.round(F.col("k") / F.col("n"), 4).alias("support"), (F.col("k") * 10 >= F.col("n") * 7).alias("supported"))


# ---- latest and layers ------------------------------------------------------


@query("""
WITH l AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS state, max(ts) FILTER (event_type = 'purchase') AS resolved FROM events GROUP BY 1) SELECT user_id, state, strftime(resolved, '%Y-%m-%d %H:%M') AS resolved FROM l""")
def latest_resolved(t: Tables) -> DataFrame:
    """The latest state of each item and when it was last resolved."""
    when = F.max(F.when(F.col("event_type") == "purchase", F.col("ts")))
    return t.events.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"), F.date_format(when, "yyyy-MM-dd HH:mm").alias("resolved"))


@query("""
SELECT l_suppkey, arg_max(l_orderkey, (l_shipdate, l_orderkey, l_linenumber)) AS l_orderkey, strftime(max(l_shipdate), '%Y-%m-%d') AS day FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1""")
def latest_download(t: Tables) -> DataFrame:
    """The last successful download of each source."""
    good = t.lineitem.where("l_returnflag <> 'R'")
    return good.groupBy("l_suppkey").agg(F.max_by("l_orderkey", F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("l_orderkey"), F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("day"))


@query("""
WITH l AS (SELECT 'orders' AS layer, o_custkey AS source, max(o_orderdate)::DATE AS last, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'events', user_id, max(ts)::DATE, count(*) FROM events GROUP BY 2)
SELECT source, string_agg(layer, '|' ORDER BY layer) AS layers, sum(n)::BIGINT AS rows, strftime(max(last), '%Y-%m-%d') AS last, arg_max(layer, (last, layer)) AS newest FROM l GROUP BY source""")
def layers_by_source(t: Tables) -> DataFrame:
    """The layers a source feeds, and the latest value over them."""
    layer = lambda df, name, key, at: df.groupBy(F.col(key).alias("source")).agg(F.max(F.col(at).cast("date")).alias("last"), F.count("*").alias("n")).withColumn("layer", F.lit(name))
    both = layer(t.orders, "orders", "o_custkey", "o_orderdate").unionByName(layer(t.events, "events", "user_id", "ts"))
    names = F.array_join(F.array_sort(F.collect_list("layer")), "|")  # two layers
    return both.groupBy("source").agg(names.alias("layers"), F.sum("n").alias("rows"), F.date_format(F.max("last"), "yyyy-MM-dd").alias("last"), F.max_by("layer", F.struct("last", "layer")).alias("newest"))


@query("""SELECT 'customer' AS kind, c_custkey AS id FROM customer UNION SELECT 'customer', o_custkey FROM orders UNION SELECT 'customer', user_id FROM events UNION SELECT 'part', p_partkey FROM part UNION SELECT 'part', l_partkey FROM lineitem""")
def known_ids(t: Tables) -> DataFrame:
    """Every id that any table knows."""
    ids = lambda df, kind, c: df.select(F.lit(kind).alias("kind"), F.col(c).alias("id")).distinct()
    parts = [ids(t.customer, "customer", "c_custkey"), ids(t.orders, "customer", "o_custkey"), ids(t.events, "customer", "user_id"), ids(t.part, "part", "p_partkey"), ids(t.lineitem, "part", "l_partkey")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')")
def resume_skip(t: Tables) -> DataFrame:
    """Items of the queue that are not done yet."""
    done = t.lineitem.where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(done, "o_orderkey", "left_anti")


@query("SELECT l_orderkey || '-' || l_linenumber AS id, count(*)::BIGINT AS n, min(l_partkey) AS first FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def id_uniqueness(t: Tables) -> DataFrame:
    """Ids that stand more than once."""
    ids = t.lineitem.groupBy(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"))
    return ids.agg(F.count("*").alias("n"), F.min("l_partkey").alias("first")).where("n > 1")


@query("""
SELECT lang, count(*)::BIGINT AS n, count(l.doc_id)::BIGINT AS tagged, round(count(l.doc_id) / count(*)::DOUBLE, 4) AS tag_share, round(count(*) FILTER (n_chars >= 200) / count(*)::DOUBLE, 4) AS summary_share FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang""")
def tag_coverage(t: Tables) -> DataFrame:
    """Shares of records with tags and with a summary."""
    rows = t.documents.select("doc_id", "lang", "n_chars").join(t.labels.select("doc_id", F.lit(1).alias("t")), "doc_id", "left")
    n = F.count("*")
    return rows.groupBy("lang").agg(n.alias("n"), F.count("t").alias("tagged"), F.round(F.count("t") / n, 4).alias("tag_share"), F.round(F.count_if(F.col("n_chars") >= 200) / n, 4).alias("summary_share"))


@query("""
WITH d AS (SELECT url, html, sha256(html) AS sha, starts_with(url, 'https') AS safe FROM pages), s AS (SELECT sha, count(*) AS n FROM d GROUP BY 1)
SELECT safe, count(*)::BIGINT AS files, count(*) FILTER (length(html) < 2000)::BIGINT AS small, count(*) FILTER (s.n > 1)::BIGINT AS repeated, sum(length(html))::BIGINT AS chars FROM d JOIN s ON d.sha = s.sha GROUP BY safe""")
def download_quality(t: Tables) -> DataFrame:
    d = t.pages.select(F.col("url").startswith("https").alias("safe"), F.sha2("html", 256).alias("sha"), F.length("html").alias("size"))
    by = d.groupBy("sha", "safe").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    every = by.withColumn("all", F.sum("n").over(Window.partitionBy("sha")))  # at most two rows a digest
    return every.groupBy("safe").agg(F.sum("n").alias("files"), F.sum(F.when(F.col("size") < 2000, F.col("n")).otherwise(0)).alias("small"), F.sum(F.when(F.col("all") > 1, F.col("n")).otherwise(0)).alias("repeated"), F.sum(F.col("n") * F.col("size")).alias("chars"))


@query("""
SELECT c_mktsegment, CASE WHEN a IS NULL THEN 'unknown' WHEN a > 2400 THEN 'stale' WHEN a > 2200 THEN 'watch' ELSE 'fresh' END AS status, count(*)::BIGINT AS n, max(a)::BIGINT AS oldest
FROM customer LEFT JOIN (SELECT o_custkey, date_diff('day', max(o_orderdate)::DATE, DATE '2005-01-01') AS a FROM orders GROUP BY 1) ON c_custkey = o_custkey GROUP BY 1, 2""")
def freshness_report(t: Tables) -> DataFrame:
    """Freshness of the records of each layer; those never dated are unknown."""
    last = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.datediff(F.lit("2005-01-01").cast("date"), F.max("o_orderdate").cast("date")).alias("a"))
    return t.customer.join(last, "c_custkey", "left").groupBy("c_mktsegment", scoring.freshness(F.col("a"), 2200, 2400).alias("status")).agg(F.count("*").alias("n"), F.max("a").cast("long").alias("oldest"))


@query("""
SELECT l_orderkey AS key, unnest(list_filter([CASE WHEN l_shipdate < o_orderdate THEN 'shipped_before_order' END, CASE WHEN date_diff('day', o_orderdate::DATE, l_shipdate::DATE) > 3000 THEN 'long_gap' END, CASE WHEN year(l_shipdate) > 1997 AND o_orderstatus = 'F' THEN 'late_final' END], lambda x: x IS NOT NULL)) AS issue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def date_logic(t: Tables) -> DataFrame:
    """Dates of a record that contradict one another."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumnRenamed("l_orderkey", "key")
    checks = {
        "shipped_before_order": F.col("l_shipdate") < F.col("o_orderdate"),
        "long_gap": F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")) > 3000,
        "late_final": (F.year("l_shipdate") > 1997) & (F.col("o_orderstatus") == "F"),
    }
    return reports.issues(rows, "key", checks)


# ---- ledgers, queues, builds ------------------------------------------------


@query("""
WITH u AS (SELECT 'UL-' || event_id AS id, strftime(ts, '%Y-%m-%d') AS day, user_id AS source, event_type AS change FROM events WHERE event_type <> 'view'), o AS (SELECT 'RP-' || o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day, o_custkey AS source, 'repair' AS change FROM orders WHERE o_orderstatus = 'P')
SELECT source, count(*)::BIGINT AS entries, max(day) AS last, count(DISTINCT change)::BIGINT AS kinds FROM (SELECT * FROM u UNION ALL SELECT * FROM o) GROUP BY source""")
def update_ledger(t: Tables) -> DataFrame:
    """Logs and repairs as one ledger, summed by source."""
    u = t.events.where("event_type <> 'view'").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("user_id").alias("source"), F.col("event_type").alias("change"))
    o = t.orders.where("o_orderstatus = 'P'").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_custkey").alias("source"), F.lit("repair").alias("change"))
    kinds = u.unionByName(o).groupBy("source", "change").agg(F.count("*").alias("n"), F.max("day").alias("day"))
    return kinds.groupBy("source").agg(F.sum("n").alias("entries"), F.max("day").alias("last"), F.count("*").alias("kinds"))


@query("""
WITH q AS (SELECT o_orderkey, o_orderpriority, CASE WHEN l_orderkey IS NULL THEN 'missing_file' WHEN n < 2 THEN 'short_file' ELSE 'stale_file' END AS reason, year(o_orderdate) AS year
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL OR n < 2 OR o_orderstatus = 'P')
SELECT o_orderkey, reason, row_number() OVER (PARTITION BY reason ORDER BY o_orderpriority, year DESC, o_orderkey) AS place FROM q""")
def repair_build(t: Tables) -> DataFrame:
    """What is to be repaired and why, in order of priority and year."""
    n = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    rows = t.orders.join(n, "o_orderkey", "left").where("n IS NULL OR n < 2 OR o_orderstatus = 'P'")
    reason = text.ladder((F.col("n").isNull(), "missing_file"), (F.col("n") < 2, "short_file"), otherwise="stale_file")
    q = rows.select("o_orderkey", "o_orderpriority", reason.alias("reason"), F.year("o_orderdate").alias("year"))
    return ranking.numbered(q, "reason", F.col("o_orderpriority"), F.desc("year"), F.col("o_orderkey")).select("o_orderkey", "reason", F.col("rank").alias("place"))


@query("""
WITH c AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->|<[^>]*>', ' ', 'g'), '[ \t\n\r\f]+', ' ', 'g')) AS body FROM pages), h AS (SELECT page_id, body, sha256(body) AS sha FROM c), f AS (SELECT sha, min(page_id) AS page_id FROM h GROUP BY 1)
SELECT h.page_id, CASE WHEN length(body) < 500 THEN 'quarantine_short' WHEN contains(body, '###') THEN 'quarantine_noise' ELSE 'indexed' END AS state, length(body)::BIGINT AS size FROM h JOIN f ON h.page_id = f.page_id""")
def rule_build(t: Tables) -> DataFrame:
    """Pages to records: text, one of each digest, then checks that index or quarantine."""
    h = t.pages.select("page_id", text.visible_text("html").alias("body")).withColumn("sha", F.sha2("body", 256))
    first = h.groupBy("sha").agg(F.min_by(F.struct("page_id", "body"), "page_id").alias("r")).select("r.*")
    state = text.ladder((F.length("body") < 500, "quarantine_short"), (F.col("body").contains("###"), "quarantine_noise"), otherwise="indexed")
    return first.select("page_id", state.alias("state"), F.length("body").cast("long").alias("size"))


_PAGES = """concat('[[page 1]]\nSection ', p_size, ' Scope\nline of ', p_brand, '\n[[page 2]]\nmore\nSection ', p_size + 1, ' Fees\npay')"""


@query(f"""
WITH l AS (SELECT p_partkey, string_split({_PAGES}, chr(10)) AS s FROM part), r AS (SELECT p_partkey, i, s[i] AS line, regexp_extract(list_filter(s[1:i], lambda x: starts_with(x, '[[page '))[-1], '(\\d+)', 1)::BIGINT AS page, list_filter(s[1:i], lambda x: starts_with(x, 'Section '))[-1] AS section FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM l))
SELECT p_partkey, section, min(page) AS first_page, max(page) AS last_page, min(i) AS first_line, max(i) AS last_line FROM r WHERE section IS NOT NULL AND NOT starts_with(line, '[[page ') GROUP BY 1, 2""")
def section_spans(t: Tables) -> DataFrame:
    """Sections of page-marked texts with their pages and lines."""
    texts = t.part.select("p_partkey", F.expr(_PAGES).alias("x"))
    found = outline.outline(texts, "p_partkey", "x", outline.Shape((("section", r"^Section .*"),), marker=r"^\[\[page (\d+)"))
    kept = found.where("level = 1").select("p_partkey", F.col("opened").alias("section"), F.coalesce("opened_page", "first_page").alias("first_page"), "last_page", F.col("opened_line").alias("first_line"), "last_line")
    return kept


_LAWS = """concat('<table><tr><th>Ch.</th></tr><tr><td>', s_suppkey, '</td><td> HB24-', 1000 + s_suppkey, ' </td><td>Concerning ', s_name, '</td></tr><tr><td>', s_suppkey + 1, '</td><td>n/a</td><td>none</td></tr></table>')"""


@query(f"""
WITH r AS (SELECT s_suppkey, unnest(regexp_extract_all({_LAWS}, '<tr>(.*?)</tr>', 1)) AS r FROM supplier), c AS (SELECT s_suppkey, regexp_extract_all(r, '<td>([^<]*)</td>', 1) AS c FROM r)
SELECT s_suppkey, 'SL-2024-' || lpad(c[1], 4, '0') AS id, trim(c[2]) AS bill, c[3] AS title FROM c WHERE len(c) = 3 AND regexp_matches(trim(c[2]), '^[HS]B\\d\\d-\\d+$')""")
def session_laws(t: Tables) -> DataFrame:
    """Rows of a table of session laws as records; rows without a bill are none."""
    page = t.supplier.select("s_suppkey", F.expr(_LAWS).alias("page"))
    c = markup.page_records(page, "s_suppkey", "page", "tr", ("td",)).select("s_suppkey", F.col("fields.text").alias("c")).where(F.size("c") == 3)
    bill = F.get("c", F.lit(1))
    return c.where(bill.rlike(r"^[HS]B\d\d-\d+$")).select("s_suppkey", F.concat(F.lit("SL-2024-"), F.lpad(F.get("c", F.lit(0)), 4, "0")).alias("id"), bill.alias("bill"), F.get("c", F.lit(2)).alias("title"))


@query("""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1)) AS href FROM pages), r AS (SELECT 'AGO-' || upper(trim(regexp_replace(href, '[^A-Za-z0-9]+', '-', 'g'), '-')) AS id, min(page_id) AS page_id, count(*)::BIGINT AS mentions FROM l WHERE length(href) > 2 GROUP BY 1)
SELECT id, page_id, mentions FROM r""")
def linked_records(t: Tables) -> DataFrame:
    """One record of each document that pages link to, merged over the pages."""
    l = t.pages.select("page_id", F.explode(text.links("html")).alias("href")).where(F.length("href") > 2)  # noqa: E741
    name = F.upper(F.regexp_replace(F.regexp_replace("href", "[^A-Za-z0-9]+", "-"), "^-+|-+$", ""))
    return l.groupBy(F.concat(F.lit("AGO-"), name).alias("id")).agg(F.min("page_id").alias("page_id"), F.count("*").alias("mentions"))


@query("""
WITH done AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A'), fresh AS (SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM done))
SELECT 'ingested' AS step, count(DISTINCT l_orderkey)::BIGINT AS titles, count(*)::BIGINT AS sections FROM fresh UNION ALL SELECT 'skipped', (SELECT count(*) FROM done), (SELECT count(*) FROM lineitem SEMI JOIN done USING (l_orderkey))""")
def bulk_ingest(t: Tables) -> DataFrame:
    """Titles that are there are skipped, the others parsed; counted."""
    titles = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.bool_or(F.col("l_returnflag") == "A").alias("done"))
    step = F.when(F.col("done"), "skipped").otherwise("ingested")
    return titles.groupBy(step.alias("step")).agg(F.count("*").alias("titles"), F.sum("n").alias("sections"))
