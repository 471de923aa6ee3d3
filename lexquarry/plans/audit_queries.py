"""Queries of audits, registries, dashboards, stores and corpus builds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.dealing import dealt
from lexquarry.functions import markup, outline, text
from lexquarry.operators import joins, ranking, reports
from lexquarry.plans.registry import Tables, query

# ---- registries and coverage ------------------------------------------------


@query("""
SELECT s_suppkey, coalesce(n_name, 'unknown') AS department, CASE WHEN n_name IS NULL THEN 'unregistered' WHEN lower(n_name) = lower(CASE WHEN s_suppkey % 3 = 0 THEN 'other' ELSE n_name END) THEN 'same' ELSE 'differs' END AS verdict
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON s_nationkey = n_nationkey""")
def registry_lookup(t: Tables) -> DataFrame:
    """Each code against the registry, with the department it states compared."""
    registry = t.nation.where("n_nationkey < 20").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    stated = F.when(F.col("s_suppkey") % 3 == 0, "other").otherwise(F.col("n_name"))
    verdict = text.ladder((F.col("n_name").isNull(), "unregistered"), (F.lower("n_name") == F.lower(stated), "same"), otherwise="differs")
    return t.supplier.join(F.broadcast(registry), "s_nationkey", "left").select("s_suppkey", F.coalesce("n_name", F.lit("unknown")).alias("department"), verdict.alias("verdict"))  # 25 rows


@query("""
WITH a AS (SELECT user_id, count(*)::BIGINT AS attempts, bool_or(event_type = 'purchase') AS ok FROM events GROUP BY 1)
SELECT n_name, c_mktsegment, count(*)::BIGINT AS sources, coalesce(sum(attempts), 0)::BIGINT AS attempts, max(CASE WHEN ok THEN 'covered' WHEN attempts > 0 THEN 'attempted' ELSE 'missing' END) AS status
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN a ON c_custkey = user_id GROUP BY 1, 2""")
def source_coverage(t: Tables) -> DataFrame:
    """Registered sources with the attempts on them, by place and category."""
    a = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("attempts"), F.bool_or(F.col("event_type") == "purchase").alias("ok"))
    rows = t.customer.join(F.broadcast(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")), "c_nationkey").join(a, "c_custkey", "left")  # 25 nations
    status = text.ladder((F.col("ok"), "covered"), (F.col("attempts") > 0, "attempted"), otherwise="missing")
    return rows.groupBy("n_name", "c_mktsegment").agg(F.count("*").alias("sources"), F.coalesce(F.sum("attempts"), F.lit(0)).alias("attempts"), F.max(status).alias("status"))


@query("""
SELECT count(*)::BIGINT AS rows, count(*) FILTER (event_type = 'error')::BIGINT AS failed, count(*) FILTER (value < 5)::BIGINT AS missing_files, (count(*) - count(DISTINCT user_id || ':' || event_type))::BIGINT AS collapsed FROM events""")
def dataset_summary(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("f"), F.count_if(F.col("value") < 5).alias("m")).agg(
        F.sum("n").alias("rows"), F.sum("f").alias("failed"), F.sum("m").alias("missing_files"), (F.sum("n") - F.count("*")).alias("collapsed")
    )


@query("""
WITH r AS (SELECT event_type AS kind, CASE WHEN value >= 85 THEN 'high' WHEN value >= 60 THEN 'medium' ELSE 'low' END AS bucket FROM events)
SELECT kind, bucket, count(*)::BIGINT AS n FROM r GROUP BY GROUPING SETS ((kind), (bucket), ())""")
def extraction_report(t: Tables) -> DataFrame:
    """Counts by kind, by confidence and in all, in one pass."""
    bucket = text.ladder((F.col("value") >= 85, "high"), (F.col("value") >= 60, "medium"), otherwise="low")
    r = t.events.select(F.col("event_type").alias("kind"), bucket.alias("bucket"))
    return r.groupingSets([["kind"], ["bucket"], []], "kind", "bucket").agg(F.count("*").alias("n"))


@query("""
SELECT o_orderstatus, count(*) FILTER (o_totalprice > 200000)::BIGINT AS better, count(*) FILTER (o_totalprice BETWEEN 50000 AND 200000)::BIGINT AS same, count(*) FILTER (o_totalprice < 50000)::BIGINT AS worse FROM orders GROUP BY 1""")
def comparison_summary(t: Tables) -> DataFrame:
    """Statuses of a comparison across, by group."""
    p = F.col("o_totalprice")
    kind = text.ladder((p > 200000, "better"), (p >= 50000, "same"), otherwise="worse")
    return t.orders.withColumn("kind", kind).groupBy("o_orderstatus").pivot("kind", ["better", "same", "worse"]).count().fillna(0)


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (event_type IN ('click', 'view'))::BIGINT AS hits, count(*) FILTER (event_type NOT IN ('click', 'view'))::BIGINT AS misses, round(count(*) FILTER (event_type IN ('click', 'view')) / count(*)::DOUBLE, 4) AS rate FROM events GROUP BY 1""")
def cache_rates(t: Tables) -> DataFrame:
    hit = F.count_if(F.col("event_type").isin("click", "view"))
    return t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(hit.alias("hits"), (F.count("*") - hit).alias("misses"), F.round(hit / F.count("*"), 4).alias("rate"))


@query("""
SELECT event_type AS route, count(*)::BIGINT AS n, round(avg((user_id % 2)), 4) AS accepted, round(sum(CAST(round(value * 100) AS BIGINT)) / count(*) / 100, 4) AS mean_value, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents FROM events GROUP BY 1""")
def pilot_report(t: Tables) -> DataFrame:
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    return t.events.groupBy(F.col("event_type").alias("route")).agg(F.count("*").alias("n"), F.round(F.avg(F.col("user_id") % 2), 4).alias("accepted"), F.round(cents / F.count("*") / 100, 4).alias("mean_value"), cents.alias("cents"))


# ---- layers, dashboards, readiness -----------------------------------------

_STATES = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'new' ELSE 'seen' END"


@query(f"""
WITH o AS (SELECT user_id AS k, arg_max({_STATES}, (ts, event_id)) AS observed FROM events GROUP BY 1), q AS (SELECT o_custkey AS k, count(*) AS pending FROM orders WHERE o_orderstatus = 'P' GROUP BY 1), l AS (SELECT o_custkey AS k, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders GROUP BY 1),
 d AS (SELECT c_custkey, CASE WHEN observed IS NULL THEN 'never_checked' WHEN observed = 'failed' THEN 'check_failed' WHEN pending > 0 THEN 'update_pending' WHEN observed = 'new' THEN 'changed' ELSE 'current' END AS status, last FROM customer LEFT JOIN o ON c_custkey = o.k LEFT JOIN q ON c_custkey = q.k LEFT JOIN l ON c_custkey = l.k)
SELECT status, count(*)::BIGINT AS sources, max(last) AS last FROM d GROUP BY status""")
def update_dashboard(t: Tables) -> DataFrame:
    """One status a source, from its last observation, the pending queue and its layer; counted."""
    observed = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by(F.expr(_STATES), F.struct("ts", "event_id")).alias("observed"))
    own = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_if(F.col("o_orderstatus") == "P").alias("pending"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last"))
    rows = t.customer.select("c_custkey").join(observed, "c_custkey", "left").join(own, "c_custkey", "left")
    o = F.col("observed")
    status = text.ladder((o.isNull(), "never_checked"), (o == "failed", "check_failed"), (F.col("pending") > 0, "update_pending"), (o == "new", "changed"), otherwise="current")
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("sources"), F.max("last").alias("last"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P' AND year(o_orderdate) >= 1995")
def failed_since(t: Tables) -> DataFrame:
    """Manifest rows that failed for good since a year."""
    return t.orders.where("o_orderstatus = 'P' AND o_orderdate >= DATE'1995-01-01'").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) IN (1994, 1996) AND o_orderpriority IN ('1-URGENT', '5-LOW')")
def queue_selection(t: Tables) -> DataFrame:
    """Queue rows of chosen years and categories."""
    return t.orders.where(F.year("o_orderdate").isin(1994, 1996) & F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey")


@query("""SELECT lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS host, count(*)::BIGINT AS n FROM pages WHERE page_id % 3 = 0 GROUP BY 1 ORDER BY n DESC, host LIMIT 10""")
def failure_hosts(t: Tables) -> DataFrame:
    """The ten hosts with most permanent failures."""
    host = F.lower(F.regexp_extract("url", "^[A-Za-z]+://([^/?#:]*)", 1))
    return ranking.top_k(t.pages.where("page_id % 3 = 0").groupBy(host.alias("host")).agg(F.count("*").alias("n")), 10, F.desc("n"), F.col("host"))


@query("""
WITH m AS (SELECT * FROM (VALUES ('A', 100), ('N', 1000000), ('R', 100)) v(layer, expected)), f AS (SELECT l_returnflag AS layer, count(*)::BIGINT AS rows, count(*) FILTER (l_quantity < 1)::BIGINT AS invalid FROM lineitem GROUP BY 1)
SELECT m.layer, coalesce(rows, 0) AS rows, coalesce(invalid, 0) AS invalid, CASE WHEN rows IS NULL THEN 'unreadable' WHEN invalid > 0 THEN 'invalid' WHEN rows < expected THEN 'short' ELSE 'ok' END AS verdict FROM m LEFT JOIN f ON m.layer = f.layer""")
def layer_audit(t: Tables) -> DataFrame:
    """Rows and invalid rows of each layer against what the manifest says."""
    m = t.spark.createDataFrame([("A", 100), ("N", 1_000_000), ("R", 100)], "layer string, expected long")
    f = t.lineitem.groupBy(F.col("l_returnflag").alias("layer")).agg(F.count("*").alias("rows"), F.count_if(F.col("l_quantity") < 1).alias("invalid"))
    verdict = text.ladder((F.col("rows").isNull(), "unreadable"), (F.col("invalid") > 0, "invalid"), (F.col("rows") < F.col("expected"), "short"), otherwise="ok")
    return m.join(f, "layer", "left").select("layer", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("invalid", F.lit(0)).alias("invalid"), verdict.alias("verdict"))


@query("""
SELECT 'orders' AS layer, o_orderkey AS id, 'price' AS issue FROM orders WHERE o_totalprice < 1500 UNION ALL SELECT 'orders', o_orderkey, 'status' FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'parts', p_partkey, 'size' FROM part WHERE p_size > 48 UNION ALL SELECT 'events', event_id, 'value' FROM events WHERE value < 1 UNION ALL SELECT 'crosswalk', l_orderkey, 'end' FROM lineitem ANTI JOIN part ON l_partkey = p_partkey""")
def layer_validation(t: Tables) -> DataFrame:
    """Broken constraints of all layers, and edges whose end is gone, as one list."""
    found = [
        reports.issues(t.orders.withColumnRenamed("o_orderkey", "id"), "id", {"price": F.col("o_totalprice") < 1500, "status": ~F.col("o_orderstatus").isin("F", "O")}).withColumn("layer", F.lit("orders")),
        reports.issues(t.part.withColumnRenamed("p_partkey", "id"), "id", {"size": F.col("p_size") > 48}).withColumn("layer", F.lit("parts")),
        reports.issues(t.events.withColumnRenamed("event_id", "id"), "id", {"value": F.col("value") < 1}).withColumn("layer", F.lit("events")),
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left_anti").select(F.col("l_orderkey").alias("id"), F.lit("end").alias("issue"), F.lit("crosswalk").alias("layer")),
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("layer", "id", "issue")


@query("""
WITH c AS (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM customer) AS b, (SELECT count(*) FROM lineitem ANTI JOIN orders ON l_orderkey = o_orderkey) AS lost, (SELECT count(*) FROM events WHERE event_type = 'error') AS errors)
SELECT gate, ok, CASE WHEN bool_and(ok) OVER (ORDER BY gate) THEN 'pass' ELSE 'blocked' END AS state FROM (SELECT unnest([1, 2, 3, 4])::BIGINT AS gate, unnest([a > 100, b > 10, lost = 0, errors < 10]) AS ok FROM c)""")
def readiness_gates(t: Tables) -> DataFrame:
    """Counts against expectations; a gate is blocked by any before it that failed (four rows)."""
    one = lambda df, name: df.agg(F.count("*").alias(name))
    lost = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    c = one(t.orders, "a").crossJoin(one(t.customer, "b")).crossJoin(one(lost, "lost")).crossJoin(one(t.events.where("event_type = 'error'"), "errors"))  # one row each
    checks = F.array(F.col("a") > 100, F.col("b") > 10, F.col("lost") == 0, F.col("errors") < 10)
    rows = c.select(F.posexplode(checks).alias("i", "ok")).select((F.col("i") + 1).cast("long").alias("gate"), "ok")
    so_far = F.bool_and("ok").over(Window.partitionBy(F.lit(1)).orderBy("gate"))
    return rows.select("gate", "ok", F.when(so_far, "pass").otherwise("blocked").alias("state"))


@query("""
SELECT n_name, seg AS category, count(c_custkey)::BIGINT AS evidence FROM (SELECT n_nationkey, n_name, seg FROM nation, (SELECT DISTINCT c_mktsegment AS seg FROM customer)) LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_nationkey = n_nationkey AND c_mktsegment = seg GROUP BY 1, 2 HAVING count(c_custkey) < 12""")
def gap_records(t: Tables) -> DataFrame:
    """Cells of the matrix of places and categories with less evidence than twelve."""
    cells = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name").crossJoin(t.customer.select("c_mktsegment").distinct())  # 25 nations by the segments, a code list
    have = t.customer.where("c_acctbal > 0").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    rows = cells.join(have, ["c_nationkey", "c_mktsegment"], "left").select("n_name", F.col("c_mktsegment").alias("category"), F.coalesce("n", F.lit(0)).cast("long").alias("evidence"))
    return rows.where("evidence < 12")


@query("""
WITH d AS (SELECT sha256(text) AS sha, count(*) AS n FROM documents GROUP BY 1)
SELECT source, count(*)::BIGINT AS rows, count(*) FILTER (n_chars <> length(text))::BIGINT AS wrong_size, count(*) FILTER (contains(text, '�'))::BIGINT AS garbled, count(*) FILTER (d.n > 1)::BIGINT AS repeated FROM documents JOIN d ON sha256(text) = sha GROUP BY source""")
def data_audit(t: Tables) -> DataFrame:
    """Sizes, encodings and repeats of the texts of each source."""
    rows = t.documents.select("source", F.sha2("text", 256).alias("sha"), (F.col("n_chars") != F.length("text")).alias("wrong"), F.col("text").contains("�").alias("bad"))
    by_text = rows.groupBy("sha", "source").agg(F.count("*").alias("n"), F.count_if("wrong").alias("wrong"), F.count_if("bad").alias("bad"))
    often = by_text.withColumn("all", F.sum("n").over(Window.partitionBy("sha")))  # one row a source and text
    return often.groupBy("source").agg(F.sum("n").alias("rows"), F.sum("wrong").alias("wrong_size"), F.sum("bad").alias("garbled"), F.sum(F.when(F.col("all") > 1, F.col("n")).otherwise(0)).alias("repeated"))


@query("""
WITH u AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey, l_linenumber) AS place FROM lineitem WHERE l_returnflag = 'N') SELECT l_orderkey, l_partkey, place FROM u WHERE place <= 2""")
def semantic_candidates(t: Tables) -> DataFrame:
    """The two best candidates of each rule for review."""
    order = Window.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"), "l_partkey", "l_linenumber")
    return t.lineitem.where("l_returnflag = 'N'").withColumn("place", F.row_number().over(order).cast("long")).where("place <= 2").select("l_orderkey", "l_partkey", "place")


@query("SELECT p_partkey, 'unreferenced' AS issue FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 30 AND l_discount > 0.08)")
def unreferenced_files(t: Tables) -> DataFrame:
    used = t.lineitem.where("l_quantity > 30 AND l_discount > 0.08").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.join(used, "p_partkey", "left_anti").select("p_partkey", F.lit("unreferenced").alias("issue"))


@query("""
WITH d AS (SELECT user_id AS k, arg_max(event_type, (ts, event_id)) AS decision FROM events GROUP BY 1)
SELECT c_custkey, CASE WHEN decision = 'purchase' AND c_acctbal > 0 THEN 'promoted' WHEN decision = 'purchase' THEN 'blocked' WHEN decision IS NULL THEN 'open' ELSE 'declined' END AS state FROM customer LEFT JOIN d ON c_custkey = k""")
def promotions(t: Tables) -> DataFrame:
    """Queued rows promoted where the decision is for them and nothing blocks them."""
    d = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("decision"))
    yes = F.col("decision") == "purchase"
    state = text.ladder((yes & (F.col("c_acctbal") > 0), "promoted"), (yes, "blocked"), (F.col("decision").isNull(), "open"), otherwise="declined")
    return t.customer.join(d, "c_custkey", "left").select("c_custkey", state.alias("state"))


_ITEMS = """concat('<ul><li>Town of ', s_name, '</li><li> City of ', s_name, ' </li><li>Town of ', s_name, '</li></ul>')"""


@query(f"""
WITH n AS (SELECT DISTINCT s_suppkey, trim(unnest(regexp_extract_all({_ITEMS}, '<li>([^<]*)</li>', 1))) AS name FROM supplier), k AS (SELECT 'town of ' || lower(s_name) AS name FROM supplier WHERE s_suppkey % 2 = 0)
SELECT s_suppkey, n.name, CASE WHEN k.name IS NULL THEN 'not_registered' ELSE 'registered' END AS status FROM n LEFT JOIN k ON lower(n.name) = k.name""")
def place_queue(t: Tables) -> DataFrame:
    """Places listed on a page, distinct, by whether the registry knows them."""
    page = t.supplier.select("s_suppkey", F.expr(_ITEMS).alias("page"))
    n = markup.page_records(page, "s_suppkey", "page", "li", ()).select("s_suppkey", F.col("text").alias("name"), F.lower("text").alias("k")).distinct()
    known = t.supplier.where("s_suppkey % 2 = 0").select(F.concat(F.lit("town of "), F.lower("s_name")).alias("k"), F.lit(True).alias("there"))
    return n.join(known, "k", "left").select("s_suppkey", "name", F.when(F.col("there"), "registered").otherwise("not_registered").alias("status"))


@query("""
WITH r AS (SELECT 'AUTH-' || lpad(n_nationkey::VARCHAR, 3, '0') AS id, n_name AS name, r_name AS parent, CASE WHEN n_nationkey < 5 THEN 'state' ELSE 'county' END AS level FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT parent, level, count(*)::BIGINT AS n, string_agg(id, '|' ORDER BY id) AS ids FROM r GROUP BY 1, 2""")
def authority_index(t: Tables) -> DataFrame:
    """Registry rows as authority records, indexed by parent and level."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    r = places.select(F.concat(F.lit("AUTH-"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("id"), F.col("r_name").alias("parent"), F.when(F.col("n_nationkey") < 5, "state").otherwise("county").alias("level"))
    return r.groupBy("parent", "level").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("id")), "|").alias("ids"))  # 25 names


@query("""
WITH u AS (SELECT o_custkey AS id, year(o_orderdate) AS year, 0 AS manual, o_orderkey AS k FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT user_id, 2000 + event_id % 25, 1, event_id FROM events), l AS (SELECT id, arg_max(year, (manual, k)) AS year, count(*)::BIGINT AS n FROM u GROUP BY id)
SELECT id, (year // 10 * 10)::BIGINT AS decade, n FROM l""")
def intake_union(t: Tables) -> DataFrame:
    """Manifest rows and manual intake together; the manual one, then the last, of each id; by decade."""
    listed = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"), F.year("o_orderdate").cast("long").alias("year"), F.lit(0).alias("manual"), F.col("o_orderkey").alias("k"))
    manual = t.events.select(F.col("user_id").alias("id"), (2000 + F.col("event_id") % 25).alias("year"), F.lit(1).alias("manual"), F.col("event_id").alias("k"))
    last = listed.unionByName(manual).groupBy("id").agg(F.max_by("year", F.struct("manual", "k")).alias("year"), F.count("*").alias("n"))
    return last.select("id", (F.floor(F.col("year") / 10) * 10).cast("long").alias("decade"), "n")


@query("""
WITH f AS (SELECT 'series' || page_id % 5 AS series, coalesce(nullif(regexp_extract(url, '\\.([a-z]{2,4})(?:[?#]|$)', 1), ''), 'none') AS format, length(html) AS size FROM pages) SELECT series, format, count(*)::BIGINT AS files, sum(size)::BIGINT AS chars FROM f GROUP BY 1, 2""")
def series_summary(t: Tables) -> DataFrame:
    """Files by series and format."""
    fmt = F.coalesce(F.nullif(F.regexp_extract("url", r"\.([a-z]{2,4})(?:[?#]|$)", 1), F.lit("")), F.lit("none"))
    f = t.pages.select(F.concat(F.lit("series"), (F.col("page_id") % 5).cast("string")).alias("series"), fmt.alias("format"), F.length("html").alias("size"))
    return f.groupBy("series", "format").agg(F.count("*").alias("files"), F.sum("size").alias("chars"))


_GOLD = {"answered": "n_chars > 100", "language": "lang IN ('en', 'de')", "safe": "coalesce(toxic, 0) = 0", "good": "coalesce(quality, 1) = 1"}


@query(f"""
WITH g AS (SELECT d.doc_id, {', '.join(f'{c} AS {n}' for n, c in _GOLD.items())} FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id), s AS (SELECT *, {' + '.join(f'{n}::INT' for n in _GOLD)} AS held FROM g)
SELECT held::BIGINT AS held, count(*)::BIGINT AS questions, count(*) FILTER (held = {len(_GOLD)})::BIGINT AS passed FROM s GROUP BY 1""")
def golden_scores(t: Tables) -> DataFrame:
    """Checks of every question of a test set, and how many hold."""
    g = t.documents.select("doc_id", "n_chars", "lang").join(t.labels, "doc_id", "left")
    held = sum((F.expr(c).cast("int") for c in _GOLD.values()), F.lit(0)).cast("long")
    return g.select(held.alias("held")).groupBy("held").agg(F.count("*").alias("questions"), F.count_if(F.col("held") == len(_GOLD)).alias("passed"))


@query("""
SELECT check_name, count(*)::BIGINT AS broken FROM (SELECT 'orphan_line' AS check_name FROM lineitem ANTI JOIN orders ON l_orderkey = o_orderkey UNION ALL SELECT 'empty_order' FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey UNION ALL SELECT 'unknown_user' FROM events ANTI JOIN customer ON user_id = c_custkey
 UNION ALL SELECT 'repeated_line' FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)) GROUP BY 1""")
def stress_invariants(t: Tables) -> DataFrame:
    """What should never be, counted by check."""
    alone = lambda n, other: F.sum(F.when(F.col("key").isNull() | (F.col(other) == 0), F.col(n)))
    lines = joins.sides(t.lineitem.select("l_orderkey"), t.orders.select("o_orderkey")).agg(alone("n_left", "n_right").alias("orphan_line"), alone("n_right", "n_left").alias("empty_order"))
    users = joins.sides(t.events.select("user_id"), t.customer.select("c_custkey")).agg(alone("n_left", "n_right").alias("unknown_user"))
    numbers = dealt(t.lineitem.select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber").groupBy("l_orderkey", "l_linenumber").count()
    repeated = numbers.where("count > 1").agg(F.count("*").alias("repeated_line"))
    named = lambda df: df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("check_name"), F.col(c).alias("broken")) for c in df.columns))).alias("r")).select("r.*")
    return named(lines).unionByName(named(users)).unionByName(named(repeated)).where("broken > 0")


# ---- stores and budgets -----------------------------------------------------


@query("""
WITH v AS (SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS value, max(ts) AS put FROM events GROUP BY 1, 2), now AS (SELECT max(ts) AS t FROM events)
SELECT user_id, event_type, value, CASE WHEN user_id % 7 = 0 THEN 'stale' WHEN put + INTERVAL 7 DAY <= now.t THEN 'expired' ELSE 'hit' END AS state FROM v, now""")
def ttl_store(t: Tables) -> DataFrame:
    """The last value put under each key, and what a reader gets: a hit, or why not (old version, or past its seven days)."""
    v = t.events.groupBy("user_id", "event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("value"), F.max("ts").alias("put"))
    now = t.events.agg(F.max("ts").alias("now"))
    state = text.ladder((F.col("user_id") % 7 == 0, "stale"), (F.col("put") + F.expr("INTERVAL 7 DAYS") <= F.col("now"), "expired"), otherwise="hit")
    return v.crossJoin(F.broadcast(now)).select("user_id", "event_type", "value", state.alias("state"))  # one row


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT AS cost, l_returnflag = 'R' AS must FROM lineitem), m AS (SELECT *, sum(CASE WHEN must THEN cost ELSE 0 END) OVER (PARTITION BY l_orderkey) AS fixed,
 sum(CASE WHEN must THEN 0 ELSE cost END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, must OR fixed + run <= 80 AS kept FROM m""")
def evict_overflow(t: Tables) -> DataFrame:
    """Items of a request dropped from the last until it fits a budget of 80; what must be stays."""
    must = F.col("l_returnflag") == "R"
    cost = F.col("l_quantity").cast("long")
    whole = Window.partitionBy("l_orderkey")  # the items of one request
    run = F.sum(F.when(must, 0).otherwise(cost)).over(whole.orderBy("l_linenumber", "l_partkey", "l_suppkey").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fixed = F.sum(F.when(must, cost).otherwise(0)).over(whole)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (must | (fixed + run <= 80)).alias("kept"))


# ---- building corpora -------------------------------------------------------

_TABLE = """concat('<h2>Proposed</h2><table><tr><td>', s_suppkey % 12 + 1, ' CCR 201-', s_suppkey, '</td><td>Rule of ', s_name, '</td><td>3/', s_suppkey % 28 + 1, '/2024</td></tr><tr><td>x</td></tr></table><h2>Adopted</h2><table><tr><td>', s_suppkey % 9 + 1, ' CCR 301-', s_suppkey, '</td><td>Other</td><td>4/1/2024</td></tr></table>')"""


@query(f"""
WITH b AS (SELECT s_suppkey, unnest(string_split({_TABLE}, '<h2>')[2:]) AS block FROM supplier), r AS (SELECT s_suppkey, regexp_extract(block, '^([^<]*)', 1) AS kind, unnest(regexp_extract_all(block, '<tr>(.*?)</tr>', 1)) AS row FROM b), c AS (SELECT s_suppkey, kind, regexp_extract_all(row, '<td>([^<]*)</td>', 1) AS c FROM r)
SELECT s_suppkey, kind, replace(c[1], ' ', '_') AS rule, c[2] AS title, CASE WHEN kind = 'Proposed' THEN c[3] END AS hearing, CASE WHEN kind = 'Adopted' THEN c[3] END AS effective FROM c WHERE len(c) >= 3 AND regexp_matches(c[1], '^\\d+ CCR ')""")
def register_table(t: Tables) -> DataFrame:
    """Rows of three cells with a citation as notices under the heading above them; the date goes by the kind of notice."""
    page = t.supplier.select("s_suppkey", F.expr(_TABLE).alias("page"))
    c = markup.page_records(page, "s_suppkey", "page").select("s_suppkey", F.col("heading").alias("kind"), F.col("fields.text").alias("c"))
    c = c.where((F.size("c") >= 3) & F.get("c", F.lit(0)).rlike(r"^\d+ CCR "))
    cell = lambda k: F.get("c", F.lit(k))
    day = lambda kind: F.when(F.col("kind") == kind, cell(2))
    return c.select("s_suppkey", "kind", F.replace(cell(0), F.lit(" "), F.lit("_")).alias("rule"), cell(1).alias("title"), day("Proposed").alias("hearing"), day("Adopted").alias("effective"))


_INDEX = """concat('WATER, ', 10 + s_suppkey, '-1-101, ', 10 + s_suppkey, '-2-5\nsee also AIR\nAIR, 25-', s_suppkey, '-7\nFREE TEXT')"""


@query(f"""
WITH l AS (SELECT s_suppkey, unnest(string_split({_INDEX}, chr(10))) AS line FROM supplier)
SELECT s_suppkey, trim(regexp_extract(line, '^([A-Z ]+)', 1)) AS heading, array_to_string(regexp_extract_all(line, '\\d+-\\d+-\\d+'), '|') AS citations, nullif(regexp_extract(line, '^see also (.+)$', 1), '') AS see_also FROM l""")
def subject_index(t: Tables) -> DataFrame:
    """Lines of a subject index: heading, citations and cross references."""
    lines = t.supplier.select("s_suppkey", F.explode(F.split(F.expr(_INDEX), "\n")).alias("line"))
    cites = F.array_join(F.regexp_extract_all("line", F.lit(r"\d+-\d+-\d+"), F.lit(0)), "|")
    return lines.select("s_suppkey", F.trim(F.regexp_extract("line", "^([A-Z ]+)", 1)).alias("heading"), cites.alias("citations"), F.nullif(F.regexp_extract("line", "^see also (.+)$", 1), F.lit("")).alias("see_also"))


_SGML = """concat('<TITLE>', s_suppkey, '<SECTION ID="', s_suppkey, '-1-1"><HEAD>First</HEAD><P>Text of ', s_name, '</P></SECTION><SECTION ID="', s_suppkey, '-1-2"><HEAD>Second</HEAD><P>One</P><P>Two</P></SECTION>')"""


@query(f"""
WITH s AS (SELECT unnest(regexp_extract_all({_SGML}, '<SECTION (.*?)</SECTION>', 1)) AS s FROM supplier)
SELECT 'CRS-' || regexp_extract(s, 'ID="([^"]+)"', 1) AS id, regexp_extract(s, '<HEAD>([^<]*)</HEAD>', 1) AS heading, array_to_string(regexp_extract_all(s, '<P>([^<]*)</P>', 1), chr(10)) AS body FROM s""")
def sgml_sections(t: Tables) -> DataFrame:
    """Sections of tagged titles as records."""
    title = t.supplier.select("s_suppkey", F.expr(_SGML).alias("page"))
    s = markup.page_records(title, "s_suppkey", "page", "section", ("head", "p"))
    of = lambda name: F.transform(F.filter("fields", lambda f: f["name"] == name), lambda f: f["text"])
    return s.select(F.concat(F.lit("CRS-"), F.col("attributes")["id"]).alias("id"), F.array_join(of("head"), " ").alias("heading"), F.array_join(of("p"), "\n").alias("body"))


MARKDOWN = outline.Shape(tuple((f"h{k}", rf"^{'#' * k} (.*)") for k in (1, 2, 3)))
_HEADED = """concat('# Rules\nIntro\n## Part ', p_size, '\n### Fees\nPay ', p_partkey, '\nSoon\n## Part B\nEnd of ', p_brand)"""


@query(f"""
WITH l AS (SELECT p_partkey, string_split({_HEADED}, chr(10)) AS s FROM part), r AS (SELECT p_partkey, i, s[i] AS line, s FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM l)),
 h AS (SELECT *, list_max(list_filter(range(1, i + 1), lambda j: regexp_matches(s[j], '^# '))) AS a, list_max(list_filter(range(1, i + 1), lambda j: regexp_matches(s[j], '^## '))) AS b, list_max(list_filter(range(1, i + 1), lambda j: regexp_matches(s[j], '^### '))) AS c FROM r),
 p AS (SELECT p_partkey, i, line, concat_ws(' > ', substring(s[a], 3), CASE WHEN b > a THEN substring(s[b], 4) END, CASE WHEN c > b THEN substring(s[c], 5) END) AS path FROM h WHERE NOT regexp_matches(line, '^#'))
SELECT p_partkey, path, string_agg(line, chr(10) ORDER BY i) AS body, min(i) - 1 AS first_line FROM p GROUP BY 1, 2""")
def heading_chunks(t: Tables) -> DataFrame:
    """Texts by their headings, with the path of headings above each; headings without text give none."""
    texts = t.part.select("p_partkey", F.expr(_HEADED).alias("x"))
    found = outline.outline(texts, "p_partkey", "x", MARKDOWN).where("n_lines > 0")
    return found.select("p_partkey", F.array_join("path", " > ").alias("path"), "body", (F.col("first_line") - 1).alias("first_line"))


#: Parts, numbered sections and lettered subsections.
PARTS = outline.Shape((("part", r"^PART (.*)"), ("section", r"^(\d+[.]\d+) "), ("subsection", r"^\(([a-z])\) ")))
_PARTED = """concat('PART A\n1.1 Scope of ', p_brand, '\n(a) first\n(b) second\nPART B\n2.1 Fees\n(a) pay ', p_size)"""


@query(f"""
WITH l AS (SELECT p_partkey, string_split({_PARTED}, chr(10)) AS s FROM part), r AS (SELECT p_partkey, i, s[i] AS line, list_filter(s[1:i], lambda x: starts_with(x, 'PART '))[-1] AS part, list_filter(s[1:i], lambda x: regexp_matches(x, '^\\d+[.]\\d+ '))[-1] AS section FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM l))
SELECT p_partkey, substring(part, 6) AS part, regexp_extract(section, '^(\\d+[.]\\d+)', 1) AS section, regexp_extract(line, '^\\(([a-z])\\)', 1) AS subsection, regexp_extract(line, '^\\([a-z]\\) (.*)$', 1) AS body, i - 1 AS line FROM r WHERE regexp_matches(line, '^\\([a-z]\\) ')""")
def structure_tree(t: Tables) -> DataFrame:
    """Subsections with the section and part they stand in, and their lines."""
    texts = t.part.select("p_partkey", F.expr(_PARTED).alias("x"))
    rows = outline.outline(texts, "p_partkey", "x", PARTS).where("level = 3")
    label = lambda name: F.col("labels")[name].alias(name)
    return rows.select("p_partkey", label("part"), label("section"), label("subsection"), F.regexp_extract("opened", r"^\([a-z]\) (.*)$", 1).alias("body"), (F.col("opened_line") - 1).alias("line"))


@query(f"""
WITH l AS (SELECT p_partkey, string_split({_PARTED}, chr(10)) AS s FROM part), r AS (SELECT p_partkey, i, s[i] AS line FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM l)), m AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^(PART |\\d+[.]\\d+ )') THEN 1 ELSE 0 END) OVER (PARTITION BY p_partkey ORDER BY i) AS block FROM r)
SELECT p_partkey, block::BIGINT AS block, string_agg(line, ' ' ORDER BY i) AS body, min(i) AS first, max(i) AS last FROM m GROUP BY 1, 2""")
def source_blocks(t: Tables) -> DataFrame:
    """Paragraphs under each heading as one block with its span of lines."""
    texts = t.part.select("p_partkey", F.expr(_PARTED).alias("x"))
    found = outline.outline(texts, "p_partkey", "x", outline.Shape((("heading", r"^(?:PART |\d+[.]\d+ )"),), joint=" "))
    body = F.concat_ws(" ", "opened", F.when(F.col("n_lines") > 0, F.col("body")))
    return found.select("p_partkey", "block", body.alias("body"), F.coalesce("opened_line", "first_line").alias("first"), F.col("last_line").alias("last"))


_SHORT = 40


@query(f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents), r AS (SELECT doc_id, s[i] AS line, i, length(s[i]) BETWEEN 1 AND {_SHORT} AS head FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM l)),
 b AS (SELECT *, count(*) FILTER (head) OVER (PARTITION BY doc_id ORDER BY i) AS block FROM r)
SELECT doc_id, block::BIGINT AS block, trim(max(line) FILTER (head), ' ') AS heading, count(*) FILTER (NOT head)::BIGINT AS n_lines, string_agg(line, chr(10) ORDER BY i) FILTER (NOT head) AS body FROM b GROUP BY 1, 2""")
def document_outline(t: Tables) -> DataFrame:
    """Documents by their short lines, taken as headings, with the lines under each."""
    found = outline.outline(t.documents, "doc_id", "text", outline.Shape((("title", rf"^(.{{1,{_SHORT}}})\Z"),)))
    return found.select("doc_id", "block", "heading", "n_lines", F.when(F.col("n_lines") > 0, F.col("body")).alias("body"))


def _read(x: str) -> str:
    """SQL of a text with the references that stand in the pages replaced, and white space collapsed."""
    for name, sign in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{sign}')"
    return f"trim(regexp_replace({x}, '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ')"


_TAGS = "regexp_replace(regexp_replace({}, '<[^>]*>', ' ', 'g'), '<[a-zA-Z/!][^>]*$', ' ')"


@query(f"""
WITH p AS (SELECT page_id, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS h, string_split(regexp_extract(html, '(?s)</h1>(.*)$', 1), '<p>') AS s FROM pages), b AS (SELECT page_id, h, i, regexp_replace(s[i], '(?s)</(p|article|body)>.*$', '') AS x FROM (SELECT *, unnest(range(2, len(s) + 1)) AS i FROM p))
SELECT page_id, i - 2 AS place, {_read('h')} AS heading, {_read(_TAGS.format('x'))} AS text FROM b""")
def page_paragraphs(t: Tables) -> DataFrame:
    """Paragraphs of real pages under their heading; one ends where it is closed, at the next one or with what is around it."""
    return markup.page_records(t.pages, "page_id", "html", "p", ()).select("page_id", "place", "heading", "text")


@query(f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS x FROM pages)
SELECT page_id, i - 1 AS place, {_read('h[i]')} AS href, {_read('x[i]')} AS text FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM l)""")
def page_anchors(t: Tables) -> DataFrame:
    """Every anchor of real pages with its target and text."""
    return markup.page_anchors(t.pages, "page_id", "html")


@query(rf"""SELECT page_id, {_read(_TAGS.format("regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<!--.*$', ' ', 'g')"))} AS visible FROM pages""")
def page_text(t: Tables) -> DataFrame:
    """Visible text of real pages with character references read."""
    return markup.page_text(t.pages, "page_id", "html")
