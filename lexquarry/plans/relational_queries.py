"""Queries over the relational tables: joins, reconciliation, reports, ranking, set operations, graphs, events and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.dealing import dealt
from lexquarry.functions import scoring, text
from lexquarry.operators import graph, joins, ranking, reports
from lexquarry.plans.registry import Tables, query

AS_OF = "2026-01-01"


def _day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


# ---- joins -----------------------------------------------------------------

_ALIAS_SQL = "trim(regexp_replace(regexp_replace(lower({}), '[.,_\\-]', ' ', 'g'), '[ \\t\\n\\r\\f]+', ' ', 'g'))"


@query(f"""
WITH a AS (SELECT {_ALIAS_SQL.format('p_name')} AS alias, 0 AS pr, 'part' AS kind, p_partkey AS id FROM part
           UNION ALL SELECT {_ALIAS_SQL.format('s_name')}, 1, 'supplier', s_suppkey FROM supplier
           UNION ALL SELECT {_ALIAS_SQL.format('c_name')}, 2, 'customer', c_custkey FROM customer)
SELECT alias, arg_min(kind, (pr, id)) AS kind, arg_min(id, (pr, id)) AS id, count(DISTINCT kind || ':' || id)::BIGINT AS n_entities FROM a GROUP BY alias""")
def alias_resolve(t: Tables) -> DataFrame:
    named = [(t.part, "p_name", "part", "p_partkey"), (t.supplier, "s_name", "supplier", "s_suppkey"), (t.customer, "c_name", "customer", "c_custkey")]
    parts = [d.select(text.normalize_alias(n).alias("alias"), F.lit(i).alias("priority"), F.lit(k).alias("kind"), F.col(key).alias("id")) for i, (d, n, k, key) in enumerate(named)]
    return joins.resolve_aliases(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("""
WITH l AS (SELECT *, row_number() OVER () AS place FROM lineitem),
     m AS (SELECT l_orderkey AS k, arg_max(l_linestatus, (l_shipdate, l_linenumber, -place)) AS status, count(*)::BIGINT AS n_lines FROM l WHERE l_shipdate >= DATE '1995-06-01' GROUP BY 1),
     q AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS priority FROM orders WHERE o_totalprice > 100000)
SELECT coalesce(q.k, m.k) AS record_id, coalesce(q.status, m.status) AS status, priority, n_lines FROM q FULL JOIN m ON q.k = m.k""")
def queue_manifest_full_outer(t: Tables) -> DataFrame:
    """Large orders beside the lines since June 1995, whose status is that of the latest; ``place`` is a line's place in the table."""
    lines = t.lineitem.where("l_shipdate >= DATE'1995-06-01'").select("*", "_metadata.file_path", "_metadata.row_index")
    # of lines of the latest day and number, the first in the table; lines without a status give none
    latest = F.struct(-F.unix_micros(F.col("l_shipdate").cast("timestamp")), -F.col("l_linenumber"), "file_path", "row_index")
    status = F.min_by("l_linestatus", F.when(F.col("l_linestatus").isNotNull(), latest))
    manifest = lines.groupBy(F.col("l_orderkey").alias("record_id")).agg(status.alias("status"), F.count("*").alias("n_lines"))
    queue = t.orders.where("o_totalprice > 100000").select(F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return joins.merged(queue, manifest, "record_id")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def orphan_anti(t: Tables) -> DataFrame:
    large = t.orders.where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(large, "c_custkey", "left_anti").select("c_custkey", "c_mktsegment")


@query("SELECT user_id, count(*)::BIGINT AS n FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') GROUP BY user_id")
def dead_reference_anti(t: Tables) -> DataFrame:
    known = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("user_id"))
    return t.events.groupBy("user_id").agg(F.count("*").alias("n")).join(known, "user_id", "left_anti")


@query("SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)")
def visible_semi(t: Tables) -> DataFrame:
    seen = t.lineitem.where("l_quantity >= 45").select(F.col("l_partkey").alias("p_partkey"))
    return t.part.join(seen, "p_partkey", "left_semi").select("p_partkey", "p_brand")


@query("""
SELECT n_name, l_partkey, count(*)::BIGINT AS n, least(round(max(l_discount) * 10, 4), 0.68::DOUBLE) AS confidence
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name, l_partkey""")
def agency_derivation_join(t: Tables) -> DataFrame:
    n = t.lineitem.count()
    per_supplier = dealt(t.lineitem.select("l_suppkey", "l_partkey", "l_discount"), "l_suppkey", "l_partkey", rows=n).groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"), F.max("l_discount").alias("d"))  # before the join
    placed = per_supplier.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")), "l_suppkey").join(t.nation.select("n_nationkey", "n_name"), "n_nationkey")
    return dealt(placed.select("n_name", "l_partkey", "n", "d"), "l_partkey", rows=n).groupBy("n_name", "l_partkey").agg(F.sum("n").alias("n"), F.least(F.round(F.max("d") * 10, 4), F.lit(0.68)).alias("confidence"))


@query("SELECT o_orderkey, o_custkey, coalesce(c_mktsegment, 'unknown') AS segment, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def history_left_join(t: Tables) -> DataFrame:
    segments = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t.orders.join(segments, "o_custkey", "left").select("o_orderkey", "o_custkey", F.coalesce("c_mktsegment", F.lit("unknown")).alias("segment"), _day("o_orderdate").alias("day"))


@query("""
SELECT e.event_id, e.user_id, arg_max(o.o_orderkey, (o.o_orderdate, o.o_orderkey)) AS o_orderkey
FROM events e LEFT JOIN orders o ON o.o_custkey = e.user_id AND o.o_orderdate <= e.ts GROUP BY e.event_id, e.user_id""")
def version_asof_match(t: Tables) -> DataFrame:
    """Each event with its user's last order up to then."""
    left = t.events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("at"))
    right = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("timestamp").alias("at"), "o_orderkey")
    return joins.as_of(left, right, "user_id", "at", "o_orderkey").select("event_id", "user_id", "o_orderkey")


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate AS a, o_orderdate + INTERVAL 20 DAY AS b FROM orders)
SELECT x.o_custkey, x.o_orderkey AS first_order, y.o_orderkey AS second_order FROM o x JOIN o y ON x.o_custkey = y.o_custkey AND x.o_orderkey < y.o_orderkey AND x.a < y.b AND y.a < x.b""")
def overlapping_orders(t: Tables) -> DataFrame:
    """Orders of a customer whose first twenty days overlap."""
    spans = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("a"), (F.col("o_orderdate") + F.expr("INTERVAL 20 DAYS")).alias("b"))
    pairs = joins.overlaps(spans, spans, ["o_custkey"], "a", "b", 20 * 86400)
    return pairs.where("o_orderkey < o_orderkey_right").select("o_custkey", F.col("o_orderkey").alias("first_order"), F.col("o_orderkey_right").alias("second_order"))


@query("""
WITH o AS (SELECT o_custkey AS k, count(*)::BIGINT AS orders FROM orders GROUP BY 1), e AS (SELECT user_id AS k, count(*)::BIGINT AS events FROM events GROUP BY 1),
     j AS (SELECT coalesce(c.c_custkey, o.k, e.k) AS k, c.c_custkey IS NOT NULL AS known, coalesce(orders, 0) AS orders, coalesce(events, 0) AS events
           FROM customer c FULL JOIN o ON c.c_custkey = o.k FULL JOIN e ON coalesce(c.c_custkey, o.k) = e.k)
SELECT k, known, orders, events, CASE WHEN known AND orders > 0 AND events > 0 THEN 0.98 WHEN known AND orders > 0 THEN 0.93 WHEN known AND events > 0 THEN 0.84 WHEN known THEN 0.0 ELSE 0.70 END::DOUBLE AS confidence FROM j""")
def three_way_reconcile(t: Tables) -> DataFrame:
    c = t.customer.select(F.col("c_custkey").alias("k"), F.lit(True).alias("known"))
    o = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    e = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("events"))
    rows = c.join(o, "k", "full_outer").join(e, "k", "full_outer").fillna(0, ["orders", "events"]).withColumn("known", F.coalesce("known", F.lit(False)))
    k, some, seen = F.col("known"), F.col("orders") > 0, F.col("events") > 0
    return rows.withColumn("confidence", text.ladder((k & some & seen, 0.98), (k & some, 0.93), (k & seen, 0.84), (k, 0.0), otherwise=0.70).cast("double"))


@query("""
SELECT l_orderkey, l_linenumber, b.bucket FROM lineitem JOIN (VALUES ('small', 0.0, 10.0), ('medium', 10.0, 30.0), ('large', 30.0, 1000.0)) b(bucket, low, high)
ON l_quantity >= b.low AND l_quantity < b.high""")
def range_join(t: Tables) -> DataFrame:
    bands = t.spark.createDataFrame([("small", 0.0, 10.0), ("medium", 10.0, 30.0), ("large", 30.0, 1000.0)], "bucket string, low double, high double")
    return t.lineitem.join(F.broadcast(bands), (F.col("l_quantity") >= F.col("low")) & (F.col("l_quantity") < F.col("high"))).select("l_orderkey", "l_linenumber", "bucket")  # 3 rows


@query("SELECT n_name, c_mktsegment, 'not_started' AS status FROM nation, (SELECT DISTINCT c_mktsegment FROM customer)")
def matrix_cross_join(t: Tables) -> DataFrame:
    """The status matrix of two small dimensions (nations and segments)."""
    segments = t.customer.select("c_mktsegment").distinct()
    return t.nation.select("n_name").crossJoin(segments).withColumn("status", F.lit("not_started"))


# ---- reports ---------------------------------------------------------------


@query("""
WITH b AS (SELECT l_returnflag, l_orderkey, l_partkey, l_linestatus, count(*) AS n, sum(l_discount) AS total, count(*) FILTER (l_discount < 0.05) AS low FROM lineitem GROUP BY 1, 2, 3, 4),
     k AS (SELECT l_returnflag, arg_min(l_linestatus, (-m, l_linestatus)) AS modal_kind FROM (SELECT l_returnflag, l_linestatus, sum(n) AS m FROM b GROUP BY ALL) GROUP BY 1)
SELECT b.l_returnflag, sum(n)::BIGINT AS rows, count(DISTINCT l_orderkey)::BIGINT AS sources, count(DISTINCT l_partkey)::BIGINT AS targets, sum(low)::BIGINT AS low_confidence,
       sum(n - 1)::BIGINT AS duplicates, round(sum(total) / sum(n), 4) AS mean_confidence, any_value(modal_kind) AS modal_kind,
       CASE WHEN sum(low) / sum(n) >= 0.5 THEN 'needs_review' WHEN sum(low) > 0 THEN 'usable_with_warnings' ELSE 'usable' END AS label
FROM b JOIN k ON b.l_returnflag = k.l_returnflag GROUP BY b.l_returnflag""")
def coverage_report(t: Tables) -> DataFrame:
    return reports.edge_coverage(t.lineitem, "l_returnflag", "l_orderkey", "l_partkey", "l_discount", "l_linestatus")


@query("""
SELECT l_orderkey, l_linenumber, round((2 * least(l_discount * 10, 1) + least(l_tax * 10, 1) + least(l_quantity / 50, 1)) / 4, 4) AS confidence FROM lineitem""")
def weighted_confidence(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("a"), (F.col("l_tax") * 10).alias("b"), (F.col("l_quantity") / 50).alias("c"))
    return rows.select("l_orderkey", "l_linenumber", F.round(scoring.weighted_mean({"a": 2, "b": 1, "c": 1}), 4).alias("confidence"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND s < 0.1 THEN 'reject' WHEN s >= 0.85 THEN 'auto_accept' WHEN s >= 0.6 THEN 'accept_flagged' ELSE 'quarantine' END AS route,
       CASE WHEN s >= 0.85 THEN 'high' WHEN s >= 0.75 THEN 'medium' ELSE 'low' END AS bucket
FROM (SELECT *, least(o_totalprice / 400000, 1) AS s FROM orders)""")
def route_confidence(t: Tables) -> DataFrame:
    s = scoring.clamp(F.col("o_totalprice") / 400000)
    return t.orders.select("o_orderkey", scoring.route(s, (F.col("o_orderstatus") == "F") & (s < 0.1)).alias("route"), scoring.confidence_bucket(s).alias("bucket"))


@query("""
SELECT l_returnflag, CASE max(CASE WHEN l_discount > 0.09 THEN 2 WHEN l_tax > 0.07 THEN 1 ELSE 0 END) WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS status,
       count(*) FILTER (l_discount > 0.09)::BIGINT AS n_fail FROM lineitem GROUP BY l_returnflag""")
def severity_counts(t: Tables) -> DataFrame:
    code = text.ladder((F.col("l_discount") > 0.09, 2), (F.col("l_tax") > 0.07, 1), otherwise=0)
    return t.lineitem.groupBy("l_returnflag").agg(scoring.worst_status(code).alias("status"), F.count_if(F.col("l_discount") > 0.09).alias("n_fail"))


@query("""
SELECT o_orderkey AS key, unnest(list_filter([CASE WHEN o_totalprice <= 1000 THEN 'price_too_low' END, CASE WHEN o_orderdate > TIMESTAMP '1998-06-01' THEN 'future_date' END,
       CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'unknown_status' END, CASE WHEN length(trim(o_orderpriority)) = 0 THEN 'blank_priority' END], lambda x: x IS NOT NULL)) AS issue FROM orders""")
def constraint_issues(t: Tables) -> DataFrame:
    checks = {
        "price_too_low": F.col("o_totalprice") <= 1000,
        "future_date": F.col("o_orderdate") > F.lit("1998-06-01").cast("timestamp"),
        "unknown_status": ~F.col("o_orderstatus").isin("F", "O"),
        "blank_priority": ~text.populated("o_orderpriority"),
    }
    return reports.issues(t.orders.withColumnRenamed("o_orderkey", "key"), "key", checks)


@query(f"""
SELECT o_orderpriority, CASE WHEN a > 180 THEN 'stale' WHEN a > 90 THEN 'watch' ELSE 'fresh' END AS status, count(*)::BIGINT AS n
FROM (SELECT o_orderpriority, date_diff('day', max(o_orderdate)::DATE, DATE '{AS_OF}') AS a, o_custkey FROM orders GROUP BY o_orderpriority, o_custkey) GROUP BY 1, 2""")
def freshness_buckets(t: Tables) -> DataFrame:
    last = t.orders.groupBy("o_orderpriority", "o_custkey").agg(F.max("o_orderdate").alias("d"))
    age = F.datediff(F.lit(AS_OF).cast("date"), F.col("d").cast("date"))
    return last.groupBy("o_orderpriority", scoring.freshness(age, 90, 180).alias("status")).agg(F.count("*").alias("n"))


# ---- ranking ---------------------------------------------------------------


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def latest_event(t: Tables) -> DataFrame:
    return ranking.latest(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id").drop("ts")


@query("""
SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_event_type, arg_max(event_type, (ts, event_id)) AS latest_event_type, count(*)::BIGINT AS n FROM events GROUP BY user_id""")
def first_and_latest(t: Tables) -> DataFrame:
    return ranking.first_and_latest(t.events, "user_id", "event_type", "ts", "event_id")


@query("""
WITH s AS (SELECT l_partkey, count(*)::BIGINT AS score FROM lineitem GROUP BY 1 ORDER BY score DESC, l_partkey LIMIT 20),
     r AS (SELECT *, row_number() OVER (ORDER BY score DESC, l_partkey) AS rank, count(*) OVER () AS n FROM s)
SELECT l_partkey, score, rank, CASE WHEN rank <= ceil(n * 0.2) THEN 'high' WHEN rank <= ceil(n * 0.6) THEN 'medium' ELSE 'low' END AS bucket FROM r""")
def relevance_buckets(t: Tables) -> DataFrame:
    return ranking.relevance_buckets(t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("score")), "score", "l_partkey")


@query("""
WITH r AS (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rank, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT o_orderpriority, o_orderkey, rank FROM r WHERE (rank - 1) % greatest(1, n // 25) = 0 AND (rank - 1) / greatest(1, n // 25) < 25""")
def stride_sample(t: Tables) -> DataFrame:
    return ranking.stride_sample(t.orders.select("o_orderpriority", "o_orderkey"), "o_orderpriority", "o_orderkey", 25)


# ---- sets, grouping sets, windows -------------------------------------------


@query("""
SELECT 'order' AS family, o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders UNION ALL SELECT 'event', event_id, strftime(ts, '%Y-%m-%d') FROM events
UNION ALL SELECT 'shipment', l_orderkey * 8 + l_linenumber, strftime(l_shipdate, '%Y-%m-%d') FROM lineitem""")
def ledger_union(t: Tables) -> DataFrame:
    shipped = t.lineitem.select(F.lit("shipment").alias("family"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), _day("l_shipdate").alias("day"))
    rows = t.orders.select(F.lit("order").alias("family"), F.col("o_orderkey").alias("id"), _day("o_orderdate").alias("day"))
    return rows.unionByName(t.events.select(F.lit("event").alias("family"), F.col("event_id").alias("id"), _day("ts").alias("day"))).unionByName(shipped)


@query("""
(SELECT 'only_orders' AS side, k FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT user_id FROM events))
UNION ALL (SELECT 'both', k FROM (SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events))""")
def set_algebra(t: Tables) -> DataFrame:
    a, b = t.orders.select(F.col("o_custkey").alias("k")), t.events.select(F.col("user_id").alias("k"))
    return a.subtract(b).select(F.lit("only_orders").alias("side"), "k").unionByName(a.intersect(b).select(F.lit("both").alias("side"), "k"))


_SALES = "FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem) GROUP BY"


def _sales(t: Tables) -> DataFrame:
    return t.lineitem.withColumn("cents", F.round(F.col("l_extendedprice") * 100).cast("long"))


@query(f"SELECT l_returnflag, l_linestatus, sum(cents)::BIGINT AS cents, count(*)::BIGINT AS n {_SALES} ROLLUP (l_returnflag, l_linestatus)")
def rollup_sales(t: Tables) -> DataFrame:
    return _sales(t).rollup("l_returnflag", "l_linestatus").agg(F.sum("cents").alias("cents"), F.count("*").alias("n"))


@query(f"SELECT l_returnflag, l_linestatus, sum(cents)::BIGINT AS cents, count(*)::BIGINT AS n {_SALES} CUBE (l_returnflag, l_linestatus)")
def cube_sales(t: Tables) -> DataFrame:
    return _sales(t).cube("l_returnflag", "l_linestatus").agg(F.sum("cents").alias("cents"), F.count("*").alias("n"))


@query(f"SELECT l_returnflag, l_linestatus, sum(cents)::BIGINT AS cents {_SALES} GROUPING SETS ((l_returnflag), (l_linestatus))")
def grouping_sets(t: Tables) -> DataFrame:
    return _sales(t).groupingSets([["l_returnflag"], ["l_linestatus"]], "l_returnflag", "l_linestatus").agg(F.sum("cents").alias("cents"))


@query("""
SELECT event_id, user_id, sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS running_cents FROM events""")
def running_total(t: Tables) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.events.select("event_id", "user_id", F.sum(F.round(F.col("value") * 100).cast("long")).over(order).alias("running_cents"))


@query("""
SELECT event_id, lag(event_type) OVER w AS before, lead(event_type) OVER w AS after FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def lag_lead(t: Tables) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select("event_id", F.lag("event_type").over(order).alias("before"), F.lead("event_type").over(order).alias("after"))


@query("SELECT user_id, count(DISTINCT event_type)::BIGINT AS kinds, count(DISTINCT strftime(ts, '%Y-%m-%d'))::BIGINT AS days FROM events GROUP BY user_id")
def distinct_counts(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.count_distinct("event_type").alias("kinds"), F.count_distinct(_day("ts")).alias("days"))


# ---- events ----------------------------------------------------------------


@query("""
SELECT user_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, count(*)::BIGINT AS n, count(*) > 2 AS limited FROM events GROUP BY 1, 2""")
def minute_rate(t: Tables) -> DataFrame:
    from lexquarry.streaming.events import rate_per_minute

    found = rate_per_minute(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", 2)
    return found.select("user_id", F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"), "n", "limited")


@query("""
WITH g AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
     s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, count(*)::BIGINT AS n FROM s GROUP BY user_id, s""")
def session_gap(t: Tables) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    gap = F.coalesce((at - F.lag(at).over(order)) > 30 * 60 * 1_000_000, F.lit(True)).cast("int")
    marked = t.events.select("user_id", "ts", "event_id", gap.alias("fresh"))
    s = F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = marked.withColumn("s", s).groupBy("user_id", "s").agg(F.min("ts").alias("started"), F.count("*").alias("n"))
    return found.select("user_id", F.date_format("started", "yyyy-MM-dd HH:mm:ss").alias("started"), "n")


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*)::BIGINT AS n FROM events GROUP BY 1, 2")
def json_props(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type", F.get_json_object("props", "$.k").try_cast("long").alias("k")).agg(F.count("*").alias("n"))


# ---- graph -----------------------------------------------------------------


def _supplied(t: Tables) -> DataFrame:
    """Suppliers by their parts."""
    return t.lineitem.select("l_suppkey", "l_partkey")


_EDGES_SQL = """m AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS k FROM lineitem),
  e AS (SELECT a.s AS src, b.s AS dst, count(*)::BIGINT AS weight FROM m a JOIN m b ON a.k = b.k AND a.s < b.s GROUP BY ALL)"""


@query(f"WITH {_EDGES_SQL} SELECT src, dst, weight FROM e")
def shared_key_graph(t: Tables) -> DataFrame:
    return graph.shared_key_edges(_supplied(t), "l_suppkey", "l_partkey")


@query(f"""
WITH {_EDGES_SQL}, b AS (SELECT src AS node, dst AS other, weight FROM e UNION ALL SELECT dst, src, weight FROM e)
SELECT node, count(*)::BIGINT AS n_edges, sum(weight)::BIGINT AS total_weight, arg_min(other, (-weight, other)) AS heaviest FROM b GROUP BY node""")
def graph_neighbors(t: Tables) -> DataFrame:
    return graph.shared_key_neighbours(_supplied(t), "l_suppkey", "l_partkey")


@query()
def graph_components(t: Tables) -> DataFrame:
    """Components of customers and the parts they bought (too much for recursive SQL; tested against union-find)."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_partkey") + 1_000_000_000).alias("dst"))
    links = t.orders.select("o_orderkey", F.col("o_custkey").alias("src")).join(lines, "o_orderkey").select("src", "dst").distinct()
    return graph.connected_components(links)


@query(f"""
WITH {_EDGES_SQL}, b AS (SELECT src AS a, dst AS b FROM e UNION ALL SELECT dst, src FROM e), h1 AS (SELECT b AS node FROM b WHERE a = 1), h2 AS (SELECT b.b AS node FROM h1 JOIN b ON h1.node = b.a)
SELECT 1::BIGINT AS start, node, min(hops)::BIGINT AS hops FROM (SELECT 1::BIGINT AS node, 0 AS hops UNION ALL SELECT node, 1 FROM h1 UNION ALL SELECT node, 2 FROM h2) GROUP BY node""")
def two_hop(t: Tables, start: int = 1) -> DataFrame:
    """Suppliers within two steps of one."""
    return graph.hops(start, _supplied(t), "l_suppkey", "l_partkey", 2)
