"""Whole records, nested from co-bucketed tables, beside SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.operators import details
from lexquarry.plans.registry import Tables, query


def _id(letter: str, c: str):
    return F.concat(F.lit(letter), F.col(c)).alias("key")


def _built(t: Tables) -> details.Details:
    """Customers and parts; orders are a customer's chunks, purchases relate both, shipped lines are versions of a part."""
    entities = t.customer.select(_id("c", "c_custkey"), F.col("c_name").alias("title"), F.lit("customer").alias("layer"))
    entities = entities.unionByName(t.part.select(_id("p", "p_partkey"), F.col("p_name").alias("title"), F.lit("part").alias("layer")))
    bought = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(_id("c", "o_custkey").alias("src"), F.lit("bought").alias("relationship"), _id("p", "l_partkey").alias("dst"))
    return details.build_details(entities, "key", {
        "chunks": (t.orders.select(_id("c", "o_custkey"), "o_orderkey", "o_orderstatus"), ["o_orderkey"]),
        "relations": (details.two_ways(bought, entities, "key", ["title", "layer"]), ["direction", "related"]),
        "timeline": (t.events.select(_id("c", "user_id"), "ts", "event_id", "event_type"), ["ts", "event_id"]),
        "versions": (t.lineitem.select(_id("p", "l_partkey"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), "l_orderkey", "l_linenumber"), ["day", "l_orderkey", "l_linenumber"]),
    })


@query(f"""
WITH e AS (SELECT 'c' || c_custkey AS key, c_name AS title, 'customer' AS layer FROM customer UNION ALL SELECT 'p' || p_partkey, p_name, 'part' FROM part),
 b AS (SELECT DISTINCT 'c' || o_custkey AS src, 'p' || l_partkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
 w AS (SELECT src AS key, 'outbound' AS direction, dst AS other FROM b UNION ALL SELECT dst, 'inbound', src FROM b),
 k AS (SELECT 'relations' AS kind, w.key, concat_ws(' ', direction, other, coalesce(title, other), layer) AS item, row_number() OVER (PARTITION BY w.key ORDER BY direction, other) AS r FROM w LEFT JOIN e ON other = e.key
   UNION ALL SELECT 'chunks', 'c' || o_custkey, o_orderkey || ' ' || o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) FROM orders
   UNION ALL SELECT 'timeline', 'c' || user_id, event_id || ' ' || event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) FROM events
   UNION ALL SELECT 'versions', 'p' || l_partkey, strftime(l_shipdate, '%Y-%m-%d') || ' ' || l_orderkey || ' ' || l_linenumber, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) FROM lineitem),
 g AS (SELECT kind, key, (r - 1) // {details.PAGE} AS page, string_agg(item, ';' ORDER BY r) AS items FROM k GROUP BY ALL),
 s AS (SELECT key, title, layer, unnest(range(0, coalesce((SELECT max(page) FROM g WHERE g.key = e.key), 0) + 1)) AS page FROM e)
SELECT s.key, s.page::BIGINT AS page, title, layer, {", ".join(f"coalesce(max(items) FILTER (kind = '{k}'), '') AS {k}" for k in ("chunks", "relations", "timeline", "versions"))}
FROM s LEFT JOIN g ON g.key = s.key AND g.page = s.page GROUP BY s.key, s.page, title, layer""")
def entity_details(t: Tables) -> DataFrame:
    """The whole record of every entity: chunks, relations both ways, timeline and versions."""
    found = details.records(_built(t))
    line = lambda kind, *fields: F.array_join(F.transform(kind, lambda x: F.concat_ws(" ", *(x[f].cast("string") for f in fields))), ";").alias(kind)
    return found.select(
        "key", "page", "entity.title", "entity.layer", line("chunks", "o_orderkey", "o_orderstatus"), line("relations", "direction", "related", "related_title", "related_layer"),
        line("timeline", "event_id", "event_type"), line("versions", "day", "l_orderkey", "l_linenumber"),
    )
