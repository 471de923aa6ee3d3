"""Queries that walk a graph and keep the paths, each beside recursive SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.operators import traversal
from lexquarry.plans.registry import Tables, query


#: Kinds of nodes: a walk runs over the code ``8 * key + kind``, a node's name is the letter and the key.
_KINDS = "copsn"


def _code(kind: str, key: str) -> Column:
    return F.col(key).cast("long") * 8 + _KINDS.index(kind)


def _name(code: Column) -> Column:
    return F.concat(F.substring(F.lit(_KINDS), F.pmod(code, F.lit(8)).cast("int") + 1, F.lit(1)), F.shiftright(code, 3).cast("string"))


def _edges(t: Tables) -> DataFrame:
    """Customers placed orders, orders hold parts, parts are supplied by suppliers, and all but parts lie in nations; pending orders are left out."""

    def link(df: DataFrame, a: str, src: str, relationship: str, b: str, dst: str) -> DataFrame:
        return df.select(_code(a, src).alias("src"), F.lit(relationship).alias("relationship"), _code(b, dst).alias("dst"))

    parts = (
        link(t.orders.where("o_orderstatus <> 'P'"), "c", "o_custkey", "placed", "o", "o_orderkey"), link(t.lineitem, "o", "l_orderkey", "holds", "p", "l_partkey"),
        link(t.lineitem, "p", "l_partkey", "supplied_by", "s", "l_suppkey"), link(t.customer, "c", "c_custkey", "lies_in", "n", "c_nationkey"),
        link(t.supplier, "s", "s_suppkey", "lies_in", "n", "s_nationkey"),
    )
    return reduce(DataFrame.unionByName, parts)


_SQL = """e AS (SELECT DISTINCT * FROM (SELECT 'c' || o_custkey AS src, 'placed' AS rel, 'o' || o_orderkey AS dst FROM orders WHERE o_orderstatus <> 'P'
   UNION ALL SELECT 'o' || l_orderkey, 'holds', 'p' || l_partkey FROM lineitem UNION ALL SELECT 'p' || l_partkey, 'supplied_by', 's' || l_suppkey FROM lineitem
   UNION ALL SELECT 'c' || c_custkey, 'lies_in', 'n' || c_nationkey FROM customer UNION ALL SELECT 's' || s_suppkey, 'lies_in', 'n' || s_nationkey FROM supplier) {which}),
 r AS (SELECT {start} AS start, {start} AS node, 0 AS hops, [{start}] AS path, []::VARCHAR[] AS rels FROM {starts}
   UNION ALL SELECT start, dst, hops + 1, list_append(path, dst), list_append(rels, rel) FROM r JOIN e ON src = node WHERE hops < {most} AND NOT list_contains(path, dst)),
 f AS (SELECT *, row_number() OVER (PARTITION BY start, node ORDER BY hops, path, rels) AS nth FROM r)"""


_GIVEN = "SELECT start, node, hops::BIGINT AS hops, array_to_string(path, '>') AS path, array_to_string(rels, '>') AS relationships FROM f WHERE nth = 1"
_ASKED = ("placed", "holds", "supplied_by")


@query(f"WITH RECURSIVE {_SQL.format(which='WHERE rel IN ' + str(_ASKED), start="('c' || c_custkey)", starts='customer', most=3)} {_GIVEN}")
def purchase_paths(t: Tables) -> DataFrame:
    """What each customer reaches by three edges of purchases, pending orders left out."""
    return traversal.paths(t.customer.select(_code("c", "c_custkey")), _edges(t), 3, _ASKED, name=_name, joined=">")


@query(f"WITH RECURSIVE {_SQL.format(which='', start="('p' || p_partkey)", starts='part', most=2)}, g AS ({_GIVEN}) SELECT node, count(*)::BIGINT AS n_starts, min(path) AS least_path FROM g WHERE node LIKE 'n%' GROUP BY node")
def nation_reach(t: Tables) -> DataFrame:
    """How many parts come from each nation by a supplier, with the least path."""
    found = traversal.paths(t.part.select(_code("p", "p_partkey")), _edges(t), 2, name=_name, joined=">")
    return found.where("node LIKE 'n%'").groupBy("node").agg(F.count("*").alias("n_starts"), F.min("path").alias("least_path"))
