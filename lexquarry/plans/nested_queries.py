"""Queries over nested records: lists, maps, JSON, dispatch, explosions and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.dealing import dealt
from lexquarry.functions import nested, text
from lexquarry.operators import ranking
from lexquarry.plans.registry import Tables, query

_LIST = "CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat(' ', p_brand, ' ,, ', p_type, ', ') WHEN 2 THEN p_brand ELSE '' END"


@query(f"""
WITH l AS (SELECT p_partkey, list_filter(list_transform(string_split(coalesce({_LIST}, ''), ','), lambda x: trim(x)), lambda x: x <> '') AS l FROM part)
SELECT p_partkey, len(l)::BIGINT AS n, array_to_string(l, '|') AS items, '["' || array_to_string(l, '","') || '"]' AS json FROM l WHERE len(l) > 0""")
def list_coercion(t: Tables) -> DataFrame:
    """Strings of values as lists, and as JSON."""
    rows = t.part.select("p_partkey", nested.string_list(F.expr(_LIST)).alias("l")).where(F.size("l") > 0)
    return rows.select("p_partkey", F.size("l").cast("long").alias("n"), F.array_join("l", "|").alias("items"), F.to_json("l").alias("json"))


@query("""SELECT event_id, '[' || CAST(json_extract_string(props, '$.k') AS BIGINT) || ',' || user_id || ']' AS packed, CAST(json_extract_string(props, '$.k') AS BIGINT) + user_id AS total FROM events""")
def json_lists(t: Tables) -> DataFrame:
    """A list that goes out as JSON and comes back."""
    packed = t.events.select("event_id", F.to_json(F.array(F.get_json_object("props", "$.k").cast("long"), F.col("user_id"))).alias("packed"))
    back = F.from_json("packed", "array<long>")
    return packed.select("event_id", "packed", F.aggregate(back, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


_KIND = "CASE p_partkey % 5 WHEN 0 THEN concat('CRS-', p_size) WHEN 1 THEN concat('RM-', p_size) WHEN 2 THEN concat(p_size, '_CCR_', p_partkey) WHEN 3 THEN NULL ELSE concat('HB', p_size) END"


@query(f"""
WITH r AS (SELECT p_partkey, {_KIND} AS id, CASE WHEN p_partkey % 7 = 0 THEN 'implements' END AS rel, CASE WHEN p_partkey % 3 = 0 THEN 'agency' END AS kind FROM part)
SELECT p_partkey, CASE WHEN rel IS NOT NULL THEN 'edge' WHEN starts_with(id, 'CRS-') THEN 'statute' WHEN starts_with(id, 'RM-') THEN 'notice' WHEN contains(id, '_CCR_') THEN 'rule' WHEN regexp_matches(id, '^[HS]B') THEN 'bill' WHEN kind IS NOT NULL THEN kind ELSE 'unknown' END AS model FROM r""")
def record_dispatch(t: Tables) -> DataFrame:
    """The schema of a record: by its relationship, the prefix of its id, or its stated kind."""
    r = t.part.select("p_partkey", F.expr(_KIND).alias("id"), F.expr("CASE WHEN p_partkey % 7 = 0 THEN 'implements' END").alias("rel"), F.expr("CASE WHEN p_partkey % 3 = 0 THEN 'agency' END").alias("kind"))
    i = F.col("id")
    steps = ((F.col("rel").isNotNull(), "edge"), (i.startswith("CRS-"), "statute"), (i.startswith("RM-"), "notice"), (i.contains("_CCR_"), "rule"), (i.rlike("^[HS]B"), "bill"))
    return r.select("p_partkey", text.ladder(*steps, otherwise=F.coalesce("kind", F.lit("unknown"))).alias("model"))


@query("""SELECT n_nationkey AS id, '{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS metadata FROM nation""")
def extra_keys(t: Tables) -> DataFrame:
    """What a record has beside its known fields, kept as an object."""
    return t.nation.select(F.col("n_nationkey").alias("id"), nested.other_keys(["n_nationkey"], t.nation.columns).alias("metadata"))


@query("""
WITH l AS (SELECT l_orderkey, list(l_partkey::VARCHAR ORDER BY l_linenumber, l_partkey, l_suppkey) AS parts, list(l_suppkey::VARCHAR ORDER BY l_linenumber, l_partkey, l_suppkey) AS supps FROM lineitem GROUP BY 1), r AS (SELECT o_orderkey, list_concat(list_concat([o_custkey::VARCHAR], parts), supps) AS r FROM orders JOIN l ON o_orderkey = l_orderkey)
SELECT o_orderkey, len(list_distinct(r))::BIGINT AS n, array_to_string(list_filter(r, lambda x, i: list_position(r, x) = i), '|') AS refs FROM r""")
def reference_flatten(t: Tables) -> DataFrame:
    """All references of a record, from scalars and lists, distinct in order."""
    inner = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))  # the lines of one order
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(inner.alias("l"))
    listed = lambda c: F.transform("l", lambda x: x[c].cast("string"))
    rows = t.orders.select("o_orderkey", "o_custkey").join(lines, "o_orderkey").select("o_orderkey", nested.flat_references(nested.scalar(F.col("o_custkey")), listed("l_partkey"), listed("l_suppkey")).alias("r"))
    return rows.select("o_orderkey", F.size("r").cast("long").alias("n"), F.array_join("r", "|").alias("refs"))


@query("""
SELECT p_partkey, coalesce(CASE WHEN p_partkey % 2 = 0 THEN nullif(trim(p_name), '') END, CASE WHEN p_partkey % 3 = 0 THEN p_brand END, 'part:' || p_partkey) AS id FROM part""")
def primary_identifier(t: Tables) -> DataFrame:
    """The first id field that is there."""
    k = F.col("p_partkey")
    return t.part.select("p_partkey", text.first_present(F.when(k % 2 == 0, F.col("p_name")), F.when(k % 3 == 0, F.col("p_brand")), F.concat(F.lit("part:"), k.cast("string"))).alias("id"))


@query("""
WITH h AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2)
SELECT p_brand, '{"n":' || sum(n)::BIGINT || ',"top":{"type":"' || arg_max(p_type, (n, p_type)) || '","n":' || max(n) || '}}' AS tag FROM h GROUP BY p_brand""")
def nested_tags(t: Tables) -> DataFrame:
    """A record with its best tag inside."""
    h = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    best = h.groupBy("p_brand").agg(F.sum("n").alias("n"), F.max(F.struct("n", "p_type")).alias("m"))
    return best.select("p_brand", F.to_json(F.struct("n", F.struct(F.col("m.p_type").alias("type"), F.col("m.n").alias("n")).alias("top"))).alias("tag"))


_HREF = """(?i)<a\\b[^>]*?href\\s*=\\s*["'']([^"'']*)["'']"""


@query(f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '{_HREF}', 1) AS l FROM pages)
SELECT page_id, unnest(l) AS asset FROM l WHERE len(l) > 0 UNION ALL SELECT page_id, NULL FROM l WHERE coalesce(len(l), 0) = 0""")
def asset_inventory(t: Tables) -> DataFrame:
    """A row for each asset of a page, or one without."""
    return t.pages.select("page_id", F.explode_outer(text.links("html")).alias("asset"))


@query("""
WITH d AS (SELECT 'text' AS category, l_orderkey AS bill, l_partkey AS doc, l_linenumber AS place FROM lineitem WHERE l_returnflag = 'N' UNION ALL SELECT 'amendment', l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A'
 UNION ALL SELECT 'supplement', l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R')
SELECT doc, arg_max(category, (bill, place, category)) AS category, max(bill) AS bill FROM d GROUP BY doc""")
def document_discovery(t: Tables) -> DataFrame:
    """Documents named in three lists of every bill, the last mention of each kept."""
    names = {"N": "text", "A": "amendment", "R": "supplement"}
    entry = F.struct(F.col("l_partkey").alias("doc"), F.col("l_linenumber").alias("place"))
    bills = t.lineitem.groupBy(F.col("l_orderkey").alias("bill")).agg(*(F.collect_list(F.when(F.col("l_returnflag") == flag, entry)).alias(name) for flag, name in names.items()))  # the lines of one order
    named = lambda name: F.transform(name, lambda x: F.struct(F.lit(name).alias("category"), x["doc"].alias("doc"), x["place"].alias("place")))
    listed = F.concat(*(named(name) for name in names.values()))
    rows = bills.select("bill", F.explode(listed).alias("d")).select("bill", "d.*")
    return ranking.latest(rows, "doc", "bill", "place", "category").select("doc", "category", "bill")


@query("""
SELECT '{"nodes":[' || (SELECT string_agg('{"id":' || n_nationkey || ',"name":"' || n_name || '"}', ',' ORDER BY n_nationkey) FROM nation) || '],"links":[' ||
 (SELECT string_agg('{"source":' || n_nationkey || ',"target":' || (100 + n_regionkey) || '}', ',' ORDER BY n_nationkey) FROM nation) || ']}' AS graph""")
def node_link(t: Tables) -> DataFrame:
    """Nations and their regions as nodes and links in JSON (25 rows)."""
    nodes = F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))))
    links = F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("source"), (F.col("n_regionkey") + 100).alias("target"))))
    return t.nation.agg(F.to_json(F.struct(nodes.alias("nodes"), links.alias("links"))).alias("graph"))


@query("""
WITH c AS (SELECT p_partkey, 'target' AS rel, p_size::VARCHAR AS target FROM part UNION ALL SELECT p_partkey, 'target', (p_size + 1)::VARCHAR FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'implements', p_brand FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 'cites', p_type FROM part)
SELECT DISTINCT p_partkey, rel, target FROM c""")
def crosswalk_relations(t: Tables) -> DataFrame:
    """A crosswalk row's scalar target, listed targets and named lists as relation rows."""
    k, size = F.col("p_partkey"), F.col("p_size")
    as_rel = lambda name, values: F.transform(values, lambda x: F.struct(F.lit(name).alias("rel"), x.alias("target")))
    lists = {
        "target": F.concat(nested.scalar(size), F.when(k % 2 == 0, nested.scalar(size + 1)).otherwise(F.array().cast("array<string>"))),
        "implements": F.when(k % 3 == 0, nested.scalar(F.col("p_brand"))).otherwise(F.array().cast("array<string>")),
        "cites": nested.scalar(F.col("p_type")),
    }
    rows = t.part.select("p_partkey", F.explode(F.concat(*(as_rel(n, v) for n, v in lists.items()))).alias("r"))
    return rows.select("p_partkey", "r.rel", "r.target").distinct()


@query("""SELECT r_name, string_agg(n_name, '|' ORDER BY n_name) AS labels FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name UNION ALL SELECT 'all', string_agg(x, '|' ORDER BY x) FROM (SELECT r_name AS x FROM region UNION SELECT n_name FROM nation)""")
def label_flatten(t: Tables) -> DataFrame:
    """A two-level vocabulary by parent, and flat."""
    tree = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("l"))  # 25 names
    flat = tree.agg(F.array_sort(F.array_distinct(F.concat(F.collect_list("r_name"), F.flatten(F.collect_list("l"))))).alias("l")).select(F.lit("all").alias("r_name"), "l")
    return tree.unionByName(flat).select("r_name", F.array_join("l", "|").alias("labels"))


@query("""
WITH a AS (SELECT l_partkey AS k, list_sort(list(DISTINCT l_returnflag)) AS tags, max(l_discount) AS conf FROM lineitem GROUP BY 1), b AS (SELECT p_partkey AS k, [p_brand, 'N'] AS tags, p_size / 500.0 AS conf FROM part WHERE p_size > 10)
SELECT coalesce(a.k, b.k) AS k, array_to_string(list_sort(list_distinct(list_concat(coalesce(a.tags, []), coalesce(b.tags, [])))), '|') AS tags, round(greatest(coalesce(a.conf, 0), coalesce(b.conf, 0)), 4)::DOUBLE AS confidence FROM a FULL JOIN b ON a.k = b.k""")
def tag_merge(t: Tables) -> DataFrame:
    """Two taggings of a record merged: all tags, and the greater confidence."""
    a = t.lineitem.groupBy(F.col("l_partkey").alias("k")).agg(F.collect_set("l_returnflag").alias("ta"), F.max("l_discount").alias("ca"))  # three flags
    b = t.part.where("p_size > 10").select(F.col("p_partkey").alias("k"), F.array(F.col("p_brand"), F.lit("N")).alias("tb"), (F.col("p_size") / 500).alias("cb"))
    zero = F.lit(0.0)
    return a.join(b, "k", "full_outer").select("k", F.array_join(nested.merged_tags(F.col("ta"), F.col("tb")), "|").alias("tags"), F.round(F.greatest(F.coalesce("ca", zero), F.coalesce("cb", zero)), 4).alias("confidence"))


@query("""
WITH l AS (SELECT p_partkey, [p_name, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END, p_type, p_brand, CASE WHEN p_partkey % 2 = 0 THEN p_type END, ' '] AS l FROM part), f AS (SELECT p_partkey, list_filter(l, lambda x: x IS NOT NULL AND trim(x) <> '') AS l FROM l)
SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), chr(10) || chr(10)) AS body FROM f""")
def record_text(t: Tables) -> DataFrame:
    """Structured fields as the text that search sees."""
    k = F.col("p_partkey")
    scalars = [F.col("p_name"), F.when(k % 3 != 0, F.col("p_brand")), F.col("p_type")]
    lists = [F.array("p_brand", F.when(k % 2 == 0, F.col("p_type"))), F.array(F.lit(" "))]
    return t.part.select("p_partkey", nested.record_text(scalars, lists).alias("body"))


@query("""
WITH e AS (SELECT s_suppkey, s_nationkey::BIGINT AS n FROM supplier UNION ALL SELECT s_suppkey, (s_nationkey + 5) % 25 FROM supplier WHERE s_acctbal > 0)
SELECT 'local' AS side, s_suppkey AS a, n AS b FROM e UNION ALL SELECT 'state', n, s_suppkey FROM e""")
def two_way_relations(t: Tables) -> DataFrame:
    """Listed authorities of local rules as edges both ways."""
    n = F.col("s_nationkey").cast("long")
    listed = F.when(F.col("s_acctbal") > 0, F.array(n, (n + 5) % 25)).otherwise(F.array(n))
    e = t.supplier.select("s_suppkey", F.explode(listed).alias("n"))
    return e.select(F.lit("local").alias("side"), F.col("s_suppkey").alias("a"), F.col("n").alias("b")).unionByName(e.select(F.lit("state").alias("side"), F.col("n").alias("a"), F.col("s_suppkey").alias("b")))


# ---- bills as nested records ------------------------------------------------


def _bills(t: Tables) -> DataFrame:
    """Orders as bills with nested histories and references."""
    entry = F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), F.col("l_linenumber").alias("step"), F.col("l_returnflag").alias("action"), F.col("l_partkey").alias("ref"))
    n = t.lineitem.count()
    lines = dealt(t.lineitem.select("l_orderkey", entry.alias("entry")), "l_orderkey", rows=n)
    history = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("entry")).alias("history"))  # the lines of one order
    return dealt(t.orders, "o_orderkey", rows=n).join(history, F.col("o_orderkey") == F.col("l_orderkey"))


@query("""
WITH h AS (SELECT l_orderkey, min(strftime(l_shipdate, '%Y-%m-%d')) AS first, count(*)::BIGINT AS steps FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE first END AS introduced, CASE WHEN lower(o_orderpriority) LIKE '%urgent%' THEN 'signed' WHEN lower(o_orderpriority) LIKE '%high%' THEN 'passed' WHEN lower(o_orderpriority) LIKE '%low%' THEN 'failed' ELSE 'introduced' END AS status,
 CASE WHEN o_orderkey % 2 = 0 THEN 'HB' ELSE 'SB' END || lpad((year(o_orderdate) % 100)::VARCHAR, 2, '0') || '-' || lpad((o_orderkey % 10000)::VARCHAR, 4, '0') AS number, steps FROM orders JOIN h ON o_orderkey = l_orderkey""")
def bill_transform(t: Tables) -> DataFrame:
    """Nested bills as flat records: number, day of introduction and status."""
    explicit = F.when(F.col("o_orderkey") % 10 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    p = F.lower("o_orderpriority")
    status = text.ladder((p.contains("urgent"), "signed"), (p.contains("high"), "passed"), (p.contains("low"), "failed"), otherwise="introduced")
    number = F.concat(F.when(F.col("o_orderkey") % 2 == 0, "HB").otherwise("SB"), F.lpad((F.year("o_orderdate") % 100).cast("string"), 2, "0"), F.lit("-"), F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0"))
    introduced = F.coalesce(explicit, F.array_min(F.transform("history", lambda x: x["date"])), F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _bills(t).select("o_orderkey", introduced.alias("introduced"), status.alias("status"), number.alias("number"), F.size("history").cast("long").alias("steps"))


@query("""SELECT DISTINCT l_orderkey AS bill, CASE l_returnflag WHEN 'A' THEN 'amends' WHEN 'N' THEN 'creates' ELSE 'repeals' END AS rel, l_partkey AS ref FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def bill_edges(t: Tables) -> DataFrame:
    """Amended, created and repealed sections of each bill as edges."""
    rows = _bills(t).select(F.col("o_orderkey").alias("bill"), F.explode("history").alias("h"))
    rel = text.ladder((F.col("h.action") == "A", "amends"), (F.col("h.action") == "N", "creates"), otherwise="repeals")
    return rows.select("bill", rel.alias("rel"), F.col("h.ref").alias("ref")).distinct()


@query("""
WITH b AS (SELECT o_custkey AS id, year(o_orderdate)::BIGINT AS year, o_orderkey FROM orders) SELECT id, arg_max(year, (year, o_orderkey)) AS year, arg_max(o_orderkey, (year, o_orderkey)) AS o_orderkey FROM b GROUP BY id""")
def bill_years(t: Tables) -> DataFrame:
    """One row of each bill, its last, with the year of the file it goes to."""
    rows = t.orders.select(F.col("o_custkey").alias("id"), F.year("o_orderdate").cast("long").alias("year"), "o_orderkey")
    return ranking.latest(rows, "id", "year", "o_orderkey").select("id", "year", "o_orderkey")
