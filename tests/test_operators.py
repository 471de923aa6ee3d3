"""Operators on small fixtures: nulls, ties, repeats, and the folds that SQL does not express."""

import difflib
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexquarry.functions import chunking, text
from lexquarry.functions import udfs
from lexquarry.operators import graph, joins, ranking, search, vectors
from lexquarry.plans.relational_queries import matrix_cross_join


def test_chunks_pack_lines_and_lose_nothing(spark):
    long = "\n".join(f"line {i} " + "x" * (i % 90) for i in range(200))
    rows = spark.createDataFrame([(1, long), (2, ""), (3, None), (4, " \n one  two \n\nthree")], "doc_id long, text string")
    got = chunking.paragraph_chunks(rows).orderBy("doc_id", "chunk_index").collect()
    first = [r.chunk for r in got if r.doc_id == 1]
    assert all(len(c) <= 1800 + 400 for c in first) and len(first) > 3
    assert [x for c in first for x in c.split("\n\n")] == [" ".join(x.split()) for x in long.splitlines()]
    assert [r.chunk for r in got if r.doc_id == 4] == ["one two\n\nthree"] and not [r for r in got if r.doc_id in (2, 3)]


def test_budget_skips_what_does_not_fit(spark):
    rows = spark.createDataFrame([(1, i, c) for i, c in enumerate([5, 9, 3, 2, 1])] + [(2, 0, 99)], "g long, o long, cost long")
    got = {(r.g, r.o): r.kept for r in ranking.budget_pick(rows, "g", "o", "cost", 10).collect()}
    assert got == {(1, 0): True, (1, 1): False, (1, 2): True, (1, 3): True, (1, 4): False, (2, 0): False}


def test_ranks_over_ranges_equal_plain_ranks(spark):
    rows = spark.createDataFrame([("a", i) for i in range(500)] + [("b", 7)], "g string, k long")
    got = ranking.numbered(rows, "g", F.col("k")).collect()
    assert all(r["rank"] == (r.k + 1 if r.g == "a" else 1) and r["n"] == (500 if r.g == "a" else 1) for r in got) and len(got) == 501


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ranks_with_other_columns_and_null_groups(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    rows = spark.range(600_000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'a' ELSE concat('g', id % 50) END AS g", "xxhash64(id) AS k", "id AS other", "1 AS rank_of")
    got = ranking.numbered(rows, "g", F.col("k"), F.col("other"))
    plain = rows.withColumn("want", F.row_number().over(Window.partitionBy("g").orderBy("k", "other")))
    both = got.join(plain.select("other", "want"), "other")
    assert both.count() == 600_000 and both.where("rank <> want").count() == 0
    spark.conf.unset("spark.sql.exchange.reuse")


def test_more_than_a_thousand_groups_all_lead(spark):
    rows = spark.range(1500).selectExpr("format_string('g%04d', id) AS g", "id AS score", "id AS k")
    got = ranking.diversified(rows, "g", "score", "k", 3).collect()
    assert [r.k for r in got] == [1499, 1498, 1497]


def test_matrix_has_more_than_a_thousand_segments(spark):
    tables = SimpleNamespace(customer=spark.range(1200).selectExpr("format_string('s%04d', id) AS c_mktsegment"), nation=spark.createDataFrame([("A",), ("B",)], "n_name string"))
    assert getattr(matrix_cross_join, "__wrapped__", matrix_cross_join)(tables).count() == 2400


def test_as_of_takes_the_last_row_at_or_before(spark):
    left = spark.createDataFrame([(1, 1, 10), (2, 1, 5), (3, 2, 1), (4, None, 3)], "id long, k long, at long")
    right = spark.createDataFrame([(1, 5, "x"), (1, 10, "y"), (1, 11, "z"), (2, 2, "w")], "k long, at long, v string")
    assert {r.id: r.v for r in joins.as_of(left, right, "k", "at", "v").collect()} == {1: "y", 2: "x", 3: None, 4: None}


def test_bags(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y")], "k long, i string")
    b = spark.createDataFrame([(1, "x"), (1, "z"), (2, "q")], "k long, i string")
    got = {r.k: (r.added, r.removed, r.shared) for r in joins.bag_difference(a, b, ["k"], "i").collect()}
    assert got == {1: (1, 2, 1), 2: (1, 0, 0)}


def test_components_of_a_path_with_loops_and_nulls(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_text_helpers(spark):
    row = spark.createDataFrame([("The FEE-2.5, must; see 12 CCR 345-67 and 24-4-103",)], "t string").select(
        text.normalize("t").alias("n"), text.normalize_alias("t").alias("a"), text.citations("t", "ccr").alias("c"), text.citations("t", "crs").alias("s"), text.first_present(F.lit(" "), F.col("t")).alias("f")
    ).first()
    assert row.n == "the fee 2 5 must see 12 ccr 345 67 and 24 4 103" and row.a.startswith("the fee 2 5 must; see")
    assert row.c == ["12 CCR 345-67"] and row.s == ["24-4-103"] and row.f.startswith("The")


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400, k) for k in range(500, 560)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {i: find(i) for e in edges if e[0] != e[1] for i in e}
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == want


def test_shared_keys_in_blocks_and_hops(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(rng.randrange(40), rng.randrange(6)) for _ in range(120)] + [(None, 1), (3, None)]
    m = spark.createDataFrame(rows, "n long, k long")
    keys = {}
    for n, k in rows:
        if n is not None and k is not None:
            keys.setdefault(n, set()).add(k)
    want = {(a, b): len(keys[a] & keys[b]) for a in keys for b in keys if a < b and keys[a] & keys[b]}
    for block in (1000, 3):
        monkeypatch.setattr(graph, "BLOCK", block)
        assert {(r.src, r.dst): r.weight for r in graph.shared_key_edges(m, "n", "k").collect()} == want
    start = min(keys)
    near = {b for (a, b) in want if a == start} | {start}
    got = {r.node: r.hops for r in graph.hops(start, m, "n", "k", 1).collect()}
    assert got == {n: int(n != start) for n in near}


def test_nearest_vectors_match_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(120, 8)).astype(np.float32)
    v[7] = v[3]  # a tie
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(500, None), (501, [])]
    df = spark.createDataFrame(rows, "id long, e array<float>").repartition(3)
    d = v.astype(np.float64)
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    sims = np.round(d @ d.T, 6)
    want = {(q, k): r for q in range(0, 120, 10) for r, k in enumerate(sorted((k for k in range(120) if k != q), key=lambda k: (-sims[q, k], k))[:4], 1)}
    for block in (4096, 5):
        got = vectors.cosine_topk(df.where("id % 10 = 0"), df, "id", "e", 4, block).collect()
        assert {(r.query, r.key): r["rank"] for r in got} == want


def test_cells_find_nearly_all_and_all_probes_find_all(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(20, 16))
    v = (centre[rng.integers(0, 20, 3000)] + 0.6 * rng.normal(size=(3000, 16))).astype(np.float32)
    v[:1000] = v[0]  # a third of all rows alike
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(5000, None), (5050, [])]
    df = spark.createDataFrame(rows, "id long, e array<float>").repartition(3)
    asked = df.where("id % 50 = 0")
    exact = {(r.query, r.key): r["rank"] for r in vectors.cosine_topk(asked, df, "id", "e", 10).collect()}
    assert len(exact) == 60 * 10
    for run, block in ((20_000, 4096), (150, 7)):  # cells of one run and of several
        monkeypatch.setattr(vectors, "RUN", run)
        monkeypatch.setattr(vectors, "BLOCK", block)
        whole = {(r.query, r.key): r["rank"] for r in vectors.nearest(asked, df, "id", "e", 10, cells=16, probes=16).collect()}
        assert whole == exact
    placed, centres = vectors.build_cells(df, "id", "e", 32)
    probes = vectors.fit_probes(asked.where("id < 4000").select(F.col("id").alias("key"), F.col("e").alias("v")), placed, centres, 10, 0.93)
    assert 1 <= probes <= 16  # grouped vectors need few of the 32 cells
    part = {(r.query, r.key) for r in vectors.nearest(asked, df, "id", "e", 10, cells=32).collect()}
    assert len(part & set(exact)) >= 0.9 * len(exact)
    assert vectors.nearest(asked, df.where("id < 0"), "id", "e", 10).count() == 0
    assert vectors.nearest(asked.where("id < 0"), df, "id", "e", 10).count() == 0
    placed, centres = vectors.build_cells(df, "id", "e", 8)
    assert placed.count() == 3000 and len(centres) == 8


def test_functions_of_our_own(spark):
    pairs = [("abcd", "bcde"), ("", ""), ("x", None), ("same", "same")]
    got = [r.s for r in spark.createDataFrame(pairs, "a string, b string").select(udfs.similarity_ratio("a", "b").alias("s")).collect()]
    assert got == [round(difflib.SequenceMatcher(None, a, b).ratio(), 6) if b is not None else 0.0 for a, b in pairs]
    assert udfs.repair("cafÃ©") == "café" and udfs.repair("Ãber") == "Ãber" and udfs.repair(None) is None and udfs.repair("plain") == "plain"
    assert udfs.decode("é".encode(), None) == "é" and udfs.decode(b"\xe9", "latin-1") == "é" and udfs.decode(b"\x80", "nonsense") == "€" and udfs.decode(None, None) is None
    ids = spark.createDataFrame([("a",), ("a",), (None,)], "n string").select(udfs.name_uuid("n").alias("u")).collect()
    assert ids[0].u == ids[1].u and len(ids[0].u) == 36 and ids[2].u is None


def test_requests_are_understood():
    rules = search.Rules(expansions={"fee": ("charge",), "air quality": ("emission",)}, anchors={"fee": ("fee", "charge")}, domains={"air": ("air",), "money": ("fee",)}, preferred=(("rule", "ccr", 60),))
    r = search.understand("What is the fee of an air quality rule?", rules)
    assert r.terms == ("what", "fee", "air", "quality", "rule", "charge", "emission") and r.anchors == ("fee", "charge")
    assert r.domains == ("air", "money") and r.preferred == (("ccr", 60),) and r.least == 2
    assert search.understand("fees", rules).anchors == () and search.understand("", rules).terms == ()


def test_search_without_hits_or_terms(spark):
    docs = spark.createDataFrame([(1, "nothing here"), (2, None)], "id long, norm string")
    for words in ("absent", ""):
        assert search.score_chunks(docs, search.understand(words, search.Rules()), search.Rules()).count() == 0


def test_budget_keeps_null_groups_large_keys_and_null_costs(spark):
    rows = [(None, 1, 40), (None, 2, 40), (None, 3, 10), (7, 1, 40), (7, 2, 40), (7, 3, 10), (7, 4, None)]
    rows += [((1 << 53) + 1, 1, 60), ((1 << 53) + 2, 1, 60)]
    got = ranking.budget_pick(spark.createDataFrame(rows, "g long, at long, cost long"), "g", "at", "cost", 64).collect()
    want = {(None, 1), (None, 3), (7, 1), (7, 3), ((1 << 53) + 1, 1), ((1 << 53) + 2, 1)}
    assert {(r.g, r.at) for r in got if r.kept} == want and len(got) == len(rows)


def test_budget_of_a_group_with_half_of_all_rows(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("g"), "id", (F.col("id") % 90 + 1).alias("cost"))
    got = {(r.g, r.id) for r in ranking.budget_pick(df, "g", "id", "cost", 64).where("kept").collect()}
    want, left = set(), {}
    for i in range(40_000):
        g = 1 if i % 2 == 0 else i
        if i % 90 + 1 <= left.setdefault(g, 64):
            left[g] -= i % 90 + 1
            want.add((g, i))
    assert got == want


def test_no_item_behind_the_first_is_lost(spark):
    from lexquarry.functions import text

    df = spark.createDataFrame([("a" + "|b" * 10_001,), ("a",), ("",), (None,)], "x string")
    assert [r.n for r in df.select(F.size(text.all_but_first(F.split("x", r"\|"))).alias("n")).collect()][:3] == [10_001, 0, 0]


def test_the_first_of_equal_lines_gives_the_status(spark, tmp_path):
    """Lines of one order, day and number: the SQL takes the first in the table that has a status."""
    import duckdb

    from lexquarry.plans.catalog import ORACLES, QUERIES

    flags = {1: "FO", 2: "OF", 3: [None, "F", "O"], 4: "OFOFO", 5: [None]}
    lines = [(k, 1 if k < 4 else 2, f, "1996-01-01 00:00:00") for k, own in flags.items() for f in own] + [(4, 1, "F", "1996-01-01 07:00:00"), (4, 1, "O", "1996-01-01 07:00:00")]
    made = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_linestatus string, day string").coalesce(1)
    made.withColumn("l_shipdate", F.col("day").cast("timestamp")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(9, "P", 2e5, "high")], "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    name = "queue_manifest_full_outer"
    got = QUERIES[name](spark, str(tmp_path)).select("record_id", "status", "priority", "n_lines").collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(ORACLES[name]).fetchall())
    assert {r.record_id: r.status for r in got} == {1: "F", 2: "O", 3: "F", 4: "F", 5: None, 9: "P"}


def test_the_sql_leaves_no_status_to_chance(spark, tmp_path):
    """Equal lines that lie in parts of the table which the SQL's engine reads at once: it too takes the first in the table."""
    import duckdb

    from lexquarry.plans.catalog import ORACLES, QUERIES

    con = duckdb.connect()
    con.sql("SET threads = 8")
    lines = "SELECT range % 4000 AS l_orderkey, 1 AS l_linenumber, chr((65 + range // 4000)::INT) AS l_linestatus, TIMESTAMP '1996-01-01' AS l_shipdate FROM range(80000)"
    con.sql(f"COPY ({lines}) TO '{tmp_path}/lineitem.parquet' (ROW_GROUP_SIZE 2048)")
    con.sql(f"COPY (SELECT 9::BIGINT AS o_orderkey, 'P' AS o_orderstatus, 2e5::DOUBLE AS o_totalprice, 'high' AS o_orderpriority) TO '{tmp_path}/orders.parquet'")
    for t in ("lineitem", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    name = "queue_manifest_full_outer"
    got = QUERIES[name](spark, str(tmp_path)).select("record_id", "status", "priority", "n_lines").collect()
    assert {r.status for r in got} == {"A", "P"}
    for _ in range(5):
        assert sorted(map(tuple, got)) == sorted(con.sql(ORACLES[name]).fetchall())


def test_pairs_of_a_category_or_a_target_are_made_once(spark, tmp_path):
    """Repeated rows count each, a name counts by every id that begins what follows it, and nothing is made distinct behind the join."""
    import duckdb

    from lexquarry.plans.catalog import ORACLES, QUERIES

    customers = [(1, "BUILDING"), (1, "BUILDING"), (12, "BUILDING"), (12, None), (123, "HOME"), (7, None), (None, "BUILDING")]
    parts = [(1, "Brand#1", "a"), (12, "Brand#2", "spring 12 ring 12"), (3, None, "ring 123 ring 07"), (4, "Brand#1", "ring 7"), (5, "Brand#2", None), (7, "Brand#2", "ring x7"), (7, "Brand#2", "ring 1ring 12")]
    spark.createDataFrame(customers, "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    for t in ("customer", "part"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = QUERIES["category_or_target"](spark, str(tmp_path))
    assert sorted(map(tuple, got.select("c_custkey", "p_partkey").collect()), key=str) == sorted(con.sql(ORACLES["category_or_target"]).fetchall(), key=str)
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_all_pairs_meet_in_cells_of_a_bounded_size(spark, monkeypatch, tmp_path):
    """Each pair of rows once, repeated and null rows too; no product of whole tables is left in the plan."""
    from lexquarry.operators import joins
    from lexquarry.plans.catalog import QUERIES

    monkeypatch.setattr(joins, "LIST", 5)
    monkeypatch.setattr(joins, "BAND", 20)
    monkeypatch.setattr(joins, "PAIRS", 300)
    left = [(k % 90, str(k % 7)) for k in range(100)] + [(None, None)] * 2
    right = [(k % 60,) for k in range(70)] + [(None,)]
    a, b = spark.createDataFrame(left, "a long, s string"), spark.createDataFrame(right, "b long")
    found = joins.all_pairs(a, b)
    assert Counter(map(tuple, found.collect())) == Counter((*x, *y) for x in left for y in right)
    assert max(r.n for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) < 3000  # of 7,242
    assert joins.all_pairs(a.where("a > 100"), b).count() == joins.all_pairs(a, b.where("b > 100")).count() == 0
    spark.createDataFrame([(k, "BUILDING") for k in range(30)], "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, "Brand#1", "a") for k in range(30)], "p_partkey long, p_brand string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    query = QUERIES["category_or_target"](spark, str(tmp_path))
    assert query.count() == 900
    assert not any(way in query._jdf.queryExecution().executedPlan().toString() for way in ("CartesianProduct", "NestedLoop"))


def test_shared_keys_in_tasks_that_do_not_grow(spark, monkeypatch):
    monkeypatch.setattr(graph, "PAIRS", 200)
    monkeypatch.setattr(graph, "BLOCK", 7)
    rows = [(n, k) for k in range(60) for n in (0, k + 1, k + 2, k + 3)] + [(n, 99) for n in range(40)] + [(1, None), (None, 1), (1, 0)]
    m = spark.createDataFrame(rows, "n long, k long")
    held = {}
    for n, k in rows:
        if n is not None and k is not None:
            held.setdefault(k, set()).add(n)
    want = Counter((a, b) for ns in held.values() for a in ns for b in ns if a < b)
    edges = graph.shared_key_edges(m, "n", "k")
    assert {(r.src, r.dst): r.weight for r in edges.collect()} == want
    # more tasks than the session's shuffles have, as many as the pairs ask
    assert edges.select(F.spark_partition_id().alias("p")).distinct().count() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = {}
    for (a, b), w in want.items():
        both.setdefault(a, []).append((-w, b))
        both.setdefault(b, []).append((-w, a))
    got = {r.node: (r.n_edges, r.total_weight, r.heaviest) for r in graph.neighbours(edges).collect()}
    assert got == {n: (len(es), -sum(w for w, _ in es), min(es)[1]) for n, es in both.items()}
    assert edges.sparkSession.createDataFrame([], "n long, k long").transform(lambda df: graph.shared_key_edges(df, "n", "k")).count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_neighbours_by_shared_keys_without_edges(spark, monkeypatch, kind):
    """The same as from the edges, in blocks and slices too; of equal weights the least node; no pair is shuffled."""
    monkeypatch.setattr(graph, "PAIRS", 150)
    monkeypatch.setattr(graph, "BLOCK", 7)
    rows = [(n, k) for k in range(60) for n in (0, k % 9 + 1, k % 7 + 11, k + 3)] + [(n, 99) for n in range(40)] + [(77, 101), (1, None), (None, 1), (1, 0), (1, 0)]
    m = spark.createDataFrame(rows, "n long, k long").select(F.col("n").cast(kind).alias("n"), "k")
    monkeypatch.setattr(graph, "SENT", 100)
    found = graph.shared_key_neighbours(m, "n", "k")
    held = Counter(k for n, k in set(rows) if n is not None and k is not None)
    sent = sum(c * (c - 1) for c in held.values())
    want = graph.neighbours(graph.shared_key_edges(m, "n", "k"))
    assert found.dtypes == want.dtypes
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, want.collect())) and want.count() > 60
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert not [line for line in plan.splitlines() if "Exchange" in line and "weight" in line]
    # the lists are read in as many tasks as the pairs to send ask
    assert "hashpartitioning(_key" in plan and f"{-(-sent // 100)}), REPARTITION_BY_NUM" in plan
    assert graph.shared_key_neighbours(m.where("k > 500"), "n", "k").count() == 0


def test_components_of_shared_keys_by_fewer_links(spark):
    rows = [(n, k) for k in range(4) for n in range(20 * k, 20 * k + 20)] + [(500, 8), (19, 9), (20, 9), (None, 9), (7, None)]
    m = spark.createDataFrame(rows, "n long, k long")
    links, edges = graph.shared_key_links(m, "n", "k"), graph.shared_key_edges(m, "n", "k")
    assert 8 * links.count() < edges.count()
    found = [{(r.node, r.component) for r in graph.connected_components(df).collect()} for df in (links, edges)]
    assert found[0] == found[1]


def test_scoring_normalises_each_text_once(spark):
    from lexquarry.plans.search_queries import _BOTH, RULES

    rows = spark.createDataFrame([(1, "License!  of a SECRET", "de"), (2, None, "de"), (3, "nothing", "en")], "doc_id long, text string, lang string")
    found = search.score_chunks(rows.select("doc_id", "lang", text.normalize("text").alias("norm")), _BOTH, RULES, kind="lang")
    assert found._jdf.queryExecution().executedPlan().toString().count("regexp_replace") == 1
    assert [(r.doc_id, r.hits, r.score) for r in found.collect()] == [(1, 2, 40 + 2 * 24 + 2 + 60)]
