"""Walks with paths against a plain search; the plan of a round; hubs in blocks."""

import random

import pytest
from pyspark.sql import functions as F

from lexquarry.operators import traversal

SCHEMA = "src long, relationship string, dst long, weight double"


def _plain(starts, edges, most, kinds, ready):
    links = {}
    for s, r, d, _ in set(edges):
        if s is not None and d is not None and (kinds is None or r in kinds) and (ready is None or d in ready):
            links.setdefault(s, []).append((d, r))
    out = {}
    for start in {s for s in starts if s is not None}:
        now = {start: ((start,), ())}
        out[start, start] = (0, (start,), ())
        for k in range(1, most + 1):
            new = {}
            for node, (path, rels) in now.items():
                for d, r in links.get(node, []):
                    if (start, d) not in out:
                        new[d] = min(new.get(d, (path + (d,), rels + (r,))), (path + (d,), rels + (r,)))
            out |= {(start, n): (k, *p) for n, p in new.items()}
            now = new
    return out


def _got(df):
    rows = df.collect()
    found = {(r.start, r.node): (r.hops, tuple(r.path), tuple(r.relationships)) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("fanout", [1000, 3])
def test_first_paths_match_a_plain_search(spark, monkeypatch, fanout):
    monkeypatch.setattr(traversal, "FANOUT", fanout)  # 3: nodes lie in several blocks
    draw = random.Random(fanout)
    edges = [(draw.randrange(30), draw.choice("abc"), draw.randrange(30), 1.0) for _ in range(60)]
    edges += [(0, "a", n, 1.0) for n in range(40, 70)] + edges[:5] + [(None, "a", 3, 1.0), (3, "a", None, 1.0), (4, "b", 4, 1.0)]  # a hub, repeats, null ends, a loop
    starts = [0, 1, 1, 2, None, 500]
    ready = [n for n in range(70) if n % 7]
    df = spark.createDataFrame(edges, SCHEMA)
    asked = spark.createDataFrame([(s,) for s in starts], "id long")
    assert _got(traversal.paths(asked, df, 4)) == _plain(starts, edges, 4, None, None)
    listed = spark.createDataFrame([(n,) for n in ready], "node long")
    assert _got(traversal.paths(asked, df, 3, ["a", "b"], listed)) == _plain(starts, edges, 3, {"a", "b"}, set(ready))


def test_no_edges_and_no_starts(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1,)], "id long")
    assert _got(traversal.paths(one, none, 3)) == {(1, 1): (0, (1,), ())}
    assert _got(traversal.paths(one.where("id > 1"), spark.createDataFrame([(1, "a", 2, 0.0)], SCHEMA), 3)) == {}


def test_a_round_shuffles_the_frontier_and_no_edges(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.range(400).select(F.col("id").alias("src"), F.lit("a").alias("relationship"), (F.col("id") * 7 % 400).alias("dst"))
        links, hubs = traversal.link_table(edges)
        frontier = spark.range(9).select(F.col("id").alias("start"), F.col("id").alias("node"), F.lit(1).cast("long").alias("blocks"), F.array("id").alias("path"), F.array(F.lit("a")).alias("relationships"))
        plan = traversal.step(frontier, links)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_node_with_half_of_all_edges_lies_in_blocks(spark):
    edges = spark.range(8000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("src"), F.lit("a").alias("relationship"), (F.col("id") + 1).alias("dst"))
    links, hubs = traversal.link_table(edges)
    assert [tuple(r) for r in hubs.collect()] == [(0, 4)]
    assert max(r.n for r in links.groupBy("src", "block").agg(F.count("*").alias("n")).collect()) < 1200


def test_last_round_is_not_written(spark, monkeypatch):
    """Only rounds that are looked up again are written, and rows on their way hold neither start nor node twice."""
    labels = []
    write = traversal.save_bucketed
    monkeypatch.setattr(traversal, "save_bucketed", lambda df, keys, buckets=None, label="bucketed": labels.append((label, df.columns)) or write(df, keys, buckets, label))
    edges = spark.createDataFrame([("a", "x", "b"), ("a", "w", "b"), ("b", "x", "c"), ("a", "x", "d"), ("d", "x", "c"), ("c", "x", "a")], "src string, relationship string, dst string")
    found = traversal.paths(spark.createDataFrame([("a",)], "node string"), edges, 2)
    got = sorted((r.node, r.hops, r.path, r.relationships) for r in found.collect())
    assert got == [("a", 0, ["a"], []), ("b", 1, ["a", "b"], ["w"]), ("c", 2, ["a", "b", "c"], ["w", "x"]), ("d", 1, ["a", "d"], ["x"])]
    assert [label for label, _ in labels].count("reached") == 2


def test_edges_are_shuffled_only_to_their_buckets(spark, monkeypatch):
    plans, plain = [], traversal.save_bucketed
    monkeypatch.setattr(traversal, "save_bucketed", lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, *a, **k))
    edges = spark.createDataFrame([("a", "r", f"b{k % 40}") for k in range(80)] + [("b1", "r", "c"), (None, "r", "c")], "src string, relationship string, dst string")
    links, hubs = traversal.link_table(edges)
    assert not any("ENSURE_REQUIREMENTS" in p.split("Initial Plan")[-1] and "hashpartitioning" in p for p in plans)
    assert links.count() == 41 and hubs.count() == 0


@pytest.mark.parametrize("pairs", [1_000_000, 12])
def test_starts_are_sent_lists_and_compare_them_by_name(spark, monkeypatch, pairs):
    """What goes to a start is a list of ends for each path, of a start of many (12: nearly all) to several tasks; codes are ordered by their names."""
    monkeypatch.setattr(traversal, "FANOUT", 4)
    monkeypatch.setattr(traversal, "PAIRS", pairs)
    draw = random.Random(pairs)
    edges = [(draw.randrange(60), draw.choice("ab"), draw.randrange(60), 1.0) for _ in range(240)] + [(3, "a", n, 1.0) for n in range(60)]
    starts = list(range(0, 30, 2))
    asked = spark.createDataFrame([(s,) for s in starts], "id long")
    found = traversal.paths(asked, spark.createDataFrame(edges, SCHEMA), 3, name=lambda c: F.concat(F.lit("n"), c.cast("string")), joined=">")
    want = _plain([f"n{s}" for s in starts], [(f"n{s}", r, f"n{d}", w) for s, r, d, w in edges], 3, None, None)
    rows = found.collect()
    assert {(r.start, r.node): (r.hops, r.path, r.relationships) for r in rows} == {pair: (k, ">".join(path), ">".join(rels)) for pair, (k, path, rels) in want.items()}
    assert len(rows) == len(want)
    sent = [line for line in found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines() if "Exchange hashpartitioning(start" in line]
    assert sent and not any("node" in line for line in sent)
