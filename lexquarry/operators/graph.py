"""Graph operators over edge tables."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.dealing import dealt, partitions
from lexquarry.scratch import drop, save


def _star(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """One star step: every node hands its smallest neighbour to the others.

    ``keep_larger`` is the large-star (only neighbours above the node are
    relinked); otherwise the small-star on edges that point downwards.
    """
    if keep_larger:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(low, "u")
    if keep_larger:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Label each node that has an edge with the smallest id it can reach.

    Alternating large-star and small-star steps (log-many rounds), each one a
    grouped minimum and a join; nothing but an edge count and a checksum comes
    back to the driver.  Null ends and loops are ignored.  Returns
    ``(node, component)``; nodes that are a component's minimum appear too.
    """
    now = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    seen = None
    for _ in range(max_rounds):
        now = save(_star(_star(now, keep_larger=True), keep_larger=False), "star")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("connected_components did not settle")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


#: Members of a key in one list.
BLOCK = 1000
#: Pairs that one task counts, and that one sends, on average.
PAIRS, SENT = 2_000_000, 20_000_000


def _members(memberships: DataFrame, node: str, key: str) -> DataFrame:
    """``src, _key``, each once; null nodes and keys are left out."""
    rows = memberships.select(F.col(node).alias("src"), F.col(key).alias("_key"))
    return dealt(rows, "src", "_key").where("src IS NOT NULL AND _key IS NOT NULL").distinct()


def _sent(memberships: DataFrame, node: str, key: str, both: bool) -> DataFrame:
    """``src, _slice, others``: the sorted lists of the nodes above each node (of all others, if ``both``), one a key, where they are counted.

    What is shuffled is the ids of the lists, not a row for each pair, and a task counts PAIRS or so.  A key of more than BLOCK
    nodes has several lists, each met with all of the key's lists; a node of more than PAIRS has its pairs counted in slices.
    """
    a = save(_members(memberships, node, key), "members")
    rows = a.count()
    blocks = a.groupBy("_key").agg(F.ceil(F.count("*") / BLOCK).alias("_blocks")).where("_blocks > 1")  # one row for BLOCK members at most
    n = F.coalesce("_blocks", F.lit(1).cast("long"))
    placed = a.join(F.broadcast(blocks), "_key", "left").select("src", "_key", n.alias("_blocks"), F.pmod(F.xxhash64("src"), n).alias("_block"))
    lists = save(dealt(placed, "_key", "_block", rows=rows).groupBy("_key", "_block", "_blocks").agg(F.sort_array(F.collect_list("src")).alias("others")), "lists")
    drop(a)

    def asked(lists: DataFrame) -> DataFrame:
        one, many = lists.where("_blocks = 1"), lists.where("_blocks > 1")
        rest = F.array_remove("others", F.col("src")) if both else F.slice("others", F.col("_at") + 2, F.greatest(F.size("others") - F.col("_at") - 1, F.lit(0)))
        own = one.select(F.posexplode("others").alias("_at", "src"), "others").select("src", rest.alias("others"))
        met = many.select("_key", F.col("others").alias("_mine"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_block")).join(many.select("_key", "_block", "others"), ["_key", "_block"])
        above = met.select(F.explode("_mine").alias("src"), "others").select("src", F.filter("others", lambda x: (x != F.col("src")) if both else (x > F.col("src"))).alias("others"))
        return own.unionByName(above).where("size(others) > 0")

    load = save(asked(lists).groupBy("src").agg(F.sum(F.size("others")).alias("_pairs")), "load")
    pairs = load.agg(F.coalesce(F.sum("_pairs"), F.lit(0))).first()[0]
    heavy = load.where(F.col("_pairs") > PAIRS).select("src", F.ceil(F.col("_pairs") / PAIRS).alias("_slices"))
    # lists lie in few files, and a task that sends all pairs of one would hold more than it has memory for
    spread = lists.repartition(partitions(a, pairs, SENT), "_key", "_block")
    cut = asked(spread).join(F.broadcast(heavy), "src", "left")  # fewer rows than tasks
    cut = cut.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_slices", F.lit(1).cast("long")) - 1)))
    part = F.when(F.col("_slices").isNull(), F.col("others")).otherwise(F.filter("others", lambda x: F.pmod(F.xxhash64(x), F.col("_slices")) == F.col("_slice")))
    return cut.select("src", "_slice", part.alias("others")).repartition(partitions(a, pairs, PAIRS), "src", "_slice")


def shared_key_edges(memberships: DataFrame, node: str, key: str) -> DataFrame:
    """``src, dst, weight``: pairs of nodes (src < dst) by the number of keys they share.

    Each node gets the sorted lists of the nodes above it, one a key, and they are counted where they arrive.
    """
    sent = _sent(memberships, node, key, both=False)
    return sent.select("src", "_slice", F.explode("others").alias("dst")).groupBy("src", "_slice", "dst").agg(F.count("*").alias("weight")).drop("_slice")


def shared_key_neighbours(memberships: DataFrame, node: str, key: str) -> DataFrame:
    """:func:`neighbours` of :func:`shared_key_edges`, without them: each node gets all of its lists, so that no pair is written or shuffled."""

    def counted(lists: pa.Table) -> pa.Table:
        """What the lists of one node and slice say of it, by one count of their ids."""
        ids = pc.list_flatten(lists["others"])
        counts = pc.value_counts(ids)
        weights = counts.field("counts")
        most = pc.max(weights)
        heaviest = pc.min(counts.field("values").filter(pc.equal(weights, most)))
        own = lists["src"].slice(0, 1)
        return pa.table({"node": own, "n": [len(counts)], "w": [len(ids)], "most": [most.as_py()], "heaviest": pa.array([heaviest.as_py()], own.type)})

    sent = _sent(memberships, node, key, both=True)
    kind = dict(sent.dtypes)["src"]
    some = sent.where("size(others) > 0").groupBy("src", "_slice").applyInArrow(counted, f"node {kind}, n long, w long, most long, heaviest {kind}")
    best = F.min(F.struct((-F.col("most")).alias("less"), "heaviest"))
    return some.groupBy("node").agg(F.sum("n").alias("n_edges"), F.sum("w").alias("total_weight"), best.alias("_best")).select("node", "n_edges", "total_weight", F.col("_best.heaviest").alias("heaviest"))


def shared_key_links(memberships: DataFrame, node: str, key: str) -> DataFrame:
    """``src, dst``: each key's least node and its others, which join what :func:`shared_key_edges` joins by far fewer rows."""
    a = _members(memberships, node, key)
    least = dealt(a, "_key", rows=memberships.count()).groupBy("_key").agg(F.min("src").alias("_least"))
    return a.join(least, "_key").where("src > _least").select(F.col("_least").alias("src"), F.col("src").alias("dst")).distinct()


def sharing(nodes: DataFrame, memberships: DataFrame, node: str, key: str) -> DataFrame:
    """All nodes that share a key with one of ``nodes`` (a column ``node``), by way of the keys, without pairs."""
    keys = memberships.join(nodes.select(F.col("node").alias(node)).distinct(), node, "left_semi").select(key).distinct()
    return memberships.join(keys, key, "left_semi").select(F.col(node).alias("node")).distinct()


def hops(start: int, memberships: DataFrame, node: str, key: str, most: int) -> DataFrame:
    """``start, node, hops`` of the nodes within ``most`` steps of shared keys."""
    spark = memberships.sparkSession
    reached = spark.createDataFrame([(start, 0)], "node long, hops long")
    for k in range(1, most + 1):
        step = sharing(reached.select("node"), memberships, node, key).select("node", F.lit(k).cast("long").alias("hops"))
        reached = reached.unionByName(step).groupBy("node").agg(F.min("hops").alias("hops"))
    return reached.select(F.lit(start).cast("long").alias("start"), "node", "hops")


#: Tasks that a node's edges are dealt to.
SLOTS = 8


def neighbours(edges: DataFrame) -> DataFrame:
    """``node, n_edges, weight, heaviest`` from both ends of every edge; a node's edges are met in SLOTS tasks first."""
    edges = save(edges, "edges")
    both = edges.select(F.col("src").alias("node"), F.col("dst").alias("other"), "weight").unionAll(edges.select(F.col("dst").alias("node"), F.col("src").alias("other"), "weight"))
    placed = dealt(both.withColumn("_slot", F.pmod(F.xxhash64("other"), F.lit(SLOTS))), "node", "_slot", rows=2 * edges.count())
    best = F.min(F.struct((-F.col("weight")).alias("less"), "other"))
    some = placed.groupBy("node", "_slot").agg(F.count("*").alias("n"), F.sum("weight").alias("w"), best.alias("best"))
    return some.groupBy("node").agg(F.sum("n").alias("n_edges"), F.sum("w").alias("total_weight"), F.min("best").alias("_best")).select("node", "n_edges", "total_weight", F.col("_best.other").alias("heaviest"))


def traverse(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """One hop: ``start, node, hops`` of the frontier to the least number of hops of each new node."""
    step = frontier.join(edges.select(F.col("src").alias("node"), F.col("dst").alias("next")), "node").select("start", F.col("next").alias("node"), (F.col("hops") + 1).alias("hops"))
    return frontier.unionByName(step).groupBy("start", "node").agg(F.min("hops").alias("hops"))
