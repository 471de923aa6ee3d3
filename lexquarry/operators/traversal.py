"""Walks along the edges of a graph that keep their paths."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.dealing import partitions
from lexquarry.scratch import drop, save_bucketed

#: Edges of a node that lie in one block, on average.
FANOUT = 1000
#: Ends that one task compares in a round, on average.
PAIRS = 1_000_000


def link_table(edges: DataFrame, relationships: Sequence[str] | None = None, ready: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The edges to walk, written once: a table bucketed by src or by (src, block), and ``src, blocks`` of the nodes with several blocks.

    ``edges`` has ``src, relationship, dst``; ends may not be null, and repeated edges count once.  Only the
    ``relationships`` named (all, if None) and ends that ``ready`` lists in its first column (all, if None) are kept.
    A node of many edges has them in blocks of FANOUT or so, and every edge says how many blocks its end has, so that
    a walk knows the blocks to ask without another join.  Where no node has several, edges stay in their buckets of src.
    """
    n = partitions(edges, edges.count())
    kept = edges.select("src", "relationship", "dst").where("src IS NOT NULL AND dst IS NOT NULL")
    if relationships is not None:
        kept = kept.where(F.col("relationship").isin(*relationships))
    if ready is not None:
        kept = kept.join(ready.select(F.col(ready.columns[0]).alias("dst")).distinct(), "dst", "left_semi")
    # repeated edges are dropped where they lie in their buckets, and need no shuffle of their own
    once = save_bucketed(kept.repartition(n, "src").distinct(), ["src"], n, label="edges")
    several = save_bucketed(once.groupBy("src").agg(F.ceil(F.count("*") / FANOUT).alias("blocks")).where("blocks > 1"), ["src"], label="hubs")
    if several.isEmpty():
        return once.select("src", F.lit(0).cast("long").alias("block"), "relationship", "dst", F.lit(1).cast("long").alias("dst_blocks")), several
    hubs = F.broadcast(several)  # one row for FANOUT edges at most
    own = F.pmod(F.xxhash64("dst", "relationship"), F.coalesce("blocks", F.lit(1)))
    ends = F.broadcast(several.select(F.col("src").alias("dst"), F.col("blocks").alias("dst_blocks")))
    placed = once.join(hubs, "src", "left").select("src", own.alias("block"), "relationship", "dst").join(ends, "dst", "left")
    links = save_bucketed(placed.select("src", "block", "relationship", "dst", F.coalesce("dst_blocks", F.lit(1)).alias("dst_blocks")), ["src", "block"], n, label="links")
    drop(once)
    return links, several


def listed(links: DataFrame, hubs: DataFrame, n: int) -> DataFrame:
    """The links of a block and relationship as one row, written in n buckets as they lie: ``dst`` is a sorted list of FANOUT ends or so."""
    lists = links.groupBy("src", "block", "relationship").agg(F.sort_array(F.collect_list("dst")).alias("dst"))
    if hubs.isEmpty():
        return save_bucketed(lists.drop("block"), ["src"], n, label="lists").withColumns({"block": F.lit(0).cast("long"), "dst_blocks": F.lit(None)})
    return save_bucketed(lists, ["src", "block"], n, label="lists").withColumn("dst_blocks", F.lit(None))


def step(frontier: DataFrame, links: DataFrame) -> DataFrame:
    """What lies one edge beyond ``frontier`` (``start, node, blocks, path, relationships``); only the frontier is shuffled.

    ``path`` is here what lies between start and node, for a row to hold neither of them twice on its way.  Of links
    that are :func:`listed`, ``node`` is the list of ends.
    """
    asked = frontier.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = asked.join(links, (asked["node"] == links["src"]) & (asked["block"] == links["block"]))
    return met.select("start", F.col("dst").alias("node"), F.col("dst_blocks").alias("blocks"), "path", F.concat("relationships", F.array("relationship")).alias("relationships"))


def _first(met: DataFrame, found: Sequence[DataFrame], heavy: DataFrame, ends: int, name: Callable[[Column], Column], shown: Callable[[Column], Column]) -> DataFrame:
    """``start, slice, slices, node`` and what ``shown`` takes from ``path, names, relationships``: each pair that ``met`` lists and no round has found, by its first path.

    Lists go to their starts as they are, and their ends are compared there: the paths of a start are numbered in their order, and
    the least number of each end says its path.  The ends of a ``heavy`` start are dealt to slices of PAIRS at most, or so.
    """
    names = F.transform("path", name)
    new = met.select("start", "node", "path", "relationships")
    known = [df.select("start", F.array("node").alias("node"), F.lit(None).cast(new.schema["path"].dataType).alias("path"), F.lit(None).cast(new.schema["relationships"].dataType).alias("relationships")) for df in found]
    slices = F.coalesce("slices", F.lit(1).cast("long"))
    cut = reduce(DataFrame.unionByName, known, new).join(F.broadcast(heavy), "start", "left").withColumn("slices", slices).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    part = F.when(F.col("slices") == 1, F.col("node")).otherwise(F.filter("node", lambda x: F.pmod(F.xxhash64(x), F.col("slices")) == F.col("slice")))
    sent = cut.withColumn("node", part).where("size(node) > 0").repartition(partitions(met, ends, PAIRS), "start", "slice")
    order = Window.partitionBy("start", "slice").orderBy(F.col("path").isNull(), "names", "relationships")
    ranked = sent.withColumn("names", names).withColumn("nth", F.when(F.col("path").isNull(), 0).otherwise(F.row_number().over(order)))
    least = ranked.select("start", "slice", "slices", "nth", F.explode("node").alias("node")).groupBy("start", "slice", "slices", "node").agg(F.min("nth").alias("nth")).where("nth > 0")
    # both sides read one shuffle: this one asks for the lists and the number of slices too
    rows = ranked.where((F.col("nth") > 0) & (F.size("node") + F.col("nth") + F.col("slices") > 0))
    rows = rows.groupBy("start", "slice").agg(F.transform(F.sort_array(F.collect_list(F.struct("names", "relationships", "path"))), shown).alias("rows"))
    return least.join(rows.hint("shuffle_hash"), ["start", "slice"]).withColumn("row", F.element_at("rows", F.col("nth"))).select("start", "slice", "slices", "node", "row.*")


def paths(
    starts: DataFrame, edges: DataFrame, most: int, relationships: Sequence[str] | None = None, ready: DataFrame | None = None, name: Callable[[Column], Column] | None = None, joined: str | None = None
) -> DataFrame:
    """``start, node, hops, path, relationships`` of every node within ``most`` edges of each start, by its first path.

    The first path has the fewest edges; of those, the least nodes in order, then the least relationships.  ``path``
    holds all nodes from start to node, ``relationships`` those of its edges; a start reaches itself by no edge.
    A path never comes back to a node of its own, since each round keeps only pairs of start and node that are new,
    and only those go on.  ``starts`` is a table whose first column holds nodes (null: dropped, repeated: once); it need
    not be in ``edges``, nor in ``ready``.  No start or no edge gives no row or the starts alone.  With a ``name``, nodes
    are ordered and returned by it, so that the walk itself can run over short codes.  With ``joined``, path and relationships
    are strings joined by it.

    Edges are bucketed once (:func:`link_table`).  Each round's new rows but the last's are written in buckets of their node, which is how
    the next round meets their edges.  The result has a row for each pair; what is shuffled is a list of ends for each path.
    """
    links, hubs = link_table(edges, relationships, ready)
    n = partitions(edges, edges.count())
    lists = listed(links, hubs, n)
    name = name or (lambda node: node)
    kind = dict(links.dtypes)
    most_blocks = PAIRS / FANOUT
    several = F.broadcast(hubs.select(F.col("src").alias("node"), "blocks"))
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    begin = starts.select(F.col(starts.columns[0]).cast(kind["src"]).alias("start")).where("start IS NOT NULL").distinct().withColumn("node", F.col("start")).join(several, "node", "left")
    none = [F.array().cast(f"array<{kind[c]}>").alias(as_) for c, as_ in (("src", "path"), ("relationship", "relationships"))]
    found = [save_bucketed(begin.select("start", "node", blocks.alias("blocks"), *none, (blocks > most_blocks).alias("heavy")), ["node"], n, label="reached")]
    text = lambda c: c if joined is None else F.array_join(c, joined)
    # what lies before the node, so that a row of the last round only adds its own
    lead = lambda start, names: F.concat(F.array(name(start)), names) if joined is None else F.concat(text(F.concat(F.array(name(start)), names)), F.lit(joined))
    last = []
    for k in range(most):
        # the inner nodes of the frontier's paths end with its own node, but for the starts themselves
        inner = F.concat("path", F.array("node")) if k else F.col("path")
        met = step(found[-1].withColumn("path", inner), lists)
        ends = met.agg(F.coalesce(F.sum(F.size("node")), F.lit(0))).first()[0]
        heavy = found[-1].where("heavy").groupBy("start").agg(F.ceil(F.sum("blocks") / most_blocks).alias("slices"))
        if k + 1 == most:  # no round looks these up, so they are not written
            shown = lambda r: F.struct(name(F.col("start")).alias("from"), lead(F.col("start"), r["names"]).alias("lead"), text(r["relationships"]).alias("relationships"))
            last = [(k + 1, _first(met, found, heavy, ends, name, shown))]
            break
        new = _first(met, found, heavy, ends, name, lambda r: F.struct(r["path"].alias("path"), r["relationships"].alias("relationships")))
        load = F.sum("blocks").over(Window.partitionBy("start", "slice"))
        new = new.join(several, "node", "left").withColumn("blocks", blocks).withColumn("heavy", (F.col("slices") > 1) | (load > most_blocks))
        found.append(save_bucketed(new.select("start", "node", "blocks", "path", "relationships", "heavy"), ["node"], n, label="reached"))
        if found[-1].isEmpty():
            break
    drop(hubs)
    saved = [(k, df.select("node", name(F.col("start")).alias("from"), lead(F.col("start"), F.transform("path", name)).alias("lead"), text(F.col("relationships")).alias("relationships"))) for k, df in enumerate(found)]
    ending = lambda k: (F.concat("lead", F.array("end") if joined is None else F.col("end")) if k else text(F.array("from"))).alias("path")
    rows = (df.withColumn("end", name(F.col("node"))).select(F.col("from").alias("start"), F.col("end").alias("node"), F.lit(k).cast("long").alias("hops"), ending(k), "relationships") for k, df in saved + last)
    return reduce(DataFrame.unionByName, rows)
