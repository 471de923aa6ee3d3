"""Whole records of entities, nested from tables that lie in the same buckets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.operators.ranking import numbered
from lexquarry.scratch import drop, save, save_bucketed

#: Children of one kind in one record; an entity with more has further pages.
PAGE = 1000


@dataclass(frozen=True)
class Details:
    """The tables of :func:`build_details`, all bucketed by ``record``: key, stroke and number of the page; columns of each kind."""

    key: str
    spine: DataFrame
    children: dict[str, DataFrame]
    columns: dict[str, list[str]]


def two_ways(relations: DataFrame, entities: DataFrame, key: str, title: list[str]) -> DataFrame:
    """``key, direction, relationship, related`` and the other end's ``title`` columns, a row for each end of a relation.

    ``relations`` has ``src, relationship, dst``; repeated ones count once, and those without an end are left out.  The
    first title column falls back to the other end's key where ``entities`` does not know it, the others to null.
    """
    known = relations.select("src", "relationship", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    out = known.select(F.col("src").alias(key), F.lit("outbound").alias("direction"), "relationship", F.col("dst").alias("related"))
    back = known.select(F.col("dst").alias(key), F.lit("inbound").alias("direction"), "relationship", F.col("src").alias("related"))
    ends = entities.groupBy(F.col(key).alias("related")).agg(F.min(F.struct(*title)).alias("_end"))
    joined = out.unionByName(back).join(ends, "related", "left")
    first, *rest = title
    named = [F.coalesce(F.col("_end")[first], F.col("related").cast("string")).alias(f"related_{first}"), *(F.col("_end")[c].alias(f"related_{c}") for c in rest)]
    return joined.select(key, "direction", "relationship", "related", *named)


def _record(key: str, page) -> F.Column:
    return F.concat_ws("/", F.col(key).cast("string"), page.cast("string"))


def build_details(entities: DataFrame, key: str, children: dict[str, tuple[DataFrame, list[str]]]) -> Details:
    """Write entities and their children in buckets, once, for many reads of :func:`records`.

    ``children`` gives for each kind a table with a column ``key`` and the columns of its order (ties go by the
    other columns).  Each entity has as many pages as its longest kind needs, of PAGE children of a kind each, at least one:
    so an entity that owns a third of all rows is many records in many buckets.  Of repeated entities the least row
    counts; null keys, and children of no entity, are left out.
    """
    tables, fields, pages = {}, {}, None
    for kind, (df, order) in children.items():
        fields[kind] = [c for c in df.columns if c != key]
        first = [c for c in order if c != key]
        item = F.struct(*(F.col(f"`{c}`") for c in first + [c for c in fields[kind] if c not in first])).alias("item")  # sorts as the order says
        bare = save(df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), item), "child")
        large = save(bare.groupBy("_key").agg(F.ceil(F.count("*") / PAGE).alias("_pages")).where("_pages > 1"), "large")
        names = F.broadcast(large.select("_key"))  # one row for PAGE children at most
        rows = bare.join(names, "_key", "left_anti").select(_record("_key", F.lit(0)).alias("record"), "item")
        if not large.isEmpty():  # only these have to be numbered
            placed = numbered(bare.join(names, "_key", "left_semi"), "_key", F.col("item"))
            rows = rows.unionByName(placed.select(_record("_key", F.floor((F.col("rank") - 1) / PAGE)).alias("record"), "item"))
        tables[kind] = save_bucketed(rows, ["record"], label="detail")
        drop(bare)
        own = large.select(F.col("_key").alias(key), "_pages")
        pages = own if pages is None else pages.unionByName(own)
    columns = [c for c in entities.columns if c != key]
    once = entities.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*(F.col(f"`{c}`") for c in columns))).alias("entity"))
    if pages is not None:
        once = once.join(pages.groupBy(key).agg(F.max("_pages").alias("_pages")), key, "left")
    else:
        once = once.withColumn("_pages", F.lit(1).cast("long"))
    n = F.coalesce("_pages", F.lit(1).cast("long"))
    spread = once.select(key, "entity", n.alias("n_pages"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("page"))
    spine = save_bucketed(spread.select(_record(key, F.col("page")).alias("record"), key, "page", "n_pages", "entity"), ["record"], label="detail")
    return Details(key, spine, tables, fields)


def records(details: Details, asked: tuple[str, int] | None = None) -> DataFrame:
    """``key, page, n_pages, entity`` and an array of structs for each kind of children, in their order (none: empty).

    No shuffle: all tables lie in buckets of the same column.  With ``asked``, a key and a page, only the buckets of that
    record are read.
    """
    spine, tables = details.spine, details.children
    if asked is not None:
        name = f"{asked[0]}/{asked[1]}"
        spine, tables = spine.where(F.col("record") == name), {k: df.where(F.col("record") == name) for k, df in tables.items()}
    for kind, df in tables.items():
        nested = df.groupBy("record").agg(F.transform(F.array_sort(F.collect_list("item")), lambda x: F.struct(*(x[c].alias(c) for c in details.columns[kind]))).alias(kind))
        spine = spine.join(nested, "record", "left").withColumn(kind, F.coalesce(kind, F.array().cast(nested.schema[kind].dataType)))
    return spine.drop("record")
