"""Resolution, reconciliation, as-of matching, rule matching and bag comparison."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexquarry.dealing import dealt, partitions
from lexquarry.scratch import save

#: Rows of the right table in one list, in one band of lists, and pairs made in one cell, on average (:func:`all_pairs`).
LIST, BAND, PAIRS = 500, 10_000, 20_000_000


def resolve_aliases(aliases: DataFrame) -> DataFrame:
    """One entity for each alias: the least (priority, id) of ``alias, priority, kind, id``."""
    first = F.min_by(F.struct("kind", "id"), F.struct("priority", "id"))
    return aliases.groupBy("alias").agg(first.alias("r"), F.count_distinct("kind", "id").alias("n_entities")).select("alias", F.col("r.kind").alias("kind"), F.col("r.id").alias("id"), "n_entities")


def merged(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join in which the left value goes first for columns of both."""
    both = [c for c in left.columns if c in right.columns and c != key]
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    return joined.select(
        F.coalesce(f"a.{key}", f"b.{key}").alias(key),
        *(F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in both),
        *(F.col(f"a.{c}") for c in left.columns if c not in both and c != key),
        *(F.col(f"b.{c}") for c in right.columns if c not in both and c != key),
    )


def sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """``key, n_left, n_right``: rows of each key in the first column of either table; null is a key too, which a join matches with nothing."""
    a = left.select(F.col(left.columns[0]).alias("key"), F.lit(1).alias("l"), F.lit(0).alias("r"))
    b = right.select(F.col(right.columns[0]).alias("key"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    return dealt(a.unionByName(b), "key", rows=left.count() + right.count()).groupBy("key").agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))


def all_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each row of ``left`` with each of ``right``, whose columns have other names; the larger table goes to the left.

    The right rows lie in lists and the lists in bands, the left rows in groups.  A band and a group meet in a cell, which is one task's
    work of a bounded size: there a left row meets lists, and only behind the join a row is made for each pair.
    """
    n, m = left.count(), right.count()
    lists, bands, groups = max(ceil(m / LIST), 1), max(ceil(m / BAND), 1), max(ceil(n * min(m, BAND) / PAIRS), 1)
    dealt_to = lambda df, k: F.pmod(F.xxhash64(*df.columns), F.lit(k))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    rows = right.groupBy(dealt_to(right, lists).alias("_list")).agg(F.collect_list(F.struct(*right.columns)).alias("_rows"))
    rows = save(rows.select(F.pmod("_list", F.lit(bands)).cast("int").alias("_band"), "_rows"), "lists").withColumn("_group", every(groups))
    own = left.withColumn("_group", dealt_to(left, groups).cast("int")).withColumn("_band", every(bands))
    cells = partitions(left, groups * bands, 1)
    met = own.repartition(cells, "_group", "_band").join(rows.repartition(cells, "_group", "_band"), ["_group", "_band"])
    return met.select(*left.columns, F.explode("_rows").alias("_row")).select(*left.columns, "_row.*")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """``left`` with the ``value`` of the last ``right`` row of its key at or before its time.

    Both sides are laid out in ranges of (key, time), written once; inside a range the last row is carried on, and
    what a range ends with is handed to the next ones of the same key, so no task holds a key.  A range's end cuts one
    key at most, so what is handed on is two rows a range at most, and is broadcast.  The last row counts with whatever
    value it has, null too; of rows of one time the greatest value is the last.  Null keys and times match nothing.
    """
    kind = right.schema[value].dataType
    own = left.withColumns({"_side": F.lit(1), "_row": F.lit(None).cast(StructType().add("v", kind))})
    other = right.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, at, F.lit(0).alias("_side"), F.struct(F.col(value).alias("v")).alias("_row"))
    rows = own.unionByName(other, allowMissingColumns=True)
    ranged = save(rows.repartitionByRange(F.col(key), F.col(at), F.col("_side")).withColumn("_span", F.spark_partition_id()), "as-of")
    inside = Window.partitionBy("_span", key).orderBy(F.asc_nulls_first(at), "_side", "_row.v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = ranged.withColumn("_last", F.last("_row", ignorenulls=True).over(inside))
    ends = ranged.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"), F.col("_span").alias("_of")).agg(F.max(F.when(F.col("_side") == 0, F.struct(F.col(at).alias("at"), F.col("_row.v").isNotNull().alias("some"), F.col("_row").alias("row")))).alias("end"))
    cut = Window.partitionBy("_key")
    handed = ends.withColumn("spans", F.count("*").over(cut)).where("spans > 1").withColumn("before", F.last("end.row", ignorenulls=True).over(cut.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)))
    joined = carried.where("_side = 1").join(F.broadcast(handed.select("_key", "_of", "before")), (F.col(key) == F.col("_key")) & (F.col("_span") == F.col("_of")), "left")
    found = F.when(F.col(key).isNotNull() & F.col(at).isNotNull(), F.coalesce("_last", "before")["v"])
    return joined.withColumn(value, found).drop("_side", "_row", "_span", "_last", "_key", "_of", "before")


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str, seconds: int) -> DataFrame:
    """Pairs of rows of equal keys whose intervals [start, end) share a time; columns of ``right`` but the keys get ``_right``.

    Intervals are cut at the ends of bins of so many ``seconds`` (about the length of most of them) and meet in their bins; a pair that meets
    in several counts in the first that both have.  Empty intervals, and null keys, starts and ends match nothing.
    """
    bin_of = lambda c: F.floor(F.unix_seconds(c.cast("timestamp")) / seconds)

    def cut(df: DataFrame) -> DataFrame:
        real = df.where(F.col(start) < F.col(end)).withColumn("_first", bin_of(F.col(start)))
        last = F.greatest("_first", bin_of(F.col(end) - F.expr("INTERVAL 1 MICROSECOND")))
        return real.withColumn("_bin", F.explode(F.sequence(F.col("_first"), last)))

    theirs = right.select(*keys, *(F.col(c).alias(f"{c}_right") for c in right.columns if c not in keys))
    renamed = cut(theirs.withColumnsRenamed({f"{start}_right": start, f"{end}_right": end})).withColumnsRenamed({start: f"{start}_right", end: f"{end}_right", "_first": "_first_right"})
    met = cut(left).join(renamed, [*keys, "_bin"])
    same = (F.col(start) < F.col(f"{end}_right")) & (F.col(f"{start}_right") < F.col(end)) & (F.col("_bin") == F.greatest("_first", "_first_right"))
    return met.where(same).drop("_bin", "_first", "_first_right")


def keyword_rules(df: DataFrame, key: str, normal: Column, rules: dict[str, tuple[tuple[str, ...], float]]) -> DataFrame:
    """``key, tag, hits, weight`` of every rule with a hit; the rules are literals, so no join is needed."""
    from lexquarry.functions.text import contains_term

    found = [
        F.struct(F.lit(tag).alias("tag"), reduce(lambda a, b: a + b, (contains_term(normal, t).cast("long") for t in terms)).alias("hits"), F.lit(weight).alias("weight"))
        for tag, (terms, weight) in rules.items()
    ]
    return df.select(key, F.explode(F.filter(F.array(*found), lambda r: r["hits"] > 0)).alias("r")).select(key, "r.tag", "r.hits", "r.weight")


def bag_difference(old: DataFrame, new: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Items added, removed and shared per key, as bags."""
    a = old.groupBy(*keys, item).agg(F.count("*").alias("a"))
    b = new.groupBy(*keys, item).agg(F.count("*").alias("b"))
    both = a.join(b, [*keys, item], "full_outer").fillna(0, ["a", "b"])
    return both.groupBy(*keys).agg(
        F.sum(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("added"),
        F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("removed"),
        F.sum(F.least("a", "b")).alias("shared"),
    )


def kept_times(now: DataFrame, prior: DataFrame, key: str, digest: str, at: str, fresh: Column) -> DataFrame:
    """``key, at``: the prior time of rows whose digest is what it was, ``fresh`` for all others."""
    old = prior.select(key, F.col(digest).alias("_digest"), F.col(at).alias("_at"))
    return now.join(old, key, "left").select(key, F.when(F.col(digest) == F.col("_digest"), F.col("_at")).otherwise(fresh).alias(at))
