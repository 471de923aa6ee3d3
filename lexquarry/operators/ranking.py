"""Latest, best and top rows per key, samples and budgets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.scratch import save


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The row of each key with the greatest ``order``; partial maxima are taken before the shuffle."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return best.select(key, *(F.col("row")[c].alias(c) for c in rest))


def first_and_latest(df: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """Each key's first and latest value and number of rows."""
    at = F.struct(*order)
    return df.groupBy(key).agg(F.min_by(value, at).alias(f"first_{value}"), F.max_by(value, at).alias(f"latest_{value}"), F.count("*").alias("n"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of an order (each task keeps k rows)."""
    return df.orderBy(*order).limit(k)


def diversified(df: DataFrame, group: str, score: str, tie: str, k: int) -> DataFrame:
    """Top ``k`` rows, each group's best row going first; null is a group too."""
    best = df.groupBy(F.col(group).alias("_group")).agg(F.max_by(tie, F.struct(F.col(score), -F.col(tie))).alias("best"))
    marked = df.join(best, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    return top_k(marked.withColumn("leads", (F.col(tie) == F.col("best")).cast("int")).drop("best"), k, F.desc("leads"), F.desc(score), F.col(tie))


def relevance_buckets(df: DataFrame, score: str, tie: str, k: int = 20) -> DataFrame:
    """Top ``k`` rows: the first fifth is high, up to three fifths medium, the rest low."""
    top = top_k(df, k, F.desc(score), F.col(tie))
    whole = Window.partitionBy(F.lit(1))  # k rows
    n, rank = F.count("*").over(whole), F.row_number().over(whole.orderBy(F.desc(score), tie))
    bucket = F.when(rank <= F.ceil(n * 0.2), "high").when(rank <= F.ceil(n * 0.6), "medium").otherwise("low")
    return top.withColumn("rank", rank.cast("long")).withColumn("bucket", bucket)


def numbered(df: DataFrame, group: str, *order: Column) -> DataFrame:
    """``df`` with each row's ``rank`` in its group's order and the group's size ``n``; null is a group too.

    Ranks come from sorting ranges of the order and adding up the ranges' sizes, so no task holds a group.
    The ranges are written once: two reads of an unsaved range exchange may sample different bounds.
    """
    ranged = save(df.repartitionByRange(F.col(group), *order).withColumn("__span", F.spark_partition_id()), "ranged")
    rows = ranged.withColumn("__at", F.row_number().over(Window.partitionBy("__span", group).orderBy(*order)))
    sizes = ranged.groupBy(F.col(group).alias("__group"), F.col("__span").alias("__of")).agg(F.count("*").alias("__size"))
    before = Window.partitionBy("__group").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__group", "__of", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"), F.sum("__size").over(Window.partitionBy("__group")).alias("n"))
    joined = rows.join(starts, (F.col("__span") == F.col("__of")) & F.col(group).eqNullSafe(F.col("__group")))
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), (F.col("__start") + F.col("__at")).alias("rank"), "n")


def stride_sample(df: DataFrame, group: str, order: str, target: int) -> DataFrame:
    """``target`` rows of each group at even strides of its order."""
    step = F.greatest(F.lit(1), F.floor(F.col("n") / target))
    placed = numbered(df, group, F.col(order))
    return placed.where(((F.col("rank") - 1) % step == 0) & ((F.col("rank") - 1) / step < target)).drop("n")


def budget_pick(df: DataFrame, group: str, order: str, cost: str, budget: int) -> DataFrame:
    """Rows of each group taken in order while they fit the budget; those that do not fit are skipped, not the end.

    Ties in the order go by cost; null is a group too; a row without a cost is not kept.  The rule is greedy, so
    a group is read in one task, but as a stream: only what is left of its budget is held, whatever its size.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = budget
        for batch in batches:
            kept = []
            for opens, x in zip(batch.column("_opens").to_pylist(), batch.column(cost).to_pylist(), strict=True):
                left = budget if opens else left
                fits = x is not None and x <= left
                kept.append(fits)
                left -= x if fits else 0
            columns = [c for c in batch.schema.names if c != "_opens"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(kept, pa.bool_())], names=[*columns, "kept"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", kept boolean"
    opens = F.row_number().over(Window.partitionBy(group).orderBy(order, cost)) == 1  # its sort is the order in which rows stream on
    return df.withColumn("_opens", opens).mapInArrow(pick, schema)
