"""Coverage, duplicates, histograms and constraint reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.dealing import dealt
from lexquarry.functions.scoring import coverage_label
from lexquarry.functions.text import populated


def field_coverage(df: DataFrame) -> DataFrame:
    """``field, populated, missing, ratio`` of every column, in one pass."""
    counts = df.agg(F.count("*").alias("_n"), *(F.count_if(populated(c)).alias(c) for c in df.columns))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("populated")) for c in df.columns))).alias("r")
    return counts.select("_n", rows).select(
        "r.field", "r.populated", (F.col("_n") - F.col("r.populated")).alias("missing"), F.round(F.col("r.populated") / F.greatest(F.col("_n"), F.lit(1)), 4).alias("ratio")
    )


def edge_coverage(edges: DataFrame, group: str, source: str, target: str, confidence: str, kind: str) -> DataFrame:
    """Per group of edges: rows, ends, low confidence, duplicates, mean confidence and the commonest kind.

    Distinct edges and ends are found in partitions whose size stays; what is left is a few rows a group.
    """
    n = edges.count()
    sums = edges.groupBy(group, kind).agg(F.count("*").alias("m"), F.sum(confidence).alias("total"), F.count_if(F.col(confidence) < 0.05).alias("low"))
    sums = sums.groupBy(group).agg(F.sum("m").alias("rows"), F.sum("low").alias("low_confidence"), F.sum("total").alias("total"), F.min_by(kind, F.struct(-F.col("m"), kind)).alias("modal_kind"))
    once = dealt(edges.select(group, source, target, kind), source, target, rows=n).distinct().groupBy(group).agg(F.count("*").alias("once"))
    ends = [dealt(edges.select(group, c), c, rows=n).distinct().groupBy(group).agg(F.count(c).alias(name)) for c, name in ((source, "sources"), (target, "targets"))]
    found = sums.join(once, group).join(ends[0], group).join(ends[1], group)
    found = found.select(
        group,
        "rows",
        "sources",
        "targets",
        "low_confidence",
        (F.col("rows") - F.col("once")).alias("duplicates"),
        F.round(F.col("total") / F.col("rows"), 4).alias("mean_confidence"),
        "modal_kind",
    )
    return found.withColumn("label", coverage_label(F.col("rows"), F.lit(0), F.col("low_confidence")))


def duplicate_groups(df: DataFrame, value: Column, row: str) -> DataFrame:
    """Values that occur more than once: number, the row kept (the last) and the excess."""
    return (
        df.groupBy(value.alias("value")).agg(F.count("*").alias("n"), F.max(row).alias("kept"), F.min(row).alias("first")).where("n > 1").withColumn("excess", F.col("n") - 1)
    )


def issues(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """``key, issue`` for every check that holds; null counts as not holding."""
    found = F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in checks.items()))
    return df.select(key, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("issue"))
