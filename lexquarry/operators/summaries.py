"""Summaries of days that are stored and merged: counts, distinct items, quantiles, heavy items."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexquarry.scratch import drop, save

#: Items whose counts a summary tracks; counts are exact while a group has at most three quarters of so many items.
TRACKED = 4096
#: Registers (as a power of two) of the sketch of distinct items: a standard error of 1.3 %.
REGISTERS = 12
#: Size of the sketch of quantiles: ranks are off by less than 1.7 % with 99 % confidence.
RANKS = 200


def summarise(df: DataFrame, by: Sequence[str], item: str, measure: str) -> DataFrame:
    """A row of mergeable state for each group: ``n``, ``n_values, least, most, total, ranks`` of the measure, ``items, heavy`` of the item.

    Null items, and null or NaN measures, count in ``n`` alone; null is a group too.  Groups are summed up before they are
    shuffled, so a hot one costs no more than any other.
    """
    # an integer's NaN test is on its double
    value = F.when(~F.isnan(F.col(measure).cast("double")), F.col(measure).cast("double"))
    rows = df.select(*by, F.col(item).alias("_item"), value.alias("_value"))
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.count("_value").alias("n_values"), F.min("_value").alias("least"), F.max("_value").alias("most"), F.sum("_value").alias("total"),
        F.kll_sketch_agg_double("_value", RANKS).alias("ranks"), F.hll_sketch_agg("_item", REGISTERS).alias("items"), F.expr(f"approx_top_k_accumulate(_item, {TRACKED})").alias("heavy"),
    )


def _together(state: DataFrame, by: Sequence[str]) -> DataFrame:
    merged = state.groupBy(*by).agg(
        *(F.sum(c).alias(c) for c in ("n", "n_values")), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("total").alias("total"),
        F.collect_list("ranks").alias("ranks"), F.hll_union_agg("items").alias("items"), F.expr(f"approx_top_k_combine(heavy, {TRACKED})").alias("heavy"),
    )
    rest = F.slice("ranks", 2, F.greatest(F.size("ranks") - 1, F.lit(0)))
    return merged.withColumn("ranks", F.aggregate(rest, F.get("ranks", F.lit(0)), lambda a, b: F.kll_sketch_merge_double(a, b)))


def merged(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The state of coarser groups, in the same columns; no state gives no row.

    Only stored rows are read, a few kilobytes each.  They are merged in two steps of about the square root of their
    number, so that no task holds more than that of sketches at once.
    """
    parts = math.isqrt(state.count()) + 1
    dealt = state.withColumn("_part", F.pmod(F.xxhash64(*(c for c, t in state.dtypes if not t.startswith("struct"))), F.lit(parts)))
    return _together(_together(dealt, [*by, "_part"]).drop("_part"), by).where("n > 0")


def add_days(df: DataFrame, folder: str, day: str, by: Sequence[str], item: str, measure: str, late: bool = False) -> None:
    """Summarise the days of ``df`` into ``folder``, a part for each day; no other day is read or written.

    ``df`` holds whole days, and a day that is there already is replaced, so a batch that is sent again does no harm.
    With ``late``, its rows are added to what is there of their days.  Rows without a day are refused.
    """
    spark = df.sparkSession
    new = save(summarise(df, [day, *by], item, measure), "summary")
    if not new.where(F.col(day).isNull()).isEmpty():
        raise ValueError(f"rows without {day}")
    put = new
    if late:
        days = [r[0] for r in new.select(day).distinct().collect()]  # of one batch
        held = stored(spark, folder, new)
        if held is not None:
            old = held.where(F.col(day).isin(*days)).select(*new.columns)
            put = save(_together(old.unionByName(new), [day, *by]), "summary")
    put.repartition(day).write.partitionBy(day).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(folder)
    drop(new, *([put] if put is not new else []))


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def stored(spark: SparkSession, folder: str, like: DataFrame | None = None) -> DataFrame | None:
    """The stored state of all days (None where nothing is stored), with the columns of ``like`` if given."""
    if not _exists(spark, folder):
        return None
    return (spark.read.schema(like.schema) if like is not None else spark.read).parquet(folder)


def estimates(state: DataFrame, quantiles: Sequence[float] = (0.5,), k: int = 10) -> DataFrame:
    """What the state says: ``n_items``, ``quantiles`` (null without values) and the ``k`` items of the highest ``counts``, in place of the sketches."""
    at = F.array(*(F.kll_sketch_get_quantile_double("ranks", F.lit(float(q))) for q in quantiles))
    return state.select(
        *(c for c in state.columns if c not in ("ranks", "items", "heavy")), F.hll_sketch_estimate("items").alias("n_items"),
        F.when(F.col("n_values") > 0, at).alias("quantiles"), F.expr(f"approx_top_k_estimate(heavy, {k})").alias("counts"),
    )
