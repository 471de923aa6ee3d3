"""Joining rows to a table with one row for each group, where a few groups may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group of more than one row in so many is dealt to so many parts, so there are fewer such groups than that.
PARTS = 64


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], n: str, how: str = "inner") -> DataFrame:
    """``rows.join(groups, keys, how)``; ``n`` is the column of ``groups`` with the number of rows of each.

    The rows of large groups are dealt over PARTS parts, to each of which their group's row is copied.
    Null keys match nothing, as in any join.
    """
    whole = groups.agg(F.sum(n)).first()[0] or 0
    large = F.broadcast(groups.where(F.col(n) * PARTS > whole).select(*keys, F.lit(PARTS).alias("__parts")))  # fewer than PARTS rows
    parts = F.coalesce("__parts", F.lit(1))
    dealt = rows.join(large, keys, "left").withColumn("__part", F.pmod(F.monotonically_increasing_id(), parts)).drop("__parts")
    copied = groups.join(large, keys, "left").withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long")))).drop("__parts")
    return dealt.join(copied, [*keys, "__part"], how).drop("__part")
