"""Partitions whose size stays while tables grow."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame

#: Rows of a partition, on average.
ROWS = 500_000


def partitions(df: DataFrame, rows: int, each: int | None = None) -> int:
    """So many partitions that ``rows`` rows make about ``each`` (ROWS) in one, and no fewer than the session's shuffles have."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(rows / (each or ROWS)))


def dealt(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """``df`` by ``keys`` over :func:`partitions`; joins and groups by all of the keys and more shuffle it no further.

    Without ``rows`` they are counted, which is cheap for a table as it lies in its files.  A shuffle that Spark plans has a fixed
    number of partitions, so that the sorts and hash maps of one task would grow with the table.
    """
    return df.repartition(partitions(df, df.count() if rows is None else rows), *keys)
