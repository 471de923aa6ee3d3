"""A Bloom filter over hashed keys that spares rows a shuffle."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

#: 1 MB on each worker, whatever the input.
BITS = 23


def may_hold(keys: DataFrame, key: str) -> Callable[[Column | str], Column]:
    """A test of 64-bit hashes that is true for every one of ``keys``, and false for most others while they are fewer than its bits.

    It only saves work; what it lets pass is joined exactly.
    """
    bit = F.shiftrightunsigned(key, 64 - BITS)
    words = keys.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{key}`, {64 - BITS}) & 63 as int))")).alias("bits"))
    held = np.zeros(1 << (BITS - 6), np.int64)  # the rows below are at most this many
    for word, bits in words.collect():
        held[word] = bits
    shared = keys.sparkSession.sparkContext.broadcast(held.view(np.uint64))

    def test(h: pd.Series) -> pd.Series:
        at = h.to_numpy().view(np.uint64) >> np.uint64(64 - BITS)
        return pd.Series((shared.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1)

    return F.pandas_udf(test, BooleanType())


def without_keys(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``rows.join(gone, key, "left_anti")`` in which only rows that may go are shuffled.

    Both tables are read twice: ``gone`` should be a saved one.
    """
    among = may_hold(gone, key)
    return rows.where(~among(key)).unionByName(rows.where(among(key)).join(gone, key, "left_anti"))
