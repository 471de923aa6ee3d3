"""Sharding by sampled splitters, with shards of nearly equal bytes.

Rows are ordered by (text hash, doc_id, row), which keeps equal texts together.
Keys are sampled with a chance proportional to their size, splitters are the
sample's weighted quantiles, and rows are dealt to the ranges between them.
Ranges that turn out overfull are sampled again and subdivided; as the row is
the last part of the key, a range of equal texts can be subdivided too.  The
exact bytes of all ranges (a bounded table) then give every range its place in
the global order, and a running sum inside each range gives every row its shard.

The law is ``bytes``: a shard's bytes differ from the mean by less than the
largest row.

Defined cases: a null text has no bytes and the checksum of the empty text; a
null doc_id sorts as -1; repeated rows are separate rows; an empty table gives
an empty result; only the id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.scratch import save

SHARDS = 24
ROWS_PER_RANGE = 20_000
LEAST_RANGES, MOST_RANGES = 256, 65_536
SAMPLES_PER_RANGE = 24
ROUNDS = 4

_RESULT = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"


def _packed(*parts: np.ndarray) -> np.ndarray:
    """Keys as bytes that sort like the tuples of signed longs."""
    flipped = [p.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for p in parts]
    whole = np.stack(flipped, axis=1).astype(">u8")  # after stacking, which gives the machine's own byte order
    return np.ascontiguousarray(whole).view(f"S{8 * len(parts)}").ravel()


def _range_of(splitters: np.ndarray) -> Column:
    """The number of splitters at or below a row's key."""

    @F.pandas_udf("int")
    def place(h: pd.Series, tie: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, _packed(h.to_numpy(), tie.to_numpy(), row.to_numpy()), "right").astype(np.int32))

    return place("h", "tie", "row")


def _sample(rows: DataFrame, total: int, count: int) -> list[tuple[bytes, float]]:
    """About ``count`` keys (at most twice that in expectation), with the bytes each stands for, in order."""
    step = max(total / max(count, 1), 1.0)
    draw = F.shiftrightunsigned(F.xxhash64("row", "h", F.lit(41)), 11) / float(1 << 53)
    got = rows.where(draw < F.col("size") / step).select("h", "tie", "row", "size").collect()
    if not got:
        return []
    keys = _packed(*(np.array([r[i] for r in got], dtype=np.int64) for i in range(3)))
    weights = np.maximum(np.array([r[3] for r in got], dtype=float), step)
    order = np.argsort(keys)
    return list(zip(keys[order].tolist(), weights[order].tolist(), strict=True))


def _quantiles(sample: list[tuple[bytes, float]], parts: int) -> list[bytes]:
    if not sample or parts < 2:
        return []
    run = np.cumsum([w for _, w in sample])
    return sorted({sample[min(bisect_left(run, run[-1] * k / parts), len(sample) - 1)][0] for k in range(1, parts)})


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    thin = save(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("tie"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "thin",
    )
    total, count = thin.agg(F.sum("size"), F.count("*")).first()
    if not count:
        return spark.createDataFrame([], _RESULT)
    ranges = int(min(max(LEAST_RANGES, count // ROWS_PER_RANGE), MOST_RANGES))
    splitters = _quantiles(_sample(thin, total, ranges * SAMPLES_PER_RANGE), ranges)
    share = total / ranges
    for _ in range(ROUNDS):
        array = np.array(splitters, dtype="S24")
        placed = thin.withColumn("part", _range_of(array)) if splitters else thin.withColumn("part", F.lit(0))
        held = {r[0]: (r[1], r[2]) for r in placed.groupBy("part").agg(F.sum("size"), F.count("*")).collect()}
        over = [p for p, (size, n) in held.items() if size > 2 * share and n > 1]
        if not over:
            break
        inside = placed.where(F.col("part").isin(over))
        size = sum(held[p][0] for p in over)
        more = _sample(inside, size, int(size / share * 2 * SAMPLES_PER_RANGE))
        by_part: dict[int, list[tuple[bytes, float]]] = {}
        for part, pair in zip(np.searchsorted(array, np.array([k for k, _ in more], dtype="S24"), "right"), more, strict=True):
            by_part.setdefault(int(part), []).append(pair)
        added = {k for p, s in by_part.items() for k in _quantiles(s, int(held[p][0] / share) + 1)}
        if added <= set(splitters):
            break
        splitters = sorted(set(splitters) | added)
    offsets, at, row = [], 0, 0
    for part in sorted(held):
        offsets.append((part, at, row))
        at, row = at + held[part][0], row + held[part][1]
    places = spark.createDataFrame(offsets, "part int, bytes_before long, rows_before long")
    order = Window.partitionBy("part").orderBy("h", "tie", "row")
    before = F.col("bytes_before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    dealt = save(
        placed.join(F.broadcast(places), "part")  # at most a few times MOST_RANGES rows
        .withColumn("before", before)
        .withColumn("place", F.col("rows_before") + F.row_number().over(order) - 1)
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"(before + size div 2) * {shards} div {total}")).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "place"),
        "dealt",
    )
    first = dealt.groupBy("shard").agg(F.min("place").alias("first"))
    return dealt.join(F.broadcast(first), "shard").select(  # one row per shard
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
