"""Benchmark decontamination by winnowing.

From every 7 consecutive 7-word grams the one with the least hash is kept
(the last one on ties), on both sides.  Any shared span of 7 + 7 - 1 = 13 words
covers one whole winnowing window, so it has a kept gram in common at the same
place; joining the fingerprints and extending each hit by up to six words either
way finds every shared 13-word window.  Items shorter than 13 words are looked
up as one gram of their own length.

A Bloom filter of the item fingerprints (``BLOOM_BITS`` bits, whatever the input)
goes to the workers so that only fingerprints that may match are shuffled.  It
only saves work: the join behind it is exact.

Defined cases: null or wordless texts have no words and are never hit; items
without words occur nowhere; repeated document rows each get their own result;
rows of one item_id count as one item, and a null item_id is spelled ``null``;
only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.llm import _text as tx
from lexquarry.llm._bloom import without_keys
from lexquarry.scratch import save

SPAN = 13
GRAM = 7
BLOOM_BITS = 23

_ITEM = "item string, key long, lead int, size int, around array<long>"
_DOC = "key long, doc_id long, n_words long, prints array<struct<print:long,at:long,lead:int,around:array<long>>>"


def winnow(hashes: np.ndarray, first: np.ndarray, row: np.ndarray, window: int) -> np.ndarray:
    """Indexes of the grams that are least in some window of their row, last on ties."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(n)
    for j in range(1, window):
        other = np.arange(j, n + j)
        best = np.where(hashes[other] <= hashes[best], other, best)
    whole = row[first[:n]] == row[first[window - 1 :]]
    return np.unique(best[whole])


def _around(words: tx.Words, at: np.ndarray, before: int, after: int) -> tuple[pa.Array, np.ndarray]:
    """Word hashes from ``before`` words ahead of ``at`` to ``after`` from it, within the row."""
    begin = np.concatenate([[0], np.cumsum(words.per_row)])
    row = words.row[at]
    lo, hi = np.maximum(at - before, begin[row]), np.minimum(at + after, begin[row + 1])
    counts = hi - lo
    total = np.concatenate([[0], np.cumsum(counts)])
    take = np.arange(total[-1]) + np.repeat(lo - total[:-1], counts)
    return tx.list_array(tx.signed(words.hash[take]), counts), (at - lo).astype(np.int32)


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j in tx.slices(batch.column("text")):
            part = batch.slice(i, j - i)
            words = tx.scan(part.column("text"), tx.ALNUM)
            out = []
            hashes, first = tx.grams(words, GRAM)
            kept = winnow(hashes, first, words.row, SPAN - GRAM + 1)
            out.append((hashes[kept], first[kept], GRAM))
            for size in range(1, SPAN):
                hashes, first = tx.grams(words, size)
                own = words.per_row[words.row[first]] == size
                out.append((hashes[own], first[own], size))
            for hashes, first, size in out:
                around, lead = _around(words, first, SPAN - GRAM if size == GRAM else 0, SPAN if size == GRAM else size)
                short = words.per_row[words.row[first]] < SPAN
                item = part.column("item").take(pa.array(words.row[first]))
                tagged = np.where(short, size, 0).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [item, pa.array(tx.signed(hashes)), pa.array(lead), pa.array(tagged), around],
                    names=["item", "key", "lead", "size", "around"],
                )


def _doc_prints(bits: np.ndarray, sizes: list[int]):
    def may_match(hashes: np.ndarray) -> np.ndarray:
        bit = hashes >> np.uint64(64 - BLOOM_BITS)
        return (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

    def matching(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = may_match(hashes)
        return hashes[ok], first[ok]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in tx.slices(batch.column("text")):
                part = batch.slice(i, j - i)
                words = tx.scan(part.column("text"), tx.ALNUM)
                hashes, first = tx.grams(words, GRAM)
                kept = winnow(hashes, first, words.row, SPAN - GRAM + 1)
                found = [matching(hashes[kept], first[kept])]
                found += [matching(*tx.grams(words, size)) for size in sizes]
                h, at = np.concatenate([h for h, _ in found]), np.concatenate([a for _, a in found])
                order = np.argsort(at, kind="stable")
                h, at = h[order], at[order]
                around, lead = _around(words, at, SPAN - GRAM, SPAN)
                begin = np.concatenate([[0], np.cumsum(words.per_row)])
                prints = pa.StructArray.from_arrays(
                    [pa.array(tx.signed(h)), pa.array(at - begin[words.row[at]]), pa.array(lead), around],
                    names=["print", "at", "lead", "around"],
                )
                counts = np.bincount(words.row[at], minlength=len(part))
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("doc_id"), pa.array(words.per_row), pa.ListArray.from_arrays(offsets, prints)],
                    names=["key", "doc_id", "n_words", "prints"],
                )

    return run


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grow each hit to the longest common run and keep runs of a window or more."""
    for batch in batches:
        rows, starts, ends, items = [], [], [], []
        for r in batch.to_pylist():
            a, b, i, j, size = r["around"], r["its_around"], r["lead"], r["its_lead"], r["size"]
            if size:
                whole = len(b) == size and a[i : i + size] == b
                low, high = 0, size if whole else 0
            else:
                low = 0
                while low < min(i, j) and a[i - low - 1] == b[j - low - 1]:
                    low += 1
                high, most = 0, min(len(a) - i, len(b) - j)
                while high < most and a[i + high] == b[j + high]:
                    high += 1
            if size and high or not size and low + high >= SPAN:
                rows.append(r["row"])
                starts.append(r["at"] - low)
                ends.append(r["at"] + high)
                items.append(r["item"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(items, pa.string())],
            names=["row", "start", "end", "item"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = 20) -> DataFrame:
    """Per document row: the words inside any occurring item window, and the items.

    Returns ``doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated``;
    ``key`` is ``xxhash64(doc_id, text)``.  A document is contaminated when
    ``n_hit > 0 and share * n_hit >= n_words``.
    """
    items = save(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
        .mapInArrow(_item_prints, _ITEM)
        .distinct(),
        "items",
    )
    bit = F.shiftrightunsigned("key", 64 - BLOOM_BITS)
    words = items.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - BLOOM_BITS}) & 63 as int))")).alias("bits")
    )
    bloom = np.zeros(1 << (BLOOM_BITS - 6), np.int64)  # the rows below are at most this many
    for word, bits in words.collect():
        bloom[word] = bits
    sizes = sorted(r[0] for r in items.where("size > 0").select("size").distinct().collect())  # at most 12
    read = save(
        docs.select(F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_doc_prints(bloom.view(np.uint64), sizes), _DOC)
        .withColumn("row", F.monotonically_increasing_id()),
        "prints",
    )
    hits = (
        read.select("row", F.explode("prints").alias("p"))
        .select("row", F.col("p.print").alias("print"), "p.at", "p.lead", "p.around")
        .join(
            items.select(F.col("key").alias("print"), "item", F.col("lead").alias("its_lead"), "size", F.col("around").alias("its_around")),
            "print",
        )
        .mapInArrow(_extend, "row long, start long, end long, item string")
    )
    hits = save(hits.distinct(), "hits")
    earlier = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        hits.select("row", "start", "end")
        .distinct()
        .withColumn("before", F.coalesce(F.max("end").over(earlier), F.lit(0)))
        .groupBy("row")
        .agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before"))).alias("n_hit"))
    )
    named = hits.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (
        read.join(covered.join(named, "row"), "row", "left")
        .select(
            "doc_id",
            "key",
            "n_words",
            n_hit.cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: int = 20) -> DataFrame:
    """``docs`` without its contaminated rows, columns unchanged."""
    found = save(contamination(docs, benchmark, share).where("contaminated").select(F.col("key").alias("__lexquarry_key")).distinct(), "contaminated")
    keyed = docs.withColumn("__lexquarry_key", F.xxhash64("doc_id", "text"))
    return without_keys(keyed, found, "__lexquarry_key").drop("__lexquarry_key")
