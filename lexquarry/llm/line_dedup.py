"""Line deduplication by content-defined chunks and by passages of PASSAGE_WORDS words.

Each text's lines are hashed; a rolling hash over WINDOW line hashes ends a
chunk where its low bits are nought, which depends on nearby lines only, so
boundaries fall in the same places of a passage wherever it stands.  A line of
LONG_WORDS words or more is a paragraph and a chunk of its own.  Chunks of one
shorter line are never removed; very long runs without a boundary are cut at
MOST_LINES lines from the last one.

A chunk hash seen more than once, anywhere, is a candidate.  The first occurrence
(least doc_id, key, place) keeps its lines; every later one is removed only after
its bytes have been compared with the first one's.

Chunks alone miss passages that no boundary encloses, so `remove_repeated_passages`
takes as candidates, beside the chunks, the least run of lines that reaches
PASSAGE_WORDS words from each line onwards and back from each line.  Any repeated
run of so many words is the union of such runs inside it, wherever it stands, so it
goes from its first line with a word to its last one.  A copy that overlaps its
first occurrence in the same text stays.

Defined cases: null and empty texts have no lines and come back as they are;
blank lines are lines; rows alike in id and text are one document and get the
same result; a null doc_id sorts first; an empty table gives an empty result;
only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.llm import _text as tx
from lexquarry.llm._bloom import may_hold
from lexquarry.llm._skew import join_groups
from lexquarry.scratch import drop, save

WINDOW = 2
MASK = np.uint64(3)
LEAST_LINES, MOST_LINES = 2, 64
LONG_WORDS = 50
#: A repeated run of lines of so many words is a repeated passage.
PASSAGE_WORDS = 50
#: Bytes of passages that go out in one batch.
BATCH_BYTES = 16 << 20

_LINE = np.ones(256, dtype=bool)
_LINE[0x0A] = False


def _lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte, byte after, hash (without the line feed) and number of words of every line of non-empty texts."""
    raw, offsets = tx.utf8(column)
    full = np.diff(offsets) > 0
    breaks = np.flatnonzero(~_LINE[raw])
    # every non-empty text opens a line, and every line feed opens one more of its text
    row = np.concatenate([np.flatnonzero(full), np.searchsorted(offsets[1:], breaks, "right")])
    begin = np.concatenate([offsets[:-1][full], breaks + 1])
    by = np.lexsort((begin, row))
    row, begin = row[by], begin[by]
    end = np.empty_like(begin)
    end[:-1] = begin[1:] - 1
    if len(end):
        last = np.append(row[1:] != row[:-1], True)
        end[last] = offsets[1:][row[last]]
    inside = tx.SPACED[raw]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[offsets[:-1][full]] = inside[offsets[:-1][full]]
    opened = np.concatenate([[0], np.cumsum(opens)])
    return row, begin, end, tx.hash_spans(raw, begin, end), opened[end] - opened[begin]


def chunk_bounds(row: np.ndarray, hashes: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Index of the first line of every chunk."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    rolling = tx.mix(hashes)
    for k in range(1, WINDOW):
        earlier = np.zeros_like(hashes)
        earlier[k:] = np.where(row[k:] == row[:-k], hashes[:-k], 0)
        rolling = tx.mix(rolling + earlier)
    ends = ((rolling & MASK) == 0) | long  # a chunk ends with this line
    ends[:-1] |= long[1:]
    first = np.zeros(n, dtype=bool)
    first[0] = True
    first[1:] = (row[1:] != row[:-1]) | ends[:-1]
    at = np.flatnonzero(first)
    since = np.arange(n) - at[np.searchsorted(at, np.arange(n), "right") - 1]
    return np.flatnonzero(first | (since % MOST_LINES == 0))


def _run_hashes(hashes: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each run of lines."""
    h = np.zeros(len(at), np.uint64)
    live = np.arange(len(at))
    k = 0
    while len(live):
        h[live] = tx.mix(h[live] ^ hashes[at[live] + k])
        k += 1
        live = live[lengths[live] > k]
    return h


def _chunks(column: pa.Array):
    row, begin, end, hashes, words = _lines(column)
    long = words >= LONG_WORDS
    at = chunk_bounds(row, hashes, long)
    stop = np.append(at[1:], len(row)).astype(np.int64)
    lengths = stop - at
    h = _run_hashes(hashes, at, lengths)
    first = np.searchsorted(row, row[at]) if len(at) else at
    return row, begin, end, at, stop, h, at - first, (lengths >= LEAST_LINES) | long[at]


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j in tx.slices(batch.column("text")):
            part = batch.slice(i, j - i)
            row, _, _, at, _, h, line, many = _chunks(part.column("text"))
            owner = pa.array(row[at][many])
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(owner), part.column("doc_id").take(owner), pa.array(line[many].astype(np.int32)), pa.array(tx.signed(h[many]))],
                names=["key", "doc_id", "line", "chunk"],
            )


def _chunk_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted chunks of each text."""
    for batch in batches:
        for i, j in tx.slices(batch.column("text")):
            part = batch.slice(i, j - i)
            raw, _ = tx.utf8(part.column("text"))
            row, begin, end, at, stop, h, line, _ = _chunks(part.column("text"))
            wanted = {(r, x) for r, xs in enumerate(part.column("lines").to_pylist()) for x in xs}
            picked = [c for c in range(len(at)) if (int(row[at[c]]), int(line[c])) in wanted]
            owner = pa.array([int(row[at[c]]) for c in picked], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key").take(owner),
                    part.column("doc_id").take(owner),
                    pa.array([int(line[c]) for c in picked], pa.int32()),
                    pa.array([int(h[c].astype(np.int64)) for c in picked], pa.int64()),
                    pa.array([raw[begin[at[c]] : end[stop[c] - 1]].tobytes() for c in picked], pa.binary()),
                ],
                names=["key", "doc_id", "line", "chunk", "bytes"],
            )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines of their removed chunks."""
    for batch in batches:
        for i, j in tx.slices(batch.column("text")):
            part = batch.slice(i, j - i)
            column = part.column("text")
            raw, _ = tx.utf8(column)
            row, begin, end, at, stop, _, line, _ = _chunks(column)
            gone = {(r, x) for r, xs in enumerate(part.column("lines").to_pylist()) for x in xs or ()}
            keep = np.ones(len(row), dtype=bool)
            for c in range(len(at)) if gone else ():
                if (int(row[at[c]]), int(line[c])) in gone:
                    keep[at[c] : stop[c]] = False
            total, removed = np.bincount(row, minlength=len(part)), np.bincount(row[~keep], minlength=len(part))
            texts = column.to_pylist()
            first = np.searchsorted(row, np.arange(len(part) + 1))
            for r in np.flatnonzero(removed):
                lines = range(first[r], first[r + 1])
                texts[r] = b"\n".join(raw[begin[k] : end[k]].tobytes() for k in lines if keep[k]).decode()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "n_lines", "n_removed", "text"],
            )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """``key, line``: the chunks to remove, after comparison of bytes."""
    rows = save(_keyed(docs).mapInArrow(_chunk_rows, "key long, doc_id long, line int, chunk long"), "chunks")
    place = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "key", "line")
    firsts = rows.groupBy("chunk").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high").select("chunk", "low")
    among = save(rows.join(firsts, "chunk").select("key", "line", "chunk", (place == F.col("low")).alias("first")).distinct(), "among")
    # lines wanted of each document: at most its own chunks
    wanted = among.groupBy("key").agg(F.collect_set("line").alias("lines"))
    # by sorting on the key at every size: the wanted lines have no bound for a broadcast
    found = _keyed(docs).hint("merge").join(wanted, "key").select("key", "doc_id", "text", "lines").mapInArrow(_chunk_bytes, "key long, doc_id long, line int, chunk long, bytes binary")
    found = save(found.dropDuplicates(["key", "line"]), "bytes")
    flagged = found.join(among.select("key", "line", "first"), ["key", "line"])
    first = flagged.where("first").select("chunk", F.col("bytes").alias("first_bytes"))
    return flagged.where("NOT first").join(first, "chunk").where("bytes = first_bytes").select("key", "line")


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_removed`` and the ``text`` that is left."""
    gone = save(repeated_chunks(docs).groupBy("key").agg(F.collect_set("line").alias("lines")), "gone")
    return _keyed(docs).hint("merge").join(gone, "key", "left").select("doc_id", "text", "lines").mapInArrow(_without, "doc_id long, n_lines long, n_removed long, text string")


def passage_bounds(row: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and line after of the least runs of PASSAGE_WORDS words from each line, onwards and back.

    Runs begin and end with a line that has words, so at most 2 * PASSAGE_WORDS of them hold a line.
    """
    total = np.concatenate([[0], np.cumsum(words)])
    line = np.flatnonzero(words > 0)
    onwards = np.searchsorted(total, total[line] + PASSAGE_WORDS, "left")
    back = np.searchsorted(total, total[line + 1] - PASSAGE_WORDS, "right") - 1
    from_, to = line[onwards <= len(words)], line[back >= 0]
    first, stop = np.concatenate([from_, back[back >= 0]]), np.concatenate([onwards[onwards <= len(words)], to + 1])
    inside = row[first] == row[stop - 1]
    return first[inside], stop[inside]


def _passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, line, number of lines and hash of every chunk and every passage."""
    row, _, _, hashes, words = _lines(column)
    at = chunk_bounds(row, hashes, words >= LONG_WORDS)
    stop = np.append(at[1:], len(row)).astype(np.int64)
    whole = (stop - at >= LEAST_LINES) | (words[at] >= LONG_WORDS)
    first, last = passage_bounds(row, words)
    many = last - first > 1  # a long line is a chunk
    runs = np.unique(np.concatenate([at[whole], first[many]]) * (len(row) + 1) + np.concatenate([stop[whole], last[many]]))
    first, stop = np.divmod(runs, len(row) + 1)
    return row[first], first - np.searchsorted(row, row[first]), stop - first, _run_hashes(hashes, first, stop - first)


def _passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j in tx.slices(batch.column("text")):
            part = batch.slice(i, j - i)
            row, line, n, h = _passages(part.column("text"))
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(owner), part.column("doc_id").take(owner), pa.array(line.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(tx.signed(h))],
                names=["key", "doc_id", "line", "n", "chunk"],
            )


def cover(spans: list[tuple[int, int]]) -> list[int]:
    """Indices of spans (first, length) that together hold every place that any of them holds, no place more than twice."""
    out, reached, best = [], 0, None
    for i in sorted(range(len(spans)), key=lambda i: spans[i]):
        first, stop = spans[i][0], sum(spans[i])
        if best is not None and first > reached:
            out.append(best)
            reached, best = sum(spans[best]), None
        if stop > reached and (best is None or stop > sum(spans[best])):
            best = i
            if first > reached:
                reached = first
    return out if best is None else [*out, best]


def _covers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text's repeated runs, so many as hold all their lines."""
    for batch in batches:
        hits = batch.column("hits")
        cuts = hits.offsets.to_numpy()
        line, n, first_key, first_line = (hits.values.field(k).to_numpy() for k in range(4))
        picked, owner = [], []
        for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            own = cover(list(zip(line[a:b].tolist(), n[a:b].tolist(), strict=True)))
            picked += [a + i for i in own]
            owner += [r] * len(own)
        at = np.array(picked, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").take(pa.array(owner, pa.int64())), *(pa.array(x[at]) for x in (line, n, first_key, first_line))],
            names=["key", "line", "n", "first_key", "first_line"],
        )


def _passage_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted runs of each text."""

    def out(keys: list, lines: list, sizes: list, found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(lines, pa.int32()), pa.array(sizes, pa.int32()), pa.array(found, pa.binary())], names=["key", "line", "n", "bytes"]
        )

    for batch in batches:
        for i, j in tx.slices(batch.column("text")):
            part = batch.slice(i, j - i)
            raw, _ = tx.utf8(part.column("text"))
            row, begin, end, _, _ = _lines(part.column("text"))
            first = np.searchsorted(row, np.arange(len(part)))
            held, size = ([], [], [], []), 0
            for r, (key, runs) in enumerate(zip(part.column("key").to_pylist(), part.column("runs").to_pylist(), strict=True)):
                for run in runs:
                    a = first[r] + run["line"]
                    text = raw[begin[a] : end[a + run["n"] - 1]].tobytes()
                    for to, x in zip(held, (key, run["line"], run["n"], text), strict=True):
                        to.append(x)
                    size += len(text)
                    if size >= BATCH_BYTES:
                        yield out(*held)
                        held, size = ([], [], [], []), 0
            yield out(*held)


def _without_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines of their removed runs."""
    for batch in batches:
        for i, j in tx.slices(batch.column("text")):
            part = batch.slice(i, j - i)
            column = part.column("text")
            raw, _ = tx.utf8(column)
            row, begin, end, _, _ = _lines(column)
            first = np.searchsorted(row, np.arange(len(part) + 1))
            keep = np.ones(len(row), dtype=bool)
            for r, runs in enumerate(part.column("runs").to_pylist()):
                for run in runs or ():
                    keep[first[r] + run["line"] : first[r] + run["line"] + run["n"]] = False
            total, removed = np.bincount(row, minlength=len(part)), np.bincount(row[~keep], minlength=len(part))
            texts = column.to_pylist()
            for r in np.flatnonzero(removed):
                texts[r] = b"\n".join(raw[begin[k] : end[k]].tobytes() for k in range(first[r], first[r + 1]) if keep[k]).decode()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "n_lines", "n_removed", "text"],
            )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``key, line, n``: the runs of lines to remove, after comparison of bytes."""
    rows = save(_keyed(docs).mapInArrow(_passage_rows, "key long, doc_id long, line int, n int, chunk long"), "runs")
    place = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "key", "line")
    firsts = rows.groupBy("chunk").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("rows")).where("low <> high").select("chunk", "low", "rows")
    later = (
        join_groups(rows, firsts, ["chunk"], "rows")
        .where((place != F.col("low")) & ((F.col("key") != F.col("low.key")) | (F.col("line") >= F.col("low.line") + F.col("n"))))
        .select("key", "line", "n", F.col("low.key").alias("first_key"), F.col("low.line").alias("first_line"))
    )
    # hits of each document: at most its own chunks and two runs a line
    hits = later.groupBy("key").agg(F.collect_set(F.struct("line", "n", "first_key", "first_line")).alias("hits"))
    covers = save(hits.mapInArrow(_covers, "key long, line int, n int, first_key long, first_line int"), "covers")
    drop(rows)
    ends = covers.select("key", "line", "n").unionAll(covers.select(F.col("first_key").alias("key"), F.col("first_line").alias("line"), "n"))
    wanted = save(ends.groupBy("key").agg(F.collect_set(F.struct("line", "n")).alias("runs")), "wanted")
    # by sorting on the key at every size: the wanted runs have no bound for a broadcast
    among = may_hold(wanted, "key")
    texts = _keyed(docs).where(among("key")).hint("merge").join(wanted, "key").select("key", "text", "runs")
    found = save(texts.mapInArrow(_passage_bytes, "key long, line int, n int, bytes binary").dropDuplicates(["key", "line", "n"]), "bytes")
    first = found.select(F.col("key").alias("first_key"), F.col("line").alias("first_line"), "n", F.col("bytes").alias("first_bytes"))
    both = covers.join(found, ["key", "line", "n"]).join(first, ["first_key", "first_line", "n"])
    return both.where("bytes = first_bytes").select("key", "line", "n")


def remove_repeated_passages(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_removed`` and the ``text`` that is left, without repeated chunks and passages.

    Texts that surely keep all their lines are not shuffled.
    """
    gone = save(repeated_passages(docs).groupBy("key").agg(F.collect_set(F.struct("line", "n")).alias("runs")), "gone")
    among = may_hold(gone, "key")
    texts = _keyed(docs)
    whole = texts.where(~among("key")).select("doc_id", "text", F.lit(None).cast(gone.schema["runs"].dataType).alias("runs"))
    cut = texts.where(among("key")).hint("merge").join(gone, "key", "left").select("doc_id", "text", "runs")
    return whole.unionByName(cut).mapInArrow(_without_passages, "doc_id long, n_lines long, n_removed long, text string")
