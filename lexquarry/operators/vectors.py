"""Nearest vectors by cosine: exactly, or by an inverted file of cells."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.scratch import save

#: Queries that travel together; each block is one pass over the vectors.
BLOCK = 4096
#: Queries that are scored at a time: with a batch of 10,000 vectors, 20 MB of scores.
TILE = 256
#: Vectors that the centres are fitted on, at most (drawn by hash of their keys); all vectors are assigned.
FIT_ROWS = 50_000
#: Queries whose exact neighbours say how many cells have to be probed (drawn by hash of their keys).
FIT_QUERIES = 256
#: Vectors of one cell that are scored in one group, on average; larger cells have several runs.
RUN = 20_000
_FOUND = "query long, key long, similarity double"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def _merged(rows: np.ndarray, keys: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` of each row by (score, key)."""
    order = np.lexsort((keys, -scores, rows))
    rows, keys, scores = rows[order], keys[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    live = place < k
    return rows[live], keys[live], scores[live]


def _best_of(ids: np.ndarray, matrix: np.ndarray, keys: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number of the query, key and score of each query's best ``k`` vectors; scores of TILE queries are held at a time."""
    parts = []
    for a in range(0, len(ids), TILE):
        scores = np.round(matrix[a : a + TILE] @ vectors.T, 6)
        scores[ids[a : a + TILE, None] == keys[None, :]] = -np.inf
        least = np.partition(scores, -k, axis=1)[:, -k][:, None] if scores.shape[1] > k else -np.inf
        row, column = np.nonzero((scores >= least) & (scores > -np.inf))  # with ties at the end, which keys settle
        parts.append(_merged(row + a, keys[column], scores[row, column], k))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.where(F.size(vector) > 0).select(F.col(key).cast("long").alias("key"), F.col(vector).alias("v"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "key")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def cosine_topk(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int, block: int = BLOCK) -> DataFrame:
    """``query, key, similarity, rank``: the ``k`` vectors most alike to each query, itself left out.

    Exact: queries go in blocks of at most ``block`` to the vectors, every task keeps its own best ``k`` for each
    query, and those are ranked.  Similarities are rounded to six places, and ties go by key.  Null and empty
    vectors match nothing; all vectors must be of one length.  The vectors are read once for each block: for many
    queries use :func:`nearest`, and this for the recall.
    """
    spark = queries.sparkSession
    asked, held = _usable(queries, key, vector), _usable(vectors, key, vector)
    blocks = max(1, -(-asked.count() // block))
    parts = []
    for b in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).toArrow().combine_chunks()  # about ``block`` rows
        ids = own.column("key").to_numpy() if own.num_rows else np.zeros(0, np.int64)
        shared = spark.sparkContext.broadcast((ids, _matrix(own.column("v").combine_chunks()) if own.num_rows else np.zeros((0, 1))))
        parts.append(held.mapInArrow(_best(shared, k), _FOUND))
    return _ranked(reduce(DataFrame.unionByName, parts), k)


def _best(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        best = None
        for batch in batches:
            if not len(ids) or not len(batch):
                continue
            found = _best_of(ids, matrix, batch.column("key").to_numpy(), _matrix(batch.column("v")), k)
            best = found if best is None else _merged(*(np.concatenate(x) for x in zip(best, found, strict=True)), k)
        if best is not None:
            row, keys, scores = best
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(keys), pa.array(scores)], names=["query", "key", "similarity"])

    return run


# ---- inverted file -----------------------------------------------------------


def fit_cells(vectors: DataFrame, key: str, vector: str, cells: int, rounds: int = 12) -> np.ndarray:
    """Centres of ``cells`` cells (fewer, if there are fewer distinct vectors), by k-means on the sphere.

    Fitted on the driver, on FIT_ROWS vectors at most: those whose keys have the least hashes, so that a later run
    over the same rows gives the same centres.
    """
    drawn = _usable(vectors, key, vector).orderBy(F.xxhash64("key"), "key").limit(FIT_ROWS).toArrow().combine_chunks()
    if not drawn.num_rows:
        return np.zeros((0, 1))
    sample = np.unique(_matrix(drawn.column("v").combine_chunks()), axis=0)
    draw = np.random.default_rng(7)
    centres = sample[draw.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        own = _closest(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        empty = np.bincount(own, minlength=len(centres)) == 0
        sums[empty] = sample[draw.choice(len(sample), int(empty.sum()))]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-300)
    return centres


def _closest(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each row, by tiles of rows."""
    parts = [np.argsort(-(rows[a : a + TILE] @ centres.T), axis=1, kind="stable")[:, :n] for a in range(0, len(rows), TILE)]
    return np.concatenate(parts) if parts else np.zeros((0, n), np.int64)


def _assigned(df: DataFrame, shared, n: int) -> DataFrame:
    """``key, v, cell``: each vector with its ``n`` nearest cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in batches:
            if len(batch):
                cell = _closest(_matrix(batch.column("v")), centres, n)
                row = pa.array(np.repeat(np.arange(len(batch)), cell.shape[1]))
                yield pa.RecordBatch.from_arrays([batch.column("key").take(row), batch.column("v").take(row), pa.array(cell.ravel().astype(np.int64))], names=["key", "v", "cell"])

    kind = df.schema["v"].dataType.simpleString()
    return df.mapInArrow(run, f"key long, v {kind}, cell long")


def build_cells(vectors: DataFrame, key: str, vector: str, cells: int) -> tuple[DataFrame, np.ndarray]:
    """``key, v, cell, run`` of every vector, written once, and the centres; a cell of n vectors has n / RUN runs, up."""
    centres = fit_cells(vectors, key, vector, cells)
    shared = vectors.sparkSession.sparkContext.broadcast(centres)
    placed = save(_assigned(_usable(vectors, key, vector), shared, 1), "cells") if len(centres) else _usable(vectors, key, vector).withColumn("cell", F.lit(0).cast("long"))
    runs = placed.groupBy("cell").agg(F.ceil(F.count("*") / RUN).alias("runs"))  # a row for each centre at most
    return placed.join(F.broadcast(runs), "cell").select("key", "v", "cell", "runs", F.pmod(F.xxhash64("key"), "runs").alias("run")), centres


def fit_probes(queries: DataFrame, placed: DataFrame, centres: np.ndarray, k: int, recall: float) -> int:
    """The least number of cells that hold ``recall`` of the exact neighbours of FIT_QUERIES queries (``key, v``)."""
    drawn = queries.orderBy(F.xxhash64("key"), "key").limit(FIT_QUERIES)
    found = cosine_topk(drawn, placed, "key", "v", k).join(placed.select("key", "cell"), "key").select("query", "cell").toArrow()
    asked = drawn.toArrow().combine_chunks()
    if not found.num_rows:
        return 1
    ids, query, cell = asked.column("key").to_numpy(), found.column("query").to_numpy(), found.column("cell").to_numpy()
    at = np.argsort(ids)
    ranks = np.argsort(_closest(_matrix(asked.column("v").combine_chunks()), centres, len(centres)), axis=1)  # of each cell, for each query
    needed = np.sort(ranks[at[np.searchsorted(ids[at], query)], cell] + 1)
    return int(needed[int(np.ceil(recall * len(needed))) - 1])


def nearest(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int, cells: int = 64, probes: int | None = None, recall: float = 0.93) -> DataFrame:
    """``query, key, similarity, rank``: about the ``k`` vectors most alike to each query, itself left out.

    An inverted file: every vector lies in the cell of its nearest centre, and a query meets all vectors of its
    ``probes`` nearest cells.  Without ``probes``, as many are taken as hold ``recall`` of the exact neighbours of
    FIT_QUERIES queries: few where vectors form groups, most cells where they fill the space evenly, since then no
    cell is better than another and the exact search serves as well.  Similarities, ties, null and empty vectors are as in :func:`cosine_topk`, which is what
    ``probes = cells`` gives.  Queries and vectors meet by cell and run: the queries of a cell go to each of its runs
    in blocks, so that no task holds a whole cell, even if a third of all vectors are alike, and the driver sees the
    sample of :func:`fit_cells` alone.
    """
    placed, centres = build_cells(vectors, key, vector, cells)
    if not len(centres):
        return _ranked(queries.sparkSession.createDataFrame([], _FOUND), k)
    shared = queries.sparkSession.sparkContext.broadcast(centres)
    probes = probes or fit_probes(_usable(queries, key, vector), placed, centres, k, recall)
    runs = placed.select("cell", "runs").distinct()
    probed = save(_assigned(_usable(queries, key, vector), shared, min(probes, len(centres))), "probes")
    blocks = probed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    sizes = runs.join(blocks, "cell")
    asked = probed.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64("key"), "blocks"))
    asked = asked.select("key", "v", "cell", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("runs") - 1)).alias("run"))
    held = placed.drop("runs").join(F.broadcast(sizes), "cell").select("key", "v", "cell", "run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    by = ["cell", "run", "block"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "similarity": pa.array([], pa.float64())})
        ids = left.column("key").to_numpy()
        matrix, rows = (_matrix(x.column("v").combine_chunks()) for x in (left, right))
        row, keys, scores = _best_of(ids, matrix, right.column("key").to_numpy(), rows, k)
        return pa.table({"query": ids[row], "key": keys, "similarity": scores})

    return _ranked(asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(meet, _FOUND), k)
