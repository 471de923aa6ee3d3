"""Hard negatives by a full sort of each anchor's scores.

Every anchor is scored against every row.  Rows are dealt by hash into runs and anchors
into blocks, both of bounded size, and each pair of a block and a run is one task's group:
there, the scores of every anchor are sorted by score and id, each positive's upper limit
is found by binary search, and the next rows of other labels are read while they are not
below the lower limit.  The first rows over all runs are those of the anchor's whole sorted
list.  No list of all scores of an anchor is ever in one place, nothing is broadcast and
nothing passes through the driver.  The work grows as anchors times rows, as scoring each
anchor against all rows asks; a run's group is held whole, RUN_ROWS rows at most on average.

Scores are inner products of whole numbers, exact up to the ends of a long and held there
beyond them.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take
no part; a vector that is shorter than another counts as filled up with zeros, so an empty
one scores 0; a null id is no anchor, comes after all others on ties and is given back as
null; of repeated ids each row counts for itself, and an anchor leaves out only its own row;
an anchor without other rows of its label has no results; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.scratch import save

#: Rows of a run and anchors of a block, on average; least number of runs, so that small tables are dealt too.
RUN_ROWS, BLOCK_ROWS, LEAST_RUNS = 1 << 16, 1 << 12, 64
#: Scores that are held at once.
_TILE = 1 << 21
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Mining:
    """How many positives and negatives, and a negative's limits in hundredths of the positive's score."""

    positives: int = 5
    negatives: int = 5
    lower: int = 80
    upper: int = 100

    def limits(self, positive: int) -> tuple[int, int]:
        """The least and the greatest score of a negative."""
        return -(-self.lower * positive // 100), self.upper * positive // 100


def quantised(vector: Column | str, scale: int = 256) -> Column:
    """Each component times ``scale``, rounded down, as long; null if the vector or a component is null or not finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    fits = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(fits, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of ``width`` numbers, short ones filled up with zeros."""
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(column: pa.ChunkedArray) -> int:
    return max((int(c.value_lengths().to_numpy(zero_copy_only=False).max()) for c in column.chunks if len(c)), default=0)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, ends of a long at most."""
    most = lambda x: float(np.abs(x.astype(np.float64)).max(initial=0))
    bound = most(a) * most(b) * max(1, a.shape[1])
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -_LONG, _LONG).astype(np.int64)


class _Run:
    """The rows of one run in order of their ids (null last), and each anchor's sorted scores."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        null = rows.column("key").is_null().to_numpy()
        ids = rows.column("key").fill_null(0).to_numpy()
        first = np.lexsort((ids, null))
        width = max(_width(anchors.column("v")), _width(rows.column("v")))
        self.ids, self.null, self.label, self.row = ids[first], null[first], rows.column("label").to_numpy()[first], rows.column("row").to_numpy()[first]
        self._rows, self._anchors = _matrix(rows.column("v"), width)[first], _matrix(anchors.column("v"), width)

    def sorted(self):
        """Of each anchor: its number, its scores falling, and the places of their rows, ties by id."""
        step = max(1, _TILE // max(1, len(self.ids)))
        place = np.arange(len(self.ids))
        for at in range(0, len(self._anchors), step):
            falling = -scores(self._anchors[at : at + step], self._rows)
            order = np.lexsort((np.broadcast_to(place, falling.shape), falling))
            falling = np.take_along_axis(falling, order, 1)
            for i in range(len(order)):
                yield at + i, falling[i], order[i]

    def id_of(self, place: int) -> int | None:
        return None if self.null[place] else int(self.ids[place])


def _positives(mining: Mining):
    def find(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        run = _Run(anchors, rows)
        own, label = anchors.column("row").to_numpy(), anchors.column("label").to_numpy()
        for i, falling, order in run.sorted():
            same = np.flatnonzero((run.label[order] == label[i]) & (run.row[order] != own[i]))[: mining.positives]
            out += [(own[i], run.id_of(order[j]), -int(falling[j])) for j in same]
        columns = zip(*out, strict=True) if out else [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["row", "positive_id", "positive_score"])

    return find


_PAIR = ("anchor", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")


def _negatives(mining: Mining):
    def find(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        run = _Run(anchors, rows)
        own, key, label, positives = (anchors.column(c).to_pylist() for c in ("row", "key", "label", "positives"))
        for i, falling, order in run.sorted():
            other = np.flatnonzero(run.label[order] != label[i])
            left = falling[other]
            for p in positives[i]:
                least, most = mining.limits(p["positive_score"])
                at = int(np.searchsorted(left, -min(most, _LONG), "left"))
                for j in range(at, min(at + mining.negatives, len(left))):
                    if -int(left[j]) < least:
                        break
                    out.append((own[i], p["place"], key[i], p["positive_id"], p["positive_score"], run.id_of(order[other[j]]), -int(left[j])))
        columns = zip(*out, strict=True) if out else [[] for _ in _PAIR]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=list(_PAIR))

    return find


def mine(vectors: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", mining: Mining = Mining()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows where ``anchor`` (over the columns of ``vectors``) is true; ``vector`` holds whole
    numbers (see :func:`quantised`).  An anchor's positives are its best other rows of the same label, and each
    positive's negatives the best rows of other labels within the limits; ``rank`` counts them from 1.
    """
    from_table = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<long>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("asks"))
    held = save(from_table.where("label IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)").withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, asked = held.agg(F.count("*"), F.count_if("asks")).first()
    runs, blocks = max(LEAST_RUNS, -(-n // RUN_ROWS)), max(1, -(-asked // BLOCK_ROWS))

    def dealt(rows: DataFrame, own: int, others: int, group: Column) -> DataFrame:
        """Rows of one side, once for each group of the other."""
        return rows.withColumn("_own", F.pmod(F.xxhash64("row"), F.lit(own))).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).withColumn("cell", group).drop("_own", "_other")

    all_rows = dealt(held.drop("asks"), runs, blocks, F.col("_other") * runs + F.col("_own")).groupBy("cell")
    anchors = held.where("asks").drop("asks")

    def scored(side: DataFrame, find, schema: str) -> DataFrame:
        return dealt(side, blocks, runs, F.col("_own") * runs + F.col("_other")).groupBy("cell").cogroup(all_rows).applyInArrow(find, schema)

    best = Window.partitionBy("row").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    found = scored(anchors, _positives(mining), "row long, positive_id long, positive_score long").withColumn("place", F.row_number().over(best)).where(F.col("place") <= mining.positives)
    listed = found.groupBy("row").agg(F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("positives"))  # a few of each anchor
    asking = save(anchors.join(listed, "row"), "anchors")

    first = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    pairs = scored(asking, _negatives(mining), ", ".join(f"{c} long" for c in _PAIR)).withColumn("rank", F.row_number().over(first))
    return pairs.where(F.col("rank") <= mining.negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
