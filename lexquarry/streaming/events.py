"""Event streams: rates, sessions and the fold of an append-only log, for batch tables and streams alike."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexquarry.operators.ranking import latest
from lexquarry.scratch import drop, save
from lexquarry.sources.published import current, draft, point, sweep


def rate_per_minute(events: DataFrame, key: str, most: int, at: str = "ts", late: str | None = None) -> DataFrame:
    """Events of each key in each minute, and whether they exceed ``most``; ``late`` is the watermark of a stream."""
    rows = events.withWatermark(at, late) if late else events
    counts = rows.groupBy(key, F.window(at, "1 minute")).agg(F.count("*").alias("n"))
    return counts.select(key, F.col("window.start").alias("minute"), "n", (F.col("n") > most).alias("limited"))


def sliding_counts(events: DataFrame, kind: str, width: str = "10 minutes", step: str = "5 minutes", at: str = "ts", late: str | None = None) -> DataFrame:
    """Events of each kind in overlapping windows."""
    rows = events.withWatermark(at, late) if late else events
    return rows.groupBy(kind, F.window(at, width, step)).agg(F.count("*").alias("n")).select(kind, F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, key: str, gap: str = "30 minutes", at: str = "ts", late: str | None = None) -> DataFrame:
    """Events of each key without a pause of ``gap``."""
    rows = events.withWatermark(at, late) if late else events
    found = rows.groupBy(key, F.session_window(at, gap)).agg(F.count("*").alias("n"))
    return found.select(key, F.col("session_window.start").alias("started"), F.col("session_window.end").alias("ended"), "n")


def distinct_events(events: DataFrame, key: str, at: str = "ts", late: str = "10 minutes") -> DataFrame:
    """A stream without repeats of a key inside the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


_STATE = "state"


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest state kept by :func:`fold_log`."""
    return current(spark, path).table(_STATE).drop("bucket")


def fold_log(stream: DataFrame, path: str, key: str, *order: str, checkpoint: str, once: bool = True, buckets: int = 64, grace: float = 3600.0):
    """Keep the latest row of every key of an append-only log in a published table (see :func:`read_state`).

    The state is dealt by the key's hash over ``buckets`` folders.  A batch reads and writes only the folders of its
    own keys; the others are carried on, and one pointer makes the change visible.  The pointer names the query and
    the batch, so a batch that is run again after it was applied changes nothing.  A query with a new checkpoint goes
    on from the state that is there.  Folders that were replaced stay for readers for ``grace`` seconds.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        before = current(spark, path)
        if before.note.get("query") == query and before.note.get("batch", -1) >= number:
            return
        fresh = save(latest(batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")), key, *order), "fold")
        touched = sorted(r.bucket for r in fresh.select("bucket").distinct().collect())  # ``buckets`` rows at most
        if not touched:
            return
        held = before.tables.get(_STATE, {"paths": [], "schema": None})
        own = {int(p.rsplit("=", 1)[1]): p for p in held["paths"]}
        columns = [c for c in fresh.columns if c != "bucket"]
        old = before.read(_STATE, [own[b] for b in touched if b in own]).select(columns) if any(b in own for b in touched) else None
        rows = fresh.select(columns) if old is None else latest(fresh.select(columns).unionByName(old), key, *order)
        home = draft(before)
        spread = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).select(*columns, "bucket")
        spread.repartition(len(touched), "bucket").write.partitionBy("bucket").parquet(f"{before.folder}/{home}/{_STATE}")
        paths = {**own, **{b: f"{home}/{_STATE}/bucket={b}" for b in touched}}
        point(before, home, {**before.tables, _STATE: {"paths": [paths[b] for b in sorted(paths)], "schema": rows.select(columns).schema.jsonValue()}}, {"query": query, "batch": number})
        drop(fresh)
        sweep(spark, path, grace)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
