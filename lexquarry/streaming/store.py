"""A store whose entries end: puts and gets of a stream, and the same over a table.

Requests are rows of ``key, op ('put' or 'get'), at, value, version, keep_seconds, asked``.
A put holds its value under the key until ``at + keep_seconds``; a newer put replaces it.
A get is answered with

* ``hit`` and the value, counting the hits of the key, or why not:
* ``missing`` (nothing was put, or it was forgotten), ``stale`` (another version than asked for),
  ``expired`` (at or after the entry's end), ``no_match`` (``asked`` is not in the value, case aside),

in this order of tests.  A put is answered with ``stored``, or ``superseded`` if the entry is newer.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

REQUEST = "key string, op string, at timestamp, value string, version string, keep_seconds long, asked string"
ANSWER = "key string, op string, at timestamp, outcome string, value string, hits long, ends timestamp"
_ENTRY = "value string, version string, put_at timestamp, ends timestamp, hits long"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _utc(t: datetime) -> datetime:
    return t.astimezone(UTC).replace(tzinfo=None) if t.tzinfo else t


class _Store(StatefulProcessor):
    """One entry for each key, with a timer at its end; nothing is left of a key once it has been forgotten."""

    def __init__(self, remember: float):
        self.remember = remember

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", _ENTRY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))  # the requests of one key in one micro-batch
        batch["_get"] = batch["op"] == "get"
        held = self.entry.get() if self.entry.exists() else None
        out = []
        for r in batch.sort_values(["at", "_get"], kind="stable").itertuples():
            at = r.at.to_pydatetime()
            if r.op == "put":
                if held and _utc(held[2]) > at:
                    out.append((*key, "put", at, "superseded", None, held[4], _utc(held[3])))
                    continue
                hits = held[4] if held else 0
                held = (r.value, r.version, at, at + timedelta(seconds=int(r.keep_seconds)), hits)
                out.append((*key, "put", at, "stored", None, hits, held[3]))
                continue
            outcome = "missing"
            if held:
                ends = _utc(held[3])
                outcome = "stale" if held[1] != r.version else "expired" if ends <= at else "no_match" if r.asked and r.asked.lower() not in (held[0] or "").lower() else "hit"
                held = (*held[:4], held[4] + (outcome == "hit"))
            out.append((*key, "get", at, outcome, held[0] if outcome == "hit" else None, held[4] if held else 0, _utc(held[3]) if held else None))
        if held:
            self.entry.update(tuple(held))
            self._ring(_utc(held[3]))
        yield pd.DataFrame(out, columns=["key", "op", "at", "outcome", "value", "hits", "ends"])

    def _ring(self, ends: datetime) -> None:
        """One timer at the time when the entry is to be forgotten."""
        due = int((ends.replace(tzinfo=UTC).timestamp() + self.remember) * 1000)
        for t in list(self.handle.listTimers()):
            if t != due:
                self.handle.deleteTimer(t)
        self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.entry.exists():
            held = self.entry.get()
            self.entry.clear()
            yield pd.DataFrame([(*key, "end", pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms"), "forgotten", None, held[4], _utc(held[3]))], columns=["key", "op", "at", "outcome", "value", "hits", "ends"])

    def close(self) -> None:
        pass


@contextmanager
def state_in_files(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in files of RocksDB, as :func:`serve` needs."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def serve(requests: DataFrame, late: str = "10 minutes", remember: float = 0.0) -> DataFrame:
    """Answers to a stream of requests, and a row ``forgotten`` when an entry's state is deleted.

    Requests are taken in the order of their times, puts before gets.  Those later than the watermark ``late``
    are dropped by Spark.  An entry is forgotten once the watermark is ``remember`` seconds past its end; until
    then a get is told ``expired``.  State is bounded by the keys whose entries have not ended.
    """
    rows = requests.withWatermark("at", late).groupBy("key")
    return rows.transformWithStateInPandas(statefulProcessor=_Store(remember), outputStructType=ANSWER, outputMode="append", timeMode="eventTime")


def answers(requests: DataFrame, *order: str) -> DataFrame:
    """What :func:`serve` answers with nothing late and nothing forgotten, over a table; ``order`` breaks ties of time and kind."""
    get = (F.col("op") == "get").cast("int")
    so_far = Window.partitionBy("key").orderBy("at", get, *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    put = F.when(F.col("op") == "put", F.struct("value", "version", (F.col("at") + F.make_dt_interval(secs=F.col("keep_seconds"))).alias("ends")))
    seen = requests.withColumn("held", F.last(put, ignorenulls=True).over(so_far))
    outcome = (
        F.when(F.col("op") == "put", "stored").when(F.col("held").isNull(), "missing").when(~F.col("held.version").eqNullSafe(F.col("version")), "stale")
        .when(F.col("held.ends") <= F.col("at"), "expired").when((F.col("asked") != "") & ~F.coalesce(F.contains(F.lower("held.value"), F.lower("asked")), F.lit(False)), "no_match").otherwise("hit")
    )
    told = seen.withColumn("outcome", outcome)
    hits = F.sum((F.col("outcome") == "hit").cast("long")).over(so_far)
    return told.select("key", "op", "at", *order, "outcome", F.when(F.col("outcome") == "hit", F.col("held.value")).alias("value"), hits.alias("hits"), F.col("held.ends").alias("ends"))
