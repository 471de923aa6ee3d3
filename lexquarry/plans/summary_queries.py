"""Queries over stored summaries of days, each beside SQL over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.operators import summaries
from lexquarry.plans.registry import Tables, query
from lexquarry.scratch import new_path

_stored: dict[tuple[str, str], str] = {}


def _summaries(t: Tables) -> DataFrame:
    """Each day's state by event type, written once for a session and folder, the errors as rows that come late."""
    own = (t.spark.sparkContext.applicationId, t.folder)
    rows = t.events.withColumn("day", F.to_date("ts")).withColumn("k", F.get_json_object("props", "$.k").try_cast("long"))
    if own not in _stored:
        folder = new_path(t.spark, "summaries")
        summaries.add_days(rows.where("event_type <> 'error'"), folder, "day", ["event_type"], "k", "value")
        summaries.add_days(rows.where("event_type = 'error'"), folder, "day", ["event_type"], "k", "value", late=True)
        _stored[own] = folder
    return summaries.stored(t.spark, _stored[own])


_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


@query(f"SELECT event_type, count(*)::BIGINT AS n, count(DISTINCT {_K})::BIGINT AS n_items, min(value) AS least, max(value) AS most, round(sum(value), 2) AS total FROM events GROUP BY 1")
def summary_types(t: Tables) -> DataFrame:
    """Rows, distinct keys and range of each type, from the stored days alone."""
    return summaries.estimates(summaries.merged(_summaries(t), ["event_type"])).select("event_type", "n", "n_items", "least", "most", F.round("total", 2).alias("total"))


@query(f"SELECT {_K} AS item, count(*)::BIGINT AS count FROM events WHERE {_K} IS NOT NULL GROUP BY 1")
def summary_heavy(t: Tables) -> DataFrame:
    """The counts of all keys over all types and days (exact for as few as here), from the stored days alone."""
    counts = summaries.estimates(summaries.merged(_summaries(t)), k=summaries.TRACKED).select(F.inline("counts"))
    return counts.select("item", "count")
