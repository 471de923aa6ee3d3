"""Queries of stores whose entries end, and of state that is folded in buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.plans.registry import Tables, query
from lexquarry.scratch import new_path
from lexquarry.streaming import events, store


def _requests(t: Tables) -> DataFrame:
    """Purchases and sign-ups are put under the user's key for value / 10 days; other events ask for them, errors by a word."""
    put = F.col("event_type").isin("purchase", "signup")
    version = F.concat(F.lit("v"), F.floor(F.get_json_object("props", "$.k").cast("long") / 50).cast("string"))
    return t.events.select(
        F.col("user_id").cast("string").alias("key"), F.when(put, "put").otherwise("get").alias("op"), F.col("ts").alias("at"), F.when(put, F.concat_ws(" ", "event_type", "event_id")).alias("value"),
        version.alias("version"), F.when(put, F.floor(F.col("value") * 8640)).cast("long").alias("keep_seconds"), F.when(F.col("event_type") == "error", "PURCHASE").alias("asked"), "event_id",
    )


@query("""
WITH r AS (SELECT user_id::VARCHAR AS key, event_type IN ('purchase', 'signup') AS p, ts AS "at", event_type || ' ' || event_id AS value, 'v' || (CAST(json_extract(props, '$.k') AS BIGINT) // 50) AS version, floor(value * 8640)::BIGINT AS keep, event_type = 'error' AS asks, event_id FROM events),
h AS (SELECT *, last_value(CASE WHEN p THEN {'value': value, 'version': version, 'ends': "at" + to_seconds(keep)} END IGNORE NULLS) OVER w AS held FROM r WINDOW w AS (PARTITION BY key ORDER BY "at", NOT p, event_id ROWS UNBOUNDED PRECEDING)),
o AS (SELECT *, CASE WHEN p THEN 'stored' WHEN held IS NULL THEN 'missing' WHEN held.version <> version THEN 'stale' WHEN held.ends <= "at" THEN 'expired' WHEN asks AND NOT contains(held.value, 'purchase') THEN 'no_match' ELSE 'hit' END AS outcome FROM h)
SELECT key, CASE WHEN p THEN 'put' ELSE 'get' END AS op, "at", event_id, outcome, CASE WHEN outcome = 'hit' THEN held.value END AS value, sum((outcome = 'hit')::INT) OVER (PARTITION BY key ORDER BY "at", NOT p, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS hits, held.ends AS ends FROM o""")
def store_answers(t: Tables) -> DataFrame:
    """What each request to the store is answered, with the hits of its key so far."""
    return store.answers(_requests(t), "event_id")


@query("""
SELECT user_id AS key, event_type AS op, event_id, ts AS "at" FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def folded_log(t: Tables) -> DataFrame:
    """The latest event of every user, by a stream that folds the log into buckets."""
    folder = new_path(t.spark, "fold")
    log = t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parquet*")
    rows = log.select(F.col("user_id").alias("key"), F.col("event_type").alias("op"), "event_id", F.col("ts").alias("at"))
    events.fold_log(rows, f"{folder}/state", "key", "at", "event_id", checkpoint=f"{folder}/checkpoint").awaitTermination()
    return events.read_state(t.spark, f"{folder}/state")
