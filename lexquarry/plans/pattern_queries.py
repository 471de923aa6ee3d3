"""Queries of many terms in many texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.functions import text
from lexquarry.operators import patterns
from lexquarry.plans.registry import Tables, query

_NORM = "trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))"
_WORDS = f"string_split({_NORM}, ' ')"


def _docs(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.normalize("text").alias("norm"))


def _phrases(t: Tables) -> DataFrame:
    """Every word and pair of words of the benchmark's items."""
    w = t.benchmark.select(F.split(text.normalize("text"), " ").alias("w"))
    pairs = F.transform(text.all_but_first(F.col("w")), lambda x, i: F.concat_ws(" ", F.get("w", i), x))
    terms = w.select(F.explode(F.concat("w", pairs)).alias("term")).where("term <> ''").distinct()
    return terms.withColumn("term_id", F.xxhash64("term"))


_PHRASES = f"""
WITH b AS (SELECT {_WORDS} AS w FROM benchmark), t AS (SELECT DISTINCT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM b),
d AS (SELECT doc_id, {_NORM} AS norm, {_WORDS} AS w FROM documents), g AS (SELECT doc_id, norm, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM d)
SELECT doc_id, g.term, count(*)::BIGINT AS n, min(instr(' ' || norm || ' ', ' ' || g.term || ' '))::BIGINT AS first FROM g JOIN t ON g.term = t.term WHERE g.term <> '' GROUP BY 1, 2"""


def _found(t: Tables, limit: int) -> DataFrame:
    terms = _phrases(t)
    return patterns.match_terms(_docs(t), "doc_id", "norm", terms, limit).join(terms, "term_id").select(F.col("key").alias("doc_id"), "term", "n", "first")


@query(_PHRASES)
def phrase_matches(t: Tables) -> DataFrame:
    """Which words and pairs of words of the benchmark stand in which documents, by one automaton."""
    return _found(t, patterns.AUTOMATON_BYTES)


@query(_PHRASES)
def phrase_matches_joined(t: Tables) -> DataFrame:
    """The same as for a taxonomy that is too large to broadcast."""
    return _found(t, 0)


@query(f"""
WITH r AS (SELECT DISTINCT item_id AS tag, unnest(list_filter({_WORDS}, lambda x: length(x) >= 8)) AS term FROM benchmark), d AS (SELECT DISTINCT doc_id, unnest({_WORDS}) AS term FROM documents)
SELECT doc_id, tag, count(*)::BIGINT AS hits, max(length(d.term) / 16)::DOUBLE AS weight FROM d JOIN r ON d.term = r.term GROUP BY 1, 2""")
def taxonomy_tags(t: Tables) -> DataFrame:
    """Tags of a taxonomy that is a table (here, items with their long words), with hits and the greatest weight."""
    w = t.benchmark.select(F.col("item_id").alias("tag"), F.explode(F.split(text.normalize("text"), " ")).alias("term")).where(F.length("term") >= 8).distinct()
    rules = w.select(F.xxhash64("term").alias("term_id"), "tag", (F.length("term") / 16).alias("weight"))
    terms = w.select("term").distinct().withColumn("term_id", F.xxhash64("term"))
    found = patterns.match_terms(_docs(t), "doc_id", "norm", terms)
    return patterns.tagged(found, rules).withColumnRenamed("key", "doc_id")
