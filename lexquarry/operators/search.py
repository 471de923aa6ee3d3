"""Ranked search: a request becomes terms, anchors, domains and an intent; rows are scored by rule tables.

The rule tables are arguments, so that a corpus brings its own; all of them are small
(they are literals in the plan), while entities and chunks may be of any size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.functions.text import STOP_WORDS, contains_term
from lexquarry.scratch import save


@dataclass(frozen=True)
class Rules:
    """Tables of a search.

    ``expansions``: triggers with the terms they add; ``anchors``: terms of which one must be there,
    by trigger; ``domains``: triggers of each domain, in the order of diversification;
    ``boosts``: (domain, term, points), negative for noise; ``preferred``: (trigger, kind, points).
    """

    expansions: dict[str, tuple[str, ...]] = field(default_factory=dict)
    anchors: dict[str, tuple[str, ...]] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    boosts: tuple[tuple[str, str, int], ...] = ()
    preferred: tuple[tuple[str, str, int], ...] = ()


@dataclass(frozen=True)
class Request:
    """What a request asks for."""

    text: str
    terms: tuple[str, ...]
    anchors: tuple[str, ...]
    domains: tuple[str, ...]
    preferred: tuple[tuple[str, int], ...]
    least: int
    assumptions: tuple[str, ...]


def normal(text: str) -> str:
    return " ".join(re.findall("[a-z0-9]+", text.lower()))


def _triggered(trigger: str, said: str) -> bool:
    return trigger in said if " " in trigger else f" {trigger} " in f" {said} "


def understand(text: str, rules: Rules) -> Request:
    """Terms are the words of the request that are no stop words, then those its triggers add.

    Two of the request's own terms must match where it has three or more, else one.
    """
    said = normal(text)
    own = tuple(dict.fromkeys(w for w in said.split() if len(w) >= 3 and w not in STOP_WORDS))
    added = {t: more for t, more in rules.expansions.items() if _triggered(t, said)}
    terms = tuple(dict.fromkeys([*own, *(w for more in added.values() for w in more)]))
    anchors = tuple(dict.fromkeys(a for t, more in rules.anchors.items() if _triggered(t, said) for a in more))
    domains = tuple(d for d, triggers in rules.domains.items() if any(_triggered(t, said) for t in triggers))
    preferred = tuple((kind, points) for t, kind, points in rules.preferred if _triggered(t, said))
    return Request(text, terms, anchors, domains, preferred, 2 if len(own) >= 3 else 1, tuple(f"{t} -> {' '.join(more)}" for t, more in added.items()))


def _count(normal_text: Column, term: str, most: int) -> Column:
    """Occurrences of a term as a string, not overlapping, up to ``most``."""
    return F.least(F.floor((F.length(normal_text) - F.length(F.replace(normal_text, F.lit(term), F.lit("")))) / len(term)), F.lit(most))


def score_chunks(chunks: DataFrame, request: Request, rules: Rules, text: str = "norm", kind: str | None = None) -> DataFrame:
    """``chunks`` that hold enough terms and one anchor, with ``hits`` and ``score``.

    40, and the occurrences of each term (12 at most), 24 for each term that is there as a whole word,
    and the points of the rules for the request's domains and preferred kinds.
    """

    def scored(x: Column) -> Column:
        hits = sum((contains_term(x, w).cast("int") for w in request.terms), F.lit(0))
        score = F.lit(40) + 24 * hits + sum((_count(x, w, 12) for w in request.terms), F.lit(0))
        for domain, term, points in rules.boosts:
            if domain in request.domains:
                score = score + F.when(contains_term(x, term), points).otherwise(0)
        if kind:
            for name, points in request.preferred:
                score = score + F.when(F.col(kind) == name, points).otherwise(0)
        some = reduce(lambda p, q: p | q, (contains_term(x, a) for a in request.anchors)) if request.anchors else F.lit(True)
        return F.struct(hits.cast("long").alias("hits"), score.cast("long").alias("score"), some.alias("some"))

    # in a lambda the text is put in normal form once; a plain filter would be moved below that step and repeat it for every term
    found = F.filter(F.transform(F.array(text), scored), lambda r: (r["hits"] >= request.least) & r["some"] & (r["score"] > 0))
    return chunks.select("*", F.explode(found).alias("_found")).select(*(F.col(f"`{c}`") for c in chunks.columns), "_found.hits", "_found.score")


def best_of(found: DataFrame, key: str, place: str) -> DataFrame:
    """The best chunk of every entity: the highest score, then the first place."""
    rest = [c for c in found.columns if c != key]
    return found.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col("score"), -F.col(place))).alias("r")).select(key, *(F.col("r")[c].alias(c) for c in rest))


def spread(found: DataFrame, domain: str, key: str, k: int, domains: tuple[str, ...]) -> DataFrame:
    """Top ``k`` with the best of every required domain first, in the order of the domains, if two are required or more."""
    first = F.lit(len(domains))
    if len(domains) >= 2:
        found = save(found, "found")  # read twice, and its texts are long to score
        tops = found.where(F.col(domain).isin(*domains)).groupBy(domain).agg(F.max_by(key, F.struct(F.col("score"), -F.col(key))).alias("_top"))
        order = F.coalesce(*(F.when(F.col(domain) == d, i) for i, d in enumerate(domains)))
        found = found.join(F.broadcast(tops), domain, "left")  # one row a required domain
        first = F.when(F.col(key) == F.col("_top"), order).otherwise(first)
        found = found.withColumn("_first", first)
        return found.orderBy("_first", F.desc("score"), key).limit(k).withColumn("leads", F.col("_first") < len(domains)).drop("_top", "_first")
    return found.withColumn("leads", F.lit(False)).orderBy(F.desc("score"), key).limit(k)


def postings(chunks: DataFrame, key: str, text: str = "norm") -> DataFrame:
    """The inverted index: ``token, key, n``, written once and then read by many requests."""
    words = chunks.select(key, F.explode(F.filter(F.split(text, " "), lambda w: F.length(w) >= 3)).alias("token"))
    return words.groupBy("token", key).agg(F.count("*").alias("n"))


def candidates(index: DataFrame, request: Request, key: str) -> DataFrame:
    """Keys of enough terms of the request, from the index alone (the terms are pushed down to its scan)."""
    return index.where(F.col("token").isin(*request.terms)).groupBy(key).agg(F.count("*").alias("hits")).where(F.col("hits") >= request.least)


def running_total(df: DataFrame, group: str, cost: Column, *order: Column) -> Column:
    """The costs of a group up to and with each row, in its order."""
    return F.sum(cost).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
