"""Votes, levels and gates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexquarry.functions.text import ladder


def exact_vote(a: Column, b: Column, pattern: Column) -> Column:
    """``status, value, confidence`` of two models and a pattern: two that agree are accepted, else quarantine.

    Null agrees with nothing.
    """
    same = lambda x, y: F.coalesce(x == y, F.lit(False))
    by = ladder((same(a, b), 0.99), (same(a, pattern) | same(b, pattern), 0.90), otherwise=0.0).cast("double")
    value = F.when(same(a, b) | same(a, pattern), a).when(same(b, pattern), b)
    return F.struct(F.when(by > 0, "ACCEPT").otherwise("QUARANTINE").alias("status"), value.alias("value"), by.alias("confidence"))


def similarity_vote(similarity: Column) -> Column:
    """ACCEPT above .90, FLAG from .70, else QUARANTINE."""
    return ladder((similarity > 0.90, "ACCEPT"), (similarity >= 0.70, "FLAG"), otherwise="QUARANTINE")


def text_vote(grounded_a: Column, grounded_b: Column) -> Column:
    """Which of two texts is taken, by whether each is grounded in its source."""
    return F.struct(
        ladder((grounded_a & grounded_b, "ACCEPT"), (grounded_a | grounded_b, "ACCEPT"), otherwise="REJECT").alias("status"),
        ladder((grounded_a, "a"), (grounded_b, "b")).alias("choice"),
        ladder((grounded_a & grounded_b, 0.90), (grounded_a | grounded_b, 0.80), otherwise=0.0).cast("double").alias("confidence"),
    )


#: Statuses of fields, the worse the later.
SEVERITY = ("ACCEPT", "FLAG", "QUARANTINE", "REJECT")


def worst(statuses: Column) -> Column:
    """The worst of an array of statuses."""
    rank = F.array_max(F.transform(statuses, lambda s: F.array_position(F.array(*(F.lit(x) for x in SEVERITY)), s)))
    return F.element_at(F.array(*(F.lit(x) for x in SEVERITY)), rank.cast("int"))


# Checks of an automated review with their weights; the first three must hold.
CHECKS = {"official": 0.20, "retrieved": 0.15, "text": 0.25, "identity": 0.15, "jurisdiction": 0.10, "fresh": 0.10, "unique": 0.05}
HARD = ("official", "retrieved", "text")


def gate(checks: dict[str, Column]) -> Column:
    """``score, failures, approved`` of boolean checks: approved from .95 where none of HARD fails; null fails."""
    held = {name: F.coalesce(c, F.lit(False)) for name, c in checks.items()}
    terms = [F.when(held[name], round(100 * weight)).otherwise(0) for name, weight in CHECKS.items()]
    score = (sum(terms[1:], terms[0]) / 100).cast("double")
    failures = F.filter(F.array(*(F.when(~held[name], F.lit(name)) for name in HARD)), lambda x: x.isNotNull())
    return F.struct(score.alias("score"), failures.alias("failures"), ((F.size(failures) == 0) & (score >= 0.95)).alias("approved"))


def text_quality(scores: dict[str, Column], fidelity: str, entity: str) -> Column:
    """``overall, level, issues`` of five scores in hundredths."""
    total = sum(list(scores.values())[1:], list(scores.values())[0])
    overall = F.round(total / (100 * len(scores)), 2)
    issues = F.filter(F.array(*(F.when(c < 60, F.lit(name)) for name, c in scores.items())), lambda x: x.isNotNull())
    level = ladder(
        ((scores[fidelity] <= 30) | (scores[entity] <= 55), "needs_review"), ((overall >= 0.86) & (F.size(issues) == 0), "high"), (overall >= 0.68, "medium"), otherwise="needs_review"
    )
    return F.struct(overall.alias("overall"), level.alias("level"), F.array_join(issues, "|").alias("issues"))


# Ranks of authorities.
AUTHORITY = {"federal": 4, "state": 3, "county": 2, "municipal": 1}


def authority_rank(level: Column) -> Column:
    return ladder(*((level == name, rank) for name, rank in AUTHORITY.items()), otherwise=0)
