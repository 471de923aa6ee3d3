"""Scores, routes and buckets as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexquarry.functions.text import ladder


def clamp(c: Column | str) -> Column:
    """The value, kept to 0..1; null counts as 0."""
    return F.least(F.greatest(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def weighted_mean(weights: dict[str, float]) -> Column:
    """Mean of clamped columns by weight."""
    total = sum(weights.values())
    terms = [clamp(c) * w for c, w in weights.items()]
    return sum(terms[1:], terms[0]) / total


def route(confidence: Column, rejected: Column | None = None) -> Column:
    """reject, auto_accept (.85), accept_flagged (.60) or quarantine."""
    steps = [(confidence >= 0.85, "auto_accept"), (confidence >= 0.60, "accept_flagged")]
    return ladder(*([(rejected, "reject")] if rejected is not None else []), *steps, otherwise="quarantine")


def confidence_bucket(c: Column) -> Column:
    """high (.85), medium (.75) or low."""
    return ladder((c >= 0.85, "high"), (c >= 0.75, "medium"), otherwise="low")


def match_confidence(best: Column, n: Column) -> Column:
    """The best match's confidence, raised by .02 for each further match (.08 at most), up to .99."""
    return F.least(F.round(best + F.least(F.lit(0.08), 0.02 * (n - 1)), 3), F.lit(0.99))


def freshness(age_days: Column, watch: int = 7, stale: int = 30) -> Column:
    """unknown, stale, watch or fresh."""
    return ladder((age_days.isNull(), "unknown"), (age_days > stale, "stale"), (age_days > watch, "watch"), otherwise="fresh")


def coverage_label(rows: Column, missing: Column, low: Column) -> Column:
    """Label of an edge table by its share of rows without evidence or of low confidence."""
    risk = (missing + low) / F.nullif(rows, F.lit(0))
    return ladder((rows == 0, "empty"), (risk >= 0.5, "needs_review"), (risk > 0, "usable_with_warnings"), otherwise="usable")


def worst_status(c: Column | str) -> Column:
    """Aggregate: fail over warn over pass."""
    code = F.max(ladder((F.col(c) == "fail", 2), (F.col(c) == "warn", 1), otherwise=0) if isinstance(c, str) else c)
    return ladder((code == 2, "fail"), (code == 1, "warn"), otherwise="pass")
