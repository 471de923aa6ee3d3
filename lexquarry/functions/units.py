"""Obligations, clauses and parts of bills in legal prose, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexquarry.functions.legal import ACTION, CLAUSE, TEMPORAL
from lexquarry.functions.text import ladder

# Forms of bills.
MONEY = r"\$\s*\d[\d,]*(?:\.\d{2})?"
FUND = r"(?i)\b(general fund|cash funds?|federal funds?|state education fund|marijuana tax cash fund|highway users tax fund|[\w\s-]{2,80}\s+fund)\b"
STAFF = r"\b(\d+(?:\.\d+)?) FTE\b"
PENALTY = r"(?i)\b(class [1-6] (?:felony|misdemeanor)|fine of \$[\d,]+|imprisonment (?:for|of) [^.;,]+)"
HONORIFICS = r"(?i)\b(?:representatives?|senators?)\b"
# Subjects, and parts of subjects, that do not say who is meant.
VAGUE = ("it", "this", "that", "there", "these", "those")
FRONT_MATTER = ("following general definitions", "following definitions", "purpose of these", "statutory authority")
# What a section does to the law, in the order of tests, in lower case.
SECTION_ACTIONS = (
    ("repeal", r"\bis\s+(?:hereby\s+)?repealed\b|\brepeal(?:ed|ing)?\b"),
    ("add", r"\b(?:by\s+the\s+addition\s+of|is\s+added|add\s+a\s+new)\b"),
    ("amend", r"\bis\s+amended(?:\s+to\s+read)?\b"),
    ("new", r"\b(?:new\s+(?:article|part|section)|is\s+enacted)\b"),
)
# Clauses that open exceptions; the other clauses are conditions.
EXCEPTIONS = r"(?i)^(unless|except)"


def action(sentence: Column | str) -> Column:
    """``subject, modal, rest`` of a sentence that orders, allows or forbids; empty strings in any other."""
    part = lambda g: F.trim(F.regexp_extract(sentence, ACTION, g))
    return F.struct(part(1).alias("subject"), F.lower(part(2)).alias("modal"), part(3).alias("rest"))


def clauses(text: Column | str, exceptions: bool) -> Column:
    """The conditions (if, when, provided that) or the exceptions (unless, except) of a text."""
    found = F.transform(F.regexp_extract_all(text, F.lit(CLAUSE), F.lit(0)), lambda c: F.trim(c))
    return F.filter(found, lambda c: c.rlike(EXCEPTIONS) if exceptions else ~c.rlike(EXCEPTIONS))


def temporal(text: Column | str) -> Column:
    """The first phrase of time, or null."""
    return F.nullif(F.trim(F.regexp_extract(text, TEMPORAL, 0)), F.lit(""))


def fit_subject(subject: Column) -> Column:
    """Neither vague nor short nor of front matter, and with a letter."""
    low = F.lower(subject)
    front = F.lit(False)
    for part in FRONT_MATTER:
        front = front | low.contains(part)
    return (F.length(subject) >= 4) & ~low.isin(*VAGUE) & ~front & subject.rlike("[A-Za-z]")


def section_action(body: Column) -> Column:
    """repeal, add, amend, new or other, by the first 1,200 characters."""
    head = F.lower(F.substring(body, 1, 1200))
    return ladder(*((head.rlike(p), name) for name, p in SECTION_ACTIONS), otherwise="other")


def sponsors(names: Column) -> Column:
    """Names without brackets, titles and joining words, distinct in order, case aside."""
    plain = F.regexp_replace(F.regexp_replace(names, r"\([^)]*\)", " "), HONORIFICS, " ")
    pieces = F.split(F.regexp_replace(plain, r"(?i)\b(?:and|with|also)\b", ","), "[,;\n]+")
    clean = F.filter(F.transform(pieces, lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    low = F.transform(clean, lambda x: F.lower(x))
    return F.filter(clean, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)
