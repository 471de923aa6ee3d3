"""Text expressions: normalisers, predicates, tokens, excerpts, citations and markup, all built-in functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# This library's own short list of words left out of search terms.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with")

# Citation forms, by kind.
CITATIONS = {
    "ccr": r"\b\d{1,2} CCR \d{3,4}-\d{1,4}(?:-\d{1,4})?\b",
    "crs": r"\b\d{1,2}(?:\.\d+)?-\d{1,3}(?:\.\d+)?-\d{3,4}(?:\.\d+)?\b",
    "cfr": r"\b\d{1,2} CFR \d{1,4}(?:\.\d+)?\b",
}
_HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>"
_HREF = r"""(?i)<a\b[^>]*?href\s*=\s*["']([^"']*)["']"""
_BLANK = r"[ \t\n\r\f]+"


def normalize(c: Column | str) -> Column:
    """Lower case; runs of anything but a-z and 0-9 become one space."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def normalize_alias(c: Column | str) -> Column:
    """Lower case; only ``. , - _`` become spaces; white space is collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[.,_\-]", " "), _BLANK, " "))


def alias_variants(c: Column | str) -> Column:
    """The normalised alias and the same without spaces."""
    alias = normalize_alias(c)
    return F.array_distinct(F.array(alias, F.replace(alias, F.lit(" "), F.lit(""))))


def contains_term(normal: Column, term: str) -> Column:
    """Is ``term`` in the normalised text as a whole word or words?"""
    return F.concat(F.lit(" "), normal, F.lit(" ")).contains(f" {term} ")


def trigger_matches(normal: Column, trigger: str) -> Column:
    """Triggers of several words match anywhere, single words as whole words."""
    return normal.contains(trigger) if " " in trigger else contains_term(normal, trigger)


def tokens(normal: Column, least: int = 3) -> Column:
    """Words of ``least`` letters or more that are no stop words."""
    return F.filter(F.split(normal, " "), lambda t: (F.length(t) >= least) & ~t.isin(*STOP_WORDS))


def excerpt(text: Column, terms: list[str], before: int = 160, width: int = 460) -> Column:
    """``width`` characters around the first hit of any term; ellipses where text is cut."""
    hits = F.filter(F.array(*(F.locate(t, F.lower(text)) for t in terms)), lambda p: p > 0)
    first = F.coalesce(F.array_min(hits), F.lit(1))
    start = F.greatest(F.lit(1), first - before)
    cut = F.substring(text, start, F.lit(width))
    return F.concat(F.when(start > 1, "...").otherwise(""), F.trim(cut), F.when(F.length(text) >= start + width, "...").otherwise(""))


def citations(text: Column | str, kind: str) -> Column:
    """All citations of a kind, in order."""
    return F.regexp_extract_all(text, F.lit(CITATIONS[kind]), F.lit(0))


def visible_text(html: Column | str) -> Column:
    """Text of a page without markup, scripts and styles, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, _HIDDEN, " "), _BLANK, " "))


def links(html: Column | str) -> Column:
    """Targets of a page's anchors, in order."""
    return F.regexp_extract_all(html, F.lit(_HREF), F.lit(1))


def first_present(*columns: Column | str) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*(F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit("")) for c in columns))


def populated(c: Column | str) -> Column:
    """Neither null nor blank."""
    return F.coalesce(F.length(F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))) > 0, F.lit(False))


def sentences(text: Column | str, least: int = 45, most: int = 720) -> Column:
    """Sentences cut after ``.`` or ``;`` and white space, of ``least`` to ``most`` characters."""
    marked = F.regexp_replace(text, r"([.;])[ \t\n\r\f]+", "$1\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda s: F.trim(s)), lambda s: F.length(s).between(least, most))


def token_count(text: Column | str) -> Column:
    """Estimated model tokens: a quarter of each word's length, rounded up, and one for each sign; at least 1."""
    parts = F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r\f]"), F.lit(0))
    counts = F.transform(parts, lambda p: F.when(p.rlike("^[A-Za-z0-9_]"), F.ceil(F.length(p) / 4)).otherwise(1).cast("long"))
    return F.greatest(F.lit(1).cast("long"), F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b))


def ladder(*steps: tuple[Column, object], otherwise: object = None) -> Column:
    """The value of the first condition that holds."""
    (first, value), *rest = steps
    return reduce(lambda c, s: c.when(s[0], s[1]), rest, F.when(first, value)).otherwise(otherwise)


def all_but_first(parts: Column) -> Column:
    """The items of an array behind the first."""
    return F.filter(parts, lambda x, i: i > 0)
