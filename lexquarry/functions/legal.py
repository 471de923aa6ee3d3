"""Citations, identifiers, clauses and terms of legal texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Forms of citations, terms and clauses.
CRS = r"\b\d{1,3}(?:\.\d+)?-\d+(?:\.\d+)?-\d+(?:\.\d+)?\b"
CCR = r"\b(\d{1,2}) CCR (\d{3,4}-\d{1,4}(?:-\d{1,4})?)\b"
FEDERAL = r"\b\d{1,2}\s+(?:CFR|C\.F\.R\.|USC|U\.S\.C\.)\s+\d{1,5}(?:\.\d+)?\b"
TERM = r'"([^"]{2,80})"\s+means\b'
CLAUSE = r"(?i)\b(?:if|when|unless|except(?: as provided)?|provided that)\b[^.;]+"
TEMPORAL = r"(?i)\b(?:within\s+\d+\s+(?:calendar\s+)?(?:days?|months?|years?)|no later than\s+[^.;,]+|before\s+[^.;,]+|after\s+[^.;,]+|annually|quarterly|monthly|weekly|daily)\b"
ACTION = r"(?i)((?:No\s+)?[A-Za-z0-9][^.;:]{2,180}?)\s+(shall not|may not|must not|is prohibited from|are prohibited from|is required to|are required to|shall|must|may)\b([^.;]{8,520})"

#: Titles of the statutes run from 1 to this.
LAST_TITLE = 44


def crs_number(part: Column) -> Column:
    """A segment of a citation without leading zeros, and without those that end its decimals."""
    whole = F.substring_index(part, ".", 1).cast("int").cast("string")
    decimals = F.rtrim(F.substring_index(part, ".", -1), F.lit("0"))
    return F.when(part.contains("."), F.concat(whole, F.lit("."), F.when(decimals == "", "0").otherwise(decimals))).otherwise(whole)


def crs_id(citation: Column) -> Column:
    """``CRS-title-article-section``."""
    parts = F.split(citation, "-")
    return F.concat_ws("-", F.lit("CRS"), *(crs_number(parts[k]) for k in range(3)))


def crs_ids(text: Column | str) -> Column:
    """Canonical statute citations, distinct, in order of their names."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(CRS), F.lit(0)), crs_id)))


def ccr_ids(text: Column | str) -> Column:
    """``n_CCR_series-rule`` of every regulation cited, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(CCR), F.lit(0)), lambda c: F.replace(c, F.lit(" "), F.lit("_")))


def federal_ids(text: Column | str) -> Column:
    """Federal citations with single spaces, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(FEDERAL), F.lit(0)), lambda c: F.regexp_replace(c, r"\s+", " "))


def defined_terms(text: Column | str) -> Column:
    """Quoted terms before "means", distinct and sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(1))))


def near_citation(text: str, citation: str) -> Column:
    """Does the column ``citation`` stand within 80 characters of "C.R.S.", or behind a section sign, in the column ``text``?"""
    quoted = f"regexp_replace({citation}, '([.])', '[.]')"
    return F.expr(f"{text} rlike concat('C[.]R[.]S[.].{{0,80}}', {quoted}, '|', {quoted}, '.{{0,80}}C[.]R[.]S[.]|§ ?', {quoted})")


def slug(c: Column | str) -> Column:
    """Upper case, with underscores for runs of other signs than letters and digits."""
    return F.upper(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))


def kept_sentences(text: Column, unwanted: Column) -> Column:
    """The text without the sentences that hold any of the array ``unwanted``, case aside."""
    parts = F.split(F.regexp_replace(text, r"([.;])\s+", "$1\u0001"), "\u0001")
    return F.array_join(F.filter(parts, lambda s: ~F.exists(unwanted, lambda w: F.lower(s).contains(F.lower(w)))), " ")
