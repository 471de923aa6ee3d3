"""Lists, maps and records as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def string_list(c: Column | str, sep: str = ",") -> Column:
    """A list in one string, trimmed and without blanks; null is an empty list."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.filter(F.transform(F.split(c, sep), lambda x: F.trim(x)), lambda x: x != ""), F.array().cast("array<string>"))


def flat_references(*columns: Column) -> Column:
    """Scalars and lists of references as one list of distinct values in order, without nulls and blanks."""
    lists = [F.coalesce(c, F.array().cast("array<string>")) for c in columns]
    return F.array_distinct(F.filter(F.concat(*lists), lambda x: x.isNotNull() & (F.trim(x) != "")))


def scalar(c: Column) -> Column:
    """A scalar as a list of one."""
    return F.array(c.cast("string"))


def merged_tags(a: Column, b: Column) -> Column:
    """The sorted union of two lists of tags."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(a, none), F.coalesce(b, none)))


def other_keys(known: list[str], columns: list[str]) -> Column:
    """A JSON object of the columns that are not known ones, nulls left out."""
    return F.to_json(F.struct(*(F.col(c) for c in columns if c not in known)))


def record_text(scalars: list[Column], lists: list[Column]) -> Column:
    """Fields of a record as paragraphs: scalars, then lists, distinct in order."""
    parts = F.concat(F.array(*(c.cast("string") for c in scalars)), *lists)
    return F.array_join(F.array_distinct(F.filter(parts, lambda x: x.isNotNull() & (F.trim(x) != ""))), "\n\n")
