"""Dates in texts and records, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Forms of dates.
ISO = r"\b((?:19|20)\d\d)-(\d{1,2})-(\d{1,2})\b"
SLASHED = r"\b(\d{1,2})/(\d{1,2})/((?:19|20)\d\d)\b"
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
NAMED = rf"\b({'|'.join(MONTHS)}) (\d{{1,2}}), ((?:19|20)\d\d)\b"
FISCAL = r"(?i)\bfiscal year ((?:19|20)\d\d)\b"


def _named_day(text: Column) -> Column:
    """The date of "Month D, YYYY" text."""
    part = lambda g: F.regexp_extract(text, NAMED, g)
    month = F.array_position(F.array(*(F.lit(m) for m in MONTHS)), part(1))
    return _day(part(3), month.cast("string"), part(2))


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")


def _from(pattern: str, year: int, month: int, day: int):
    return lambda text: _day(*(F.regexp_extract(text, pattern, g) for g in (year, month, day)))


_FORMS = ((ISO, _from(ISO, 1, 2, 3)), (SLASHED, _from(SLASHED, 3, 1, 2)), (NAMED, _named_day))


def all_dates(text: Column | str) -> Column:
    """Every date of the three forms that a calendar has, by form and then in order."""
    lists = (F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(0)), day) for p, day in _FORMS)
    return F.filter(F.concat(*lists), lambda d: d.isNotNull())


def flexible_date(c: Column | str) -> Column:
    """A whole value as a date: ISO, or month/day/year with four digits or two (20xx); null otherwise."""
    c = F.trim(c)
    short = r"^(\d{1,2})/(\d{1,2})/(\d\d)$"
    iso = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), _from(r"^(\d{4})-(\d{1,2})-(\d{1,2})$", 1, 2, 3)(c))
    slashed = F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), _from(r"^(\d{1,2})/(\d{1,2})/(\d{4})$", 3, 1, 2)(c))
    two = F.when(c.rlike(short), _day(F.concat(F.lit("20"), F.regexp_extract(c, short, 3)), F.regexp_extract(c, short, 1), F.regexp_extract(c, short, 2)))
    return F.coalesce(iso, slashed, two)


def stated_date(c: Column | str) -> Column:
    """The first ISO date, else the first "Month D, YYYY", else the first of July before a fiscal year."""
    c = F.col(c) if isinstance(c, str) else c
    fiscal = F.nullif(F.regexp_extract(c, FISCAL, 1), F.lit("")).try_cast("int")
    return F.coalesce(_FORMS[0][1](c), _named_day(c), F.make_date(fiscal - 1, F.lit(7), F.lit(1)))


def day_text(d: Column | str) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def newer(observed: Column, held: Column) -> Column:
    """Is a marker newer than the one held?  By date where both are dates, else where they differ; true where none is held."""
    a, b = flexible_date(observed), flexible_date(held)
    return F.when(observed.isNull(), False).when(held.isNull(), True).when(a.isNotNull() & b.isNotNull(), a > b).otherwise(F.trim(observed) != F.trim(held))
