"""Functions that built-in ones cannot express: Arrow-batched scalar, grouped and table functions."""

from __future__ import annotations

import difflib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql.types import DoubleType, StringType, StructType


@pandas_udf(DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The share of matching blocks of two strings (0 where either is null), to six places."""
    pairs = zip(a, b, strict=True)
    return pd.Series([round(difflib.SequenceMatcher(None, x, y).ratio(), 6) if x is not None and y is not None else 0.0 for x, y in pairs])


def repair(text: str | None) -> str | None:
    """UTF-8 that was read as a legacy code page, read again; anything else as it is."""
    if not text or not any(c in text for c in "ÃÂâ"):
        return text
    try:
        again = text.encode("cp1252").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return text
    return again if len(again) < len(text) else text


@pandas_udf(StringType())
def repaired(text: pd.Series) -> pd.Series:
    return text.map(repair, na_action="ignore")


def decode(raw: bytes | None, declared: str | None) -> str | None:
    """Bytes as UTF-8, else in the declared character set, else in cp1252, else latin-1."""
    if raw is None:
        return None
    for name in ("utf-8", declared or "utf-8", "cp1252"):
        try:
            return raw.decode(name)
        except (UnicodeDecodeError, LookupError):
            continue
    return raw.decode("latin-1")


@pandas_udf(StringType())
def decoded(raw: pd.Series, declared: pd.Series) -> pd.Series:
    return pd.Series([decode(bytes(r) if r is not None else None, d) for r, d in zip(raw, declared, strict=True)], dtype=object)


NAMES = uuid.NAMESPACE_URL


@pandas_udf(StringType())
def name_uuid(name: pd.Series) -> pd.Series:
    """A UUID that depends on the name alone."""
    return name.map(lambda x: str(uuid.uuid5(NAMES, x)), na_action="ignore")


@pandas_udf(DoubleType())
def middle(values: pd.Series) -> float:
    """The median of a group (grouped aggregate; a group is held in one place)."""
    return float(values.median())


@udtf(returnType=StructType().add("pos", "integer").add("word", "string"))
class Words:
    """Words of a text with their places."""

    def eval(self, text: str) -> Iterator[tuple[int, str]]:
        yield from enumerate((text or "").split(" "))
