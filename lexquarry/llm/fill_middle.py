"""Fill-in-the-middle transformation with a two-pass streaming matcher.

A text is tiled by units: white space with the word after it, or white space at the
end.  Two numbers of units, drawn from the document's id, cut it into prefix, middle
and suffix, which are written in one of two orders behind markers, or left plain.

Each text is matched twice and never split: the first pass counts units, the second
moves one lazy iterator of matches on to the lower and then to the higher cut.  Memory
is the text and what is made of it, whatever its number of units.

Defined cases: a null text counts as empty; an empty text and one that holds a marker
stay plain; a null id draws as ``42:`` followed by nothing; repeated rows give repeated
results; an empty table gives an empty one; texts of any length are taken whole; columns
other than the id and the text play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKER = re.compile("|".join((PREFIX, SUFFIX, MIDDLE)))
#: Characters of finished texts in a batch on their way back, or one text.
_BATCH = 2_000_000

_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Draw:
    """How often a text is transformed, how often suffix first, and the seed; all in hundredths."""

    seed: str = "42"
    transformed: int = 50
    suffix_first: int = 80

    def numbers(self, key: int | None) -> list[int]:
        """Four unsigned 32-bit numbers of a document's id."""
        digest = hashlib.sha256(f"{self.seed}:{'' if key is None else key}".encode()).hexdigest()
        return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def count_units(text: str) -> int:
    """The number of units, by one pass over lazy matches."""
    return sum(1 for _ in _UNIT.finditer(text))


def cut_points(text: str, low: int, high: int) -> tuple[int, int]:
    """Where the first ``low`` and the first ``high`` units end, by moving one lazy iterator on to both ranks."""
    matches, passed, ends = _UNIT.finditer(text), 0, []
    for rank in (low, high):
        if rank > passed:
            ends.append(next(islice(matches, rank - passed - 1, None)).end())
            passed = rank
        else:
            ends.append(ends[-1] if ends else 0)
    return ends[0], ends[1]


def transform(text: str, key: int | None, draw: Draw) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, characters of prefix and middle (none if plain), and the transformed text."""
    n = count_units(text)
    h1, h2, h3, h4 = draw.numbers(key)
    if not text or h3 % 100 >= draw.transformed or _MARKER.search(text):
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = cut_points(text, low, high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < draw.suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _transformer(draw: Draw):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for b in batches:
            rows, held = [], 0
            for key, text in zip(b.column(0), b.column(1), strict=True):  # one text at a time as a string
                key = key.as_py()
                rows.append((key, *transform(text.as_py() or "", key, draw)))
                held += len(rows[-1][-1])
                if held >= _BATCH:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)

    return run


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", draw: Draw = Draw()) -> DataFrame:
    """Per row: ``doc_id, n, form, prefix_chars, middle_chars, output``; one pass over the rows, no shuffle."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(_transformer(draw), _SCHEMA)


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that a transformed text was made of.

    No text that holds a marker is transformed, and no marker can begin inside a part and end
    in the marker after it, so each marker stands once where one is looked for.
    """
    output, form = F.col(output) if isinstance(output, str) else output, F.col(form) if isinstance(form, str) else form
    first = lambda x, mark: F.substring_index(x, mark, 1)
    after = lambda x, mark: F.substring_index(x, mark, -1)
    psm = F.concat(first(after(output, PREFIX), SUFFIX), after(output, MIDDLE), first(after(output, SUFFIX), MIDDLE))
    spm = F.concat(first(after(output, PREFIX), MIDDLE), after(output, MIDDLE), first(after(output, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(transformed: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of :func:`fill_in_middle`'s rows."""
    return transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored("output", "form"), 256).alias("restored_sha256"))
