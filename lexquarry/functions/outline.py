"""The outline of texts: blocks of lines under open headings, by one pass over each text.

A level is a name and a pattern; a line that a level's pattern finds opens a heading of that
level, titled by the pattern's first group (or the line without blanks at its ends), and
closes the headings of its own and deeper levels.  Lines under a heading make up its block,
up to the next heading.  Each text is read in its own row by a stack of open headings: no
shuffle, in time and memory linear in the text, whatever its number of lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK = (
    "block long, piece long, level int, heading string, opened string, opened_line long, opened_page long, labels map<string,string>, path array<string>, body string, n_lines long, "
    "first_line long, last_line long, first_char long, last_char long, first_page long, last_page long"
)
_BATCH = 2_000_000


@dataclass(frozen=True)
class Shape:
    """How texts are laid out.

    ``levels``: (name, pattern) from the highest; ``noise``: lines that count for nothing but, with ``most``, end a piece;
    ``marker``: lines that turn a page, whose first group is its number; ``most``: characters after which, and ``blank``:
    whether at lines without a word, a block is cut into pieces; ``joint``: what stands between lines of a body.
    """

    levels: tuple[tuple[str, str], ...]
    noise: str | None = None
    marker: str | None = None
    most: int | None = None
    blank: bool = False
    joint: str = "\n"


def fold(text: str | None, shape: Shape) -> Iterator[tuple]:
    """The rows of ``BLOCK`` of one text, those of headings without lines included (their ``n_lines`` is 0, their lines the heading's)."""
    levels = [(name, re.compile(pattern)) for name, pattern in shape.levels]
    noise, marker = (re.compile(p) if p else None for p in (shape.noise, shape.marker))
    open_: list[str | None] = [None] * len(levels)
    opened: tuple[str | None, int | None, int | None] = (None, None, None)
    level, block, piece, page = 0, 0, 0, None
    lines: list[str] = []
    size, first, last, chars, pages = 0, 0, 0, (0, 0), (None, None)

    def row() -> tuple:
        labels = [(name, title) for (name, _), title in zip(levels, open_, strict=True) if title is not None]
        return (block, piece, level, open_[level - 1] if level else None, *opened, labels, [t for _, t in labels], shape.joint.join(lines), len(lines), first, last, chars[0], chars[1], *pages)

    at = 0
    for number, line in enumerate((text or "").split("\n"), 1):
        begin, at = at, at + len(line) + 1
        turned = marker.search(line) if marker else None
        if turned:
            page = int(turned[1])
            continue
        if (noise and noise.search(line)) or (shape.blank and not line.strip()):
            if lines and (shape.most is not None or shape.blank):
                yield row()
                lines, size, piece = [], 0, piece + 1
            continue
        found = next(((k, m) for k, (_, p) in enumerate(levels) if (m := p.search(line))), None)
        if found:
            if lines or (level and not piece):
                yield row()
            k, m = found
            open_[k] = (m[1] if m.re.groups and m[1] is not None else line).strip()
            open_[k + 1 :] = [None] * (len(levels) - k - 1)
            opened = (line, number, page)
            level, block, piece, lines, size = k + 1, block + 1, 0, [], 0
            first = last = number
            chars, pages = (begin + 1, begin + len(line)), (page, page)
            continue
        if lines and shape.most is not None and size + len(line) > shape.most:
            yield row()
            lines, size, piece = [], 0, piece + 1
        if not lines:
            first, chars, pages = number, (begin + 1, 0), (page, page)
        lines.append(line)
        size += len(line) + len(shape.joint)
        last, chars, pages = number, (chars[0], begin + len(line)), (pages[0], page)
    if lines or (level and not piece):
        yield row()


def outline(df: DataFrame, key: str, text: str, shape: Shape) -> DataFrame:
    """``key`` and the rows of ``BLOCK``: every block of every text.

    ``block`` numbers headings from 1 (0 is what stands above the first), ``opened`` is the heading's whole line, ``piece`` the pieces of a block from 0; ``path`` has
    the open headings, ``labels`` the same by the names of their levels; lines, characters and pages are of the block's first and
    last line, from 1.  A null text counts as empty; an empty one without headings is one block of one empty line, unless
    blank lines part pieces.  Rows of equal keys are read each for itself; other columns play no part.
    """
    own = df.select(F.col(key), F.col(text).cast("string").alias("__text"))
    whole, target = own.schema.fields[0], to_arrow_schema(df.sparkSession.createDataFrame([], BLOCK).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, of, held = [], [], 0
            for i, x in enumerate(batch.column(1)):  # one text at a time as a string
                x = x.as_py()
                for r in fold(x, shape):
                    found.append(r)
                    of.append(i)
                held += len(x or "") + 100
                if held >= _BATCH or i + 1 == batch.num_rows:
                    columns = [pa.array([r[k] for r in found], f.type) for k, f in enumerate(target)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *columns], names=[batch.schema.names[0], *target.names])
                    found, of, held = [], [], 0

    return own.mapInArrow(run, f"`{whole.name}` {whole.dataType.simpleString()}, {BLOCK}")
