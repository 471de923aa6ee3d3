"""Secret scanning through trigram inverted indexes.

Each rule's regular expression is parsed into a Boolean query of trigrams that
every match must contain.  Each slice of a partition gets an inverted index of
just the trigrams that some rule asks for (lower-cased bytes -> rows); a rule's
postings are intersected and united as its query says, and only the rows that
remain are verified with the expression itself.  Rules without mandatory
trigrams (bare character classes such as ``hex``) scan every row.

Spans are code points ``kind:start:end`` (end exclusive), leftmost and not
overlapping within a kind, ordered by start, then by the rules' order.

No kind has a greatest length.  Defined cases: a null text is empty; a text longer
than a slice stands alone; spans of several kinds at one place are all reported;
repeated rows are reported for each row; an empty table gives an empty result;
other columns are not read, so they may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from re import _constants as rc
from re import _parser as rp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.llm import _text as tx


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches whose ``group`` is shorter than ``least`` are dropped; the group ``span`` is reported."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False
    span: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, (re.ASCII | re.IGNORECASE) if self.any_case else 0)


# The kinds and their patterns.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    # from the beginning of a run, so that a long run without a token is read once
    Rule("jwt", r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)", span=1),
    Rule("login", r"://[^\s/:@]+:[^\s/:@]{3,}@"),
)
RULES = BASE + MORE

_MOST_STRINGS = 48
_ANY = ("any",)


def _and(parts: list) -> tuple:
    parts = [p for p in parts if p != _ANY]
    return _ANY if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _of_strings(strings: set[str]) -> tuple:
    """Trigrams of which a text holding one of ``strings`` must have all of one string's."""
    ways = []
    for s in sorted(strings):
        raw = s.lower().encode()
        if len(raw) < 3:
            return _ANY
        ways.append(_and([("has", raw[i : i + 3]) for i in range(len(raw) - 2)]))
    return ways[0] if len(ways) == 1 else ("or", *ways)


def _strings(op, arg) -> set[str] | None:
    """All texts that a node may match, if they are few."""
    if op is rc.LITERAL:
        return {chr(arg)}
    if op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
        return {chr(a) for _, a in arg}
    if op is rc.SUBPATTERN:
        return _strings_of(arg[-1])
    if op is rc.BRANCH:
        ways = [_strings_of(b) for b in arg[1]]
        return None if None in ways else set().union(*ways)
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[1] <= 8:
        one = _strings_of(arg[2])
        if one is None:
            return None
        out, run = set(), {""}
        for n in range(arg[1] + 1):
            out |= run if n >= arg[0] else set()
            run = {a + b for a in run for b in one}
            if len(run) > _MOST_STRINGS:
                return None
        return out
    return None


def _strings_of(nodes) -> set[str] | None:
    run = {""}
    for op, arg in nodes:
        more = _strings(op, arg)
        if more is None or len(run) * len(more) > _MOST_STRINGS:
            return None
        run = {a + b for a in run for b in more}
    return run


def _query(nodes) -> tuple:
    parts, run = [], {""}
    for op, arg in nodes:
        more = _strings(op, arg)
        if more is not None and len(run) * len(more) <= _MOST_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        parts.append(_of_strings(run))
        run = more if more is not None else {""}
        if more is None:
            if op is rc.SUBPATTERN:
                parts.append(_query(arg[-1]))
            elif op is rc.BRANCH:
                ways = [_query(b) for b in arg[1]]
                parts.append(_ANY if _ANY in ways else ("or", *ways))
            elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] > 0:
                parts.append(_query(arg[2]))
    parts.append(_of_strings(run))
    return _and(parts)


def trigram_query(rule: Rule) -> tuple:
    """``("any",)``, ``("has", trigram)``, ``("and", ...)`` or ``("or", ...)``."""
    return _query(rp.parse(rule.pattern))


def _needed(query: tuple) -> set[bytes]:
    return {query[1]} if query[0] == "has" else set().union(*(_needed(q) for q in query[1:]))


class _Index:
    """Postings of the needed trigrams over the rows of one slice."""

    def __init__(self, needed: list[bytes]):
        self.ids = {t: i for i, t in enumerate(needed)}
        self.slot = np.zeros(1 << 24, np.uint16)
        for t, i in self.ids.items():
            self.slot[int.from_bytes(t, "big")] = i + 1

    def load(self, column: pa.Array) -> None:
        raw, offsets = tx.utf8(column)
        self.rows = np.arange(len(column))
        self.postings = {}
        if len(raw) < 3:
            return
        low = tx._LOWER[raw].astype(np.int32)
        slots = self.slot[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
        at = np.flatnonzero(slots)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + 2 < offsets[row + 1]
        pairs = np.unique(slots[at[inside]].astype(np.int64) * len(column) + row[inside])
        kinds, rows = np.divmod(pairs, len(column))
        cuts = np.searchsorted(kinds, np.arange(len(self.ids) + 2))
        self.postings = {i: rows[cuts[i + 1] : cuts[i + 2]] for i in range(len(self.ids))}

    def rows_for(self, query: tuple) -> np.ndarray:
        if query == _ANY:
            return self.rows
        if query[0] == "has":
            return self.postings.get(self.ids[query[1]], self.rows[:0])
        parts = [self.rows_for(q) for q in query[1:]]
        if query[0] == "and":
            return reduce(np.intersect1d, sorted(parts, key=len))
        return reduce(np.union1d, parts)


def _scanner(rules: tuple[Rule, ...], base: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(r) for r in rules]
        index = _Index(sorted(set().union(*(_needed(q) for q in queries if q != _ANY))))
        compiled = [r.compiled() for r in rules]
        for batch in batches:
            for i, j in tx.slices(batch.column("text")):
                part = batch.slice(i, j - i)
                index.load(part.column("text"))
                texts = part.column("text").to_pylist()
                spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                for k, (rule, query, finds) in enumerate(zip(rules, queries, compiled, strict=True)):
                    for row in index.rows_for(query).tolist():
                        for m in finds.finditer(texts[row] or ""):
                            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                                spans[row].append((m.start(rule.span), k, m.end(rule.span)))
                counts = {kind: [] for kind in base}
                shas, joined = [], []
                for found in spans:
                    found.sort()
                    said = [(rules[k].kind, f"{rules[k].kind}:{a}:{b}") for a, k, b in found]
                    for kind in base:
                        counts[kind].append(sum(x == kind for x, _ in said))
                    shas.append(hashlib.sha256(",".join(s for x, s in said if x in counts).encode()).hexdigest())
                    joined.append(",".join(s for _, s in said))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in base), pa.array(shas, pa.string()), pa.array(joined, pa.string())],
                    names=["doc_id", *(f"n_{k}" for k in base), "base_sha256", "spans"],
                )

    return run


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[str, ...] = tuple(r.kind for r in BASE)) -> DataFrame:
    """Per row: ``doc_id``, a count for each base kind, the digest of base spans, and all spans."""
    schema = "doc_id long, " + "".join(f"n_{k} long, " for k in base) + "base_sha256 string, spans string"
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return thin.mapInArrow(_scanner(rules, base), schema)
