"""Many terms found in many texts in one pass.

Up to a checked size the terms become one automaton over bytes (goto table with failure
links folded in), held as arrays and broadcast.  Texts are cut into lanes that overlap by
the longest term and all lanes of a batch move on by one byte together, so that the time
goes by the bytes of text and not by the number of terms.

A larger set of terms is joined: for each length of the terms, texts look up the hashes of
their windows of that length in a Bloom filter of all terms, and windows that may be terms
meet the terms themselves in a join, byte by byte, with their counts and first places.  What
is shuffled thus follows the matches.  Both ways give the same rows.

Defined cases: null and empty terms match nothing; a null text has no matches; equal terms
of several ids match for each id; texts and terms are taken as they are (normalise both
first); a place counts in characters from 1; overlapping occurrences count each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.scratch import save

#: Bytes of an automaton that is broadcast; beyond it, terms are joined.
AUTOMATON_BYTES = 64 << 20
#: Bytes of a lane of text, bytes of text that move on together, and parts over which the rows of a term are dealt.
LANE, SLICE, PARTS = 512, 1 << 21, 16
#: Bits of the filter for each term, and the logarithms of its fewest and most bits; terms longer than PREFIX bytes are sought by so many first.
FILTER_BITS, LEAST_LOG, MOST_LOG, PREFIX = 32, 16, 28, 64

#: Bytes that make up words: letters, digits, the underscore and all that is not ASCII.
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x5F, *range(0x80, 0x100)]] = True


@dataclass
class Automaton:
    """``table[state, class_of[byte]]`` is the next state; terms that end in a state are those of it and of its links."""

    table: np.ndarray
    class_of: np.ndarray
    own: np.ndarray  # the term that a state spells, or -1
    link: np.ndarray  # the longest proper suffix that is a term, or 0
    size: np.ndarray  # bytes of each term
    whole: list[list[int]]  # ids of each term as a whole word
    any: list[list[int]]  # ids of each term anywhere

    @property
    def longest(self) -> int:
        return int(self.size.max(initial=1))


def build(terms: list[tuple[int, bytes, bool]]) -> Automaton:
    """The automaton of (id, term, whole word only)."""
    ids: dict[bytes, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
    for number, term, whole in terms:
        if term:
            ids[term][0 if whole else 1].append(number)
    used = sorted({b for t in ids for b in t})
    class_of = np.zeros(256, np.int32)
    class_of[used] = np.arange(1, len(used) + 1)
    children: list[dict[int, int]] = [{}]
    own = [-1]
    for k, term in enumerate(ids):
        at = 0
        for c in class_of[np.frombuffer(term, np.uint8)].tolist():
            if c not in children[at]:
                children[at][c] = len(children)
                children.append({})
                own.append(-1)
            at = children[at][c]
        own[at] = k
    table = np.zeros((len(children), len(used) + 1), np.int32)
    link, fails = np.zeros(len(children), np.int32), np.zeros(len(children), np.int32)
    level = [0]
    while level:
        below = []
        for state in level:
            if state:
                table[state] = table[fails[state]]
            for c, child in children[state].items():
                fail = fails[child] = table[state, c] if state else 0
                link[child] = fail if own[fail] >= 0 else link[fail]
                below.append((state, c, child))
        for state, c, child in below:
            table[state, c] = child
        level = [child for _, _, child in below]
    return Automaton(table, class_of, np.array(own, np.int32), link, np.array([len(t) for t in ids], np.int64), [ids[t][0] for t in ids], [ids[t][1] for t in ids])


def occurrences(auto: Automaton, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first byte and term of every occurrence in texts laid end to end."""
    reach = auto.longest - 1
    lane = max(LANE, 4 * reach)
    size = np.diff(offsets)
    lanes = np.maximum(1, -(-size // lane))
    text = np.repeat(np.arange(len(size)), lanes)
    number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    first = offsets[:-1][text] + number * lane  # where a lane's own bytes begin
    end = np.minimum(first + lane, offsets[1:][text])
    at = np.maximum(first - reach, offsets[:-1][text])
    classes = auto.class_of[raw]
    order = np.argsort(at - end, kind="stable")  # the longest lanes first
    text, first, end, at = text[order], first[order], end[order], at[order]
    state = np.zeros(len(at), np.int32)
    hits = auto.own >= 0
    ending = hits | (auto.link > 0)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    left = at - end
    step, live = 0, int(np.searchsorted(left, 0, "left"))
    while live:
        now = at[:live] + step
        state[:live] = auto.table[state[:live], classes[now]]
        some = np.flatnonzero(ending[state[:live]] & (now >= first[:live]))
        if len(some):
            found.append((some, now[some], state[some].copy()))
        step += 1
        live = int(np.searchsorted(left, -step, "left"))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    which, last, state = (np.concatenate(x) for x in zip(*found, strict=True))
    which, out = text[which], []
    while len(state):
        terms = auto.own[state]
        spelt = terms >= 0
        out.append((which[spelt], last[spelt] + 1 - auto.size[terms[spelt]], terms[spelt]))
        state = auto.link[state]
        more = state > 0
        which, last, state = which[more], last[more], state[more]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        yield i, j
        i = j


def _counted(text: np.ndarray, first: np.ndarray, number: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, term, count and first place in characters of each pair."""
    order = np.lexsort((first, number, text))
    text, first, number = text[order], first[order], number[order]
    opens = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (number[1:] != number[:-1])])) if len(text) else np.zeros(0, np.int64)
    n = np.diff(np.append(opens, len(text)))
    begun = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return text[opens], number[opens], n, begun[first[opens]] - begun[offsets[:-1][text[opens]]] + 1


def _bounded(raw: np.ndarray, offsets: np.ndarray, text: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Does neither side of an occurrence go on with a byte of a word?"""
    inside = np.concatenate([_WORD[raw], [False]])
    end = first + size
    before = (first > offsets[:-1][text]) & inside[first - 1]
    return ~before & ~((end < offsets[1:][text]) & inside[np.minimum(end, len(raw))])


def _by_automaton(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto: Automaton = shared.value
        counts = {True: np.array([len(x) for x in auto.whole], np.int64), False: np.array([len(x) for x in auto.any], np.int64)}
        flat = {True: np.array([i for x in auto.whole for i in x], np.int64), False: np.array([i for x in auto.any for i in x], np.int64)}
        for batch in batches:
            for i, j in _slices(_utf8(batch.column(1))[1]):
                part = batch.slice(i, j - i)
                raw, offsets = _utf8(part.column(1))
                text, first, term = occurrences(auto, raw, offsets)
                bounded = _bounded(raw, offsets, text, first, auto.size[term])
                for whole in (True, False):
                    some = bounded & (counts[True][term] > 0) if whole else counts[False][term] > 0
                    own, number, n, place = _counted(text[some], first[some], term[some], raw, offsets)
                    times = counts[whole][number]
                    starts = np.cumsum(counts[whole]) - counts[whole]
                    at = np.repeat(starts[number], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    keys = part.column(0).take(pa.array(np.repeat(own, times)))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(flat[whole][at], pa.int64()), pa.array(np.repeat(n, times), pa.int64()), pa.array(np.repeat(place, times), pa.int64())], names=["key", "term_id", "n", "first"])

    return run


#: A number for each byte, an odd base and its inverse modulo 2^64, for hashes of windows from running sums.
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _running(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the bytes' numbers times powers of the base, and the inverse powers."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(_BASE, len(raw)), out=sums[1:])
    return sums, _powers(_INVERSE, len(raw) + 1)


def _places(sums: np.ndarray, inverse: np.ndarray, first: np.ndarray, size, log: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of windows in a filter of 2^log bits."""
    h = (sums[first + size] - sums[first]) * inverse[first] + np.asarray(size, np.uint64)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    other = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(64 - log), other >> np.uint64(64 - log)


def _filter_words(log: int):
    """Terms to the filter's words (``at``, 64 bits each) that have their bits, and those of their first PREFIX bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = _utf8(batch.column(0))
            sums, inverse = _running(raw)
            size = np.diff(offsets)
            long = size > PREFIX
            first, size = np.concatenate([offsets[:-1], offsets[:-1][long]]), np.concatenate([size, np.full(long.sum(), PREFIX)])
            place = np.concatenate(_places(sums, inverse, first, size, log))
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64))], names=["at", "bits"])

    return run


def _coded(raw: np.ndarray, first: np.ndarray, size: int) -> tuple[pa.Array, np.ndarray]:
    """The distinct windows that begin at ``first``, and the number of each one's; a SLICE of their bytes at once."""
    number: dict[bytes, int] = {}
    codes, step = [], max(1, SLICE // size)
    for k in range(0, len(first), step):
        some = first[k : k + step]
        laid = pa.py_buffer(raw[(some[:, None] + np.arange(size)).ravel()].tobytes())
        coded = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(some), [None, laid]).dictionary_encode()
        own = np.array([number.setdefault(w, len(number)) for w in coded.dictionary.to_pylist()], np.int64)
        codes.append(own[coded.indices.to_numpy()])
    return pa.array(list(number), pa.binary()), np.concatenate(codes)


def _windows(shared, sizes: dict[bool, list[int]], log: int):
    """Texts to the windows that may be terms: ``key, window, whole, n, first``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: np.ndarray = shared.value

        def may(sums: np.ndarray, inverse: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
            one, two = _places(sums, inverse, first, size, log)
            hit = np.ones(len(first), bool)
            for place in (one, two):
                hit &= ((words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
            return first[hit]

        for batch in batches:
            for i, j in _slices(_utf8(batch.column(1))[1]):
                part = batch.slice(i, j - i)
                raw, offsets = _utf8(part.column(1))
                sums, inverse = _running(raw)
                text_of = np.repeat(np.arange(len(part)), np.diff(offsets))
                end_of = offsets[1:][text_of]
                inside = _WORD[raw]
                opens = np.ones(len(raw), bool)  # may a whole word begin here, or end before here?
                opens[1:] = ~inside[:-1]
                opens[offsets[:-1][offsets[:-1] < len(raw)]] = True
                for whole in (True, False):
                    starts = np.flatnonzero(opens) if whole else np.arange(len(raw))
                    reach = starts + PREFIX <= end_of[starts]
                    begun = may(sums, inverse, starts[reach], PREFIX) if any(n > PREFIX for n in sizes[whole]) else starts[:0]
                    for size in sizes[whole]:
                        first = begun if size > PREFIX else starts
                        first = first[first + size <= end_of[first]]
                        if whole:
                            last = first + size
                            first = first[(last == end_of[first]) | ~inside[np.minimum(last, len(raw) - 1)]]
                        first = may(sums, inverse, first, size)
                        if not len(first):
                            continue
                        distinct, codes = _coded(raw, first, size)
                        text, number, n, place = _counted(text_of[first], first, codes, raw, offsets)
                        window = distinct.take(pa.array(number))
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(text)), window, pa.array(np.full(len(n), whole)), pa.array(n, pa.int64()), pa.array(place, pa.int64())],
                            names=["key", "window", "whole", "n", "first"],
                        )

    return run


def _by_join(rows: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    spark = rows.sparkSession
    lengths = terms.groupBy("whole", F.octet_length("term").alias("size")).agg(F.count("*").alias("n")).collect()  # a row for each length
    sizes = {whole: sorted(r["size"] for r in lengths if r.whole == whole) for whole in (True, False)}
    log = min(MOST_LOG, max(LEAST_LOG, (FILTER_BITS * sum(r.n for r in lengths)).bit_length()))
    words = np.zeros(1 << (log - 6), np.uint64)  # as many rows at most
    got = terms.select("term").mapInArrow(_filter_words(log), "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    schema = f"key {key}, window binary, whole boolean, n long, first long"
    found = rows.mapInArrow(_windows(spark.sparkContext.broadcast(words), sizes, log), schema)
    dealt = found.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS)))
    own = terms.select("term_id", F.col("term").cast("binary").alias("window"), "whole")
    copied = own.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    return dealt.join(copied, ["window", "whole", "part"]).select("key", "term_id", "n", "first")


def match_terms(df: DataFrame, key: str, text: str, terms: DataFrame, limit: int = AUTOMATON_BYTES) -> DataFrame:
    """``key, term_id, n, first``: the occurrences of each term in each row's text.

    ``terms`` has a unique ``term_id``, a ``term`` and, optionally, ``whole``: whether it only counts as a whole word
    (the default) or anywhere.
    """
    whole = F.coalesce(F.col("whole"), F.lit(True)) if "whole" in terms.columns else F.lit(True)
    own = save(terms.select(F.col("term_id").cast("long").alias("term_id"), F.col("term").cast("string").alias("term"), whole.alias("whole")).where("term <> ''"), "terms")
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, term_id long, n long, first long"
    size = F.octet_length("term")
    states = (own.agg(F.sum(size)).first()[0] or 0) + 1  # at most
    classes = own.select(F.explode(F.regexp_extract_all(F.hex("term"), F.lit(".."), F.lit(0)))).distinct().count() + 1
    if states * classes * 4 <= limit:
        return rows.mapInArrow(_by_automaton(_shared(own)), schema)
    return _by_join(rows, own, rows.schema["key"].dataType.simpleString())


def _shared(terms: DataFrame):
    got = terms.toArrow()
    return terms.sparkSession.sparkContext.broadcast(build(list(zip(got.column("term_id").to_pylist(), (t.encode() for t in got.column("term").to_pylist()), got.column("whole").to_pylist(), strict=True))))


def tagged(matches: DataFrame, rules: DataFrame) -> DataFrame:
    """``key, tag, hits, weight``: how many distinct terms of each tag a row holds; ``rules`` has ``term_id, tag, weight``."""
    return matches.join(rules, "term_id").groupBy("key", "tag").agg(F.count_distinct("term_id").alias("hits"), F.max("weight").alias("weight"))
