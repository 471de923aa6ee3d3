"""Vectorised word scanning over Arrow string columns.

Words are maximal runs of bytes of a class; every class used here separates on
ASCII bytes only, so scanning UTF-8 bytes equals scanning characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 20
_LONG_WORD = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: Words separated by white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: After lower-casing, letters, digits and all that is not ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of a run of rows: row number, byte span in ``buf``, and hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    per_row: np.ndarray
    buf: np.ndarray
    offsets: np.ndarray


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    _, off, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row stands alone."""
    offsets = utf8(column)[1] if len(column) else None
    i = 0
    while i < len(column):
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), len(column))
        yield i, j
        i = j


def scan(column: pa.Array, kind: np.ndarray, lower: bool = True) -> Words:
    """Find and hash the words of each row."""
    buf, offsets = utf8(column)
    n = len(buf)
    buf = _LOWER[buf] if lower else buf
    inside = kind[buf]
    first, last = offsets[:-1], offsets[1:]
    full = first < last
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[first[full]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[last[full] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    per_row = np.bincount(row, minlength=len(column)).astype(np.int64)
    return Words(row, start, end, hash_spans(buf, start, end), per_row, buf, offsets)


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, eight bytes at a time."""
    size = end - start
    out = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    if not len(start):
        return out
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    lanes = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    live = np.flatnonzero(size <= _LONG_WORD)
    at = 0
    while len(live):
        left = size[live] - at
        lane = lanes[start[live] + at] & _MASKS[np.minimum(left, 8)]
        out[live] = mix(out[live] ^ lane)
        at += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > _LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(buf[start[i] : end[i]].tobytes(), seed=7)
    return out


def prefixes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of the first ``size`` bytes (8 at most) of the words that are longer."""
    at = np.flatnonzero(words.end - words.start > size)
    padded = np.concatenate([words.buf, np.zeros(8, np.uint8)])
    lanes = np.ndarray(shape=(len(words.buf) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    return words.row[at], mix((lanes[words.start[at]] & _MASKS[size]) + np.uint64(size))


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside a row, and each one's first word."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.row[:n] == words.row[k - 1 :])
    out = mix(words.hash[at] + np.uint64(k))
    for j in range(1, k):
        out = mix(out ^ words.hash[at + j])
    return out, at


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.Array:
    """One list of ``counts[i]`` values per row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
