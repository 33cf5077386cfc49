"""Vectorised work on batches of texts: views of Arrow's buffers, words, and 64-bit hashes, all in NumPy.

White space is the six ASCII characters [\\x20\\x09-\\x0D]; a word is a run of anything else. Since UTF-8 never uses
those bytes inside a character, words can be cut on bytes, without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: Values of bytes in hashes: never 0, so that a leading byte always counts.
AS_IS = np.arange(1, 257, dtype=np.uint64)
LOWER = AS_IS.copy()
LOWER[65:91] = AS_IS[97:123]
#: An odd multiplier and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


@lru_cache(maxsize=2)
def _cached(base: int) -> np.ndarray:
    return _powers(base, CHUNK)


def powers(base: int, n: int) -> np.ndarray:
    return _cached(base) if n <= CHUNK else _powers(base, n)


def prefix_sums(data: np.ndarray, values: np.ndarray = AS_IS) -> np.ndarray:
    """s with s[j] - s[i] = the sum of values[data[k]] * BASE**k over i <= k < j, modulo 2**64."""
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(BASE, len(data))[: len(data)], out=s[1:])
    return s


def span_hashes(s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of spans, the same wherever the bytes stand."""
    return mix((s[ends] - s[starts]) * powers(INVERSE, len(s))[starts] + np.uint64(0x2545F4914F6CDD1D) * (ends - starts).astype(np.uint64))


class Texts(NamedTuple):
    """A run of a batch's texts as bytes: text k is data[starts[k]:ends[k]], row `first` + k of the batch."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def views(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its len + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if "binary" in str(column.type) else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Texts]:
    """The texts of a column in runs of about `size` bytes; a longer text makes a run of its own. No text is cut."""
    data, offsets = views(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        at = offsets[i]
        yield Texts(i, data[at : offsets[j]], offsets[i:j] - at, offsets[i + 1 : j + 1] - at)
        i = j


class Words(NamedTuple):
    """Words of Texts: word k is data[starts[k]:ends[k]] of text doc[k]; first[d] is the first word of text d, first[-1] their number."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def words(t: Texts, apart: np.ndarray = IS_SPACE) -> Words:
    """Runs of bytes that aren't `apart`; no word goes on into the next text."""
    solid = ~apart[t.data]
    before = np.zeros(len(solid) + 1, bool)
    before[1:] = solid
    after = np.zeros(len(solid) + 1, bool)
    after[:-1] = solid
    inner = t.starts[(t.starts > 0) & (t.starts < len(solid))]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before[:-1])
    after[inner] = False
    ends = np.flatnonzero(solid & ~after[1:]) + 1
    first = np.searchsorted(starts, np.append(t.starts, len(solid)))
    return Words(starts, ends, np.repeat(np.arange(len(t.starts)), np.diff(first)), first)


def word_hashes(t: Texts, w: Words, values: np.ndarray = AS_IS) -> np.ndarray:
    return span_hashes(prefix_sums(t.data, values), w.starts, w.ends)


def windows(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the n-word windows that lie within a text, and the windows' hashes."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        h *= np.uint64(BASE)
        h += hashes[k : len(hashes) - n + 1 + k]
    at = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])
    return at, mix(h[at])


def code_points(data: np.ndarray) -> np.ndarray:
    """1 where a character starts."""
    return (data & 0xC0) != 0x80


def counted(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set in each span."""
    s = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=s[1:])
    return s[ends] - s[starts]
