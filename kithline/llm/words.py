"""Words, word hashes and shingle hashes of whole Arrow string columns, as numpy arrays.

Used inside tasks by the operators that are free to run Python. All functions take the UTF-8 bytes of many texts at once;
a word never crosses from one text into the next. Hashes are 64 bits wide and do not depend on batches or partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into arrays at once (a longer single text is handled alone).
CHUNK_BYTES = 500_000
#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = (32, 9, 10, 11, 12, 13)

_RNG = np.random.Generator(np.random.PCG64(20_240_917))
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Masks of the first 0 to 8 bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """Words of consecutive texts: byte ranges in ``data`` and, per text, the first word's index (one entry more at the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective scrambling of 64-bit values; another seed gives another order of the same values."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0xA0761D6478BD642F + 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, text borders) of runs of rows that hold at most ``limit`` bytes; nulls are empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    _, offsets, data = texts.buffers()
    borders = np.frombuffer(offsets, dtype=np.int64, count=n + 1 + texts.offset)[texts.offset:]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    if texts.null_count:  # a null may cover bytes: leave them out
        filled = texts.fill_null("")
        yield from chunks(filled, limit)
        return
    row = 0
    while row < n:
        to = int(np.searchsorted(borders, borders[row] + limit, side="right")) - 1
        to = min(max(to, row + 1), n)
        yield row, to, data[borders[row]:borders[to]], borders[row:to + 1] - borders[row]
        row = to


def lowered(data: np.ndarray) -> bytes:
    """The bytes with A-Z folded."""
    return _LOWER[data].tobytes()


def split(data: np.ndarray, borders: np.ndarray, blank: np.ndarray = _IS_SPACE) -> Words:
    """Words of the texts whose bytes lie between ``borders``; ``blank`` tells per byte value if it stands between words."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(borders), dtype=np.int64))
    solid = ~blank[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = borders[(borders > 0) & (borders < n)]
    begins[inner] = solid[inner]
    starts = np.flatnonzero(begins)
    stops = solid.copy()
    stops[:-1] &= ~solid[1:]
    stops[inner - 1] = solid[inner - 1]
    ends = np.flatnonzero(stops) + 1
    return Words(data, starts, ends, np.searchsorted(starts, borders))


def hashes(words: Words, lower: bool = False) -> np.ndarray:
    """One 64-bit hash per word; ``lower`` folds A-Z first.

    A word's eight-byte pieces are scrambled, each with its place, and summed: no structure of a text survives that, as it
    would in a polynomial modulo 2**64."""
    if len(words.starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    data = np.zeros(len(words.data) + 8, dtype=np.uint8)
    data[:-8] = _LOWER[words.data] if lower else words.data
    eight = np.ndarray((len(words.data),), dtype="<u8", buffer=data, strides=(1,))  # the eight bytes from each place on
    size = words.ends - words.starts
    pieces = (size + 7) >> 3
    total = mix(eight[words.starts] & _FIRST[np.minimum(size, 8)])
    long = np.flatnonzero(pieces > 1)
    with np.errstate(over="ignore"):
        if len(long):
            more = pieces[long] - 1
            begin = np.cumsum(more) - more
            place = np.arange(int(more.sum())) - np.repeat(begin, more) + 1
            at = np.repeat(words.starts[long], more) + 8 * place
            left = np.repeat(words.ends[long], more) - at
            value = mix((eight[at] & _FIRST[np.minimum(left, 8)]) ^ mix(place.astype(np.uint64), 3), 4)
            total[long] += np.add.reduceat(value, begin)
        return mix(total + size.astype(np.uint64) * _BASE, 5)


def runs(values: np.ndarray, first: np.ndarray, width: int, whole_if_short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` consecutive values of a text, and per text the first one's index (one entry more).

    With ``whole_if_short`` a text of fewer, but not zero, values has one hash, of all of them."""
    counts = np.diff(first)
    out = np.maximum(counts - width + 1, 0)
    short = (counts > 0) & (counts < width) & whole_if_short
    begin = np.zeros(len(first), dtype=np.int64)
    np.cumsum(np.where(short, 1, out), out=begin[1:])
    result = np.zeros(begin[-1], dtype=np.uint64)
    with np.errstate(over="ignore"):
        texts = np.flatnonzero(out)
        lead = np.repeat(first[texts] - begin[texts], out[texts])
        slot = np.repeat(begin[texts] - (np.cumsum(out[texts]) - out[texts]), out[texts]) + np.arange(len(lead))
        at = slot + lead
        total = np.zeros(len(at), dtype=np.uint64)
        for k in range(width):
            total += values[at + k] * _PLACE[k]
        result[slot] = mix(total)
        for text in np.flatnonzero(short):
            part = values[first[text]:first[text + 1]]
            result[begin[text]] = mix((part * _PLACE[:len(part)]).sum(dtype=np.uint64, keepdims=True), len(part))[0]
    return result, begin


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive values, joined from hashes of halves and of halves of these."""
    parts, have, size = [], values, 1
    at = 0
    with np.errstate(over="ignore"):
        while True:
            if width & size:  # the part of this size begins behind the smaller ones
                parts.append((at, have))
                at += size
            if 2 * size > width:
                break
            have = mix(have[:len(have) - size] * _BASE + have[size:], size) if len(have) > size else have[:0]
            size *= 2
        n = max(len(values) - width + 1, 0)
        total = np.full(n, np.uint64(width), dtype=np.uint64)
        for k, (offset, part) in enumerate(parts):
            total = mix(total * _BASE + part[offset:offset + n], k)
    return total


def rolling(values: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``runs``, for wide windows; the cost grows with the logarithm of the width."""
    out = np.maximum(np.diff(first) - width + 1, 0)
    begin = np.zeros(len(first), dtype=np.int64)
    np.cumsum(out, out=begin[1:])
    texts = np.flatnonzero(out)
    if len(texts) == 0:
        return np.zeros(0, dtype=np.uint64), begin
    at = np.repeat(first[texts] - begin[texts], out[texts]) + np.arange(begin[-1])
    return windows(values, width)[at], begin
