"""Words of whole texts as arrays of hashes, computed on the bytes of Arrow columns.

A word is a run of bytes other than space and 0x09 to 0x0D.  Nothing here makes a Python
string per word: a batch of texts is one byte array, and words, n-grams and windows are
arrays over it.  Hashes have 64 bits and do not depend on process, batch or position.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20                   # texts handled at once; a longer text is one slice

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(
    1, 2 ** 64, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_VALUES[_SEPARATOR] = 0
_FOLDED_VALUES = _BYTE_VALUES[_FOLD]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly, so that ranges and remainders of them are even."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power_table(length: int) -> np.ndarray:
    global _powers
    if len(_powers) < length:
        _powers = np.cumprod(np.concatenate([
            [np.uint64(1)], np.full(max(length, 256) - 1, _STEP)]), dtype=np.uint64)
    return _powers


class Words(NamedTuple):
    """Words of a slice of texts."""

    hashes: np.ndarray       # one for each word
    first: np.ndarray        # index of each text's first word, and the number of words
    start: np.ndarray        # first byte of each word in ``data``
    end: np.ndarray          # byte after each word
    data: np.ndarray         # bytes of the slice

    def text_of(self) -> np.ndarray:
        """Index of the text each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each word on, and whether so many are left in its text."""
        total = len(self.hashes)
        fits = np.arange(total) + n <= np.repeat(self.first[1:], np.diff(self.first))
        return mix(combine(self.hashes, n)), fits


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Rolling combination of n neighbours, built by doubling; the last n - 1 are padding."""
    result, width, block, size = None, 0, hashes, 1
    while True:
        if n & size:
            result, width = (block, size) if result is None else (
                _joined(result, width, block, size), width + size)
        if (size << 1) > n:
            return result
        block, size = _joined(block, size, block, size), size << 1


def _joined(left: np.ndarray, width: int, right: np.ndarray, size: int) -> np.ndarray:
    factor = np.uint64(pow(int(_STEP), size, 1 << 64))
    out = left * factor
    if width < len(out):
        out[:len(out) - width] += right[width:]
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its texts; a missing text is empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if column.null_count:
        column = pc.fill_null(column, "")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, kind)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets.astype(np.int64)
    return np.frombuffer(data, np.uint8), offsets.astype(np.int64)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each."""
    _, offsets = text_bytes(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, len(column))
        at = min(to, len(column))


def find_words(column: pa.Array, fold: bool = False) -> Words:
    """The words of a text column, whole; ``fold`` ignores the case of A to Z."""
    raw, offsets = text_bytes(column)
    data, offsets = raw[offsets[0]:offsets[-1]], offsets - offsets[0]
    none = np.zeros(0, np.int64)
    if not len(data):
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none, data)
    inside = ~_SEPARATOR[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = np.flatnonzero(np.diff(offsets))
    before[offsets[filled]] = False
    after[offsets[filled + 1] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, offsets)
    if not len(start):
        return Words(np.zeros(0, np.uint64), first, none, none, data)
    place = np.zeros(len(data), np.int64)
    place[start] = start
    np.maximum.accumulate(place, out=place)
    np.subtract(np.arange(len(data)), place, out=place)
    place[~inside] = 0
    values = (_FOLDED_VALUES if fold else _BYTE_VALUES)[data]
    values *= _power_table(int((end - start).max()))[place]
    hashes = mix(np.add.reduceat(values, start) + (end - start).astype(np.uint64) * _STEP)
    return Words(hashes, first, start, end, data)


def distinct_by_text(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs in that order; ``text`` must not decrease."""
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], text[new]


def shingle_sets(column: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of n words of each text, and the index of their text.

    A text with fewer words has one shingle, its whole word sequence; one without words none.
    """
    words = find_words(column, fold=True)
    text = words.text_of()
    hashes, fits = words.grams(n)
    short = np.flatnonzero((np.diff(words.first) > 0) & (np.diff(words.first) < n))
    found, owner = hashes[fits], text[fits]
    if len(short):
        tails = np.empty(len(short), np.uint64)
        for k, t in enumerate(short):
            own = words.hashes[words.first[t]:words.first[t + 1]]
            tails[k] = mix(combine(own, len(own))[:1] + np.uint64(len(own)))[0]
        found, owner = np.concatenate([found, tails]), np.concatenate([owner, short])
    return distinct_by_text(found, owner)
