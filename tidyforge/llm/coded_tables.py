"""Sorted hash arrays with few bytes an entry, for tables of counts.

One file holds one shard: the places where buckets of keys begin, 32 bits of each key beyond
those that name its bucket, and one byte that names its row of values.  Values repeat a lot, so
the different rows are kept once, the most frequent first; an entry whose row is not among the
first 255 is listed with its row's number.  A bucket has 16 to 32 keys at any size, so an
absent key is taken for a present one about once in 2^27 searches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidyforge.llm.hash_tables import map_array, write_file
from tidyforge.llm.words import mix

_ESCAPE = 255


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """The shard of each key; independent of the order of the keys within a shard."""
    return (mix(keys) >> np.uint64(64 - bits)).astype(np.int64)


def parted(shards: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard and the places of its rows, in their order."""
    if len(shards) and shards.max() < 1 << 16:
        shards = shards.astype(np.uint16)       # sorted by their digits, in linear time
    order = np.argsort(shards, kind="stable")
    names, first = np.unique(shards[order], return_index=True)
    yield from zip(names.tolist(), np.split(order, first[1:]) if len(names) else [])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted keys, a place of each, and the place of each given key among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    again = np.empty(len(keys), np.int64)
    again[order] = np.cumsum(new) - 1
    return ordered[new], order[new], again


def write_coded(path: str, keys: np.ndarray, columns: list[np.ndarray]) -> None:
    """Write a shard of sorted distinct keys and the columns of whole numbers beside them."""
    bits = max(1, len(keys).bit_length() - 5)
    buckets = np.arange((1 << bits) + 1, dtype=np.uint64)
    begin = np.searchsorted(keys >> np.uint64(64 - bits), buckets)
    rows = np.zeros(len(keys), np.uint64)
    for column in columns:
        rows = mix(rows + column.astype(np.uint64))
    _, first, row, count = np.unique(rows, return_index=True, return_inverse=True,
                                     return_counts=True)
    order = np.argsort(-count, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    code = rank[row]
    rare = np.flatnonzero(code >= _ESCAPE)
    values = np.stack([c.astype(np.int64)[first[order]] for c in columns], axis=1)
    write_file(path, [part.tobytes() for part in (
        np.array([len(keys), bits, len(values), len(columns), len(rare)], np.int64), values,
        begin.astype(np.uint32), (keys >> np.uint64(32 - bits)).astype(np.uint32),
        rare.astype(np.uint32), code[rare].astype(np.uint32),
        np.minimum(code, _ESCAPE).astype(np.uint8))])


class _Shard:
    """A mapped file of ``write_coded``."""

    def __init__(self, path: str):
        data, at = map_array(path, np.uint8), 40
        size, self.bits, rows, width, rare = (int(x) for x in data[:at].view(np.int64))

        def part(count: int, kind) -> np.ndarray:
            nonlocal at
            at, begin = at + count * np.dtype(kind).itemsize, at
            return data[begin:at].view(kind)

        self.values = part(rows * width, np.int64).reshape(rows, width)
        self.begin = part((1 << self.bits) + 1, np.uint32)
        self.keys = part(size, np.uint32)
        self.rare, self.rare_codes = part(rare, np.uint32), part(rare, np.uint32)
        self.codes = part(size, np.uint8)
        self.widest = int(np.diff(self.begin).max())

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rows of values; zeros for absent keys."""
        asked = (keys >> np.uint64(32 - self.bits)).astype(np.uint32)
        bucket = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        place = self.begin[bucket].astype(np.int64)
        end = self.begin[bucket + 1].astype(np.int64)
        for step in (1 << k for k in range(self.widest.bit_length() - 1, -1, -1)):
            ahead = place + step
            place = np.where((ahead <= end) & (self.keys[np.minimum(ahead, end) - 1] < asked),
                             ahead, place)
        found = np.flatnonzero(place < end)
        found = found[self.keys[place[found]] == asked[found]]
        place = place[found]
        code = self.codes[place].astype(np.int64)
        rare = np.flatnonzero(code == _ESCAPE)
        code[rare] = self.rare_codes[np.searchsorted(self.rare, place[rare])]
        values = np.zeros((len(keys), self.values.shape[1]), np.int64)
        values[found] = self.values[code]
        return values


class CodedTable:
    """The shards of a folder; files are mapped when a process first searches them."""

    _mapped: dict[str, _Shard] = {}

    def __init__(self, folder: str, shards: list[int], width: int):
        self.folder, self.shards, self.width = folder, frozenset(shards), width

    def search(self, keys: np.ndarray, shards: np.ndarray) -> np.ndarray:
        """Rows of values of the keys, each looked for in its shard; zeros for absent keys."""
        values = np.zeros((len(keys), self.width), np.int64)
        order = np.argsort(keys)                # keys in ascending order are found side by side
        for shard, at in parted(shards[order]):
            if shard in self.shards:
                own = order[at]
                values[own] = self._shard(shard).find(keys[own])
        return values

    def _shard(self, shard: int) -> _Shard:
        path = f"{self.folder}/{shard}"
        if path not in self._mapped:
            if len(self._mapped) > 16384:
                self._mapped.clear()
            self._mapped[path] = _Shard(path)
        return self._mapped[path]
