"""Sorted hash arrays in the shared folder, counted by Spark and memory-mapped by tasks.

Tasks send sorted, packed arrays of 64-bit keys, one row for each shard (a range of keys);
one task per shard merges what belongs to it and writes the merged arrays as ``.npy`` files
into the shared folder.  Later tasks map these files and search them, so a table may be far
larger than a worker's memory.  Files are written under a temporary name and renamed, so a
repeated task leaves the same result, and they outlive the executor that wrote them.
"""

from __future__ import annotations

import mmap
import os
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyforge.session import WorkTables, shared_path

SHARD_BYTES = 16 << 20               # bytes of input text for each shard
FLUSH_KEYS = 1_500_000               # keys a task gathers before it sends them


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, deleted with the tables of an open run."""
    folder = shared_path(spark, name)
    for tables in WorkTables._open:
        tables.paths.append(folder)
    return folder


def _plain(path: str) -> str | None:
    parts = urlparse(path)
    return parts.path if parts.scheme in ("", "file") else None


def write_file(path: str, chunks) -> None:
    """Write a file of the shared folder whole or not at all."""
    local = _plain(path)
    if local is None:
        store, name = pafs.FileSystem.from_uri(path)
        with store.open_output_stream(name) as out:       # appears when closed
            for chunk in chunks:
                out.write(chunk)
        return
    os.makedirs(os.path.dirname(local), exist_ok=True)
    part = f"{local}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as out:
        for chunk in chunks:
            out.write(chunk)
    os.replace(part, local)


def open_file(path: str):
    """A readable file of the shared folder; files of remote stores are copied first.

    The copy has no name, so that nothing is left in the folder of an executor.
    """
    local = _plain(path)
    if local is not None:
        return open(local, "rb")
    store, name = pafs.FileSystem.from_uri(path)
    copy = tempfile.TemporaryFile()
    with store.open_input_stream(name) as source:
        while block := source.read(1 << 24):
            copy.write(block)
    copy.seek(0)
    return copy


def write_array(path: str, values: np.ndarray) -> None:
    write_file(path, [np.ascontiguousarray(values).tobytes()])


def map_array(path: str, kind) -> np.ndarray:
    """A file of ``write_array``, memory-mapped."""
    with open_file(path) as source:
        if not os.fstat(source.fileno()).st_size:
            return np.zeros(0, kind)
        keep_no_handle = {"trackfd": False} if sys.version_info >= (3, 13) else {}
        return np.frombuffer(mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ,
                                       **keep_no_handle), kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as compressed differences, byte plane by byte plane."""
    steps = np.diff(keys, prepend=np.zeros(1, np.uint64))
    planes = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


def pack_values(values: np.ndarray) -> bytes:
    """Non-negative whole numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_values(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def shard_bits(total_bytes: int) -> int:
    """Leading bits of a key that name its shard."""
    return max(3, int(np.ceil(np.log2(max(1, total_bytes / SHARD_BYTES)))))


def text_size(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts."""
    return docs.select(F.sum(F.octet_length(F.col(column))).alias("b")).first()["b"] or 0


def shard_ranges(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Shards of sorted keys and the places of their keys."""
    bounds = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64)
                             << np.uint64(64 - bits))
    bounds = np.concatenate([[0], bounds, [len(keys)]])
    for shard in np.flatnonzero(np.diff(bounds)):
        yield int(shard), slice(int(bounds[shard]), int(bounds[shard + 1]))


def add_up(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with their summed counts (1 each by default)."""
    if counts is None:
        if not len(keys):
            return keys, np.zeros(0, np.uint64)
        keys = np.sort(keys)
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[new], np.diff(np.append(new, len(keys))).astype(np.uint64)
    if not len(keys):
        return keys, counts.astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.uint64)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], np.add.reduceat(counts, new)


PACKED = "shard int, keys binary, counts binary"


def counted(batches: Iterator[pa.RecordBatch], keys_of: Callable[[pa.RecordBatch],
            Iterator[np.ndarray]], bits: int, flush: int = FLUSH_KEYS) -> Iterator[pa.RecordBatch]:
    """Packed shard rows of the keys of all batches, counted within the task first."""
    held, size = [], 0

    def emit():
        keys = np.concatenate(held)
        held.clear()                            # not needed while the keys are sorted
        yield from packed(*add_up(keys), bits)

    for batch in batches:
        for keys in keys_of(batch):
            held.append(keys)
            size += len(keys)
            if size >= flush:
                yield from emit()
                size = 0
    if size:
        yield from emit()


def packed(keys: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``PACKED`` for sorted distinct keys."""
    rows = [(shard, pack_keys(keys[at]), pack_values(counts[at]))
            for shard, at in shard_ranges(keys, bits)]
    if rows:
        shards, k, c = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(shards, pa.int32()), pa.array(k, pa.binary()), pa.array(c, pa.binary())],
            ["shard", "keys", "counts"])


def merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a shard's rows with their summed counts."""
    return add_up(np.concatenate([unpack_keys(x.as_py()) for x in table["keys"]]),
                  np.concatenate([unpack_values(x.as_py()) for x in table["counts"]]))


def write_table(rows: DataFrame, folder: str, bits: int, least: int = 1,
                with_counts: bool = False) -> "HashTable":
    """Merge packed rows and keep the keys counted at least ``least`` times."""

    def write(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        keys, counts = merged(table)
        keep = counts >= least
        write_array(f"{folder}/{shard}.keys", keys[keep])
        if with_counts:
            write_array(f"{folder}/{shard}.counts", counts[keep])
        return pa.table({"shard": pa.array([shard], pa.int32()),
                         "size": pa.array([int(keep.sum())], pa.int64())})

    sizes = rows.groupBy("shard").applyInArrow(write, "shard int, size long").collect()
    columns = {"counts": np.uint64} if with_counts else {}
    return HashTable(folder, bits, [r["shard"] for r in sizes if r["size"]], columns)


class HashTable:
    """Sorted keys and columns of whole numbers beside them, one file each per shard.

    Files are mapped when a process first searches them; the object itself is small.
    """

    _mapped: dict[str, np.ndarray] = {}

    def __init__(self, folder: str, bits: int, shards: list[int], columns: dict):
        self.folder, self.bits = folder, bits
        self.shards, self.columns = frozenset(shards), columns

    def _array(self, shard: int, part: str, kind) -> np.ndarray:
        path = f"{self.folder}/{shard}.{part}"
        if path not in self._mapped:
            if len(self._mapped) > 16384:
                self._mapped.clear()
            self._mapped[path] = map_array(path, kind)
        return self._mapped[path]

    def search(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Whether each key is there, and the columns' values (0 for an absent key)."""
        order = np.argsort(keys)
        asked = keys[order]
        found = np.zeros(len(keys), bool)
        values = {c: np.zeros(len(keys), kind) for c, kind in self.columns.items()}
        for shard, at in shard_ranges(asked, self.bits):
            if shard not in self.shards:
                continue
            own = self._array(shard, "keys", np.uint64)
            place = np.searchsorted(own, asked[at])
            place[place == len(own)] = 0
            hit = own[place] == asked[at]
            target = order[at][hit]
            found[target] = True
            for column, kind in self.columns.items():
                values[column][target] = self._array(shard, column, kind)[place[hit]]
        return found, values

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Count of each key; 0 for an absent one, 1 for a present one without counts."""
        found, values = self.search(keys)
        return values["counts"].astype(np.int64) if self.columns else found.astype(np.int64)
