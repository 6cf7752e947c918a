"""Packing token sequences by minimum bin slack."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY = 2048
END_ID = 1
POOL = 256                   # pieces a task holds back to choose from

# How byte-level BPE files split text and write bytes as characters (fixed values).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file, as an encoder that gives the same ids.

    This one is about five times as fast.  Special tokens in a text become their ids, which is
    what the file's own library does by default.  Other kinds of files are refused.
    """
    if path not in _encodings:
        with open(path, encoding="utf-8") as source:
            told = json.load(source)
        split = told["pre_tokenizer"] or {}
        if (told["model"].get("type", "BPE") != "BPE" or split.get("type") != "ByteLevel"
                or split.get("add_prefix_space") or told.get("normalizer")):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        others = [b for b in range(256) if b not in _PRINTED]
        byte = {chr(b): b for b in _PRINTED} | {chr(256 + k): b for k, b in enumerate(others)}
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): rank
                 for token, rank in told["model"]["vocab"].items() if token not in special}
        _encodings[path] = tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks,
                                             special_tokens=special)
    return _encodings[path]


def fullest(lengths: dict[int, int], space: int) -> tuple[int, dict[int, int]]:
    """The multiset of lengths whose sum is nearest to ``space`` without passing it.

    ``lengths`` gives how many pieces there are of each length.  Bit s of an integer says that
    sum s can be reached; each piece adds the sums shifted by its length.  The counts of the
    chosen lengths are read off backwards from the largest sum.
    """
    sums, steps, limit = 1, [], (1 << (space + 1)) - 1
    for length in sorted(lengths, reverse=True):
        for _ in range(min(lengths[length], space // length)):
            more = (sums | sums << length) & limit
            if more == sums:
                break
            steps.append((length, sums))
            sums = more
        if sums >> space:
            break
    best = left = sums.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, before in reversed(steps):
        if not before >> left & 1:
            left -= length
            chosen[length] = chosen.get(length, 0) + 1
    return best, chosen


class _Packer:
    """Deals the pieces of one task into sequences."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.pool: dict[int, list] = {}
        self.count = self.total = 0
        self.rows: list = []

    def add(self, document, ids: np.ndarray) -> None:
        at, size = 0, len(ids)
        while size - at >= self.capacity:
            self._write([(document, ids, at, at + self.capacity, size)])
            at += self.capacity
        if at < size:
            self._hold((document, ids[at:].copy(), 0, size - at, size, at))
        while self.count > POOL:
            self._fill()

    def _hold(self, piece) -> None:
        self.pool.setdefault(piece[3] - piece[2], []).append(piece)
        self.count += 1
        self.total += piece[3] - piece[2]

    def _take(self, length: int):
        own = self.pool[length]
        piece = own.pop()
        if not own:
            del self.pool[length]
        self.count -= 1
        self.total -= length
        return piece

    def _fill(self) -> None:
        """One full sequence: the largest piece and the multiset that fits best beside it."""
        largest = max(self.pool)
        pieces = [self._take(largest)]
        reached, chosen = fullest({k: len(v) for k, v in self.pool.items()},
                                  self.capacity - largest)
        for length, times in chosen.items():
            pieces += [self._take(length) for _ in range(times)]
        slack = self.capacity - largest - reached
        if slack:                                     # only a cut can fill the rest
            piece = self._take(min(k for k in self.pool if k > slack))
            pieces.append((*piece[:3], piece[2] + slack, *piece[4:]))
            self._hold((*piece[:2], piece[2] + slack, *piece[3:]))
        self._write(pieces)

    def finish(self) -> None:
        """Full sequences while they can be filled, then one for each power of two left."""
        while self.total >= self.capacity:
            self._fill()
        rest = [p for own in self.pool.values() for p in own]
        while self.total:
            size, taken = 1 << (self.total.bit_length() - 1), []
            self.total -= size
            while size:
                piece = rest.pop()
                to = min(piece[3], piece[2] + size)
                taken.append((*piece[:3], to, *piece[4:]))
                size -= to - piece[2]
                if to < piece[3]:
                    rest.append((*piece[:2], to, *piece[3:]))
            self._write(taken)

    def _write(self, pieces) -> None:
        offset = 0
        for document, ids, start, to, size, *base in pieces:
            self.rows.append((document, start + (base[0] if base else 0), to - start, size,
                              self.sequence, offset, ids[start:to].tobytes()))
            offset += to - start
        self.sequence += 1


_OUT = [("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of tokenized documents in sequences of at most ``capacity`` ids.

    Columns: the document's id under its own name, ``start``, ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset`` and ``ids`` (unsigned 32-bit little-endian, binary).  A
    document is its text's ids and ``end_id``; a missing or empty text is that end alone.  A
    document of a window or more is cut into full windows and a remainder.  Each further
    window takes the largest waiting remainder and the multiset of others that comes closest
    to the capacity; if even that leaves a gap, one piece is cut to fill it.  What is left of a
    task at its end is cut into sequences whose lengths are powers of two, so none is padded.
    Rows with equal or missing ids are separate documents.  Each task packs its own rows, reads
    them once and holds a few hundred remainders, so nothing is shuffled; its number is the
    upper part of its sequence ids, so a repeated task gives the same ones.
    """
    source = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField(doc_id, source.schema[0].dataType)] + [
        T.StructField(n, T.BinaryType() if n == "ids" else T.LongType()) for n, _ in _OUT])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(tokenizer).encode_to_numpy
        packer = _Packer(capacity, TaskContext.get().partitionId() << 33)
        end, kind = np.array([end_id], np.uint32), None
        for batch in batches:
            kind = batch.schema.field(0).type
            for document, own in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(own.as_py() or "", allowed_special="all")
                packer.add(document, np.concatenate([ids.astype(np.uint32), end]))
                if len(packer.rows) >= 2000:
                    yield _batch(packer, kind, doc_id)
        packer.finish()
        if packer.rows:
            yield _batch(packer, kind, doc_id)

    return source.mapInArrow(packed, schema)


def _batch(packer: _Packer, kind, doc_id: str) -> pa.RecordBatch:
    columns, packer.rows = list(zip(*packer.rows)), []
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], kind)] + [pa.array(c, t) for c, (_, t) in zip(columns[1:], _OUT)],
        [doc_id, *[n for n, _ in _OUT]])
