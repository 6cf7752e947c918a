"""Removal of long passages that occur more than once, found by fixed-block anchors."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.llm.hash_tables import (
    PACKED, HashTable, counted, new_folder, shard_bits, text_size, write_table)
from tidyforge.llm.words import Words, find_words, slices

WINDOW = 35


def repeated_windows(docs: DataFrame, text: str = "text", window: int = WINDOW) -> HashTable:
    """The windows of ``window`` words that start at two or more places, as a hash table.

    Each text is cut into non-overlapping reference blocks of half a window, so that every
    window holds a whole block.  The blocks' hashes are the index.  Every rolling run of a
    block's length is looked up in it; a hit is a place whose words equal a reference block
    elsewhere.  Hits are extended to both sides as far as a window around them reaches, and
    the windows so found are kept if their hash occurs twice.  Runs of kept windows are the
    maximal exact repeats.  Only hashes are shuffled, counted within each task first, so a
    passage in a third of all documents is one key per task.
    """
    spark, block = docs.sparkSession, (window + 1) // 2
    texts = docs.select(F.col(text).cast("string").alias("text"))
    bits = shard_bits(text_size(texts))

    def blocks(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for words in _slices(batch):
            hashes, fits = words.grams(block)
            yield hashes[fits & _is_reference(words, block)]

    index = write_table(
        texts.mapInArrow(lambda b: counted(b, blocks, bits), PACKED),
        new_folder(spark, "blocks"), bits, with_counts=True)

    def extended(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for words in _slices(batch):
            if len(words.hashes) < window:
                continue
            runs, fits = words.grams(block)
            seen = index.counts(runs)
            hit = fits & (seen > _is_reference(words, block))
            sums = np.concatenate([[0], np.cumsum(hit), np.full(block, hit.sum())])
            near = sums[block:block + len(hit)] > sums[:len(hit)]
            hashes, fits = words.grams(window)
            yield hashes[near & fits]

    return write_table(texts.mapInArrow(lambda b: counted(b, extended, bits), PACKED),
                       new_folder(spark, "windows"), bits, least=2)


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW,
                   layout: bool = False) -> DataFrame:
    """Every document without the words that a repeated window covers.

    All columns stay; ``text`` holds the kept words joined by one space, and ``n_words`` and
    ``n_removed`` (replaced if present) count the words before and the removed ones.  With
    ``layout`` a text that loses nothing stays as it is, white space included.  Windows are
    judged on the input as a whole: of two equal passages both go.  A missing text counts as
    one without words and becomes empty (with ``layout`` it stays missing); a text shorter
    than a window is kept; a row that occurs twice repeats itself.  Two different windows
    count as equal if their 64-bit hashes are.
    """
    repeats = repeated_windows(docs, text, window)
    plain = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    whole = docs.select(*[F.col(f"`{c}`") for c in plain]).withColumn(
        text, F.col(f"`{text}`").cast("string"))
    schema = T.StructType([*whole.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType())])
    place = plain.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in slices(batch.column(place)):
                part = batch.slice(at, to - at)
                kept, total, removed = _cut(part.column(place), repeats, window, layout)
                columns = part.columns
                columns[place] = kept
                yield pa.RecordBatch.from_arrays([*columns, total, removed], schema.names)

    return whole.mapInArrow(cut, schema)


def _slices(batch: pa.RecordBatch) -> Iterator[Words]:
    for at, to in slices(batch.column(0)):
        yield find_words(batch.column(0).slice(at, to - at))


def _is_reference(words: Words, block: int) -> np.ndarray:
    place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], np.diff(words.first))
    return place % block == 0


def _covered(words: Words, repeats: HashTable, window: int) -> np.ndarray:
    """Whether each word lies in a repeated window."""
    hashes, fits = words.grams(window)
    starts = np.flatnonzero(fits)
    starts = starts[repeats.counts(hashes[starts]) > 0]
    depth = np.zeros(len(words.hashes) + 1, np.int64)
    depth[starts] += 1
    depth[starts + window] -= 1
    return np.cumsum(depth)[:-1] > 0


def _cut(texts: pa.Array, repeats: HashTable, window: int, layout: bool):
    words = find_words(texts)
    keep = ~_covered(words, repeats, window)
    total = np.diff(words.first)
    sums = np.concatenate([[0], np.cumsum(keep)])
    kept = sums[words.first[1:]] - sums[words.first[:-1]]
    out = []
    for k, value in enumerate(texts):
        if layout and kept[k] == total[k]:
            out.append(value.as_py())
            continue
        own = (value.as_py() or "").encode().split()
        if kept[k] < total[k]:
            own = compress(own, keep[words.first[k]:words.first[k + 1]])
        out.append(b" ".join(own).decode())
    return pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(
        total - kept, pa.int64())
