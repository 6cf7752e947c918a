"""Exact similarity join of documents on their sets of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyforge.llm.hash_tables import (
    PACKED, HashTable, counted, new_folder, shard_bits, text_size, write_table)
from tidyforge.llm.links import Forest, components, labels_between, split_join
from tidyforge.llm.words import mix, shingle_sets, slices
from tidyforge.session import materialize

SHINGLE = 5
#: Two sets link when 100 * intersection >= 80 * union.
PERCENT = 80
TILE_DOCS = 1024                 # documents of one side of a block product
TILE_ENTRIES = 1 << 20           # shingles of one side
BLOCK_CELLS = 1 << 22            # cells of a dense column block
_ROUGH = np.uint64(0xFFFFFFFFFFFF0000)


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_id`` and ``component_id`` of every row.

    ``component_id`` is the smallest doc_id that links reach.  Rows with equal sets are one
    class (``set_id``) and are joined once.  A row without words, or with a missing text, has
    an empty set, links with nothing and is its own component.  Missing doc_ids are ignored
    as component names unless a component has no other; a row that occurs twice is two rows
    of one class.

    The join is the product of the document by shingle incidence matrix with itself:

    1. Columns: shingles are counted over all documents; those in one document only can add
       to no product and are left out.  A document keeps its row only if the shared ones
       reach its size-derived bound (an overlap is at least ``percent`` of either set).
    2. Rows with equal sets are collapsed, columns are counted again over the classes, and the
       bound is applied again.
    3. Blocks: rows are gathered by the rarest columns that two linked rows must have in
       common; connected rows are one block, a large block is dealt into tiles.
    4. Products: for each pair of tiles the overlaps add up column block by column block, and
       rows are discarded as soon as no pair of theirs can reach its bound any more.  Only a
       spanning forest of the links leaves a task, never all pairs of a group.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                         F.col(f"`{text}`").cast("string").alias("text"))
    bits = shard_bits(text_size(source))

    def rough(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for at, to in slices(batch.column(0)):
            yield shingle_sets(batch.column(0).slice(at, to - at), shingle)[0] & _ROUGH

    shared = write_table(
        source.select("text").mapInArrow(lambda b: counted(b, rough, bits), PACKED),
        new_folder(spark, "shared"), bits, least=2)

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, n, sets, hashes, owner in _rows(batch, shingle):
                common = np.bincount(owner, shared.counts(hashes & _ROUGH) > 0, len(n))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), _sets(sets, n),
                     pa.array((100 * common >= percent * n) & (n > 0))],
                    ["doc_id", "n_shingles", "set_id", "joins"])

    rows = materialize(source.mapInArrow(
        survey, "doc_id long, n_shingles long, set_id long, joins boolean"), "sets")
    chosen = _chosen(rows, bits)
    sets = materialize(_class_sets(source, chosen, shingle), "classes")
    links = _links(sets, bits, percent)
    found = components(links).select(F.col("node").alias("set_id"), F.col("component"))

    joined = rows.where("set_id IS NOT NULL").join(found, "set_id", "left").withColumn(
        "class", F.coalesce("component", "set_id"))
    first = joined.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    linked = split_join(joined, first, "class").select("doc_id", "n_shingles", "set_id", "component_id")
    alone = rows.where("set_id IS NULL").select(
        "doc_id", "n_shingles", "set_id", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def _rows(batch: pa.RecordBatch, shingle: int):
    """Slices of (doc_id, text) rows with set sizes, set hashes, shingles and their rows."""
    for at, to in slices(batch.column(1)):
        part = batch.slice(at, to - at)
        hashes, owner = shingle_sets(part.column(1), shingle)
        n = np.bincount(owner, minlength=to - at)
        sums = np.zeros(to - at, np.uint64)
        filled = np.flatnonzero(n)
        if len(filled):
            first = np.concatenate([[0], np.cumsum(n)[:-1]])[filled]
            sums[filled] = np.add.reduceat(mix(hashes), first)
        yield part, n, mix(sums + n.astype(np.uint64)), hashes, owner


def _sets(sets: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.array(sets.view(np.int64), mask=n == 0)


def _chosen(rows: DataFrame, bits: int) -> HashTable:
    """One row of every class that joins, as a table of (set_id, doc_id) hashes."""
    first = rows.where("joins").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield _row_key(batch.column(0), batch.column(1))

    return write_table(first.mapInArrow(lambda b: counted(b, keys, bits), PACKED),
                       new_folder(rows.sparkSession, "chosen"), bits)


def _row_key(sets: pa.Array, ids: pa.Array) -> np.ndarray:
    ids = ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    sets = sets.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return mix(mix(ids) + sets)


def _class_sets(source: DataFrame, chosen: HashTable, shingle: int) -> DataFrame:
    """``set_id``, ``n`` and the sorted shingles (64-bit, packed) of each class that joins."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, n, sets, hashes, owner in _rows(batch, shingle):
                ids = _sets(sets, n)
                take = np.flatnonzero((chosen.counts(_row_key(ids, part.column(0))) > 0)
                                      & (n > 0))
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(take)), pa.array(n[take]),
                     pa.array([hashes[ends[k] - n[k]:ends[k]].tobytes() for k in take],
                              pa.binary())], ["set_id", "n", "shingles"])

    return source.mapInArrow(collect, "set_id long, n long, shingles binary")


def _parts(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def _concatenated(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(x.as_py(), np.uint64) for x in column]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), owner


def _links(sets: DataFrame, bits: int, percent: int) -> DataFrame:
    """A spanning forest (``a``, ``b`` set_ids) of the links between classes."""
    spark = sets.sparkSession

    def columns(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in _parts(batch):
            yield _concatenated(part.column(0))[0]

    counts = write_table(
        sets.select("shingles").mapInArrow(lambda b: counted(b, columns, bits), PACKED),
        new_folder(spark, "columns"), bits, least=2, with_counts=True)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole)):
            hashes, owner = _concatenated(batch.column(2))
            n = batch.column(1).to_numpy(zero_copy_only=False)
            df = counts.counts(hashes)
            hashes, owner, df = hashes[df > 0], owner[df > 0], df[df > 0]
            order = np.lexsort((hashes, df, owner))
            hashes, owner = hashes[order], owner[order]
            common = np.bincount(owner, minlength=len(n))
            wanted = common + 1 - -(-percent * n // 100)     # of the columns a pair shares
            rank = np.arange(len(owner)) - (np.cumsum(common) - common)[owner]
            take = rank < wanted[owner]
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[owner[take]]), pa.array(hashes[take].view(np.int64))],
                ["set_id", "shingle"])

    keys = materialize(sets.mapInArrow(rarest, "set_id long, shingle long"), "keys")
    hubs = keys.groupBy("shingle").agg(F.min("set_id").alias("a"), F.count("*").alias("n"))
    near = split_join(keys, hubs.where("n > 1"), "shingle").select("a", F.col("set_id").alias("b"))
    blocks = materialize(components(near), "blocks")
    members = sets.join(blocks.withColumnRenamed("node", "set_id"), "set_id")
    sizes = (sets.select("set_id", "n").join(blocks.withColumnRenamed("node", "set_id"), "set_id")
             .groupBy("component").agg(F.greatest(
                 F.ceil(F.count("*") / TILE_DOCS),
                 F.ceil(F.sum("n") / TILE_ENTRIES)).cast("int").alias("tiles")))
    tile = F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int")
    pairs = (split_join(members, sizes, "component").withColumn("tile", tile)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other"))
             .select("component", "i", "j", "set_id", "n", "shingles"))

    def product(table: pa.Table) -> pa.Table:
        ids = table["set_id"].to_numpy()
        ids, first = np.unique(ids, return_index=True)       # a row may have come twice
        shingles = table["shingles"].combine_chunks().take(pa.array(first))
        a, b = _forest([np.frombuffer(x.as_py(), np.uint64) for x in shingles], percent)
        return pa.table({"a": pa.array(ids[a]), "b": pa.array(ids[b])})

    return pairs.groupBy("component", "i", "j").applyInArrow(product, "a long, b long")


def _forest(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Members and roots of a spanning forest of the links between some sets."""
    forest = Forest(len(sets))
    alive, linked = _products(sets, percent)
    np.fill_diagonal(linked, True)               # a set is the same as a row and as a column
    root, _ = labels_between(linked)
    forest.join(zip(alive, alive[root]))
    roots = forest.roots()
    members = np.flatnonzero(roots != np.arange(len(sets)))
    return members, roots[members]


def _products(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may link and which of them do: overlaps are summed over column blocks."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    columns, column, df = np.unique(np.concatenate(sets), return_inverse=True,
                                    return_counts=True)
    rows, column = rows[df[column] > 1], column[df[column] > 1]
    size = np.array([len(s) for s in sets])
    alive = np.arange(len(sets))
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    left = np.bincount(rows, minlength=len(sets))
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    at = 0
    while at < len(rows) and len(alive):
        width = max(1, min(int(column[-1] - column[at]) + 1, max(64, BLOCK_CELLS // len(alive))))
        to = int(np.searchsorted(column, column[at] + width))
        own, cell = rows[at:to], column[at:to] - column[at]
        left -= np.bincount(own, minlength=len(sets))
        place = np.full(len(sets), -1)
        place[alive] = np.arange(len(alive))
        dense = np.zeros((len(alive), width), np.float32)
        inside = place[own] >= 0
        dense[place[own[inside]], cell[inside]] = 1
        overlap += dense @ dense.T
        possible = overlap + np.minimum(left[alive][:, None], left[alive][None, :])
        reach = _reaches(possible, size[alive], percent)
        stay = reach.any(axis=1)
        alive, overlap = alive[stay], overlap[np.ix_(stay, stay)]
        at = to
    return alive, _reaches(overlap, size[alive], percent)


def _reaches(overlap: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    sums = size[:, None] + size[None, :]
    found = (100 + percent) * overlap.astype(np.int64) >= percent * sums
    np.fill_diagonal(found, False)
    return found
