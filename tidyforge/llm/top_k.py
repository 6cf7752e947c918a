"""Exact search for the highest inner products, by tiled matrix products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyforge.llm.vectors import matrices
from tidyforge.llm.words import mix

TOP = 5
SCALE = 256
QUERY_TILE = 1024            # queries and rows that are multiplied at a time
SHARD_TILE = 256
PACK_BYTES = 4 << 20         # of vectors that a task packs before it sends them
CELL_BYTES = 24 << 20        # of rows, and of queries, of a cell in numbers of 16 bits
CELLS = 4                    # that each core should have where there are enough pairs
COPIES = 8                   # of the rows and queries, sent at most to have more cells
FAN_IN = 16
_TILE = "asks boolean, own int, size int, bits int, ids binary, parts binary"
_HIT = "cell int, query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, vec_id: str = "vec_id",
          embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's best rows.

    Every component x counts as the whole number floor(scale * x), taken in double precision;
    the score is the exact whole-number inner product.  The queries are the rows where
    ``is_query`` holds, the candidates all rows with another id, ties go to the smaller id and a
    query with fewer candidates gets all.  Rows without an id or a vector, and vectors with a
    missing or non-finite component, take no part; vectors of different length do not meet.
    Rows that repeat an id and its score count once, and a query id with several vectors is one
    query with the best of them.  A component or score beyond 64 bits is an error.

    Rows are dealt into shards and queries into blocks, by a hash of id and vector.  Every shard
    meets every block in a cell of bounded size, which is one group: rows are sent once for each
    block and queries once for each shard, packed, and no side is ever broadcast.  A cell
    multiplies tile by tile, in order of the ids, and keeps k rows per query.  The partial lists
    are merged as a tree, a fixed number at a time.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                          F.col(f"`{embedding}`").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("q")).where(
        "vec_id IS NOT NULL AND v IS NOT NULL")
    numbers = F.size("v").cast("long")
    count, asked, held, wanted = rows.select(
        F.count("*"), F.count_if("q"), F.sum(numbers), F.sum(F.when(F.col("q"), numbers))).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    shards, blocks = _grid(count, asked, 2 * (held or 0), 2 * (wanted or 0), CELLS * cores)
    tiles = rows.mapInArrow(lambda b: _tiles(b, scale, shards, blocks), _TILE)
    sent = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(
        F.col("asks"), shards - 1).otherwise(blocks - 1))))
    cells = sent.select(
        F.when(F.col("asks"), F.col("other") * blocks + F.col("own")).otherwise(
            F.col("own") * blocks + F.col("other")).alias("cell"),
        "size", "asks", "bits", "ids", "parts")
    # A number of partitions of its own, since few bytes of tiles are much work.
    found = cells.repartition(2 * shards * blocks, "cell").groupBy("cell", "size").applyInArrow(
        lambda t: _best(t, k), _HIT)
    lists = found.select(F.expr(f"cell div {blocks}").alias("shard"), "query_id", F.struct(
        (-F.col("score")).alias("s"), "vec_id").alias("hit"))
    while True:
        shards = -(-shards // FAN_IN)
        merged = lists.groupBy("query_id", F.expr(f"shard div {FAN_IN}").alias("shard")).agg(
            F.slice(F.array_sort(F.collect_set("hit")), 1, k).alias("hits"))
        if shards == 1:
            break
        lists = merged.select("shard", "query_id", F.explode("hits").alias("hit"))
    return merged.select("query_id", F.posexplode("hits").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id",
        (-F.col("hit.s")).alias("score"))


def _grid(rows: int, asked: int, row_bytes: int, asked_bytes: int,
          cells: int) -> tuple[int, int]:
    """How many shards of rows and blocks of queries there are.

    As many as bound a cell, then more up to ``cells`` cells of more than one tile, where that
    sends few enough copies.
    """
    shards, blocks = -(-row_bytes // CELL_BYTES) or 1, -(-asked_bytes // CELL_BYTES) or 1
    while shards * blocks < cells and rows * asked > shards * blocks * QUERY_TILE * SHARD_TILE:
        more = (2 * shards, blocks) if shards * asked <= blocks * rows else (shards, 2 * blocks)
        if more[0] * asked + more[1] * rows > COPIES * (rows + asked):
            break
        shards, blocks = more
    return shards, blocks


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """Vectors as whole numbers of the fewest bytes that hold them."""
    scaled = np.floor(scale * values)
    if (np.abs(scaled) >= 2.0 ** 62).any():
        raise OverflowError("a scaled component does not fit into 64 bits")
    return scaled.astype(next(t for t in (np.int16, np.int32, np.int64)
                              if np.abs(scaled).max() <= np.iinfo(t).max))


def _distinct(ids: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of their ids, rows that are equal in id and vector once."""
    order = np.argsort(ids, kind="stable")
    ids, parts = ids[order], np.ascontiguousarray(parts[order])
    if (ids[1:] == ids[:-1]).any():
        row = np.hstack([x.view(np.uint8).reshape(len(ids), -1) for x in (ids, parts)])
        keep = np.sort(np.unique(row.view(f"V{row.shape[1]}").ravel(), return_index=True)[1])
        ids, parts = ids[keep], parts[keep]
    return ids, parts


def _number(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """A hash of id and vector."""
    state = mix(ids.view(np.uint64))
    for part in parts.T:
        state = mix(state + part.astype(np.int64).view(np.uint64))
    return state


def _tiles(batches: Iterator[pa.RecordBatch], scale: int, shards: int,
           blocks: int) -> Iterator[pa.RecordBatch]:
    """All rows packed by shard, and the queries once more by block, for each length and width."""
    held: dict[tuple[int, int], list] = {}
    size = 0

    def packed() -> pa.RecordBatch:
        out = []
        for (length, bits), some in held.items():
            every = [np.concatenate(x) for x in zip(*some)]
            for asks, count in ((False, shards), (True, blocks)):
                chosen = every[2] if asks else slice(None)
                ids, parts = _distinct(every[0][chosen], every[1][chosen])
                own = (_number(ids, parts) % np.uint64(count)).astype(np.int64)
                order = np.argsort(own, kind="stable")
                ids, parts = ids[order], parts[order]
                bounds = np.searchsorted(own[order], np.arange(count + 1))
                out += [(asks, i, length, bits, ids[a:b].tobytes(), parts[a:b].tobytes())
                        for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
        held.clear()
        return pa.RecordBatch.from_arrays([
            pa.array(c, kind) for c, kind in zip(zip(*out), (
                pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
            ["asks", "own", "size", "bits", "ids", "parts"])

    for batch in batches:
        ids, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
        for own, values in matrices(batch.column(1)):
            parts = _whole(values, scale)
            held.setdefault((parts.shape[1], parts.itemsize * 8), []).append(
                (ids[own], parts, asks[own].astype(bool)))
            size += parts.nbytes
            if size >= PACK_BYTES:
                yield packed()
                size = 0
    if held:
        yield packed()


def _kind(a: np.ndarray, b: np.ndarray) -> type:
    """The fastest kind of number in which all inner products are exact."""
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    return (np.float32 if bound < 2 ** 24 else          # exact in any order of the sum
            np.float64 if bound < 2 ** 53 else np.int64 if bound < 2 ** 63 else object)


def _products(a: np.ndarray, b: np.ndarray, kind: type | None = None,
              out: np.ndarray | None = None) -> np.ndarray:
    """Exact inner products of whole-number rows."""
    kind = kind or _kind(a, b)
    if kind is not object:
        return np.matmul(a.astype(kind, copy=False), b.astype(kind, copy=False).T, out=out)
    exact = a.astype(object) @ b.astype(object).T
    if any(abs(x) >= 2 ** 63 for x in exact.flat):
        raise OverflowError("a score does not fit into 64 bits")
    return exact.astype(np.int64)


def _best(table: pa.Table, k: int) -> pa.Table:
    """The k best rows of a cell for each of its queries, for each width of their numbers."""
    cell, size = table["cell"][0], table["size"][0].as_py()
    sides: tuple[dict, dict] = {}, {}
    for asks, bits, ids, parts in zip(*(table[c] for c in ("asks", "bits", "ids", "parts"))):
        kind = f"i{bits.as_py() // 8}"
        sides[asks.as_py()].setdefault(kind, []).append((
            np.frombuffer(ids.as_buffer(), np.int64),
            np.frombuffer(parts.as_buffer(), kind).reshape(-1, size)))
    rows, queries = ([_distinct(*map(np.concatenate, zip(*some))) for some in side.values()]
                     for side in sides)
    hits = [hit for asked, wanted in queries for ids, parts in rows
            for hit in _search(asked, wanted, ids, parts, k)]
    columns = [np.concatenate(c) for c in zip(*hits)] or [np.zeros(0, np.int64)] * 3
    return pa.table([pa.repeat(cell, len(columns[0])), *map(pa.array, columns)],
                    ["cell", "query_id", "vec_id", "score"])


def _search(asked: np.ndarray, wanted: np.ndarray, ids: np.ndarray, parts: np.ndarray,
            k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query ids, ids and scores of the k best rows of each query; ``ids`` are sorted.

    As ids ascend, a later row enters a full list only with a higher score.
    """
    kind = _kind(wanted, parts)
    held = np.int64 if kind is object else kind
    lowest = np.iinfo(held).min if held is np.int64 else -np.inf
    apart = bool((ids[1:] != ids[:-1]).all())
    for start in range(0, len(asked), QUERY_TILE):
        own, left = asked[start:start + QUERY_TILE], wanted[start:start + QUERY_TILE]
        left = left.astype(kind)
        step = SHARD_TILE * max(1, QUERY_TILE // len(own))
        room = None if kind is object else np.empty((len(own), step), kind)
        scores, names = np.full((len(own), k), lowest, held), np.zeros((len(own), k), np.int64)
        for at in range(0, len(ids), step):
            some = ids[at:at + step]
            found = _products(left, parts[at:at + step], kind,
                              room if len(some) == step else None)
            hit = np.flatnonzero(found.max(axis=1) > scores[:, -1])
            if len(hit):
                _enter(scores, names, hit, own[hit], some, found[hit], lowest, apart)
        row, place = np.nonzero(scores > lowest)
        yield own[row], names[row, place], scores[row, place].astype(np.int64)


def _enter(scores: np.ndarray, names: np.ndarray, hit: np.ndarray, asked: np.ndarray,
           ids: np.ndarray, found: np.ndarray, lowest: float, apart: bool) -> None:
    """Put rows into the lists of the queries ``hit``; ``apart`` says that no id is repeated."""
    k = scores.shape[1]
    first, after = np.searchsorted(ids, asked), np.searchsorted(ids, asked, "right")
    for i in np.flatnonzero(first < after):                      # no row of the query's own id
        found[i, first[i]:after[i]] = lowest
    better = found > scores[hit, -1:]
    if apart and found.shape[1] > k and np.count_nonzero(better) > 8 * k * len(hit):
        better &= found >= np.partition(found, -k, axis=1)[:, -k, None]
    flat = np.flatnonzero(better)
    row, column = np.divmod(flat, found.shape[1])
    place = k + np.arange(len(row)) - np.searchsorted(row, row)
    score = np.full((len(hit), place.max(initial=k) + 1), lowest, scores.dtype)
    name = np.zeros(score.shape, np.int64)
    score[:, :k], name[:, :k] = scores[hit], names[hit]
    score[row, place], name[row, place] = found.ravel()[flat], ids[column]

    def descend() -> None:                     # ids ascend already where scores are equal
        order = np.argsort(-score if score.dtype.kind == "f" else ~score, axis=1, kind="stable")
        for x in (score, name):
            x[:] = np.take_along_axis(x, order, axis=1)

    descend()
    if not apart:
        again = (score[:, 1:] == score[:, :-1]) & (name[:, 1:] == name[:, :-1])
        score[:, 1:][again] = lowest
        descend()
    scores[hit], names[hit] = score[:, :k], name[:, :k]
