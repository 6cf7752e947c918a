"""Near-duplicate vectors: an exact range join over cells around pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyforge.llm.links import components, labels_between, split_join
from tidyforge.llm.vectors import matrices
from tidyforge.llm.words import mix
from tidyforge.session import materialize

COSINE = 0.93
CELL = 2048                  # vectors a cell should hold, and a tile holds at most
SAMPLE = 4096                # vectors among which pivots are chosen
MOST_PIVOTS = 256


def near_vectors(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id",
                 embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Two rows link if their labels are equal and not missing and the cosine of their vectors, in
    double precision, is at least ``cosine``.  ``component_id`` is the smallest vec_id that
    links reach; ``kept`` marks the row that bears it.  A vector that is missing, empty, zero
    or has a missing or non-finite component links with nothing, nor do vectors of different
    length; such rows are their own component.  Rows with equal labels and vectors are joined
    once and link with one another; a row that occurs twice is two such rows.  A row without a
    vec_id lends no name and is kept only if its component has none.

    On the unit sphere the cosine is a distance r.  Each vector's home is the cell of its
    nearest pivot; by the triangle inequality a vector can be within r of a vector at home in
    another cell only if that cell's pivot is at most 2 r farther than its own, and only if it
    is within r of the plane between the two pivots; then it is sent there as well.  Every link of a vector is thus found in its home cell, and cells are joined
    independently.  A large cell is dealt into tiles.  Tasks return link counts and a spanning
    forest, never pairs of a whole group.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                          F.col(f"`{embedding}`").alias("v"),
                          F.col(f"`{label}`").cast("string").alias("label")).withColumn(
        "seed", F.xxhash64("label"))
    kept = materialize(rows.mapInArrow(
        _classes, "vec_id long, label string, size int, class long, vector binary"), "vectors")
    classes = materialize(
        kept.where("class IS NOT NULL").groupBy("class", "label", "size").agg(
            F.count("*").alias("copies"), F.first("vector").alias("vector")), "classes")
    largest = classes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 0
    pivots = _pivots(classes, max(2, min(MOST_PIVOTS, -(-largest // CELL))))
    reach = np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _cells(batch, pivots, reach)

    # Dealt anew for the counts and for each side, which is cheaper than a table of copies.
    cells = classes.mapInArrow(
        deal, "class long, label string, size int, copies long, vector binary, cell int, "
        "home boolean")
    key = ["label", "size", "cell"]
    tiles = cells.groupBy(*key).agg(
        F.ceil(F.count_if("home") / CELL).cast("int").alias("rows"),
        F.ceil(F.count("*") / CELL).cast("int").alias("columns")).where("rows > 0")
    dealt = cells.join(tiles, key)
    number = F.xxhash64("class")
    side = [*key, "i", "j", "class", "copies", "vector"]
    home = dealt.where("home").withColumn("i", F.pmod(number, "rows").cast("int")).withColumn(
        "j", F.explode(F.expr("sequence(0, columns - 1)"))).select(*side, F.lit(True).alias("home"))
    other = dealt.withColumn("j", F.pmod(number, "columns").cast("int")).withColumn(
        "i", F.explode(F.expr("sequence(0, rows - 1)"))).select(*side, F.lit(False).alias("home"))

    def product(table: pa.Table) -> pa.Table:
        return _tile(table, cosine)

    found = materialize(home.unionByName(other).groupBy(*key, "i", "j").applyInArrow(
        product, "a long, b long, links long"), "found")
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed(
        "node", "class")
    counts = found.where("links IS NOT NULL").groupBy(F.col("a").alias("class")).agg(
        F.sum("links").alias("links"))
    told = (classes.select("class", "copies").join(counts, "class", "left")
            .join(roots, "class", "left").select(
        "class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "class").alias("component")))
    joined = split_join(kept.where("class IS NOT NULL").select("vec_id", "class"), told, "class")
    first = joined.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    linked = split_join(joined, first, "component").select("vec_id", "n_links", "component_id")
    alone = kept.where("class IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors in the fewest bytes that hold them, and one number for equal labels and vectors."""
    for batch in batches:
        n = batch.num_rows
        units, sizes = np.full(n, None, object), np.zeros(n, np.int32)
        numbers = np.zeros(n, np.uint64)
        for own, values in matrices(batch.column(1)):
            usable = (values != 0).any(axis=1)
            values, own = values[usable] + 0.0, own[usable]           # no negative zeros
            bits = values.view(np.uint64)
            state = np.full(len(own), values.shape[1], np.uint64)
            for part in bits.T:
                state = mix(state + part)
            numbers[own], sizes[own] = state, values.shape[1]
            with np.errstate(over="ignore"):
                short = values.astype(np.float32)
            exact = (short == values).all(axis=1)
            units[own] = [(s if e else v).tobytes() for s, v, e in zip(short, values, exact)]
        units[batch.column(2).is_null().to_numpy(zero_copy_only=False)] = None
        seeds = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
        numbers = mix(numbers ^ mix(seeds)).view(np.int64)
        none = np.array([u is None for u in units], bool)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(2), pa.array(sizes), pa.array(numbers, mask=none),
            pa.array(units, pa.binary())], ["vec_id", "label", "size", "class", "vector"])


def _units(vectors, size: int) -> np.ndarray:
    """Unit vectors, in double precision, of packed ones of one length."""
    values = np.stack([np.frombuffer(v, np.float64 if len(v) == 8 * size else np.float32)
                       .astype(np.float64) for v in vectors])
    largest = np.abs(values).max(axis=1)
    odd = (largest > 1e140) | (largest < 1e-140)             # squares out of range
    values[odd] /= largest[odd][:, None]
    return values / np.sqrt((values * values).sum(axis=1))[:, None]


def _pivots(classes: DataFrame, wanted: int) -> dict[int, np.ndarray]:
    """Pivots by length of vector: spread-out members of a sample of fixed size."""
    sample: dict[int, list] = {}
    for row in classes.select("size", "class", "vector").orderBy("class").limit(SAMPLE).collect():
        sample.setdefault(row["size"], []).append(bytes(row["vector"]))
    found = {}
    for size, vectors in sample.items():
        own = _units(vectors, size)
        chosen, nearest = [0], own @ own[0]
        while len(chosen) < min(wanted, len(own)):
            chosen.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, own @ own[chosen[-1]])
        found[size] = own[chosen]
    return found


def _cells(batch: pa.RecordBatch, pivots: dict, reach: float) -> Iterator[pa.RecordBatch]:
    sizes = batch.column(2).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        around = pivots.get(int(size))
        if around is None:
            row, cell, home = own, np.zeros(len(own), np.int32), np.ones(len(own), bool)
        else:
            units = _units([batch.column(4)[int(i)].as_py() for i in own], int(size))
            cosines = units @ around.T
            far = np.sqrt(np.maximum(0, 2 - 2 * cosines))
            nearest = far.argmin(axis=1)
            apart = np.sqrt(np.maximum(0, 2 - 2 * (around @ around.T)))[nearest]
            # the distance to the plane between two unit pivots is the difference of the
            # cosines, divided by the distance of the pivots
            nearer = cosines[np.arange(len(own)), nearest][:, None] - cosines
            sent = (far <= far.min(axis=1)[:, None] + 2 * reach) & (nearer <= reach * apart + 1e-9)
            at, cell = np.nonzero(sent)
            row, home = own[at], nearest[at] == cell
        part = batch.take(pa.array(row))
        order = ["class", "label", "size", "copies", "vector"]
        yield pa.RecordBatch.from_arrays(
            [part.column(part.schema.get_field_index(c)) for c in order] + [
                pa.array(cell.astype(np.int32)), pa.array(home)], [*order, "cell", "home"])


def _tile(table: pa.Table, cosine: float) -> pa.Table:
    home = table["home"].to_numpy(zero_copy_only=False).astype(bool)
    number = table["class"].to_numpy()
    units = _units(table["vector"].to_pylist(), table["size"][0].as_py())
    copies = table["copies"].to_numpy()[~home]
    rows, columns = number[home], number[~home]
    if not len(rows) or not len(columns):
        return pa.table({c: pa.array([], pa.int64()) for c in ("a", "b", "links")})
    linked = units[home] @ units[~home].T >= cosine
    linked &= rows[:, None] != columns[None, :]
    links = linked @ copies
    up, across = labels_between(linked)
    names = np.concatenate([rows, columns])
    roots = np.concatenate([up, across])
    a, b = names, names[roots]
    apart = a != b
    some = links > 0
    return pa.table({
        "a": pa.array(np.concatenate([a[apart], rows[some]])),
        "b": pa.array(np.concatenate([b[apart], np.zeros(some.sum(), np.int64)]),
                      mask=np.concatenate([np.zeros(apart.sum(), bool), np.ones(some.sum(), bool)])),
        "links": pa.array(np.concatenate([np.zeros(apart.sum(), np.int64), links[some]]),
                          mask=np.concatenate([np.ones(apart.sum(), bool),
                                               np.zeros(some.sum(), bool)]))})
