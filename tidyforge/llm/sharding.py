"""Sharding by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyforge.functions.names import ref
from tidyforge.llm.links import split_join
from tidyforge.llm.places import numbered
from tidyforge.session import materialize

LANE_GROUPS = 200_000        # groups a task packs at a time, about
CRATES = 1024                # crates of a shard's size, about; bounds what the driver packs


class Bins:
    """Open bins in a balanced search tree over (room left, number).

    The tree is a list of sorted leaves of bounded length, each found by bisection on its
    largest entry; a leaf that grows too long is cut in two, an empty one goes.
    """

    LEAF = 512

    def __init__(self, capacity: int):
        self.capacity, self.count = capacity, 0
        self.leaves: list[list[tuple[int, int]]] = []
        self.largest: list[tuple[int, int]] = []

    def put(self, size: int) -> int:
        """The bin that ``size`` enters: the one with the least room that is enough, the
        earliest of equal ones, else a new one.  What is larger than a bin gets its own."""
        at = bisect.bisect_left(self.largest, (size, -1))
        if at == len(self.leaves):
            number, room = self.count, self.capacity
            self.count += 1
        else:
            leaf = self.leaves[at]
            room, number = leaf.pop(bisect.bisect_left(leaf, (size, -1)))
            if leaf:
                self.largest[at] = leaf[-1]
            else:
                del self.leaves[at], self.largest[at]
        if room > size:
            self._add((room - size, number))
        return number

    def _add(self, entry: tuple[int, int]) -> None:
        if not self.leaves:
            self.leaves, self.largest = [[entry]], [entry]
            return
        at = min(bisect.bisect_left(self.largest, entry), len(self.leaves) - 1)
        leaf = self.leaves[at]
        bisect.insort(leaf, entry)
        if len(leaf) > self.LEAF:
            half = len(leaf) // 2
            self.leaves[at:at + 1] = [leaf[:half], leaf[half:]]
            self.largest[at:at + 1] = [leaf[half - 1], leaf[-1]]
        else:
            self.largest[at] = leaf[-1]


def best_fit(sizes: Iterable[int], capacity: int) -> tuple[list[int], int]:
    """Bin of each size, in the order given, and the number of bins."""
    bins = Bins(capacity)
    return [bins.put(int(s)) for s in sizes], bins.count


def even_bins(sizes: np.ndarray, count: int) -> np.ndarray:
    """Bins 0 to ``count`` - 1 of ``sizes``, which are in falling order, with near equal sums.

    What is as large as an equal part of all that is left has a bin of its own.  The others are
    packed best-fit-decreasing with the least capacity, found by bisection, that needs no more
    bins than are left.
    """
    bins = np.zeros(len(sizes), np.int64)
    alone, left = 0, int(sizes.sum())
    while alone < min(count - 1, len(sizes)) and int(sizes[alone]) * (count - alone) >= left:
        bins[alone] = alone
        left -= int(sizes[alone])
        alone += 1
    rest, free = sizes[alone:], count - alone
    if not len(rest):
        return bins
    low = max(-(-left // free), int(rest[0]))
    high = low + int(rest[0])    # enough: a bin that refuses a size holds more than ``low``
    chosen, _ = best_fit(rest, high)
    while low < high:
        middle = (low + high) // 2
        found, used = best_fit(rest, middle)
        if used <= free:
            chosen, high = found, middle
        else:
            low = middle + 1
    bins[alone:] = np.array(chosen) + alone
    return bins


def pack_groups(groups: DataFrame, capacity: int, lane_groups: int = LANE_GROUPS,
                n_groups: int | None = None) -> DataFrame:
    """``groups`` (key, size) with ``lane`` and ``bin``, bins holding ``capacity`` at most.

    Groups are dealt to lanes by the hash of their key; a lane is packed best-fit-decreasing
    by one task, which reads it in falling order of size and keeps only the open bins.  In a
    lane no two bins are half empty, so the bins are fewer than twice the least number, and in
    practice near it, plus one for each lane.  A group larger than ``capacity`` has a bin of
    its own.  Equal sizes follow the order of their keys, so reruns agree.
    """
    if n_groups is None:
        n_groups = groups.count()
    lanes = max(1, -(-n_groups // lane_groups))
    dealt = groups.withColumn("lane", F.pmod(F.xxhash64("key"), F.lit(lanes)).cast("int"))
    ordered = dealt.repartition(lanes, "lane").sortWithinPartitions(
        "lane", F.col("size").desc(), "key")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, bins = None, Bins(capacity)
        for batch in batches:
            out = np.empty(batch.num_rows, np.int64)
            own = batch.column("lane").to_pylist()
            for i, size in enumerate(batch.column("size").to_pylist()):
                if own[i] != lane:
                    lane, bins = own[i], Bins(capacity)
                out[i] = bins.put(size)
            yield batch.append_column("bin", pa.array(out))
    return ordered.mapInArrow(pack, f"{_fields(dealt)}, bin long")


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def shard_rows(rows: DataFrame, key: Column, size: Column, shards: int,
               crates: int = CRATES, lane_groups: int = LANE_GROUPS) -> DataFrame:
    """``rows`` with ``size``, ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0 in a shard).

    Rows with equal ``key`` are a group, which stays in one shard; missing keys are a group
    too.  Columns of ``rows`` named size, shard or slot are replaced.  Sizes are whole numbers
    of at least 1.  Repeated rows each have a slot, an empty table gives an empty result.  Shards are near equal in the sum of their
    sizes, as far as groups allow: one that is larger than an equal part has a shard of its own.

    Groups first enter crates of 1 / (``shards`` x ``crates``) of all sizes, packed by many
    tasks; larger groups are crates of their own.  There are at most about two crates for each
    such part and one for each lane of ``lane_groups`` groups, and these the driver packs into
    the shards.  While the groups are small in number they are few to a crate, or one.  Both
    steps are best-fit-decreasing.  Within a shard rows stand by group, then by their hash.
    """
    own = [c for c in rows.columns if c.lower() not in ("size", "shard", "slot")]
    kept = materialize(rows.select(
        F.struct(*[ref(c) for c in own]).alias("row"), key.alias("key"),
        size.cast("long").alias("size")), "sizes")
    kept = kept.withColumn("tie", F.monotonically_increasing_id())
    groups = kept.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    groups = materialize(groups, "groups")
    told = groups.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    capacity = max(1, -(-int(told["size"] or 0) // (shards * crates)))
    packed = materialize(pack_groups(groups, capacity, lane_groups, told["n"]), "crates")

    found = packed.groupBy("lane", "bin").agg(F.sum("size").alias("size")).toArrow()
    crate = {c: found.column(c).to_numpy().astype(np.int64) for c in ("lane", "bin", "size")}
    order = np.lexsort((crate["bin"], crate["lane"], -crate["size"]))
    shard = even_bins(crate["size"][order], shards)
    spark = rows.sparkSession
    where = spark.createDataFrame(pa.table({
        "__lane": crate["lane"][order], "__bin": crate["bin"][order], "shard": shard}))
    placed = materialize(packed.join(where, (F.col("lane") == F.col("__lane"))
                                     & (F.col("bin") == F.col("__bin")))
                         .select("key", "shard", "n"), "placed")
    first, starts = 0, []
    counts = {r[0]: r[1] for r in placed.groupBy("shard").agg(F.sum("n")).collect()}
    for k in range(shards):
        starts.append((k, first))
        first += counts.get(k, 0)
    begins = spark.createDataFrame(starts, "__shard long, __first long")
    dealt = split_join(kept, placed.drop("n"), "key")
    ordered = numbered(dealt, "shard", "key", "tie")
    return ordered.join(begins, F.col("shard") == F.col("__shard")).select(
        "row.*", F.col("size").alias("size"), F.col("shard").cast("int").alias("shard"),
        (F.col("place") - F.col("__first")).alias("slot"))
