"""Records of large text files whose limits depend on all the text before them.

Whether a line break ends a CSV record, or a closing brace an element of a JSON array, depends
on the quotes and brackets since the start of the file.  Spark splits files at any separator,
so a split does not know how it starts.  Each reports how it moves from one state to the next,
if it starts outside or inside of quotes; running sums over the splits of a file then tell how
each of them starts, and records are cut by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidyforge.session import materialize

PLACE = ["file", "block", "chunk", "n"]
#: State and depth where the last record of a sound file has been read.
_CHUNKS = ("file string, block long, chunk long, text string, turned int, outside long, "
           "inside long, turned_after int, outside_after long, inside_after long")
_PIECES = ("file string, block long, chunk long, n long, kind int, depth long, "
           "depth_after long, text string")


@dataclass(frozen=True)
class Rule:
    """What may end a record: ``separator``, outside of quotes, at ``depth`` brackets or less.

    ``opening`` and ``closing`` brackets count outside of quotes; ``closes`` says that the
    separator is itself a closing one.  With an ``escape`` the sign after it counts for nothing.
    """

    separator: str
    depth: int = 0
    quote: str = '"'
    escape: str | None = None
    opening: str = ""
    closing: str = ""
    closes: bool = False

    def moves(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each part: whether it leads from outside quotes to inside or back, and by how
        much it changes the depth if it starts outside and if it starts inside."""
        if self.escape:
            parts = pc.replace_substring_regex(parts, f"(?s){_literal(self.escape)}.", "")
        turns = pc.count_substring(parts, self.quote).to_numpy() % 2
        if not (self.opening or self.closing):
            return turns, np.zeros(len(turns), np.int64), np.zeros(len(turns), np.int64)
        quote = _literal(self.quote)
        quoted = rf"{quote}[^{quote}]*(?:{quote}|\z)"
        unquoted = pc.replace_substring_regex(parts, quoted, "")
        later = pc.replace_substring_regex(
            pc.replace_substring_regex(parts, rf"\A[^{quote}]*(?:{quote}|\z)", ""), quoted, "")
        outside, inside = self._depth(unquoted), self._depth(later)
        if self.closes:
            outside, inside = outside - (turns == 0), inside - (turns == 1)
        return turns, outside, inside

    def _depth(self, parts: pa.Array) -> np.ndarray:
        total = np.zeros(len(parts), np.int64)
        for sign in self.opening:
            total += pc.count_substring(parts, sign).to_numpy()
        for sign in self.closing:
            total -= pc.count_substring(parts, sign).to_numpy()
        return total


def _literal(sign: str) -> str:
    return "\\" + sign if not sign.isalnum() else sign


def json_array_rule() -> Rule:
    return Rule("}", depth=1, escape="\\", opening="{[", closing="]", closes=True)


def json_columns_rule() -> Rule:
    return Rule(",", depth=2, escape="\\", opening="{[", closing="}]")


def _split(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Chunks of the parts of each file split, with the moves from its start to theirs."""
    at, chunk, before = None, 0, (0, 0, 0)
    for batch in batches:
        names = batch.column("file").dictionary_encode()
        blocks = batch.column("block").to_numpy()
        turn = np.flatnonzero((np.diff(names.indices.to_numpy()) != 0) | (np.diff(blocks) != 0)) + 1
        limits = [0, *turn.tolist(), batch.num_rows]
        for first, last in zip(limits, limits[1:]):
            if first == last:
                continue
            own = (batch.column("file")[first].as_py(), int(blocks[first]))
            if own != at:
                at, chunk, before = own, 0, (0, 0, 0)
            parts = batch.column("value").slice(first, last - first)
            turns, outside, inside = rule.moves(parts)
            state = (np.cumsum(turns) - turns + before[0]) % 2
            after = ((before[0] + int(turns.sum())) % 2,
                     before[1] + int(np.where(state == 0, outside, inside).sum()),
                     before[2] + int(np.where(state == 1, outside, inside).sum()))
            text = rule.separator.join(parts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(
                    [*own, chunk, text, *before, *after],
                    [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(),
                     pa.int64(), pa.int32(), pa.int64(), pa.int64()])],
                ["file", "block", "chunk", "text", "turned", "outside", "inside",
                 "turned_after", "outside_after", "inside_after"])
            chunk, before = chunk + 1, after


def _cut(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Records of chunks.  What a chunk has before the first end of a record, if it starts
    within one, is of kind 1, what is left open at its end of kind 2, whole records of kind 0."""
    for batch in batches:
        for row in batch.to_pylist():
            parts = row["text"].split(rule.separator)
            turns, outside, inside = rule.moves(pa.array(parts, pa.string()))
            state = (np.cumsum(turns) - turns + row["state"]) % 2
            depth = row["depth"] + np.cumsum(np.where(state == 0, outside, inside))
            ends = np.flatnonzero(((state + turns) % 2 == 0) & (depth <= rule.depth)) + 1
            limits = [0, *ends.tolist()]
            if limits[-1] != len(parts):
                limits.append(len(parts))
            pairs = list(zip(limits, limits[1:]))
            kinds = np.zeros(len(pairs), np.int32)
            if not len(ends) or ends[-1] != len(parts):
                kinds[-1] = 2
            if row["state"] or row["depth"] > rule.depth:
                kinds[0] = 1
            start = np.concatenate([[row["depth"]], depth])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["file"]] * len(pairs), pa.string()),
                 pa.array([row["block"]] * len(pairs), pa.int64()),
                 pa.array([row["chunk"]] * len(pairs), pa.int64()),
                 pa.array(np.arange(len(pairs))), pa.array(kinds),
                 pa.array([int(start[a]) for a, _ in pairs], pa.int64()),
                 pa.array([int(start[b]) for _, b in pairs], pa.int64()),
                 pa.array([rule.separator.join(parts[a:b]) for a, b in pairs], pa.string())],
                ["file", "block", "chunk", "n", "kind", "depth", "depth_after", "text"])


def cut_records(spark: SparkSession, path, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Records of text files, and how each file ends.

    The first frame has the place of a record (``file``, ``block``, ``chunk``, ``n``, in this
    order), the ``depth`` before it and ``depth_after`` it, and its ``text`` without the
    separator that ends it; it is a written table.  The second has ``file``, ``state`` (1 inside
    of quotes) and ``depth`` at the end of a file.

    Files are read once, by splits, into a written table of chunks, because splits may be laid
    out otherwise the next time.  Only records that go over the end of a chunk are gathered.
    """
    parts = spark.read.option("lineSep", rule.separator).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")
    chunks = materialize(parts.mapInArrow(lambda batches: _split(batches, rule), _CHUNKS), "chunks")

    moves = chunks.groupBy("file", "block").agg(F.max_by(
        F.struct("turned_after", "outside_after", "inside_after"), "chunk").alias("all"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    moves = moves.withColumn("state", F.coalesce(F.sum("all.turned_after").over(before), F.lit(0)) % 2)
    deeper = F.when(F.col("state") == 0, F.col("all.outside_after")).otherwise(
        F.col("all.inside_after"))
    moves = moves.withColumn("deeper", deeper).withColumn(
        "depth", F.coalesce(F.sum("deeper").over(before), F.lit(0)))
    # one row per split, written so that Spark knows how small it is beside the chunks
    starts = materialize(moves.select("file", "block", F.col("state").alias("split_state"),
                                      F.col("depth").alias("split_depth")), "starts")
    ends = moves.groupBy("file").agg(F.max_by(F.struct(
        ((F.col("state") + F.col("all.turned_after")) % 2).alias("state"),
        (F.col("depth") + F.col("deeper")).alias("depth")), "block").alias("end")).select(
        "file", "end.*")

    known = chunks.join(starts, ["file", "block"]).select(
        "file", "block", "chunk", "text",
        ((F.col("split_state") + F.col("turned")) % 2).cast("int").alias("state"),
        (F.col("split_depth") + F.when(F.col("split_state") == 0, F.col("outside"))
         .otherwise(F.col("inside"))).alias("depth"))
    pieces = materialize(known.mapInArrow(lambda batches: _cut(batches, rule), _PIECES), "pieces")
    whole = pieces.where("kind = 0").drop("kind")
    order = Window.partitionBy("file").orderBy("block", "chunk", "kind")
    opened = F.sum((F.col("kind") == 2).cast("long")).over(order)
    # a chunk wholly inside a record both goes on and stays open: it opens nothing
    broken = pieces.where("kind > 0")
    # a file's pieces are numbered in one task, which gets their places without their text
    numbers = materialize(broken.select(*PLACE, "kind").select(*PLACE, opened.alias("opened")),
                          "opened")
    joined = broken.join(numbers, PLACE).groupBy("file", "opened").agg(
        F.min(F.struct("block", "chunk", "n", "depth")).alias("first"),
        F.max(F.struct("block", "chunk", "n", "depth_after")).alias("last"),
        F.sort_array(F.collect_list(F.struct("block", "chunk", "text"))).alias("parts"))
    joined = joined.select(
        "file", "first.block", "first.chunk", "first.n", "first.depth", "last.depth_after",
        F.array_join(F.transform("parts", lambda p: p["text"]), rule.separator).alias("text"))
    return materialize(whole.unionByName(joined.select(*whole.columns)), "records"), ends


def place_text() -> Column:
    """The place of a record as text that sorts like it."""
    return F.concat_ws("\t", "file", *[F.lpad(F.col(c).cast("string"), 20, "0") for c in PLACE[1:]])
