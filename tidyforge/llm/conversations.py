"""Repair of the turn structure of conversations at the least cost."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyforge.functions.names import ref
from tidyforge.llm.places import add_places, in_order
from tidyforge.session import materialize

SEGMENT = 4096               # most rows of a conversation that are handled at once
#: What a row may have wrong; only the first that applies counts.
FAULTS = {"blank": 1, "duplicate": 2, "truncated": 3}
COSTS = {"rerole": 1, "delete": 2, "insert": 5, "truncated": 5}
_BLANKS = " \t\n\x0b\x0c\r"
_FAR = 1 << 40
# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
# The turn that a state asks for leads to _NEXT; _STEP has the state that a turn with the
# initial s, u, a or another leads to, -1 where it may not stand.
_NEXT = np.array([2, 2, 3, 2])
_STEP = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
_LETTERS = "\0DIKR"          # ranks of length one, in the order of the letters


def faults(text: Column) -> Column:
    """Fault of a text on its own: blank, truncated (its last sign that is not white space is
    none of ``.!?``) or 0."""
    seen = F.rtrim(text, F.lit(_BLANKS))
    return (F.when(seen == "", FAULTS["blank"])
            .when(~F.substring(seen, -1, 1).isin(".", "!", "?"), FAULTS["truncated"]).otherwise(0))


def _insertions(v: np.ndarray) -> np.ndarray:
    """Least costs where turns may be inserted first; the states are the second axis."""
    cost = COSTS["insert"]
    user, reply = v[:, 2], v[:, 3]
    out = np.empty_like(v)
    for start in (0, 1):
        out[:, start] = np.minimum(np.minimum(v[:, start], user + cost), reply + 2 * cost)
    out[:, 2] = np.minimum(user, reply + cost)
    out[:, 3] = np.minimum(reply, user + cost)
    return out


def end_costs() -> np.ndarray:
    """Costs from each state when no row is left."""
    return _insertions(np.array([[0, _FAR, _FAR, 0]], np.int64))[0]


def _edits(initial: np.ndarray, fault: np.ndarray, after: np.ndarray):
    """Costs of deleting, keeping and renaming rows, given the costs ``after`` them.

    ``after`` has a row each, then the states, then anything.
    """
    extra = np.where(fault == FAULTS["truncated"], COSTS["truncated"], 0)
    must_go = (fault == FAULTS["blank"]) | (fault == FAULTS["duplicate"])
    shape = (len(initial), 1) + (1,) * (after.ndim - 2)
    extra, must_go = extra.reshape(shape), must_go.reshape(shape)
    step = _STEP[:, initial].T                                   # row, state
    rows = np.arange(len(initial))[:, None]
    kept = np.where((step < 0).reshape(step.shape + (1,) * (after.ndim - 2)), _FAR,
                    after[rows, np.maximum(step, 0)]) + extra
    renamed = after[:, _NEXT] + extra + COSTS["rerole"]
    return (after + COSTS["delete"], np.where(must_go, _FAR, kept),
            np.where(must_go, _FAR, renamed))


class Segments:
    """Stretches of conversations, one after the other, as graphs of (row, state) nodes.

    Segment s has its rows at ``starts[s]`` to ``starts[s + 1]``.  Its nodes are 4 states before
    each row and 4 after the last one; arcs are the edits of a row and, at no row, insertions.
    """

    def __init__(self, initial: np.ndarray, fault: np.ndarray, starts: np.ndarray):
        self.initial, self.fault, self.starts = initial, fault, starts
        self.lengths = np.diff(starts)
        self.base = 4 * (starts[:-1] + np.arange(len(self.lengths)))   # a segment's first node

    def costs(self, end: np.ndarray) -> np.ndarray:
        """Costs from every node, the rows in step from the last to the first.

        ``end`` has for each segment and state the costs after it, in one or more columns.
        """
        out = np.empty((len(self.initial) + len(self.lengths),) + end.shape[1:], np.int64)
        places = self.starts[:-1] + np.arange(len(self.lengths))       # first layer of each
        out[places + self.lengths] = end
        longest = np.argsort(-self.lengths, kind="stable")
        ordered = self.lengths[longest]
        for back in range(1, int(ordered[0]) + 1 if len(ordered) else 0):
            live = longest[:np.searchsorted(-ordered, -back, side="right")]
            row = self.starts[1:][live] - back
            at = places[live] + self.lengths[live] - back
            best = np.minimum.reduce(_edits(self.initial[row], self.fault[row], out[at + 1]))
            out[at] = _insertions(best)
        return np.minimum(out, _FAR)

    def matrices(self, which: np.ndarray) -> np.ndarray:
        """Costs from each state before to each state after the segments ``which``."""
        part = self.take(which)
        unit = np.full((len(which), 4, 4), _FAR, np.int64)
        unit[:, np.arange(4), np.arange(4)] = 0
        return part.costs(unit)[part.starts[:-1] + np.arange(len(which))]

    def take(self, which: np.ndarray) -> "Segments":
        rows = np.concatenate([np.arange(self.starts[s], self.starts[s + 1]) for s in which]
                              or [np.empty(0, np.int64)]).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(self.lengths[which])]).astype(np.int64)
        return Segments(self.initial[rows], self.fault[rows], starts)

    def rank(self, end: np.ndarray, last: np.ndarray) -> "Paths":
        """Rank the nodes by their least audit, given the costs after each segment.

        ``last`` marks the segments that end their conversation; there, turns may be inserted
        after the last row.  Only arcs on a cheapest way count.  At length one a node has the
        rank of the least letter of its arcs, which differ in their letters, and points to where
        that arc ends.  Ranks at twice the length are those of the pairs (own rank, rank of the
        node pointed to), and pointers lead twice as far, until every pointer has come to an end.
        """
        cost = self.costs(end)
        layers, count = len(cost), len(self.lengths)
        segment = np.repeat(np.arange(count), self.lengths + 1)
        depth = np.arange(layers) - (self.starts[:-1] + np.arange(count))[segment]
        inner = depth < self.lengths[segment]
        node = np.arange(layers * 4).reshape(layers, 4)
        letter = np.zeros((layers, 4), np.int64)
        target = node.copy()

        def arcs(at: np.ndarray, letters: int, fits: np.ndarray, ends: np.ndarray) -> None:
            """Arcs are offered from the last letter to the first, so the least one stays."""
            letter[at] = np.where(fits, letters, letter[at])
            target[at] = np.where(fits, ends, target[at])

        at = np.flatnonzero(inner)
        row = (self.starts[:-1][segment] + depth)[at]
        after, here = cost[at + 1], cost[at]
        deleted, kept, renamed = _edits(self.initial[row], self.fault[row], after)
        arcs(at, 4, renamed == here, node[at + 1][:, _NEXT])
        step = np.maximum(_STEP[:, self.initial[row]].T, 0)
        arcs(at, 3, kept == here, np.take_along_axis(node[at + 1], step, 1))
        arcs(at, 2, here[:, _NEXT] + COSTS["insert"] == here, node[at][:, _NEXT])
        arcs(at, 1, deleted == here, node[at + 1])
        at = np.flatnonzero(~inner & last[segment])
        here = cost[at]
        arcs(at, 2, (here[:, _NEXT] + COSTS["insert"] == here) & (here > 0), node[at][:, _NEXT])

        rank, pointers = letter.ravel(), [target.ravel()]
        while True:
            far = pointers[-1]
            key = rank * (int(rank.max(initial=0)) + 1) + rank[far]
            rank = np.unique(key, return_inverse=True)[1]
            if (far[far] == far).all():
                break
            pointers.append(far[far])
        return Paths(self, cost, letter.ravel(), rank, pointers)


class Paths:
    """Least paths through ranked segments."""

    def __init__(self, segments: Segments, cost: np.ndarray, letter: np.ndarray,
                 rank: np.ndarray, pointers: list[np.ndarray]):
        self.segments, self.cost = segments, cost.ravel()
        self.letter, self.rank, self.pointers = letter, rank, pointers

    def exits(self) -> np.ndarray:
        """State after each segment, for each state before it."""
        first = self.segments.base[:, None] + np.arange(4)
        return self.pointers[-1][first] % 4

    def nodes(self, entry: np.ndarray) -> np.ndarray:
        """Nodes on the least path of each segment from state ``entry``, in path order.

        Starting from the segments' first nodes, every pointer, the longest first, adds the
        nodes it leads to, so each node of a path is reached by the powers of two that sum up
        to its place.
        """
        reached = self.segments.base + entry
        steps = np.zeros(len(reached), np.int64)
        for k in reversed(range(len(self.pointers))):
            far = self.pointers[k][reached]
            more = self.letter[far] > 0
            reached = np.concatenate([reached, far[more]])
            steps = np.concatenate([steps, steps[more] + (1 << k)])
        live = self.letter[reached] > 0
        reached, steps = reached[live], steps[live]
        owner = np.searchsorted(self.segments.base, reached, side="right") - 1
        return reached[np.lexsort((steps, owner))]


def _changes(column: pa.Array) -> np.ndarray:
    """Where the values differ from those before them; nulls are equal."""
    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.diff(codes)) + 1


_CUT = ("part int, at long, initial binary, fault binary, turn array<{turn}>, "
        "role array<string>, digest array<binary>, illegal long, cost array<long>")


def _cut(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Segments of a task's rows.  Those at the edge of a batch may go on, so they carry their
    matrix of costs; the others are whole conversations."""
    part, at = TaskContext.get().partitionId(), 0
    for whole in batches:
        for first in range(0, whole.num_rows, rows):
            batch = whole.slice(first, rows)
            conversation = batch.column("conversation")
            starts = np.concatenate([[0], _changes(conversation), [batch.num_rows]])
            starts = np.unique(starts).astype(np.int64)
            initial = batch.column("initial").to_numpy().astype(np.uint8)
            fault = batch.column("fault").to_numpy().astype(np.uint8)
            segments = Segments(initial.astype(np.int64), fault.astype(np.int64), starts)
            n = len(segments.lengths)
            edge = np.unique([0, n - 1])
            cost = [None] * n
            for s, matrix in zip(edge, segments.matrices(edge)):
                cost[s] = matrix.ravel().tolist()
            pairs = ~_legal(initial[:-1], initial[1:])
            pairs[starts[1:-1] - 1] = False
            before = np.concatenate([[0], np.cumsum(pairs), [pairs.sum()]])
            illegal = before[starts[1:] - 1] - before[starts[:-1]]
            offsets = pa.array(starts, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, batch.column(c))
                     for c in ("turn", "role", "digest")]
            bounds = list(zip(starts[:-1], starts[1:]))
            yield pa.RecordBatch.from_arrays(
                [conversation.take(pa.array(starts[:-1])), pa.array(np.full(n, part, np.int32)),
                 pa.array(np.arange(at, at + n)),
                 pa.array([initial[a:b].tobytes() for a, b in bounds], pa.binary()),
                 pa.array([fault[a:b].tobytes() for a, b in bounds], pa.binary()), *lists,
                 pa.array(illegal, pa.int64()), pa.array(cost, pa.list_(pa.int64()))],
                ["conversation", "part", "at", "initial", "fault", "turn", "role", "digest",
                 "illegal", "cost"])
            at += n


def _legal(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether turns with these initials (s 0, u 1, a 2, others 3) may follow one another."""
    return (second == 1) & ((first == 0) | (first == 2)) | (first == 1) & (second == 2)


def _read(batch: pa.RecordBatch) -> Segments:
    initial = batch.column("initial").to_pylist()
    starts = np.concatenate([[0], np.cumsum([len(b) for b in initial])]).astype(np.int64)
    join = [np.frombuffer(b"".join(x), np.uint8).astype(np.int64)
            for x in (initial, batch.column("fault").to_pylist())]
    return Segments(*join, starts)


def _ends(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Costs after each segment, and whether its conversation ends with it."""
    told = batch.column("after").to_pylist()
    end = end_costs()
    return (np.array([end if t is None else t for t in told], np.int64).reshape(-1, 4),
            np.array([t is None for t in told], bool))


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        exits = _read(batch).rank(*_ends(batch)).exits()
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("first"),
             pa.array(exits.tolist(), pa.list_(pa.int32()))], ["place", "first", "leads"])


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit, cost and edits of each segment, from the state its conversation enters it in."""
    names = np.array(list(_LETTERS))
    for batch in batches:
        segments = _read(batch)
        paths = segments.rank(*_ends(batch))
        entry = np.array([e or 0 for e in batch.column("entry").to_pylist()], np.int64)
        nodes = paths.nodes(entry)
        letters = paths.letter[nodes]
        owner = np.searchsorted(segments.base, nodes, side="right") - 1
        bounds = np.searchsorted(owner, np.arange(len(entry) + 1)).astype(np.int32)
        text = "".join(names[letters])
        audit = [text[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        row = (nodes - segments.base[owner]) // 4 + segments.starts[owner]
        named = np.where(nodes % 4 == 2, "assistant", "user")
        row = np.minimum(row, max(len(segments.initial) - 1, 0))   # insertions after the end
        turn, role, digest = (batch.column(c).flatten() for c in ("turn", "role", "digest"))
        take = pa.array(row, mask=letters == 2)
        new = pc.if_else(pa.array(letters == 3), role.take(take), pa.array(named))
        edits = pa.StructArray.from_arrays(
            [pa.array(names[letters]), turn.take(take), role.take(take), digest.take(take), new],
            ["edit", "turn", "role", "digest", "new_role"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conversation"), batch.column("place"), batch.column("illegal"),
             pa.array(_own_costs(letters, row, segments.fault, bounds), pa.int64()),
             pa.array(audit, pa.string()), pa.ListArray.from_arrays(pa.array(bounds), edits)],
            ["conversation", "place", "illegal", "cost", "audit", "edits"])


def _own_costs(letters: np.ndarray, row: np.ndarray, fault: np.ndarray,
               bounds: np.ndarray) -> np.ndarray:
    price = np.array([0, COSTS["delete"], COSTS["insert"], 0, COSTS["rerole"]])[letters]
    if len(row):
        price = price + np.where((letters > 2) & (fault[row] == FAULTS["truncated"]),
                                 COSTS["truncated"], 0)
    total = np.concatenate([[0], np.cumsum(price)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Two frames: what was found and done in each conversation, and the repaired turns.

    A conversation's rows stand by turn, a missing one first, then by role and by the hash of
    their text.  Missing roles and texts count as one space.  A row's fault is the first of
    blank (no text), duplicate (role and text were seen earlier) and truncated.  Edits are K
    (keep, 0), R (give the role user or assistant, 1), D (delete, 2; blank and duplicate rows
    must go) and I (insert an empty turn of user or assistant anywhere, 5); truncated rows that
    stay cost 5 more.  The roles' initials must become empty or an optional s and one or more
    ua.  Of the cheapest lists of edits that with the least letters is chosen.

    The first frame has conversation, ``gaps`` (turns missing between the least and the
    largest), ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours whose initials
    are none of su, ua, au), ``cost`` and ``audit`` (the letters of the edits).  The second has
    conversation, ``place`` and ``step`` (their order), ``edit``, ``turn``, ``role`` and
    ``text`` of what is left.  Other columns are left out.  Repeated rows are duplicates, empty
    tables give empty frames.

    Rows travel without their texts, as hashes.  They are sorted into ranges, so a conversation
    of any length is cut into segments of at most ``segment`` rows.  Costs after a segment are
    found by doubling matrices of costs over the segments that follow, the state it is entered
    in by doubling what the segments before it lead to; both concern only conversations at the
    edge of a batch.  Within a segment, ranks by doubled audit lengths give the path.
    """
    said = rows.select(
        ref(conversation).alias("conversation"), ref(turn).alias("turn"),
        F.coalesce(ref(role), F.lit(" ")).alias("role"),
        F.coalesce(ref(text), F.lit(" ")).alias("text")).withColumn(
        "digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    keys = ["conversation", "turn", "role", "digest"]
    # equal rows are counted before they are dealt out; all but the first are duplicates
    kinds = materialize(said.groupBy(*keys, faults(F.col("text")).alias("fault")).agg(
        F.count("*").alias("n")), "turns")
    seen = kinds.where(F.col("fault") != FAULTS["blank"]).groupBy(
        "conversation", "role", "digest").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("earliest"),
        F.count("*").alias("places")).where("places > 1").select(
        F.col("conversation").alias("__conversation"), F.col("role").alias("__role"),
        F.col("digest").alias("__digest"), "earliest")
    kinds = kinds.join(seen, F.col("conversation").eqNullSafe(F.col("__conversation"))
                       & (F.col("role") == F.col("__role"))
                       & (F.col("digest") == F.col("__digest")), "left")
    later = F.col("earliest").isNotNull() & (
        F.struct(F.col("turn").isNotNull().alias("has"), "turn") > F.col("earliest"))
    kinds = materialize(kinds.select(*keys, "fault", "n", later.alias("later")), "turns")
    again = (F.col("fault") != FAULTS["blank"]) & (F.col("later") | (F.col("copy") > 1))
    initial = F.substring("role", 1, 1)
    slim = kinds.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select(
        *keys, "copy", F.when(again, FAULTS["duplicate"]).otherwise(F.col("fault")).alias("fault"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
        .alias("initial"))
    fields = dict(slim.dtypes)
    told = f"conversation {fields['conversation']}, "
    pieces = materialize(in_order(slim, "conversation", "turn", "role", "digest", "copy").mapInArrow(
        lambda batches: _cut(batches, segment), told + _CUT.format(turn=fields["turn"])), "segments")
    pieces = add_places(pieces, "part", "at")

    border = pieces.where("cost is not null")
    spans = border.groupBy("conversation").agg(
        F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    spans = spans.withColumnRenamed("conversation", "__conversation")
    linked = materialize(border.join(spans, F.col("conversation").eqNullSafe(
        F.col("__conversation"))).drop("__conversation"), "linked")
    linked = _costs_after(linked)
    entries = _entries(linked)
    more = linked.select(F.col("place").alias("__place"), "after", "between").join(
        entries.withColumnRenamed("place", "__entered"),
        F.col("__place") == F.col("__entered"), "left").drop("__entered")
    done = pieces.drop("cost").join(more, F.col("place") == F.col("__place"), "left").withColumn(
        "illegal", F.col("illegal") + F.coalesce("between", F.lit(0)))
    done = materialize(done.select(
        "conversation", "place", "illegal", "initial", "fault", "turn", "role", "digest", "after",
        "entry").mapInArrow(_audit, told + (
            "place long, illegal long, cost long, audit string, edits array<struct<edit string, "
            f"turn {fields['turn']}, role string, digest binary, new_role string>>")), "audits")

    counts = kinds.groupBy("conversation").agg(
        F.min("turn").alias("least"), F.max("turn").alias("most"),
        F.count_distinct("turn").alias("turns"),
        *[_faulty(name).alias(name) for name in FAULTS])
    summary = done.groupBy(F.col("conversation").alias("__conversation")).agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "audit"))),
                                 lambda x: x["audit"]), "").alias("audit"))
    found = counts.join(summary, F.col("conversation").eqNullSafe(F.col("__conversation"))).select(
        F.col("conversation").alias(conversation),
        F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long")
        .alias("gaps"), *FAULTS, "illegal", "cost", "audit")

    edits = done.select("conversation", "place", F.posexplode("edits").alias("step", "e")).where(
        "e.edit <> 'D'").select("conversation", "place", "step", "e.*")
    texts = said.groupBy(*keys).agg(F.first("text").alias("text")).select(
        *[F.col(k).alias(f"__{k}") for k in keys], "text")
    repaired = edits.join(texts, F.col("conversation").eqNullSafe(F.col("__conversation"))
                          & F.col("turn").eqNullSafe(F.col("__turn"))
                          & (F.col("role") == F.col("__role"))
                          & (F.col("digest") == F.col("__digest")), "left").select(
        F.col("conversation").alias(conversation), "place", "step", "edit", "turn",
        F.col("new_role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return found, repaired


def _faulty(name: str) -> Column:
    """Rows with a fault, from the counted kinds of rows."""
    fault, n, later = F.col("fault"), F.col("n"), F.col("later")
    if name == "blank":
        return F.sum(F.when(fault == FAULTS["blank"], n).otherwise(0))
    clean = fault != FAULTS["blank"]
    if name == "duplicate":
        return F.sum(F.when(clean, F.when(later, n).otherwise(n - 1)).otherwise(0))
    return F.sum(F.when((fault == FAULTS["truncated"]) & ~later, 1).otherwise(0)).cast("long")


def _rounds(spans: DataFrame) -> int:
    most = spans.agg(F.max(F.col("last") - F.col("first"))).first()[0]
    return int(most or 0).bit_length()


def _costs_after(linked: DataFrame) -> DataFrame:
    """``linked`` with ``after`` (costs of each state after a segment, null for the last) and
    ``between`` (1 if the pair of rows between it and the next may not stand)."""
    far = materialize(linked.select("place", "last", "cost"), "matrices")
    for k in range(_rounds(linked)):
        other = far.select((F.col("place") - (1 << k)).alias("__place"),
                           F.col("cost").alias("__cost"), F.col("last").alias("__last"))
        joined = far.join(other, (F.col("place") == F.col("__place"))
                          & (F.col("last") == F.col("__last")), "left")
        product = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.least(
            F.lit(_FAR), F.array_min(F.transform(
                F.sequence(F.lit(0), F.lit(3)),
                lambda j: F.get("cost", i - i % 4 + j) + F.get("__cost", j * 4 + i % 4)))))
        far = materialize(joined.select("place", "last", F.when(
            F.col("__cost").isNull(), F.col("cost")).otherwise(product).alias("cost")), "matrices")
    end = F.array(*[F.lit(int(c)) for c in end_costs()])
    start = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.array_min(F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda r: F.get("cost", q * 4 + r) + F.get(end, r))))
    following = far.select((F.col("place") - 1).alias("__place"), F.col("last").alias("__last"),
                           start.cast("array<long>").alias("after"))
    heads = linked.select((F.col("place") - 1).alias("__place"), F.col("last").alias("__last"),
                          F.substring("initial", 1, 1).alias("head"))
    following = following.join(heads, ["__place", "__last"])
    tail = F.hex(F.substring("initial", -1, 1))
    pair = F.concat(tail, F.hex("head"))
    return materialize(linked.drop("cost").join(
        following, (F.col("place") == F.col("__place")) & (F.col("last") == F.col("__last")),
        "left").withColumn("between", F.when(F.col("head").isNull()
                                             | pair.isin("0001", "0102", "0201"), 0).otherwise(1))
        .drop("__place", "__last", "head"), "after")


def _entries(linked: DataFrame) -> DataFrame:
    """``place`` and ``entry``, the state in which the least path enters a segment."""
    leads = materialize(linked.select("place", "first", "initial", "fault", "after").mapInArrow(
        _exits, "place long, first long, leads array<int>"), "leads")
    for k in range(_rounds(linked)):
        other = leads.select((F.col("place") + (1 << k)).alias("__place"),
                             F.col("leads").alias("__leads"), F.col("first").alias("__first"))
        joined = leads.join(other, (F.col("place") == F.col("__place"))
                            & (F.col("first") == F.col("__first")), "left")
        leads = materialize(joined.select("place", "first", F.when(
            F.col("__leads").isNull(), F.col("leads")).otherwise(F.transform(
                "__leads", lambda q: F.get("leads", q))).alias("leads")), "leads")
    ends = leads.select((F.col("place") + 1).alias("__place"), F.col("first").alias("__first"),
                        F.get("leads", F.lit(0)).alias("entry"))
    return linked.select("place", "first").join(
        ends, (F.col("place") == F.col("__place")) & (F.col("first") == F.col("__first"))).select(
        "place", "entry")


def ordered_sha256(rows: DataFrame, key: str, order: list[str], line: Column) -> DataFrame:
    """``key`` and ``sha256`` of its lines, joined by line feeds, in ``order``.

    A hash runs through its lines one by one, so a key's rows are read by one task in sorted
    order; it holds one batch of them and one open hash.
    """
    kind = rows.schema[key].dataType.simpleString()
    ordered = rows.select(ref(key).alias("key"), *order, line.alias("line")).repartition(
        "key").sortWithinPartitions("key", *order).select("key", "line")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            keys, hashes = [], []
            for own, text in zip(batch.column("key").to_pylist(), batch.column("line").to_pylist()):
                if running is None or own != key:
                    if running is not None:
                        keys.append(key)
                        hashes.append(running.hexdigest())
                    key, running = own, hashlib.sha256(text.encode())
                else:
                    running.update(b"\n" + text.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field("key").type), pa.array(hashes, pa.string())],
                ["key", "sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], batch.schema.field("key").type),
                 pa.array([running.hexdigest()], pa.string())], ["key", "sha256"])
    return ordered.mapInArrow(digest, f"key {kind}, sha256 string").withColumnRenamed("key", key)
