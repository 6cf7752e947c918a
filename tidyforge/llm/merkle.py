"""A Merkle manifest of a table: one root, and a proof of every row against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyforge.llm.links import split_join
from tidyforge.llm.places import numbered
from tidyforge.session import materialize

FANOUT = 2
SUBTREE = 1024               # most nodes of a level that proofs gather in one row


def leaf_hash(columns: Sequence[Column]) -> Column:
    """Lower-case hex SHA-256 over the columns' texts.

    A missing value is written as ``-``, any other as its number of UTF-8 bytes, a colon and
    itself, so no two rows are written alike.
    """
    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                          F.lit("-"))
    return F.sha2(F.concat(*[written(c) for c in columns]).cast("binary"), 256)


def _parent(digests: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*digests).cast("binary"), 256)


def build_levels(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """All levels of the trees over ``leaves``, from the leaves up.

    ``leaves`` has ``tree``, ``pos`` (from 0, gapless within a tree), ``n`` (leaves of the
    tree) and ``digest``.  A level joins its nodes to those at the computed indices of their
    siblings, ``pos`` XOR 1 in binary trees and the slots after their own otherwise; the row in
    slot 0 of a run emits the hash of the run, be it a whole one or not.  A tree's single node
    is its root and is not in higher levels.  Keys are (tree, pos), so a tree that holds most
    rows is dealt like any other.  Each level is a written table.
    """
    levels = [leaves]
    while levels[-1].where("n > 1").limit(1).count():
        nodes = levels[-1].where("n > 1")
        run = nodes.where(F.col("pos") % fanout == 0)
        for slot in range(1, fanout):
            there = F.col("pos").bitwiseXOR(F.lit(1)) if fanout == 2 else F.col("pos") + slot
            siblings = nodes.select(F.col("tree").alias("__tree"), F.col("pos").alias("__pos"),
                                    F.col("digest").alias(f"__{slot}"))
            run = run.join(siblings, (F.col("tree") == F.col("__tree"))
                           & (there == F.col("__pos")), "left").drop("__tree", "__pos")
        digests = [F.col("digest"), *[F.coalesce(f"__{k}", F.lit("")) for k in range(1, fanout)]]
        levels.append(materialize(run.select(
            "tree", F.floor(F.col("pos") / fanout).alias("pos"),
            F.ceil(F.col("n") / fanout).alias("n"), _parent(digests).alias("digest")), "level"))
    return levels


def roots(levels: Sequence[DataFrame]) -> DataFrame:
    """``tree`` and ``digest`` of each tree's root."""
    out = levels[0].where("n = 1").select("tree", "digest")
    for level in levels[1:]:
        out = out.unionByName(level.where("n = 1").select("tree", "digest"))
    return out


def proofs(levels: Sequence[DataFrame], above: DataFrame | None = None,
           fanout: int = FANOUT, subtree: int = SUBTREE) -> DataFrame:
    """``tree``, ``pos`` and ``path`` of every leaf.

    ``path`` lists for each level, from the leaf up, the texts ``before`` and ``after`` the node
    in its run: the digests of its siblings, empty without any.  ``above`` (tree, path) goes on
    above the roots.  Levels are gathered several at a time, so that a row holds the nodes
    above at most ``subtree`` nodes of the lowest one, from the top down: only the last step
    handles as many rows as there are leaves.
    """
    stride = 1
    while fanout ** (stride + 1) <= subtree:
        stride += 1
    if above is None:
        above = levels[0].select("tree").distinct().withColumn(
            "path", F.array().cast("array<struct<before:string,after:string>>"))
    paths = None
    for low in reversed(range(0, len(levels), stride)):
        paths = _descend(levels[low:low + stride], paths, above, fanout, stride)
        if low:
            paths = materialize(paths, "paths")
    return paths


def _descend(levels: Sequence[DataFrame], higher: DataFrame | None, above: DataFrame,
             fanout: int, stride: int) -> DataFrame:
    """Paths of the nodes of the lowest of ``levels``, from those of the nodes above all."""
    nodes = None
    for k, level in enumerate(levels):
        part = level.select(
            "tree", F.floor(F.col("pos") / fanout ** (stride - k)).alias("__sub"),
            F.lit(k).alias("level"), "pos", "digest", "n")
        nodes = part if nodes is None else nodes.unionByName(part)
    rows = nodes.groupBy("tree", "__sub").agg(
        F.sort_array(F.collect_list(F.struct("level", "pos", "digest"))).alias("nodes"),
        F.max(F.when(F.col("level") == 0, F.col("n"))).alias("n"))
    rows = rows.withColumn("digests", F.transform("nodes", lambda x: x["digest"]))
    rows = rows.withColumn("low", F.filter("nodes", lambda x: x["level"] == 0))
    # trees whose root is among these levels end here; the others go on from a higher step
    ends = above.select(F.col("tree").alias("__tree"), F.col("path").alias("__end"))
    top = rows.where(F.col("n") <= fanout ** stride).join(
        ends, F.col("tree") == F.col("__tree"))
    kept = [F.col(c) for c in ("tree", "__sub", "n", "digests", "low")]
    top = top.select(*kept, F.col("__end").alias("path"))
    if higher is not None:
        up = higher.select(F.col("tree").alias("__tree"), F.col("pos").alias("__pos"),
                           F.col("path").alias("__up"))
        inner = rows.where(F.col("n") > fanout ** stride).join(
            up, (F.col("tree") == F.col("__tree")) & (F.col("__sub") == F.col("__pos")))
        top = top.unionByName(inner.select(*kept, F.col("__up").alias("path")))
    # Level k of a subtree with `own` lowest nodes has ceil(own / fanout^k) nodes; its nodes
    # stand in `digests` after those of the levels below.
    own_nodes = F.size("low")

    def path(j: Column) -> Column:
        entries, start = [], F.lit(0)
        for k in range(stride):
            own = F.ceil(own_nodes / fanout ** k).cast("int")
            at = F.floor(j / fanout ** k).cast("int")
            first = at - at % fanout
            last = F.least(first + fanout, own)
            entries.append(F.when(F.ceil(F.col("n") / fanout ** k) > 1, F.struct(
                F.array_join(F.slice("digests", start + first + 1, at - first), "")
                .alias("before"),
                F.array_join(F.slice("digests", start + at + 2, last - at - 1), "")
                .alias("after"))))
            start = start + own
        return F.concat(F.filter(F.array(*entries), lambda x: x.isNotNull()), F.col("path"))

    each = F.transform("low", lambda x, j: F.struct(x["pos"].alias("pos"), path(j).alias("path")))
    return top.select("tree", F.explode(each).alias("node")).select("tree", "node.pos", "node.path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(
        F.concat(step["before"], digest, step["after"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 over all siblings of a path, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.transform(
        path, lambda step: F.concat(step["before"], step["after"])), "").cast("binary"), 256)


def manifest(rows: DataFrame, group: str, order: Sequence[str], columns: Sequence[str],
             claims: Sequence[Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """A leaf for every row, a tree for each value of ``group``, and a tree over their roots.

    Leaves hash ``columns`` and stand in the ``order`` of their group, missing values first,
    equal ones by their hash; groups stand in byte order, the missing one first.  ``claims``
    are the columns as somebody else holds them: they are hashed again and folded with the
    proofs of the original rows.

    Returns the columns of ``order`` and ``group``, ``leaf``, ``subroot``, ``root``, ``path``,
    ``claim`` (hash of the claim) and ``folded`` (the root the claim leads to).  Repeated rows
    are leaves of their own; an empty table gives an empty result.
    """
    kept = list(dict.fromkeys([*order, group]))
    hashed = rows.select(
        *[F.col(c).alias(f"key_{i}") for i, c in enumerate(kept)],
        leaf_hash([F.col(c) for c in columns]).alias("leaf"),
        (leaf_hash(claims) if claims else F.lit(None).cast("string")).alias("claim"))
    hashed = materialize(hashed, "leaves")       # texts are read and hashed once
    at = {c: f"key_{i}" for i, c in enumerate(kept)}
    # equal rows may stand in any order; a number keeps very many of them from one task
    ordered = numbered(hashed.withColumn("tie", F.monotonically_increasing_id()),
                       at[group], *[at[c] for c in order], "leaf", "claim", "tie")
    spans = ordered.groupBy(at[group]).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    trees = numbered(spans, at[group], place="tree")
    leaves = materialize(split_join(ordered, trees, at[group]).select(
        "tree", (F.col("place") - F.col("first")).alias("pos"), "n",
        F.col("leaf").alias("digest"), "claim", *at.values()), "leaves")

    lower = build_levels(leaves.select("tree", "pos", "n", "digest"), fanout)
    subroots = materialize(roots(lower), "subroots")
    n_trees = subroots.count()
    # a written table, since Spark would drop the constant tree from the joins' conditions
    upper = build_levels(materialize(subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"),
        F.lit(n_trees).cast("long").alias("n"), "digest"), "subroots"), fanout)
    tops = proofs(upper, None, fanout).select(F.col("pos").alias("tree"), "path")
    tops = materialize(tops, "tops")
    root = [r["digest"] for r in roots(upper).collect()]
    paths = proofs(lower, tops, fanout).select(
        F.col("tree").alias("__tree"), F.col("pos").alias("__pos"), "path")
    whole = leaves.join(paths, (F.col("tree") == F.col("__tree"))
                        & (F.col("pos") == F.col("__pos")))
    own = subroots.select(F.col("tree").alias("__own"), F.col("digest").alias("subroot"))
    whole = whole.join(own, F.col("tree") == F.col("__own"))
    return whole.select(
        *[F.col(a).alias(c) for c, a in at.items()], F.col("digest").alias("leaf"), "subroot",
        F.lit(root[0] if root else None).cast("string").alias("root"), "path", "claim",
        fold(F.coalesce("claim", "digest"), F.col("path")).alias("folded"))
