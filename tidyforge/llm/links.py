"""Connected components of links between documents, as joins and aggregates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyforge.session import materialize


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Inner or left join on one column that may have a hot value on the left.

    The null-safe form has exchanges of its own on both sides, also next to an aggregate on
    the same column, and so adaptive execution can split the hot value.
    """
    other = right.withColumnRenamed(key, "__key")
    return left.join(other, F.col(key).eqNullSafe(F.col("__key")), how).drop("__key")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that its links reach.

    ``links`` has two whole-number columns, ``a`` and ``b``; loops, repeats and both
    directions are allowed, missing ends are ignored.  Nodes without a link are not in the
    result.  Each round hangs every node under its smallest known neighbour (large star, then
    small star) until nothing changes.  A round is aggregates and joins on the node, so a hub
    with very many links is combined before the shuffle and split by the join; each round is
    written to the shared folder, which cuts the lineage.
    """
    edges = materialize(_straight(links.select("a", "b")), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = split_join(both, lowest, "a").where("b > a").select(F.col("m").alias("a"), "b")
        hub = large.groupBy("b").agg(F.min("a").alias("m"))
        small = split_join(large, hub, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
        edges = materialize(_straight(small.unionByName(
            hub.select(F.col("m").alias("a"), "b"))), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _straight(links: DataFrame) -> DataFrame:
    return (links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a < b").distinct())


def _state(edges: DataFrame):
    return tuple(edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                 .first())


class Forest:
    """Union-find over the numbers 0 to n - 1 within a task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def join(self, pairs) -> None:
        for i, j in pairs:
            i, j = self.root(int(i)), self.root(int(j))
            if i != j:
                self.parent[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        """Root of each number, the smallest of its tree."""
        up = self.parent
        while True:
            higher = up[up]
            if (higher == up).all():
                self.parent = up
                return up
            up = higher


def labels_between(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of a two-sided graph given as a boolean matrix.

    Rows are numbered from 0, columns after them; each gets the smallest number it reaches.
    """
    rows, columns = linked.shape
    up, across = np.arange(rows), np.arange(columns) + rows
    last = rows + columns
    touched = np.flatnonzero(linked.any(axis=1))
    while len(touched):
        before = up.copy(), across.copy()
        part = linked[touched]
        across = np.minimum(across, np.where(part, up[touched][:, None], last).min(axis=0))
        up[touched] = np.minimum(up[touched], np.where(part, across[None, :], last).min(axis=1))
        if (up == before[0]).all() and (across == before[1]).all():
            break
    return up, across
