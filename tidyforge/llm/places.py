"""Gapless numbers of rows in a sorted order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyforge.session import materialize


def in_order(df: DataFrame, *keys: Column | str) -> DataFrame:
    """``df`` dealt to ranges of ``keys``, each range sorted.

    Rows that are equal in all keys come to one task, so keys should tell rows apart.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def numbered(df: DataFrame, *keys: Column | str, place: str = "place") -> DataFrame:
    """The rows with their number from 0 in the order of ``keys``, as a written table."""
    marked = in_order(df, *keys).select(
        "*", F.spark_partition_id().alias("__part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"))
    return add_places(materialize(marked, "ordered"), "__part", "__at", place)


def add_places(table: DataFrame, part: str, at: str, place: str = "place") -> DataFrame:
    """Number rows from their task and their number within it, both of which are dropped.

    What the driver holds is one count for each task that wrote the table.
    """
    counts = {r[0]: r[1] for r in table.groupBy(part).count().collect()}
    starts, seen = [], 0
    for task in sorted(counts):
        starts.append((task, seen))
        seen += counts[task]
    offsets = table.sparkSession.createDataFrame(starts, "__task int, __start long")
    return table.join(offsets, F.col(part) == F.col("__task")).withColumn(
        place, F.col("__start") + F.col(at)).drop(part, at, "__task", "__start")
