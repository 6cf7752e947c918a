"""Gapless numbers of rows in a sorted order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyforge.session import materialize

PART, AT = "__task_of_row", "__place_in_task"


def numbered(df: DataFrame, *keys: Column | str, place: str = "place") -> DataFrame:
    """The rows with their number from 0 in the order of ``keys``, as a written table.

    Rows are dealt to ranges of the keys and sorted within, so no task has more than a range;
    rows that are equal in all keys come to one task.
    """
    return number_tasks(df.repartitionByRange(*keys).sortWithinPartitions(*keys), place)


def number_tasks(df: DataFrame, place: str = "place") -> DataFrame:
    """The rows numbered from 0 as they stand, task after task, as a written table.

    What the driver holds is one count for each task.
    """
    return _after_earlier_tasks(_with_task(df), F.count("*"), F.col(AT), place)


def sums_before(df: DataFrame, keys: list[str], amount: str, output: str = "before") -> DataFrame:
    """For each row the sum of ``amount`` over all rows before it in the order of ``keys``.

    Sums within a range of the keys and sums of whole ranges; of the latter the driver holds
    one for each task.
    """
    table = _with_task(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    earlier = Window.partitionBy(PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(amount).over(earlier), F.lit(0))
    return _after_earlier_tasks(table, F.sum(amount), inside, output)


def _with_task(df: DataFrame) -> DataFrame:
    """A written table of the rows with the number of their task and theirs within it."""
    return materialize(df.select("*", F.spark_partition_id().alias(PART), F.monotonically_increasing_id()
                                 .bitwiseAND(F.lit((1 << 33) - 1)).alias(AT)), "numbered")


def _after_earlier_tasks(table: DataFrame, total: Column, inside: Column, output: str) -> DataFrame:
    totals = {r[0]: r[1] for r in table.groupBy(PART).agg(total).collect()}
    starts, seen = [], 0
    for task in sorted(totals):
        starts.append((task, seen))
        seen += totals[task]
    offsets = table.sparkSession.createDataFrame(starts, "__task int, __start long")
    return table.withColumn(output, inside).join(offsets, F.col(PART) == F.col("__task")).withColumn(
        output, F.col("__start") + F.col(output)).drop(PART, AT, "__task", "__start")
