"""Row counts per stage.

``DataFrame.observe`` would count for free, but in Spark 4.1 a session that has used an
``Observation`` can no longer ship models with a training summary to its tasks, which
is the very next thing a user of prepared data does.  The counts are plain aggregates
instead: lazy, in one query, and reading no columns but those that decide the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "stage string, metric string, value bigint"


class StageReport:
    """Collects counters of named stages; nothing runs before the report is read."""

    def __init__(self):
        self._counts: list[DataFrame] = []
        self._notes: list[tuple[str, str, int]] = []

    def watch(self, df: DataFrame, stage: str, **metrics: Column) -> DataFrame:
        """Report the rows of ``df`` and further aggregates; returns ``df`` unchanged."""
        parts = {"rows": F.count(F.lit(1)), **metrics}
        wide = df.agg(*[value.cast("bigint").alias(name) for name, value in parts.items()])
        self._counts.append(wide.unpivot([], list(parts), "metric", "value")
                            .select(F.lit(stage).alias("stage"), "metric", "value"))
        return df

    def note(self, stage: str, metric: str, value: int) -> None:
        """Report a value that is already known."""
        self._notes.append((stage, metric, value))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The report as ``(stage, metric, value)``."""
        parts = list(self._counts)
        if self._notes or not parts:
            parts.append(spark.createDataFrame(self._notes, SCHEMA))
        return reduce(DataFrame.unionByName, parts)
