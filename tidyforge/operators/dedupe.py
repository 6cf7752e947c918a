"""Duplicate removal with a stated keep rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyforge.functions.names import orderable, ref


def ordering(df: DataFrame, order_by: list[str] | None, ascending: bool = True,
             reverse: bool = False, skip: list[str] = ()) -> list[Column]:
    """Sort columns with missing values last, ties broken by all other columns.

    ``reverse`` turns the whole order round, missing values included, so that the
    last row of the order comes first.
    """
    order_by = order_by or []
    rest = [f.name for f in df.schema
            if f.name not in order_by and f.name not in skip and orderable(f.dataType)]
    keys = []
    for name in order_by:
        if reverse:
            keys.append(ref(name).desc_nulls_first() if ascending else ref(name).asc_nulls_first())
        else:
            keys.append(ref(name).asc_nulls_last() if ascending else ref(name).desc_nulls_last())
    for name in rest:
        keys.append(ref(name).desc_nulls_first() if reverse else ref(name).asc_nulls_last())
    return keys


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key.

    Spark limits each key to one row per input task before the shuffle, so a key
    that holds a large share of all rows reaches its task already reduced.
    """
    number = "__row_in_key"
    order = order or [F.lit(0)]
    window = Window.partitionBy(*map(ref, keys)).orderBy(*order)
    return (df.withColumn(number, F.row_number().over(window))
            .where(F.col(number) == 1).drop(number))


def deduplicate(df: DataFrame, subset: list[str] | None = None, keep: str | bool = "first",
                sort_by: list[str] | str | None = None, sort_ascending: bool = True) -> DataFrame:
    """Keep the first, the last or none (``keep=False``) of each group of duplicates.

    Missing values equal each other.  Without ``subset`` whole rows are compared.
    """
    if keep not in ("first", "last", False):
        raise ValueError(f"keep must be 'first', 'last' or False, not {keep!r}")
    sort_by = [sort_by] if isinstance(sort_by, str) else list(sort_by or [])
    subset = [subset] if isinstance(subset, str) else subset
    unknown = [c for c in [*(subset or []), *sort_by] if c not in df.columns]
    if unknown:
        raise KeyError(f"columns not found: {unknown}")
    if keep is False:
        return _unique_rows(df, subset)
    if not subset:
        return df.dropDuplicates()
    order = ordering(df, sort_by, sort_ascending, reverse=keep == "last", skip=subset)
    return first_per_key(df, subset, order)


def _unique_rows(df: DataFrame, subset: list[str] | None) -> DataFrame:
    """Rows whose key occurs once: a pre-aggregated count that carries the row along."""
    keys = subset or df.columns
    rest = {c: f"__rest_{i}" for i, c in enumerate(df.columns) if c not in keys}
    # Of a group that is kept, any value is the value; columns carried one by one leave
    # fixed-width rows to the hash aggregate.
    carried = [F.any_value(ref(c)).alias(name) for c, name in rest.items()]
    counted = df.groupBy(*map(ref, keys)).agg(F.count(F.lit(1)).alias("__rows"), *carried)
    return counted.where(F.col("__rows") == 1).select(
        *[F.col(rest[c]).alias(c) if c in rest else ref(c) for c in df.columns])


def sort_rows(df: DataFrame, by: list[str], ascending: bool = True) -> DataFrame:
    """Sort with missing values last in both directions."""
    return df.orderBy(*[ref(c).asc_nulls_last() if ascending else ref(c).desc_nulls_last()
                        for c in by])
