"""User functions over cells and rows.

A function without a declared return type must work on Columns and stays in the JVM.
With a return type it is an ordinary Python function; it then runs on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyforge.functions.names import present, ref, replace_columns


def _as_column(func: Callable, argument) -> Column:
    result = func(argument)
    if not isinstance(result, Column):
        raise TypeError("a function without a declared return type must return a Column")
    return result


def cell_function(func: Callable, returns: str | None = None) -> Callable[[Column], Column]:
    """Column function from a user function of one cell."""
    if returns is None:
        return lambda value: _as_column(func, value)

    @F.pandas_udf(returns)
    def per_batch(cells: pd.Series) -> pd.Series:
        return cells.map(func)

    return per_batch


def row_function(df: DataFrame, func: Callable, returns: str | None = None,
                 columns: list[str] | None = None) -> Column:
    """Column from a user function of one row, or of a name-to-Column mapping.

    ``columns`` limits what is shipped to Python; by default the whole row is.
    """
    names = list(df.columns) if columns is None else present(df, columns)
    if returns is None:
        return _as_column(func, {c: ref(c) for c in names})

    @F.pandas_udf(returns)
    def per_batch(rows: pd.DataFrame) -> pd.Series:
        return rows.apply(func, axis=1) if len(rows) else pd.Series([], dtype=object)

    return per_batch(F.struct(*[ref(c) for c in names]))


def apply_custom_function(df: DataFrame, columns: list[str], func: Callable,
                          returns: str | None = None) -> DataFrame:
    """Replace cells of the listed columns by the function's result; absent ones skipped."""
    apply = cell_function(func, returns)
    return replace_columns(df, {c: apply(ref(c)) for c in present(df, columns)})
