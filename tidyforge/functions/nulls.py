"""One notion of "missing": NULL.  NaN becomes NULL where data enters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import FLOATING, ref, replace_columns

# The texts a CSV reader of the pandas family takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def nan_as_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column; other columns stay untouched."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, FLOATING)]
    return replace_columns(df, {c: nan_as_null(ref(c)) for c in floats})


def missing(df: DataFrame, name: str) -> Column:
    """True where the column is NULL or NaN."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return ref(name).isNull() | F.isnan(ref(name))
    return ref(name).isNull()


def token_as_null(value: Column, tokens: list[str] | None = None) -> Column:
    """NULL where a text cell is one of the missing-value tokens."""
    return F.when(~value.isin(NA_TOKENS if tokens is None else tokens), value)


def double_or_null(value: Column, data_type: T.DataType) -> Column:
    """The value as double, with NaN as NULL."""
    if isinstance(data_type, FLOATING):
        return nan_as_null(value.cast("double"))
    return value.cast("double")
