"""Column names and type families."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)


def quoted(name: str) -> str:
    """Back-ticked name, safe for dots, blanks and brackets."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    return F.col(quoted(name))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The listed columns that exist, in the listed order, each once."""
    have = set(df.columns)
    return [c for c in dict.fromkeys(columns) if c in have]


def is_number(df: DataFrame, name: str) -> bool:
    """Number or boolean, the types that arithmetic features accept."""
    return name in df.columns and isinstance(
        df.schema[name].dataType, (T.NumericType, T.BooleanType))


def orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(orderable(f.dataType) for f in data_type)
    if isinstance(data_type, T.ArrayType):
        return orderable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def replace_columns(df: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """One projection that swaps or appends the given columns, keeping order."""
    return df.withColumns(changed) if changed else df


def missing_free(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.when(~F.isnan(ref(name)), ref(name))
    return ref(name)
