"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import FLOATING, INTEGRAL
from tidyforge.functions.nulls import nan_as_null
from tidyforge.functions.text import strip

# The shape of a number.  The JVM would also take `5d` or `0x1p3`.
NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf(inity)?))$"

# Dtype names of the pandas family and their Spark types.
DTYPES = {
    "int": "bigint", "int64": "bigint", "Int64": "bigint", "int32": "int", "Int32": "int",
    "int16": "smallint", "int8": "tinyint", "float": "double", "float64": "double",
    "Float64": "double", "float32": "float", "str": "string", "string": "string",
    "object": "string", "category": "string", "bool": "boolean", "boolean": "boolean",
    "datetime64[ns]": "timestamp",
}


def to_number(value: Column, data_type: T.DataType) -> Column:
    """Text to double; text that is no number becomes NULL.  Numbers pass through."""
    if isinstance(data_type, FLOATING):
        return nan_as_null(value)
    if isinstance(data_type, T.NumericType):
        return value
    if isinstance(data_type, T.BooleanType):
        return value.cast("int")
    return F.regexp_substr(strip(value.cast("string")), F.lit(NUMBER)).try_cast("double")


def number_type(data_type: T.DataType) -> T.DataType:
    """Result type of :func:`to_number`."""
    if isinstance(data_type, T.NumericType):
        return data_type
    return T.IntegerType() if isinstance(data_type, T.BooleanType) else T.DoubleType()


def spark_type(dtype: str) -> str:
    return DTYPES.get(dtype, dtype)


def round_half_even(value: Column, data_type: T.DataType, decimals: int) -> Column:
    """Round half to even, by scaling as array libraries do."""
    if isinstance(data_type, FLOATING):
        factor = F.lit(float(10 ** abs(decimals)))
        if decimals < 0:
            return F.rint(value / factor) * factor
        return F.rint(value * factor) / factor
    if isinstance(data_type, INTEGRAL) and decimals >= 0:
        return value
    return F.bround(value, decimals).cast(data_type)


def log1p_or_null(value: Column) -> Column:
    """ln(1 + x); NULL for x <= -1."""
    return F.when(value > -1, F.log1p(value))


def threshold_flag(value: Column, threshold: float) -> Column:
    """1 above the threshold, else 0; missing gives 0."""
    return F.when(value > F.lit(threshold), 1).otherwise(0)
