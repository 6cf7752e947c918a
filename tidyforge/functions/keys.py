"""Join keys in one canonical text form."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import FLOATING, INTEGRAL
from tidyforge.functions.text import as_text, scrub


def canonical_key(value: Column, data_type: T.DataType, scrubber=scrub) -> Column:
    """Text key where ``123``, ``123.0`` and ``" 123 "`` are the same.

    Missing keys stay NULL.  Integer keys need neither scrubbing nor regex work.
    """
    if isinstance(data_type, INTEGRAL):
        return value.cast("string")
    text = as_text(value, data_type)
    if scrubber is not None and isinstance(data_type, (T.StringType, T.BinaryType)):
        text = scrubber(text)
    text = F.regexp_replace(text, r"\.0$", "")
    if not isinstance(data_type, FLOATING):
        return text
    whole = value.cast("bigint").cast("string")
    return F.when((F.abs(value) < 1e16) & (value == F.floor(value)), whole).otherwise(text)


def equals_value(value: Column, data_type: T.DataType, wanted: object,
                 clean=lambda text: text) -> Column:
    """``column == wanted`` on trimmed text, as a plain comparison where types allow.

    A comparison on the stored type can be pushed into the file scan, one on
    ``trim(cast(...))`` cannot.  ``clean`` is applied to the wanted text, so that a
    column cleaned beforehand is compared with an equally cleaned value.
    """
    text = str(wanted).strip()
    if isinstance(data_type, INTEGRAL):
        whole = re.sub(r"\.0$", "", text)
        return value == F.lit(int(whole)) if re.fullmatch(r"-?\d{1,18}", whole) else F.lit(False)
    if isinstance(data_type, T.NumericType):
        return value == F.lit(text).try_cast("double")
    if isinstance(data_type, T.BooleanType):
        return value.cast("string") == text.lower()
    exact = F.trim(as_text(value, data_type)) == F.trim(clean(F.lit(text)))
    if isinstance(data_type, T.StringType) and text:
        # A cell that equals the text contains it, which the file scan can test.
        return value.contains(F.trim(clean(F.lit(text)))) & exact
    return exact
