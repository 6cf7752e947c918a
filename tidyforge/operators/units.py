"""Measurements in one canonical unit."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import ref, replace_columns
from tidyforge.functions.numbers import to_number
from tidyforge.functions.text import as_text

log = logging.getLogger(__name__)


def _usable(df: DataFrame, configs: list[dict] | None) -> list[dict]:
    """Rules whose value and unit columns exist; the others are reported and skipped."""
    usable = []
    for rule in configs or []:
        absent = [rule.get(k) for k in ("value_col", "unit_col") if rule.get(k) not in df.columns]
        if absent:
            log.warning("units of %r: columns %s not found, rule skipped", rule["value_col"], absent)
        else:
            usable.append(rule)
    return usable


def _factor(rule: dict, clean: Callable[[Column], Column]) -> Column:
    """Factor for a row's unit label; 1 for the canonical unit, NULL for an unknown one."""
    label = F.trim(ref(rule["unit_col"]))
    result = F.when(label == clean(F.lit(rule["canonical"].strip())), 1.0)
    for unit, factor in rule.get("conversions", {}).items():
        result = result.when(label == clean(F.lit(str(unit).strip())), float(factor))
    return result


def normalize_units(df: DataFrame, configs: list[dict] | None = None,
                    clean: Callable[[Column], Column] = lambda text: text,
                    mark: str | None = None) -> DataFrame:
    """Multiply values of a known other unit by their factor and rewrite the label.

    Labels are compared trimmed.  Unknown and missing labels are left alone; see
    :func:`unconverted_units`.  ``clean`` is applied to the labels of the rules when
    the column itself was cleaned before (lower-cased, say).  Several rules for one
    value column apply in turn.  In a text column only cells that are numbers are converted;
    others, such as ``<5``, and their labels stay, and the column stays text.  ``mark`` is
    the start of the names of added columns that tell, rule by rule, which rows changed.
    """
    for number, rule in enumerate(_usable(df, configs)):
        value, unit = ref(rule["value_col"]), ref(rule["unit_col"])
        factor = _factor(rule, clean)
        known, kind = factor.isNotNull(), df.schema[rule["value_col"]].dataType
        if isinstance(kind, T.StringType):
            read = to_number(value, kind)
            known = known & (read.isNotNull() | value.isNull())
            plain = as_text(read * factor, T.DoubleType())
            converted = F.when(known & (factor != 1.0), plain).otherwise(value)
        else:
            converted = F.when(known, value.cast("double") * factor).otherwise(
                value.cast("double"))
        changed = {} if mark is None else {
            f"{mark}{number}": F.coalesce(known & (factor != 1.0) & value.isNotNull(), F.lit(False))}
        df = replace_columns(df, {
            **changed, rule["value_col"]: converted,
            rule["unit_col"]: F.when(known, F.lit(rule["canonical"])).otherwise(unit),
        })
    return df


def _no_number(df: DataFrame, column: str) -> Column:
    """Whether a text cell holds something that is not a number."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.StringType):
        return F.lit(False)
    return ref(column).isNotNull() & to_number(ref(column), kind).isNull()


def unconverted_units(df: DataFrame, configs: list[dict] | None = None,
                      clean: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """Report ``(value_col, unit, rows)`` of rows no rule converts, most frequent first.

    These are rows with a label no rule covers, and text cells that are no numbers.
    """
    reports = []
    for rule in _usable(df, configs):
        unit = ref(rule["unit_col"])
        factor = _factor(rule, clean)
        reports.append(
            df.where(unit.isNotNull() & (factor.isNull() | _no_number(df, rule["value_col"])))
            .groupBy(F.trim(unit).alias("unit")).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(rule["value_col"]).alias("value_col"), "unit", "rows"))
    if not reports:
        return df.sparkSession.createDataFrame([], "value_col string, unit string, rows bigint")
    result = reports[0]
    for extra in reports[1:]:
        result = result.unionByName(extra)
    return result.orderBy(F.desc("rows"), "value_col", "unit")
