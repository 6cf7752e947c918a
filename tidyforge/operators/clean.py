"""Cleaning of text and number columns as one fit/transform pair."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import (numeric_columns, present, ref, replace_columns,
                                       text_columns)
from tidyforge.functions.numbers import number_type, round_half_even, spark_type, to_number
from tidyforge.functions.text import apply_string_options, java_pattern, java_replacement
from tidyforge.operators.saved import Saved
from tidyforge.operators.stats import counts
from tidyforge.operators.udf import apply_custom_function, row_function

log = logging.getLogger(__name__)

# Options used when none are given.
DEFAULT_OPTIONS = {"universal_text_scrubber": True, "lowercase": True, "strip_whitespace": True}


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the listed columns; absent ones are ignored."""
    return df.drop(*present(df, columns))


def clean_strings(df: DataFrame, columns: list[str], options: dict) -> DataFrame:
    """Apply string options to the listed columns in one projection."""
    return replace_columns(df, {
        c: apply_string_options(ref(c), df.schema[c].dataType, options)
        for c in present(df, columns)})


def map_categories_regex(df: DataFrame, column: str, regex_mapping: dict,
                         default_val: object = None,
                         new_column_name: str | None = None) -> DataFrame:
    """Map text to categories by patterns, in place or into a new column.

    ``default_val`` fills a new column where no pattern matches; without it the
    original text stays.
    """
    if column not in df.columns:
        raise ValueError(f"column {column!r} not found")
    target = new_column_name or column
    # Each pattern is gated on the original text and works on the result so far.  One
    # projection per pattern: nested in one expression the size would double each time.
    original, hit = ref("__original"), F.lit(False)
    df = replace_columns(df, {"__original": ref(column), target: ref(column)})
    for written, value in regex_mapping.items():
        pattern = java_pattern(written)
        if isinstance(value, str):
            new = F.regexp_replace(ref(target), pattern, java_replacement(value))
        else:
            new = F.lit(value).cast("string")
        df = replace_columns(df, {target: F.when(original.rlike(pattern), new).otherwise(ref(target))})
        hit = hit | F.coalesce(original.rlike(pattern), F.lit(False))
    if target != column and default_val is not None:
        df = replace_columns(df, {target: F.when(hit, ref(target)).otherwise(F.lit(str(default_val)))})
    return df.drop("__original")


def castable_columns(df: DataFrame, columns: list[str], dtype: str,
                     numbers_first: bool) -> list[str]:
    """Columns whose every value survives the cast, found in one aggregate."""
    columns = present(df, columns)
    if not columns:
        return []
    checks = {}
    for i, c in enumerate(columns):
        value = to_number(ref(c), df.schema[c].dataType) if numbers_first else ref(c)
        lost = value.isNotNull() & value.try_cast(spark_type(dtype)).isNull()
        checks[f"lost_{i}"] = lost
    row = counts(df, checks).first()
    lossy = {c: row[f"lost_{i}"] for i, c in enumerate(columns) if row[f"lost_{i}"]}
    if lossy:
        log.warning("type %s would lose values, columns left as they are: %s", dtype, lossy)
    return [c for c in columns if c not in lossy]


def clean_numeric(df: DataFrame, columns: list[str], to_numeric: bool = False,
                  force_dtype: str | None = None, round_decimals: int | None = None,
                  castable: list[str] | None = None) -> DataFrame:
    """Parse, cast and round the listed columns in one projection.

    A column is cast only if no value would be lost, which one aggregate finds out;
    pass ``castable`` to reuse an earlier answer.
    """
    columns = present(df, columns)
    if force_dtype and castable is None:
        castable = castable_columns(df, columns, force_dtype, to_numeric)
    changed = {}
    for c in columns:
        data_type, value = df.schema[c].dataType, ref(c)
        if to_numeric:
            value, data_type = to_number(value, data_type), number_type(data_type)
        if force_dtype and c in castable:
            value = value.try_cast(spark_type(force_dtype))
            data_type = T.DataType.fromDDL(spark_type(force_dtype))
        if round_decimals is not None and isinstance(data_type, T.NumericType):
            value = round_half_even(value, data_type, round_decimals)
        changed[c] = value
    return replace_columns(df, changed)


class TableCleaner(Saved, Estimator):
    """Drop, clean text, map categories, clean numbers, then user functions.

    User functions are ``{"columns": [...], "func": f, "returns": type}`` and
    ``{"new_column_name": name, "func": f, "returns": type}``; leave out ``returns``
    for functions over Columns.
    """

    STATE = ("string_columns", "string_options", "numeric_columns", "to_numeric", "force_dtype",
             "round_decimals", "drop_columns", "category_mappings", "custom_column_functions",
             "custom_row_functions")

    def __init__(self, string_columns: list[str] | None = None, string_options: dict | None = None,
                 numeric_columns: list[str] | None = None, to_numeric: bool = False,
                 force_dtype: str | None = None, round_decimals: int | None = None,
                 drop_columns: list[str] | None = None, category_mappings: list[dict] | None = None,
                 custom_column_functions: list[dict] | None = None,
                 custom_row_functions: list[dict] | None = None):
        super().__init__()
        self.string_columns = string_columns
        self.string_options = string_options or {}
        self.numeric_columns = numeric_columns
        self.to_numeric = to_numeric
        self.force_dtype = force_dtype
        self.round_decimals = round_decimals
        self.drop_columns = drop_columns or []
        self.category_mappings = category_mappings or []
        self.custom_column_functions = custom_column_functions or []
        self.custom_row_functions = custom_row_functions or []

    def _fit(self, dataset: DataFrame) -> "TableCleanerModel":
        strings = text_columns(dataset) if self.string_columns is None else self.string_columns
        numbers = numeric_columns(dataset) if self.numeric_columns is None else self.numeric_columns
        model = TableCleanerModel(self, present(dataset, strings), present(dataset, numbers),
                                  present(dataset, self.drop_columns))
        if self.force_dtype:
            model.castable = castable_columns(model.clean_text(dataset), model.numeric_columns,
                                              self.force_dtype, self.to_numeric)
        return model


class TableCleanerModel(Saved, Model):
    """Resolved column lists; the transform is a few projections."""

    def __init__(self, settings: TableCleaner, strings: list[str], numbers: list[str],
                 dropped: list[str]):
        super().__init__()
        self.settings = settings
        self.string_columns = strings
        self.numeric_columns = numbers
        self.drop_columns = dropped
        self.castable: list[str] | None = None

    def _state(self) -> dict:
        return {"settings": self.settings._state(), "strings": self.string_columns,
                "numbers": self.numeric_columns, "dropped": self.drop_columns,
                "castable": self.castable}

    @classmethod
    def _restored(cls, state: dict) -> "TableCleanerModel":
        model = cls(TableCleaner(**state["settings"]), state["strings"], state["numbers"],
                    state["dropped"])
        model.castable = state["castable"]
        return model

    def clean_text(self, df: DataFrame) -> DataFrame:
        """The steps before number cleaning."""
        df = drop_columns(df, self.drop_columns)
        df = clean_strings(df, self.string_columns, self.settings.string_options)
        for mapping in self.settings.category_mappings:
            df = map_categories_regex(df, mapping.get("column"), mapping.get("regex_mapping", {}),
                                      mapping.get("default_val"), mapping.get("new_column_name"))
        return df

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.settings
        df = clean_numeric(self.clean_text(dataset), self.numeric_columns, s.to_numeric,
                           s.force_dtype, s.round_decimals, self.castable)
        for entry in s.custom_column_functions:
            df = apply_custom_function(df, entry.get("columns", []), entry["func"],
                                       entry.get("returns"))
        for entry in s.custom_row_functions:
            if entry.get("new_column_name") and entry.get("func"):
                df = replace_columns(df, {entry["new_column_name"]: row_function(
                    df, entry["func"], entry.get("returns"), entry.get("uses"))})
        return df


def clean_text(df: DataFrame, columns: list[str] | None = None, options: dict | None = None,
               drop_columns: list[str] | None = None,
               cleaner: Callable[..., Estimator] = TableCleaner) -> DataFrame:
    """Clean text columns; ``{}`` as options only drops columns."""
    chosen = DEFAULT_OPTIONS if options is None else options
    stage = cleaner(string_columns=columns, string_options=chosen, drop_columns=drop_columns)
    return stage.fit(df).transform(df)
