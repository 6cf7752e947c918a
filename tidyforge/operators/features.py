"""Derived columns, as single functions and as a fitted list of steps."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import is_number, missing_free, ref, replace_columns
from tidyforge.functions.numbers import log1p_or_null, threshold_flag
from tidyforge.operators.saved import Saved
from tidyforge.operators.stats import exact_quantiles
from tidyforge.operators.udf import row_function

DATE_PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth, "dayofweek": F.dayofweek,
              "dayofyear": F.dayofyear, "quarter": F.quarter, "hour": F.hour}


def _number(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return ref(name).cast("int")
    return missing_free(df, name)


def binarize(df: DataFrame, column: str, threshold: float,
             new_column_name: str | None = None) -> DataFrame:
    """1 above the threshold, else 0 (missing included); no-op unless numeric."""
    if not is_number(df, column):
        return df
    return replace_columns(df, {new_column_name or f"{column}_binarized":
                                threshold_flag(_number(df, column), threshold)})


def log_transform(df: DataFrame, column: str, new_column_name: str | None = None) -> DataFrame:
    """ln(1 + x), NULL for x <= -1; no-op unless numeric."""
    if not is_number(df, column):
        return df
    return replace_columns(df, {new_column_name or f"{column}_log":
                                log1p_or_null(_number(df, column))})


def polynomial_interaction(df: DataFrame, col1: str, col2: str,
                           new_column_name: str | None = None) -> DataFrame:
    """Product of two columns, the square when they are the same; no-op if one is absent."""
    if col1 not in df.columns or col2 not in df.columns:
        return df
    return replace_columns(df, {new_column_name or f"{col1}_x_{col2}":
                                _number(df, col1) * _number(df, col2)})


def date_parts(df: DataFrame, column: str, parts: list[str] = ("year", "month", "day")) -> DataFrame:
    """Calendar parts of a date or timestamp as ``<column>_<part>``; no-op if absent."""
    unknown = [p for p in parts if p not in DATE_PARTS]
    if unknown:
        raise ValueError(f"unknown date parts {unknown}; choose from {sorted(DATE_PARTS)}")
    if column not in df.columns:
        return df
    return replace_columns(df, {f"{column}_{p}": DATE_PARTS[p](ref(column)) for p in parts})


def quantile_edges(df: DataFrame, wanted: dict[str, int]) -> dict[str, list[float]]:
    """Distinct exact quantile edges per column, all columns in shared passes."""
    found = exact_quantiles(df, {c: [i / q for i in range(q + 1)] for c, q in wanted.items()})
    return {c: sorted({e for e in edges if e is not None}) for c, edges in found.items()}


def interval_labels(edges: list[float]) -> list[str]:
    """Texts ``(lo, hi]`` rounded as pandas shows them; works on the edges only."""
    if len(edges) < 2:
        return []
    bins = pd.cut(pd.Series(edges), bins=edges, include_lowest=True)
    return [str(i) for i in bins.cat.categories]


def bin_by_edges(value: Column, edges: list[float], labels: list | None = None,
                 codes: bool = False) -> Column:
    """Right-closed bins with the lowest value included; outside and missing give NULL."""
    count = max(len(edges) - 1, 0)
    if labels is not None and len(labels) != count:
        raise ValueError(f"{len(labels)} labels for {count} bins")
    names = list(range(count)) if codes else labels if labels is not None else interval_labels(edges)
    if not names:
        return F.lit(None).cast("int" if codes else "string")
    result = F.when(value < edges[0], None)
    for name, high in zip(names, edges[1:]):
        result = result.when(value <= high, F.lit(name))
    return result


def quantile_binning(df: DataFrame, column: str, q: int, labels: list | None = None,
                     new_column_name: str | None = None, codes: bool = False) -> DataFrame:
    """Equal-frequency bins learned from this table; no-op unless numeric.

    To reuse the edges on other data, fit a :class:`FeatureEngineer`.
    """
    if not is_number(df, column):
        return df
    edges = quantile_edges(df, {column: q})[column]
    return replace_columns(df, {new_column_name or f"{column}_q{q}_bins":
                                bin_by_edges(_number(df, column), edges, labels, codes)})


def custom_row_logic(df: DataFrame, new_column_name: str, func: Callable,
                     returns: str | None = None, uses: list[str] | None = None) -> DataFrame:
    """New column from a user function of a row; see :mod:`tidyforge.operators.udf`.

    ``uses`` names the columns the function reads; only those are shipped to Python.
    """
    if not new_column_name or func is None:
        return df
    return replace_columns(df, {new_column_name: row_function(df, func, returns, uses)})


# Step names and the argument names each accepts, aliases included.
TOOLS = {
    "binarize": ("column", "threshold", "new_column_name"),
    "quantile_binning": ("column", "q", "labels", "new_column_name", "codes"),
    "log_transform": ("column", "new_column_name"),
    "polynomial_interaction": ("col1", "col2", "new_column_name"),
    "date_parts": ("column", "parts"),
    "custom_row_logic": ("new_column_name", "func", "returns", "uses"),
}
REQUIRED = {
    "binarize": ("column", "threshold"), "quantile_binning": ("column", "q"),
    "log_transform": ("column",), "polynomial_interaction": ("col1", "col2"),
    "date_parts": ("column",), "custom_row_logic": ("new_column_name", "func"),
}
TOOL_ALIASES = {"custom_logic": "custom_row_logic"}
ARGUMENT_ALIASES = {"col": "column", "custom_func": "func"}


@dataclass(frozen=True)
class Step:
    tool: str
    arguments: dict

    @classmethod
    def parse(cls, step: dict) -> "Step":
        """Check a step dict; unknown tools and arguments are errors, not skipped."""
        arguments = {ARGUMENT_ALIASES.get(k, k): v for k, v in step.items() if k not in ("tool", "op")}
        tool = step.get("tool") or step.get("op")
        tool = TOOL_ALIASES.get(tool, tool)
        if tool not in TOOLS:
            raise ValueError(f"unknown feature tool {tool!r}; choose from {sorted(TOOLS)}")
        unknown = sorted(set(arguments) - set(TOOLS[tool]))
        lacking = [a for a in REQUIRED[tool] if arguments.get(a) is None]
        if unknown or lacking:
            raise ValueError(f"{tool}: unknown arguments {unknown}, missing arguments {lacking}")
        return cls(tool, arguments)


PLAIN_TOOLS = {"binarize": binarize, "log_transform": log_transform, "date_parts": date_parts,
               "polynomial_interaction": polynomial_interaction,
               "custom_row_logic": custom_row_logic}


class FeatureEngineer(Saved, Estimator):
    """Fit a list of feature steps; quantile edges are learned once and frozen."""

    def _state(self) -> dict:
        return {"operations": [{"tool": s.tool, **s.arguments} for s in self.steps]}

    def __init__(self, operations: list[dict] | None = None):
        super().__init__()
        self.steps = [Step.parse(s) for s in operations or []]

    def _fit(self, dataset: DataFrame) -> "FeatureModel":
        edges: dict[int, list[float]] = {}
        frame = dataset
        pending = list(enumerate(self.steps))
        while pending:
            # Bins over columns that exist by now share their passes over the data.
            todo, made = [], set()
            for i, s in pending:
                if s.tool == "quantile_binning" and s.arguments["column"] not in made \
                        and is_number(frame, s.arguments["column"]):
                    todo.append((i, s))
                made.add(s.arguments.get("new_column_name"))
            by_q: dict[str, dict[int, int]] = {}
            shares: dict[str, set[float]] = {}
            for i, s in todo:
                c, q = s.arguments["column"], s.arguments["q"]
                by_q.setdefault(c, {})[i] = q
                shares.setdefault(c, set()).update(k / q for k in range(q + 1))
            found = exact_quantiles(frame, {c: sorted(v) for c, v in shares.items()})
            for c, uses in by_q.items():
                at = dict(zip(sorted(shares[c]), found[c]))
                for i, q in uses.items():
                    edges[i] = sorted({at[k / q] for k in range(q + 1)} - {None})
            # Advance until a step needs edges of a column that did not exist yet.
            while pending:
                i, s = pending[0]
                if s.tool == "quantile_binning" and i not in edges \
                        and is_number(frame, s.arguments["column"]):
                    break
                frame = _apply(frame, s, edges.get(i))
                pending.pop(0)
        return FeatureModel(self.steps, edges)


class FeatureModel(Saved, Model):
    """Fitted feature steps; only projections, so usable on other data and on streams."""

    def _state(self) -> dict:
        return {"steps": [{"tool": s.tool, **s.arguments} for s in self.steps], "edges": self.edges}

    @classmethod
    def _restored(cls, state: dict) -> "FeatureModel":
        return cls([Step.parse(s) for s in state["steps"]], state["edges"])

    def __init__(self, steps: list[Step], edges: dict[int, list[float]]):
        super().__init__()
        self.steps = steps
        self.edges = edges

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for i, step in enumerate(self.steps):
            dataset = _apply(dataset, step, self.edges.get(i))
        return dataset


def _apply(df: DataFrame, step: Step, edges: list[float] | None) -> DataFrame:
    if step.tool != "quantile_binning":
        return PLAIN_TOOLS[step.tool](df, **step.arguments)
    column, q = step.arguments["column"], step.arguments["q"]
    if edges is None or not is_number(df, column):
        return df
    name = step.arguments.get("new_column_name") or f"{column}_q{q}_bins"
    binned = bin_by_edges(_number(df, column), edges, step.arguments.get("labels"),
                          step.arguments.get("codes", False))
    return replace_columns(df, {name: binned})


def engineer_features(df: DataFrame, steps: list[dict] | None = None,
                      engineer: Callable[..., Estimator] = FeatureEngineer) -> DataFrame:
    """Learn and apply feature steps ``{"tool": ..., ...}`` in their order."""
    if not steps:
        return df
    return engineer(steps).fit(df).transform(df)
