"""Scaling of numeric columns."""

from __future__ import annotations

import logging
import math
import sys

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyforge.functions.names import numeric_columns, present, ref, replace_columns
from tidyforge.functions.nulls import double_or_null
from tidyforge.operators.saved import Saved
from tidyforge.operators.stats import column_stats, exact_quantiles

log = logging.getLogger(__name__)

METHODS = ("standard", "minmax", "robust")
# Spreads below this count as constant and divide by one.
TINY = 10 * sys.float_info.epsilon


def _nonzero(spread: float) -> float:
    return 1.0 if spread < TINY else spread


def _center_scale(method: str, stats: dict) -> tuple[float, float]:
    if method == "standard":
        constant = stats["min"] == stats["max"]
        return stats["mean"], 1.0 if constant else _nonzero(stats["std"])
    if method == "minmax":
        return stats["min"], _nonzero(stats["max"] - stats["min"])
    low, middle, high = stats["quartiles"]
    return middle, _nonzero(high - low)


def _flag_quantile(zeros: int, rows: int, share: float) -> float:
    """Quantile of a 0/1 column from its counts."""
    position = share * (rows - 1)
    lo, hi = (1.0 if math.floor(position) >= zeros else 0.0,
              1.0 if math.ceil(position) >= zeros else 0.0)
    return lo + (hi - lo) * (position - math.floor(position))


def flag_stats(ones: int, rows: int) -> dict:
    """Scaler statistics of a 0/1 column that follow from its counts alone."""
    share = ones / rows
    return {"mean": share, "std": math.sqrt(share * (1 - share)),
            "min": 1.0 if ones == rows else 0.0, "max": 1.0 if ones else 0.0,
            "quartiles": [_flag_quantile(rows - ones, rows, s) for s in (0.25, 0.5, 0.75)]}


def fit_scaling(df: DataFrame, columns: list[str], method: str) -> dict[str, tuple[float, float]]:
    """Centre and scale per column; columns without any value are left out."""
    columns = present(df, columns)
    if method == "robust":
        found = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
        stats = {c: {"quartiles": v} for c, v in found.items() if v[0] is not None}
    else:
        stats = {c: s for c, s in column_stats(df, columns).items() if s["mean"] is not None}
    return {c: _center_scale(method, s) for c, s in stats.items()}


class NumericScaler(Saved, Estimator):
    """Standard (population deviation), min-max or robust (median, IQR) scaling.

    Missing cells are ignored by the fit and stay missing.
    """

    STATE = ("columns", "method")

    def __init__(self, columns: list[str] | None = None, method: str = "standard"):
        super().__init__()
        if method not in METHODS:
            raise ValueError(f"unknown scaling method {method!r}; choose from {METHODS}")
        self.columns = columns
        self.method = method

    def _fit(self, dataset: DataFrame) -> "ScalerModel":
        columns = numeric_columns(dataset) if self.columns is None else self.columns
        return ScalerModel(fit_scaling(dataset, columns, self.method))


class ScalerModel(Saved, Model):
    """Fitted ``(centre, scale)`` per column."""

    STATE = ("parameters",)

    def __init__(self, parameters: dict[str, tuple[float, float]]):
        super().__init__()
        self.parameters = parameters

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return replace_columns(dataset, {
            c: (double_or_null(ref(c), dataset.schema[c].dataType) - F.lit(center)) / F.lit(scale)
            for c, (center, scale) in self.parameters.items() if c in dataset.columns})


def scale_numeric(df: DataFrame, columns: list[str], method: str = "standard") -> DataFrame:
    """Learn and apply scaling on the listed columns; absent columns are skipped.

    An unknown method is reported and leaves the table as it is.
    """
    columns = present(df, columns)
    if method not in METHODS:
        log.warning("unknown scaling method %r, nothing scaled", method)
        return df
    if not columns:
        return df
    return NumericScaler(columns, method).fit(df).transform(df)
