"""Missingness, sparse columns and fill values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import INTEGRAL, missing_free, present, replace_columns
from tidyforge.functions.nulls import missing
from tidyforge.operators.saved import Saved
from tidyforge.operators.stats import column_stats, counts, exact_quantiles, modes

METHODS = ("mean", "median", "mode", "constant")


def missing_percent(df: DataFrame, columns: list[str] | None = None) -> dict[str, float]:
    """Missing cells per column in percent, all columns in one pass."""
    stats = column_stats(df, [], missing_only=df.columns if columns is None else columns)
    return {c: 100.0 * s["missing"] / s["n"] for c, s in stats.items() if s["n"]}


def missingness_report(df: DataFrame) -> DataFrame:
    """``(column, missing_pct)`` of columns with missing cells, worst first.

    One aggregate over the table; the unpivot works on its single row.
    """
    found = counts(df, {"n": F.lit(True)} | {f"m{i}": missing(df, c)
                                             for i, c in enumerate(df.columns)})
    wide = found.select(*[(F.lit(100.0) * F.col(f"m{i}") / F.nullif(F.col("n"), F.lit(0))).alias(f"m{i}")
                          for i in range(len(df.columns))])
    names = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns) for x in (f"m{i}", c)])
    return (
        wide.unpivot([], wide.columns, "slot", "missing_pct")
        .select(names[F.col("slot")].alias("column"), "missing_pct")
        .where(F.col("missing_pct") > 0)
        .orderBy(F.desc("missing_pct"), "column")
    )


def _is_plain_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


@dataclass
class Strategy:
    """Fill rule for a list of columns; None stands for every column."""

    method: str = "mean"
    columns: list[str] | None = None
    constant_val: object = None

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"unsupported imputation method: {self.method!r}")


def _rules_by_column(df: DataFrame, strategies: list[Strategy]) -> dict[str, list[Strategy]]:
    """The strategies that can fill each column, in order.  A constant ends the list."""
    rules: dict[str, list[Strategy]] = {}
    for s in strategies:
        for c in present(df, df.columns if s.columns is None else s.columns):
            mine = rules.setdefault(c, [])
            if s.method in ("mean", "median") and not _is_plain_number(df, c):
                continue
            if s.method == "constant" and s.constant_val is None:
                continue
            if not mine or mine[-1].method != "constant":
                mine.append(s)
    return rules


def _sparse(stats: dict[str, dict], threshold: float | None) -> list[str]:
    if threshold is None:
        return []
    return [c for c, s in stats.items() if s["n"] and 100.0 * s["missing"] / s["n"] > threshold]


def fit_imputation(df: DataFrame, drop_threshold: float | None,
                   strategies: list[Strategy]) -> "FillPlan":
    """Learn the sparse columns and the fill values of a sequence of strategies.

    A later strategy finds no missing cells in a column an earlier one filled, so the
    first strategy with a defined value wins.  Missing counts and means share one pass,
    all medians share theirs, and modes take one pass per data type.
    """
    rules = _rules_by_column(df, strategies)

    def asked(method):
        return [c for c, mine in rules.items() if any(r.method == method for r in mine)]

    stats = column_stats(df, asked("mean"), [] if drop_threshold is None else df.columns)
    dropped = _sparse(stats, drop_threshold)
    rules = {c: mine for c, mine in rules.items() if c not in dropped}
    learned = {
        "mean": {c: stats[c]["mean"] for c in asked("mean")},
        "median": {c: v[0] for c, v in exact_quantiles(df, {c: [0.5] for c in asked("median")}).items()},
        "mode": modes(df, asked("mode")),
    }
    values = {}
    for c, mine in rules.items():
        for rule in mine:
            value = rule.constant_val if rule.method == "constant" else learned[rule.method].get(c)
            if value is not None and value == value:
                values[c] = (value, rule.method)
                break
    return FillPlan(dropped, values)


@dataclass
class FillPlan:
    """Learned state: columns to drop and values to fill in."""

    drop_columns: list[str] = field(default_factory=list)
    fill_values: dict[str, tuple[object, str]] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        df = df.drop(*present(df, self.drop_columns))
        changed = {}
        for c, (value, method) in self.fill_values.items():
            if c not in df.columns:
                continue
            data_type = df.schema[c].dataType
            cell = missing_free(df, c)
            if method in ("mean", "median") and isinstance(data_type, (*INTEGRAL, T.DecimalType)):
                changed[c] = F.coalesce(cell.cast("double"), F.lit(float(value)))
            elif isinstance(data_type, INTEGRAL) and isinstance(value, float) \
                    and not value.is_integer():
                changed[c] = F.coalesce(cell.cast("double"), F.lit(value))
            else:
                changed[c] = F.coalesce(cell, F.lit(value).cast(data_type))
        return replace_columns(df, changed)


class MissingValueImputer(Saved, Estimator):
    """Drop sparse columns and fill the rest by mean, median, mode or a constant.

    Mean and median turn integer columns into doubles.  A column without any value
    gets no fill.
    """

    def _state(self) -> dict:
        rule = self.strategy
        return {"columns": rule.columns, "method": rule.method,
                "constant_val": rule.constant_val, "drop_threshold": self.drop_threshold}

    def __init__(self, columns: list[str] | None = None, method: str = "mean",
                 constant_val: object = None, drop_threshold: float | None = None):
        super().__init__()
        self.strategy = Strategy(method, columns, constant_val)
        self.drop_threshold = drop_threshold

    def _fit(self, dataset: DataFrame) -> "MissingValueModel":
        return MissingValueModel(fit_imputation(dataset, self.drop_threshold, [self.strategy]))


class MissingValueModel(Saved, Model):
    """Fitted drop list and fill values; usable on other data and on streams."""

    def _state(self) -> dict:
        return {"drop_columns": self.plan.drop_columns, "fill_values": self.plan.fill_values}

    @classmethod
    def _restored(cls, state: dict) -> "MissingValueModel":
        return cls(FillPlan(**state))

    def __init__(self, plan: FillPlan):
        super().__init__()
        self.plan = plan

    @property
    def drop_columns(self) -> list[str]:
        return self.plan.drop_columns

    @property
    def fill_values(self) -> dict[str, object]:
        return {c: v for c, (v, _) in self.plan.fill_values.items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.plan.apply(dataset)


def impute_missing(df: DataFrame, drop_threshold: float | None = 50.0,
                   strategies: list[dict] | None = None, fit=fit_imputation) -> DataFrame:
    """Drop sparse columns, then fill by a sequence of strategies.

    Each strategy is ``{"cols": [...], "method": ..., "constant_val": ...}``.  Another
    ``fit`` may be given; its result must have ``apply``.
    """
    rules = [Strategy(s.get("method", "mean"), s.get("cols", []), s.get("constant_val"))
             for s in strategies or []]
    return fit(df, drop_threshold, rules).apply(df)
