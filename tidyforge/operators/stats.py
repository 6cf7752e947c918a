"""Whole-table statistics that stay bounded on any data size.

Built-in ``median``, ``percentile``, ``mode`` and ``collect_set`` without grouping keep
every distinct value of a column in one task.  Here exact quantiles come from
narrowing brackets, and value counts are grouped by (column, value), so that the
shuffle is pre-aggregated and spread over all tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyforge.functions.names import ref
from tidyforge.functions.nulls import double_or_null, missing

# Rows that may be left inside the brackets when their values are fetched one by one.
GATHER_ROWS = 20_000
# Categories that may be fetched for the columns of one type.
FETCHED = 100_000
# Sketch size and the margin, in rank share, put around a sketched quantile.
SKETCH_K = 1024
MARGIN = 0.004
# First-level groups of an aggregate with wide buffers: partial results of many input
# tasks merge in this many tasks before the last step.
MERGE_GROUPS = 64


# ---------------------------------------------------------------- one-pass statistics

def in_merge_groups(df: DataFrame, parts: list[Column]) -> DataFrame:
    """At most ``MERGE_GROUPS`` partial results of whole-table aggregates.

    Without grouping, one task would receive a partial result of every input task, for
    every column.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("merge_group")
    return df.groupBy(group).agg(*parts)


def counts(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row with the number of rows each test is true for."""
    partial = in_merge_groups(df, [F.count_if(test).alias(name) for name, test in tests.items()])
    return partial.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in tests])


def column_stats(df: DataFrame, columns: list[str],
                 missing_only: list[str] = ()) -> dict[str, dict]:
    """Row count, missing count, mean, population deviation, min and max in one pass.

    For the ``missing_only`` columns just the first two are found.
    """
    parts = [F.count(F.lit(1)).alias("n")]
    every = list(dict.fromkeys([*columns, *missing_only]))
    if not every:
        return {}
    for i, name in enumerate(every):
        parts.append(F.count_if(missing(df, name)).alias(f"missing_{i}"))
        if name in columns:
            value = double_or_null(ref(name), df.schema[name].dataType)
            parts += [F.avg(value).alias(f"mean_{i}"), F.var_pop(value).alias(f"var_{i}"),
                      F.min(value).alias(f"min_{i}"), F.max(value).alias(f"max_{i}")]
    groups = in_merge_groups(df, parts).collect()
    rows, found = sum(g["n"] for g in groups), {}
    for i, name in enumerate(every):
        found[name] = {"n": rows, "missing": sum(g[f"missing_{i}"] for g in groups)}
        if name in columns:
            found[name] |= _combine([
                (g["n"] - g[f"missing_{i}"], g[f"mean_{i}"], g[f"var_{i}"], g[f"min_{i}"], g[f"max_{i}"])
                for g in groups if g[f"mean_{i}"] is not None])
    return found


def _combine(parts: list[tuple]) -> dict:
    """Statistics of the whole from (count, mean, variance, min, max) of its parts."""
    if not parts:
        return dict.fromkeys(("mean", "std", "min", "max"))
    total = sum(n for n, *_ in parts)
    mean = math.fsum(n * m for n, m, *_ in parts) / total
    spread = math.fsum(n * (v + (m - mean) ** 2) for n, m, v, *_ in parts) / total
    return {"mean": mean, "std": math.sqrt(spread),
            "min": min(p[3] for p in parts), "max": max(p[4] for p in parts)}


# ---------------------------------------------------------------- exact quantiles

@dataclass
class _Bracket:
    """Open value interval that holds the wanted ranks of one column."""

    column: str
    ranks: list[int] | None          # 0-based; None until the row count is known
    low: float | None = None         # exclusive; None is unbounded
    high: float | None = None
    below: int = 0                   # rows at or under ``low``
    rows: int | None = None          # rows strictly inside
    guess: tuple[float, float] | None = None
    found: dict[int, float] = field(default_factory=dict)

    def holds(self, value: Column) -> Column:
        test = value.isNotNull()
        if self.low is not None:
            test = test & (value > F.lit(self.low))
        if self.high is not None:
            test = test & (value < F.lit(self.high))
        return test


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]],
                    gather_rows: int = GATHER_ROWS) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, for many columns at once.

    Every pass is one column-pruned aggregate with a tiny result.  A sketch proposes
    two values around each wanted rank, the next pass counts the rows at and under
    them exactly, and only the rows strictly between remain.  Each pass cuts the
    remaining rows about a hundredfold.  Columns of any length are narrowed at least
    once; the values left are fetched when at most ``gather_rows`` rows remain.  A wrong proposal costs a pass, never the result.
    """
    columns = [c for c, shares in wanted.items() if shares]
    if not columns:
        return {c: [] for c in wanted}
    values = {c: double_or_null(ref(c), df.schema[c].dataType) for c in columns}
    base = df.select(*[values[c].alias(f"v{i}") for i, c in enumerate(columns)])
    cells = {c: F.col(f"v{i}") for i, c in enumerate(columns)}

    sizes, open_brackets, done = {}, [], []
    first = [_Bracket(c, None) for c in columns]
    shares = [sorted(set(wanted[c])) for c in columns]
    measured = _measure(base, cells, first, shares)
    for b, of_column, (rows, guesses) in zip(first, shares, measured):
        sizes[b.column] = rows
        for share, guess in zip(of_column, guesses):
            if rows:
                position = share * (rows - 1)
                ranks = sorted({math.floor(position), math.ceil(position)})
                open_brackets.append(_Bracket(b.column, ranks, rows=rows, guess=guess))

    if open_brackets:
        open_brackets = _narrow(base, cells, open_brackets, done)
    while open_brackets and _rows_left(open_brackets) > gather_rows:
        open_brackets = _narrow(base, cells, open_brackets, done)
    if open_brackets:
        _gather(base, cells, open_brackets)
        done += open_brackets

    at_rank: dict[tuple[str, int], float] = {}
    for b in done:
        at_rank |= {(b.column, r): v for r, v in b.found.items()}
    result: dict[str, list[float | None]] = {c: [] for c in wanted}
    for c in columns:
        for share in wanted[c]:
            if not sizes[c]:
                result[c].append(None)
                continue
            position = share * (sizes[c] - 1)
            lo, hi = at_rank[c, math.floor(position)], at_rank[c, math.ceil(position)]
            part = position - math.floor(position)
            result[c].append(lo if lo == hi else lo + (hi - lo) * part)
    return result


def _rows_left(brackets: list[_Bracket]) -> int:
    distinct = {(b.column, b.low, b.high): b.rows for b in brackets}
    return sum(distinct.values())


def _measure(base, cells, brackets, shares) -> list[tuple[int, list[tuple[float, float]]]]:
    """Rows inside each bracket and, per wanted share, two values around it."""
    sketches, merged, out = [], [], []
    for i, (b, wanted) in enumerate(zip(brackets, shares)):
        value = cells[b.column]
        inside = F.when(b.holds(value), value)
        sketches += [F.count(inside).alias(f"n{i}"),
                     F.kll_sketch_agg_double(inside, F.lit(SKETCH_K)).alias(f"s{i}")]
        merged += [F.sum(f"n{i}").alias(f"n{i}"), F.kll_merge_agg_double(f"s{i}").alias(f"s{i}")]
        ranks = [min(max(s + d, 0.0), 1.0) for s in wanted for d in (-MARGIN, MARGIN)]
        guess = F.kll_sketch_get_quantile_double(f"s{i}", F.array(*map(F.lit, ranks)))
        out += [F.col(f"n{i}"), F.when(F.col(f"n{i}") > 0, guess).alias(f"g{i}")]
    if all(b.low is not None or b.high is not None for b in brackets):
        # Most rows lie outside by now; drop them before the slower object aggregate.
        base = base.where(reduce(Column.__or__, [b.holds(cells[b.column]) for b in brackets]))
    row = in_merge_groups(base, sketches).agg(*merged).select(*out).first()
    result = []
    for i, wanted in enumerate(shares):
        found = row[f"g{i}"] or [None] * (2 * len(wanted))
        result.append((row[f"n{i}"] or 0, list(zip(found[::2], found[1::2]))))
    return result


def _narrow(base, cells, brackets, done) -> list[_Bracket]:
    """Count around the guesses and keep, per wanted rank, the part that holds it."""
    fresh = [b for b in brackets if b.guess is None]
    if fresh:
        shares = [[((b.ranks[0] + b.ranks[-1]) / 2 - b.below) / max(b.rows - 1, 1)] for b in fresh]
        for b, (_, guesses) in zip(fresh, _measure(base, cells, fresh, shares)):
            b.guess = guesses[0]
        return brackets

    tests, names = {}, ("under_low", "at_low", "under_high", "at_high")
    for i, b in enumerate(brackets):
        value, (low, high) = cells[b.column], b.guess
        for name, test in zip(names, (value < F.lit(low), value <= F.lit(low),
                                      value < F.lit(high), value <= F.lit(high))):
            tests[f"{name}_{i}"] = b.holds(value) & test
    row = counts(base, tests).first()

    left = []
    for i, b in enumerate(brackets):
        under_low, at_low, under_high, at_high = (b.below + row[f"{n}_{i}"] for n in names)
        low, high = b.guess
        pieces: dict[tuple, list[int]] = {}
        for rank in b.ranks:
            if under_low <= rank < at_low:
                b.found[rank] = low
            elif under_high <= rank < at_high:
                b.found[rank] = high
            elif rank < under_low:
                pieces.setdefault((b.low, low, b.below, under_low - b.below), []).append(rank)
            elif rank < under_high:
                pieces.setdefault((low, high, at_low, under_high - at_low), []).append(rank)
            else:
                end = b.below + b.rows
                pieces.setdefault((high, b.high, at_high, end - at_high), []).append(rank)
        done.append(b)
        left += [_Bracket(b.column, ranks, lo, hi, below, rows)
                 for (lo, hi, below, rows), ranks in pieces.items()]
    return left


def _gather(base, cells, brackets) -> None:
    """Fetch the counted values inside the brackets, at most ``gather_rows`` rows."""
    spans: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        spans.setdefault((b.column, b.low, b.high), []).append(b)
    tests = [(group[0].holds(cells[column]), cells[column])
             for (column, _, _), group in spans.items()]
    inside = base.where(reduce(Column.__or__, [test for test, _ in tests]))
    hits = [F.when(test, F.struct(F.lit(i).alias("span"), value.alias("value")))
            for i, (test, value) in enumerate(tests)]
    counted = (
        inside.select(F.explode(F.array_compact(F.array(*hits))).alias("hit"))
        .groupBy("hit.span", "hit.value").count().toArrow()
    )
    span, value, count = (counted.column(i).to_numpy() for i in range(3))
    order = np.lexsort((value, span))
    for i, group in enumerate(spans.values()):
        mine = order[span[order] == i]
        ends = np.cumsum(count[mine])
        for b in group:
            places = np.searchsorted(ends, np.array(b.ranks) - b.below, side="right")
            b.found = {r: float(value[mine[p]]) for r, p in zip(b.ranks, places)}


# ---------------------------------------------------------------- value counts

def value_counts(df: DataFrame, columns: list[str]) -> list[DataFrame]:
    """Counts per (column, value) without missing cells, one frame per data type.

    One unpivot per type keeps typed values; the grouping pre-aggregates on the map
    side, so one value with most of the rows costs nothing extra.
    """
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    frames = []
    for members in by_type.values():
        present = [F.when(~missing(df, c), ref(c)).alias(f"c{i}") for i, c in enumerate(members)]
        long = df.select(*present).unpivot(
            [], [f"c{i}" for i in range(len(members))], "slot", "value")
        names = F.create_map(*[F.lit(x) for i, c in enumerate(members) for x in (f"c{i}", c)])
        frames.append(
            long.where(F.col("value").isNotNull())
            .groupBy("slot", "value").agg(F.count(F.lit(1)).alias("rows"))
            .select(names[F.col("slot")].alias("column"), "value", "rows")
        )
    return frames


# Frequent values that a sketch tracks, and those whose rows are then counted.  A value that
# a sketch does not report has at most the share 2 * 3.5 / map size of the rows, where the map
# has a third more places than values tracked.
TRACKED = 3_000
CANDIDATES = 8
UNREPORTED = 2 * 3.5 * 0.75 / TRACKED
SKETCHED = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType)


def modes(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent value per column; the smallest one on a tie; absent if all missing.

    Mergeable sketches propose a few values per column, whose rows one more pass counts.  The
    most frequent of them is the mode if it has more rows than any other value can have, by
    the sketch's bound; then nothing but sketches was shuffled.  The other columns, without a
    clear mode, are grouped by value.
    """
    found: dict[str, object] = {}
    open_columns = list(columns)
    sketched = [c for c in columns if isinstance(df.schema[c].dataType, SKETCHED)]
    if sketched:
        proposed = _frequent(df, sketched)
        tests, values = {}, {}
        for i, c in enumerate(sketched):
            for j, item in enumerate(proposed[c]):
                values[f"v{i}_{j}"] = item["item"]
                tests[f"v{i}_{j}"] = ref(c) == F.lit(item["item"])
            tests[f"n{i}"] = ~missing(df, c)
        rows = counts(df, tests).first().asDict()
        for i, c in enumerate(sketched):
            own = [(rows[f"v{i}_{j}"], values[f"v{i}_{j}"]) for j in range(len(proposed[c]))]
            # what is not among the candidates: unreported, or reported with fewer rows
            others = UNREPORTED * rows[f"n{i}"]
            if len(own) == CANDIDATES:
                others = max(others, proposed[c][-1]["count"])
            most = max((n for n, _ in own), default=0)
            if most > others:
                found[c] = min(v for n, v in own if n == most)
            if rows[f"n{i}"] == 0 or c in found:
                open_columns.remove(c)
    for counted in value_counts(df, open_columns):
        best = counted.groupBy("column").agg(
            F.min(F.struct((-F.col("rows")).alias("order"), F.col("value"))).alias("best"))
        found |= {r["column"]: r["best"]["value"] for r in best.collect()}
    return found


def _frequent(df: DataFrame, columns: list[str]) -> dict[str, list]:
    """Values of each column that sketches report as frequent, most frequent first."""
    parts = [F.expr(f"approx_top_k_accumulate(`c{i}`, {TRACKED}) FILTER (WHERE `c{i}` IS NOT NULL)")
             .alias(f"s{i}") for i in range(len(columns))]
    cells = df.select(*[F.when(~missing(df, c), ref(c)).alias(f"c{i}")
                        for i, c in enumerate(columns)])
    merged = in_merge_groups(cells, parts).agg(*[
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(`s{i}`, {TRACKED}), {CANDIDATES})").alias(
            f"s{i}") for i in range(len(columns))]).first()
    return {c: [x for x in merged[f"s{i}"] or [] if x["item"] is not None]
            for i, c in enumerate(columns)}


def categories(df: DataFrame, columns: list[str], most: int | None = None) -> dict[str, dict[object, int]]:
    """Sorted categories with their row counts.

    The categories become output columns, so how many there may be is the caller's choice, up
    to ``FETCHED`` for all columns of a type, which is what the driver may hold.  With ``most`` a column that has more raises before any is fetched; nothing is cut off.
    """
    found: dict[str, dict[object, int]] = {c: {} for c in columns}
    if not columns:
        return found
    if most is not None:
        sketches = in_merge_groups(df, [
            F.hll_sketch_agg(ref(c).cast("string"), F.lit(11)).alias(f"d{i}")
            for i, c in enumerate(columns)])
        about = sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"d{i}")).alias(f"d{i}")
                               for i in range(len(columns))]).first()
        _refuse_wide({c: about[f"d{i}"] or 0 for i, c in enumerate(columns)}, most * 1.2, most)
    for counted in value_counts(df, columns):
        rows = counted.limit(FETCHED + 1).collect()
        if len(rows) > FETCHED:
            raise ValueError(f"more than {FETCHED} categories in {columns}; exclude columns, or use "
                             "the sparse or the vector encoding")
        for r in rows:
            found[r["column"]][r["value"]] = r["rows"]
    if most is not None:
        _refuse_wide({c: len(v) for c, v in found.items()}, most, most)
    return {c: dict(sorted(v.items())) for c, v in found.items()}


def _refuse_wide(distinct: dict[str, int], allowed: float, most: int) -> None:
    wide = {c: n for c, n in distinct.items() if n > allowed}
    if wide:
        raise ValueError(
            f"too many categories for one column each (limit {most}): {wide}; raise the "
            "limit, exclude the columns, or use the sparse encoding")
