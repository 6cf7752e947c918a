"""Whole-table statistics against plain pandas on the same values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidyforge.operators import stats
from tidyforge.operators.ranks import number_tasks, numbered, sums_before
from tidyforge.operators.stats import categories, column_stats, exact_quantiles, modes

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def frame(spark, values, parts=5):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)],
                               "i int, v double")
    return df.repartition(parts, "i")


def shapes():
    rng = np.random.default_rng(5)
    hot = np.where(rng.random(4000) < 0.4, 7.0, rng.normal(0, 100, 4000))
    return {
        "spread": rng.normal(50, 9, 5000).round(3),
        "hot value": hot,
        "two values": np.repeat([1.0, 2.0], [10, 3000]),
        "outliers": np.concatenate([rng.random(3000), [1e300, -1e300]]),
        "constant": np.full(500, 3.0),
        "few": np.array([1.0, 4.0]),
        "single": np.array([9.0]),
    }


@pytest.mark.parametrize("name", shapes())
@pytest.mark.parametrize("limit", [200_000, 40])
def test_quantiles_are_exact(spark, name, limit):
    values = shapes()[name]
    found = exact_quantiles(frame(spark, values), {"v": SHARES}, gather_rows=limit)["v"]
    np.testing.assert_allclose(found, np.quantile(values, SHARES), rtol=1e-12)


def test_quantiles_stay_exact_when_the_sketch_is_wrong(spark, monkeypatch):
    values = shapes()["spread"]
    real = stats._measure

    def misleading(base, cells, brackets, shares):
        return [(n, [(g[0][0], g[0][0])] * len(g) if n else g)
                for n, g in real(base, cells, brackets, shares)]

    monkeypatch.setattr(stats, "_measure", misleading)
    found = exact_quantiles(frame(spark, values), {"v": [0.25, 0.5]}, gather_rows=200)["v"]
    np.testing.assert_allclose(found, np.quantile(values, [0.25, 0.5]))


def test_quantiles_skip_missing(spark):
    df = frame(spark, [1, None, 4, float("nan"), 2]).withColumn("w", F.lit(None).cast("int"))
    found = exact_quantiles(df, {"v": [0.5], "w": [0.5], "i": [0.5]})
    assert found == {"v": [2.0], "w": [None], "i": [2.0]}


def test_column_stats(spark):
    found = column_stats(frame(spark, [1, None, 4, float("nan")]), ["v"])["v"]
    assert found["n"] == 4 and found["missing"] == 2 and found["mean"] == 2.5
    assert found["std"] == 1.5 and (found["min"], found["max"]) == (1.0, 4.0)


def test_modes_take_the_smallest_on_a_tie(spark):
    rows = [("b", 2, 1.5, None), ("a", 10, 1.5, None), ("a", 10, 0.5, None), ("b", 2, None, None)]
    df = spark.createDataFrame(rows, "t string, i int, d double, e string")
    assert modes(df, ["t", "i", "d", "e"]) == {"t": "a", "i": 2, "d": 1.5}
    pdf = df.toPandas()
    assert pdf["t"].mode().iloc[0] == "a" and pdf["i"].mode().iloc[0] == 2


def test_categories_refuse_instead_of_cutting(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("t"), (F.col("id") % 3).alias("k"))
    assert categories(df, ["k"], 10) == {"k": {0: 167, 1: 167, 2: 166}}
    with pytest.raises(ValueError, match="too many categories"):
        categories(df, ["t", "k"], 100)


def test_partitioning_does_not_change_results(spark):
    values = shapes()["hot value"]
    one = exact_quantiles(frame(spark, values, 1), {"v": SHARES}, gather_rows=100)
    many = exact_quantiles(frame(spark, values, 9), {"v": SHARES}, gather_rows=100)
    assert one == many
    assert modes(frame(spark, values, 1), ["v"]) == modes(frame(spark, values, 9), ["v"])


def test_labels_match_pandas():
    from tidyforge.operators.features import interval_labels
    values = pd.Series([0.0012345, 1.5, 2.25, 3.3333, 80.0, 123456.789])
    _, edges = pd.qcut(values, 4, retbins=True)
    want = [str(i) for i in pd.qcut(values, 4).cat.categories]
    assert interval_labels(list(edges)) == want


def test_modes_by_sketch_and_by_counting_agree(spark, monkeypatch):
    """Clear modes need no grouping by value; unclear ones and ties are counted in full."""
    from collections import Counter
    pick = np.random.default_rng(2)
    n = 30_000
    data = pd.DataFrame({
        "clear": np.where(pick.random(n) < 0.2, "often", pick.integers(0, 10**6, n).astype(str)),
        "unclear": pick.integers(0, 20_000, n).astype(str), "tie": np.arange(n) % 2,
        "few": pick.integers(0, 5, n) / 2, "unique": np.arange(n)})
    df = spark.createDataFrame(data).withColumn("empty", F.lit(None).cast("string"))
    want = {}
    for c in data:
        counted = Counter(data[c].tolist())
        most = max(counted.values())
        want[c] = min(v for v, k in counted.items() if k == most)
    asked = []
    plain = stats.value_counts
    monkeypatch.setattr(stats, "value_counts", lambda d, cs: asked.append(cs) or plain(d, cs))
    assert stats.modes(df, df.columns) == want
    assert asked == [["unclear", "unique"]]


def test_rows_are_numbered_in_order(spark):
    df = spark.range(4000).selectExpr("id * 7919 % 4000 AS v")
    assert all(r["v"] == r["place"] for r in numbered(df, "v").collect())
    ordered = df.orderBy(F.col("v").desc())
    assert all(r["v"] == 3999 - r["place"] for r in number_tasks(ordered).collect())
    assert numbered(df.limit(0), "v").count() == 0


def test_sums_before_each_row(spark):
    df = spark.range(3000).selectExpr("id * 7919 % 3000 AS v", "id % 5 AS n")
    got = {r["v"]: (r["n"], r["before"]) for r in sums_before(df, ["v"], "n").collect()}
    total = 0
    for v in range(3000):
        assert got[v][1] == total
        total += got[v][0]


def test_more_categories_than_the_driver_may_hold_are_refused(spark, monkeypatch):
    df = spark.range(50).selectExpr("CAST(id AS STRING) AS s", "id % 3 AS n")
    monkeypatch.setattr(stats, "FETCHED", 49)
    with pytest.raises(ValueError, match="vector encoding"):
        categories(df, ["s"])
    monkeypatch.setattr(stats, "FETCHED", 50)
    assert len(categories(df, ["s", "n"])["s"]) == 50
