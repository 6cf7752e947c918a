"""Joins, collapse, collisions and duplicate removal."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidyforge.operators.dedupe import deduplicate, sort_rows
from tidyforge.operators.merge import filter_equal, merge, resolve_collisions

HOT = ["AdaptiveSparkPlan", "WindowGroupLimit"]


def plan_of(df):
    return df._jdf.queryExecution().toString()


def tables(spark):
    base = spark.createDataFrame(
        [("1", "a", 10), (" 2 ", "b", 20), (None, "c", 30), ("9", "d", 40)],
        "k string, v string, pos_x int")
    new = spark.createDataFrame(
        [(1.0, "x", "p", 1), (1.0, "y", "q", 2), (2.0, "z", "p", 3), (None, "n", "p", 4),
         (7.0, "w", "p", 5)],
        "k double, v string, f string, o int")
    return base, new


def test_left_merge_harmonises_collapses_and_matches_null(spark, rows):
    base, new = tables(spark)
    out = merge(base, new, ["k"], order_by=["o"])
    assert out.columns == ["k", "v", "pos_x", "f", "o"]
    assert rows(out) == [(None, "c", 30, "p", 4), ("1", "a", 10, "p", 1), ("2", "b", 20, "p", 3),
                         ("9", "d", 40, None, None)]
    never = merge(base, new, ["k"], order_by=["o"], null_keys="never")
    assert (None, "c", 30, None, None) in rows(never)


@pytest.mark.parametrize("how,keys", [
    ("left", [None, "1", "2", "9"]), ("inner", [None, "1", "2"]),
    ("right", [None, "1", "2", "7"]), ("outer", [None, "1", "2", "7", "9"])])
def test_join_kinds(spark, rows, how, keys):
    base, new = tables(spark)
    out = merge(base, new, ["k"], how, order_by=["o"])
    assert [r[0] for r in rows(out, "k")] == keys
    if how in ("right", "outer"):
        alone = out.where("k = '7'").first()
        assert (alone["v"], alone["pos_x"], alone["f"], alone["o"]) == (None, None, "p", 5)


def test_fan_out_without_collapse(spark):
    base, new = tables(spark)
    assert merge(base, new, ["k"], collapse_duplicates=False).count() == 5


def test_filter_runs_before_collapse(spark, rows):
    base, new = tables(spark)
    out = merge(base, new, ["k"], filters={"f": " q ", "absent": 1}, collision="keep_new")
    assert rows(out, "k", "v", "f") == [
        (None, None, None), ("1", "y", "q"), ("2", None, None), ("9", None, None)]


def test_filter_on_a_key_and_on_numbers(spark, rows):
    base, new = tables(spark)
    assert rows(merge(base, new, ["k"], "inner", filters={"k": 2}), "k") == [("2",)]
    typed = merge(base, new, ["k"], "inner", filters={"o": "3"})
    assert dict(typed.dtypes)["o"] == "string" and rows(typed, "o") == [("3",)]


@pytest.mark.parametrize("rule,columns,value", [
    ("keep_base", ["k", "v", "pos_x", "f", "o"], ("a",)),
    ("keep_new", ["k", "pos_x", "v", "f", "o"], ("x",)),
    ("keep_both", ["k", "v_base", "pos_x", "v_new", "f", "o"], ("a", "x")),
    ("suffix", ["k", "v_x", "pos_x", "v_y", "f", "o"], ("a", "x"))])
def test_collisions(spark, rule, columns, value):
    base, new = tables(spark)
    out = merge(base, new, ["k"], collision=rule, order_by=["o"])
    assert out.columns == columns
    shared = [c for c in columns if c.startswith("v")]
    assert tuple(out.where("k = '1'").select(shared).first()) == value


def test_resolving_an_earlier_join(spark):
    df = spark.createDataFrame([(1, "a", "b", 5)], "k int, v_x string, v_y string, pos_x int")
    assert resolve_collisions(df).columns == ["k", "v", "pos_x"]
    assert resolve_collisions(df, "keep_new").first()["v"] == "b"
    assert resolve_collisions(df, "keep_both").columns == ["k", "v_base", "v_new", "pos_x"]
    with pytest.raises(ValueError):
        resolve_collisions(df, "other")


def test_case_only_differences_collide(spark):
    base = spark.createDataFrame([(1, 2)], "k int, Age int")
    new = spark.createDataFrame([(1, 3)], "k int, AGE int")
    assert tuple(merge(base, new, ["k"]).first()) == ("1", 2)


def test_bad_arguments(spark):
    base, new = tables(spark)
    with pytest.raises(ValueError):
        merge(base, new, [])
    with pytest.raises(ValueError):
        merge(base, new, ["k"], how="cross")
    with pytest.raises(KeyError):
        merge(base, new, ["absent"])
    assert merge(base, new, ["absent"], on_missing_key="skip").columns == base.columns


def test_like_pandas_merge(spark, rows):
    left = pd.DataFrame({"k": ["1", "2", "2", "3"], "a": [1, 2, 3, 4]})
    right = pd.DataFrame({"k": ["2", "3", "3", "5"], "b": [5, 6, 7, 8]})
    for how in ("left", "inner", "right", "outer"):
        want = left.merge(right, on="k", how=how).astype(object)
        want = sorted(tuple(None if pd.isna(v) else v for v in r) for r in want.values.tolist())
        out = merge(spark.createDataFrame(left), spark.createDataFrame(right), ["k"], how,
                    collapse_duplicates=False)
        key = lambda r: [(v is not None, str(v)) for v in r]
        assert rows(out) == sorted(want, key=key)


def test_hot_key_is_split_by_adaptive_execution(spark):
    names = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        base = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 5000)
            .cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        new = spark.range(0, 5000, 1, 8).select(F.col("id").cast("string").alias("k"),
                                                (F.col("id") * 2).alias("w"))
        second = new.withColumnRenamed("w", "w2")
        out = merge(merge(base, new, ["k"]), second, ["k"])
        assert out.agg(F.count("v")).first()[0] == 60_000
        grouped = out.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v"))
        grouped.collect()
        assert "skew=true" in plan_of(grouped)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def visits(spark):
    return spark.createDataFrame(
        [("p", 1, "a"), ("p", 3, "b"), ("p", None, "c"), ("q", 2, "d"), (None, 5, "e"), (None, 4, "f")],
        "id string, day int, v string")


@pytest.mark.parametrize("keep,ascending,want", [
    ("first", True, "adf"), ("last", True, "cde"), ("first", False, "bde"), ("last", False, "cdf")])
def test_keep_first_and_last(spark, keep, ascending, want):
    out = deduplicate(visits(spark), ["id"], keep, ["day"], ascending)
    assert "".join(sorted(r["v"] for r in out.collect())) == want
    pdf = visits(spark).toPandas().sort_values("day", ascending=ascending)
    assert "".join(sorted(pdf.drop_duplicates("id", keep=keep)["v"])) == want


def test_keep_none_and_whole_rows(spark, rows):
    df = visits(spark)
    assert rows(deduplicate(df, ["id"], False)) == [("q", 2, "d")]
    twice = df.union(df.where("id = 'p'"))
    assert deduplicate(twice).count() == 6
    assert rows(deduplicate(twice, keep=False), "v") == [("d",), ("e",), ("f",)]
    assert deduplicate(twice, keep=False).columns == df.columns
    once = deduplicate(df, ["id"], "first", ["day"])
    assert rows(deduplicate(once, ["id"], "first", ["day"])) == rows(once)


def test_dedupe_bad_arguments(spark):
    with pytest.raises(ValueError):
        deduplicate(visits(spark), ["id"], "middle")
    with pytest.raises(KeyError):
        deduplicate(visits(spark), ["absent"])


def test_hot_group_is_reduced_before_the_shuffle(spark):
    plan = plan_of(deduplicate(visits(spark), ["id"], "last", ["day"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_sort_puts_missing_last_both_ways(spark):
    df = visits(spark)
    assert [r["day"] for r in sort_rows(df, ["day"]).collect()][-1] is None
    assert [r["day"] for r in sort_rows(df, ["day"], False).collect()] == [5, 4, 3, 2, 1, None]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_merges_on_one_key_shuffle_the_base_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.createDataFrame([(" 1 ", 1)], "k string, v int")
        news = [spark.createDataFrame([(1.0, i)], f"k double, w{i} int") for i in range(3)]
        out = base
        for new in news:
            out = merge(out, new, ["k"])
        # Each incoming table: once for the collapse, once for the join.
        assert exchanges(out) == 1 + 2 * 3
        assert out.collect() == [("1", 1, 0, 1, 2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_number_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "n.parquet")
    spark.createDataFrame([(1, 5, 2.0, "x")], "k int, o int, d double, unused string").write.parquet(path)
    base = spark.createDataFrame([(1,)], "k int")
    out = merge(base, spark.read.parquet(path), ["k"], filters={"o": "5", "d": 2}).select("k", "o")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o,5)" in plan and "EqualTo(d,2.0)" in plan
    assert out.collect() == [("1", "5")]


def test_text_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(" R ", 1), ("R", 2), ("RA", 3), (None, 4), ("x", 5)], "f string, i int").write.parquet(path)
    kept = filter_equal(spark.read.parquet(path), {"f": " R "})
    assert sorted(r["i"] for r in kept.collect()) == [1, 2]
    assert "StringContains(f,R)" in kept._jdf.queryExecution().executedPlan().toString()


def test_key_filter_leaves_out_rows_before_they_are_shuffled(spark, rows):
    from tidyforge.operators.merge import with_known_keys
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (7, "d")], "k int, v string")
    new = spark.range(20000).selectExpr("CASE WHEN id % 50 > 0 THEN id % 5000 END AS k",
                                        "CAST(id AS STRING) AS w", "id % 3 AS z")
    for how in ("left", "inner", "right", "outer"):
        plain = merge(base, new, ["k"], how=how, order_by=["w"])
        assert rows(merge(base, new, ["k"], how=how, order_by=["w"], key_filter=True)) == rows(plain)
    words = new.withColumn("k", F.concat(F.lit(" K"), "k"))
    named = base.withColumn("k", F.concat(F.lit("k"), "k"))
    assert rows(merge(named, words, ["k"], order_by=["w"], key_filter=True)) == rows(
        merge(named, words, ["k"], order_by=["w"]))
    left = with_known_keys(base, new, ["k"])
    assert left.columns == new.columns
    assert new.count() == 20000 and left.count() == new.where("k in (1, 2, 7) or k is null").count()
    plan = merge(base, new, ["k"], order_by=["w"], key_filter=True)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
