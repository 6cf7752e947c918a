"""Imputation, features, encoding, scaling and units."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tidyforge.operators.encode import (OneHotEncoder, VectorOneHotEncoder, VectorOneHotModel,
                                        encode_categorical, encodable, one_hot_sparse, one_hot_vector)
from tidyforge.operators.features import (FeatureEngineer, binarize, bin_by_edges, custom_row_logic,
                                          date_parts, engineer_features, log_transform,
                                          polynomial_interaction, quantile_binning)
from tidyforge.operators.format import ModelFormatter, ModelFormatterModel, format_for_ml
from tidyforge.operators.impute import (MissingValueImputer, impute_missing, missing_percent,
                                        missingness_report)
from tidyforge.operators.scale import NumericScaler, flag_stats, scale_numeric
from tidyforge.operators.udf import apply_custom_function
from tidyforge.operators.units import normalize_units, unconverted_units

NAN = float("nan")


def patients(spark):
    return spark.createDataFrame(
        [(1, 20, 1.5, "b", None, None), (2, None, None, "a", None, "x"), (3, 40, NAN, "a", None, None),
         (4, 50, 4.5, "b", None, None), (5, 90, 6.0, None, None, None)],
        "i int, age int, bmi double, site string, empty double, notes string").repartition(3)


# ------------------------------------------------------------------ imputation

def test_missingness(spark, rows):
    df = patients(spark)
    assert missing_percent(df, ["i", "bmi"]) == {"i": 0.0, "bmi": 40.0}
    report = [tuple(r) for r in missingness_report(df).collect()]
    assert report == [("empty", 100.0), ("notes", 80.0), ("bmi", 40.0), ("age", 20.0), ("site", 20.0)]


def test_fill_methods(spark, rows):
    df = patients(spark)
    mean = MissingValueImputer(["age", "site", "absent"], "mean").fit(df)
    assert mean.fill_values == {"age": 50.0}
    out = mean.transform(df)
    assert dict(out.dtypes)["age"] == "double"
    assert rows(out.where("i = 2"), "age") == [(50.0,)]
    assert MissingValueImputer(["age", "bmi"], "median").fit(df).fill_values == {"age": 45.0, "bmi": 4.5}
    mode = MissingValueImputer(None, "mode").fit(df).fill_values
    assert mode == {"i": 1, "age": 20, "bmi": 1.5, "site": "a", "notes": "x"}
    constant = MissingValueImputer(["notes", "bmi"], "constant", constant_val=0).fit(df).transform(df)
    assert constant.where("notes = '0'").count() == 4 and constant.where("bmi = 0").count() == 2
    with pytest.raises(ValueError):
        MissingValueImputer(method="other")


def test_fit_on_one_table_and_fill_another(spark):
    model = MissingValueImputer(["bmi"], "mean", drop_threshold=50.0).fit(patients(spark))
    assert sorted(model.drop_columns) == ["empty", "notes"]
    other = spark.createDataFrame([(None, 1.0)], "bmi double, empty double")
    out = model.transform(other)
    assert out.columns == ["bmi"] and out.first()["bmi"] == 4.0


def test_threshold_is_strict(spark):
    df = patients(spark)
    assert "bmi" in impute_missing(df, 40.0).columns
    assert "bmi" not in impute_missing(df, 39.9).columns
    assert impute_missing(df, None).columns == df.columns


def test_first_defined_strategy_wins(spark):
    out = impute_missing(patients(spark), None, [
        {"cols": ["empty", "age"], "method": "mean"},
        {"cols": ["empty", "age"], "method": "constant", "constant_val": 7},
        {"cols": ["site"], "method": "constant", "constant_val": None},
        {"cols": ["site"], "method": "mode"}, {"method": "constant", "constant_val": 1}])
    got = out.where("i = 2 or i = 5").orderBy("i").collect()
    assert [r["empty"] for r in got] == [7.0, 7.0]
    assert [r["age"] for r in got] == [50.0, 90.0] and got[1]["site"] == "a"


# ------------------------------------------------------------------ features

def test_simple_features(spark):
    df = patients(spark)
    out = binarize(df, "bmi", 2.0)
    assert [r["bmi_binarized"] for r in out.orderBy("i").collect()] == [0, 0, 0, 1, 1]
    assert binarize(df, "site", 1).columns == df.columns == log_transform(df, "absent").columns
    logs = log_transform(spark.createDataFrame([(0.0,), (-1.0,), (-2.0,), (NAN,), (1.0,)], "v double"), "v")
    assert [r["v_log"] for r in logs.collect()] == [0.0, None, None, None, math.log(2)]
    square = polynomial_interaction(df, "age", "age", "age2").where("i = 1").first()
    assert square["age2"] == 400
    assert polynomial_interaction(df, "age", "absent").columns == df.columns
    assert "age_x_bmi" in polynomial_interaction(df, "age", "bmi").columns


def test_date_parts(spark):
    df = spark.sql("select timestamp '2024-02-29 13:00:00' as d")
    assert tuple(date_parts(df, "d", ["year", "month", "day", "hour"]).first())[1:] == (2024, 2, 29, 13)
    assert date_parts(df, "absent").columns == ["d"]
    with pytest.raises(ValueError):
        date_parts(df, "d", ["century"])


@pytest.mark.parametrize("q", [2, 4, 7])
def test_bins_like_pandas(spark, q):
    rng = np.random.default_rng(1)
    values = np.where(rng.random(300) < 0.35, 5.0, rng.normal(5, 3, 300))
    pdf = pd.DataFrame({"i": range(300), "v": values})
    pdf.loc[7, "v"] = np.nan
    out = quantile_binning(spark.createDataFrame(pdf), "v", q).toPandas().sort_values("i")
    want = pd.qcut(pdf["v"], q, duplicates="drop")
    assert [None if pd.isna(x) else str(x) for x in want] == \
        [None if pd.isna(x) else x for x in out[f"v_q{q}_bins"]]
    codes = quantile_binning(spark.createDataFrame(pdf), "v", q, codes=True, new_column_name="c")
    got = [None if pd.isna(x) else int(x) for x in codes.toPandas().sort_values("i")["c"]]
    assert got == [None if x < 0 else int(x) for x in want.cat.codes]


def test_bins_edge_cases(spark):
    constant = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert {r[1] for r in quantile_binning(constant, "v", 4).collect()} == {None}
    with pytest.raises(ValueError):
        quantile_binning(spark.range(10), "id", 4, labels=["a", "b"])
    named = quantile_binning(spark.range(10), "id", 2, labels=["lo", "hi"])
    assert [r[1] for r in named.orderBy("id").collect()] == ["lo"] * 5 + ["hi"] * 5
    with pytest.raises(ValueError):
        bin_by_edges(F.col("id"), [0.0, 1.0, 2.0], ["a"])


def test_feature_steps_learn_once_and_see_earlier_steps(spark):
    df = spark.range(1, 9).select(F.col("id").cast("double").alias("v"))
    steps = [{"tool": "log_transform", "col": "v"},
             {"tool": "quantile_binning", "column": "v_log", "q": 2, "codes": True},
             {"tool": "quantile_binning", "column": "v", "q": 4, "labels": list("abcd")},
             {"tool": "custom_logic", "new_column_name": "w", "custom_func": lambda c: c["v"] * 2}]
    model = FeatureEngineer(steps).fit(df)
    out = model.transform(df).orderBy("v").collect()
    assert [r["v_log_q2_bins"] for r in out] == [0] * 4 + [1] * 4
    assert "".join(r["v_q4_bins"] for r in out) == "aabbccdd"
    assert out[0]["w"] == 2.0
    other = model.transform(spark.createDataFrame([(8.0,), (100.0,)], "v double")).collect()
    assert [r["v_q4_bins"] for r in other] == ["d", None]


def test_bad_steps_raise(spark):
    for step in ({"tool": "sorcery"}, {"column": "v"}, {"tool": "binarize", "column": "v"},
                 {"tool": "log_transform", "column": "v", "base": 2}):
        with pytest.raises(ValueError):
            engineer_features(spark.range(3), [step])
    assert engineer_features(spark.range(3), None).columns == ["id"]


def test_user_functions(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "t string, i int")
    assert rows(apply_custom_function(df, ["t", "absent"], lambda x: x * 2, "string"), "t") == \
        [("aa",), ("bb",)]
    assert rows(apply_custom_function(df, ["i"], lambda c: c + 1), "i") == [(2,), (3,)]
    out = custom_row_logic(df, "s", lambda row: f"{row['t']}{row.i}", "string")
    assert rows(out, "s") == [("a1",), ("b2",)]
    with pytest.raises(TypeError):
        apply_custom_function(df, ["i"], lambda c: 1)


# ------------------------------------------------------------------ encoding, scaling

def test_one_hot_like_pandas(spark):
    pdf = pd.DataFrame({"i": [1, 2, 3, 4], "t": ["b", "a", None, "c"], "f": [1.0, 2.5, 1.0, 1.0],
                        "b": [True, False, True, True]})
    for drop in (True, False):
        want = pd.get_dummies(pdf, columns=["t", "f", "b"], drop_first=drop, dtype=int)
        out = encode_categorical(spark.createDataFrame(pdf), ["t", "f", "b", "absent"], drop)
        assert out.columns == list(want.columns)
        got = out.toPandas().sort_values("i").reset_index(drop=True)
        assert got.astype("int64").equals(want.astype("int64"))


def test_one_hot_on_other_data_and_limits(spark):
    df = spark.createDataFrame([("a",), ("b",)], "t string")
    model = OneHotEncoder(["t"], drop_first=False).fit(df)
    other = spark.createDataFrame([("z",), ("b",)], "t string")
    assert sorted(tuple(r) for r in model.transform(other).collect()) == [(0, 0), (0, 1)]
    with pytest.raises(ValueError, match="too many"):
        OneHotEncoder(["t"], max_categories=1).fit(df)
    both = encode_categorical(spark.createDataFrame([("x",), ("X",)], "t string"), ["t"], False)
    assert both.columns == ["t_X_0", "t_x_1"]


def test_sparse_form_agrees_with_columns(spark):
    df = spark.createDataFrame([(1, "a", "p"), (2, "b", None), (3, None, "q"), (4, "c", "q")],
                               "i int, t string, u string")
    wide = encode_categorical(df, ["t", "u"]).collect()
    sparse = {r["i"]: set(r["active_dummies"]) for r in one_hot_sparse(df, ["t", "u"]).collect()}
    for r in wide:
        assert sparse[r["i"]] == {c for c, v in r.asDict().items() if c != "i" and v == 1}


def test_encodable_names(spark):
    df = spark.createDataFrame([("", "", "", "", 1)],
                               "id_code string, Lnk_a string, sitename string, t string, n int")
    assert encodable(df, ("ID", "LNK_", "SITE")) == ["t"]
    assert encodable(df, (), ["t"]) == ["id_code", "Lnk_a", "sitename"]


@pytest.mark.parametrize("method", ["standard", "minmax", "robust"])
def test_scaling(spark, method):
    rng = np.random.default_rng(3)
    x = rng.normal(10, 4, 501)
    pdf = pd.DataFrame({"i": range(501), "x": x, "c": 5.0, "n": None})
    df = spark.createDataFrame(pdf.astype({"n": "float64"}))
    out = scale_numeric(df, ["x", "c", "n", "absent"], method).toPandas().sort_values("i")
    center, spread = {
        "standard": (x.mean(), x.std()), "minmax": (x.min(), x.max() - x.min()),
        "robust": (np.median(x), np.subtract(*np.quantile(x, [0.75, 0.25])))}[method]
    np.testing.assert_allclose(out["x"], (x - center) / spread, rtol=1e-9, atol=1e-9)
    assert (out["c"] == 0).all() and out["n"].isna().all()


def test_scaling_keeps_missing_and_rejects_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert sorted(r[0] for r in scale_numeric(df, ["v"]).dropna().collect()) == [-1.0, 1.0]
    assert scale_numeric(df, ["v"]).where("v is null").count() == 1
    assert scale_numeric(df, ["v"], "other") is df
    with pytest.raises(ValueError):
        NumericScaler(["v"], "other")


def test_dummy_statistics_follow_from_counts():
    flags = np.repeat([0.0, 1.0], [7, 4])
    found = flag_stats(4, 11)
    assert found["mean"] == flags.mean() and math.isclose(found["std"], flags.std())
    assert found["quartiles"] == list(np.quantile(flags, [0.25, 0.5, 0.75]))


def test_format_stage(spark):
    df = spark.createDataFrame([(1, 2.0, "a", "s", 3), (2, 4.0, "b", "t", 5)],
                               "ID int, x double, t string, SITE_A string, k int")
    out = format_for_ml(df, exclude_scale_cols=["k"]).orderBy("ID").collect()
    assert out[0].asDict() == {"ID": 1, "x": -1.0, "SITE_A": "s", "k": 3, "t_b": 0}
    assert format_for_ml(df, scale_method="odd").first()["x"] in (2.0, 4.0)
    assert format_for_ml(df, encode_categorical=False, scale_method=None).columns == df.columns
    scaled = ModelFormatter(scale_dummies=True).fit(df).transform(df).orderBy("ID").collect()
    assert [r["t_b"] for r in scaled] == [-1.0, 1.0]
    assert "t" in format_for_ml(df, keys=["t"]).columns


def test_stages_fit_into_an_ml_pipeline_and_a_stream(spark, tmp_path):
    df = patients(spark).drop("empty", "notes")
    stages = [MissingValueImputer(["age", "bmi"], "median"), MissingValueImputer(["site"], "mode"),
              FeatureEngineer([{"tool": "binarize", "column": "age", "threshold": 45},
                               {"tool": "quantile_binning", "column": "bmi", "q": 2, "codes": True}]),
              ModelFormatter(exclude_encode_prefixes=("ID",), exclude_scale_cols=["i"])]
    model = Pipeline(stages=stages).fit(df)
    batch = model.transform(df)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = model.transform(stream).writeStream.format("memory").queryName("scored") \
        .trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("scored").collect())) == sorted(map(tuple, batch.collect()))


# ------------------------------------------------------------------ units

GLUCOSE = [{"value_col": "g", "unit_col": "u", "canonical": "mg/dL",
            "conversions": {"mmol/L": 10.0, "umol/L": 0.01}},
           {"value_col": "absent", "unit_col": "u", "canonical": "x"},
           {"value_col": "g", "canonical": "x"}]


def test_units(spark, rows):
    df = spark.createDataFrame([(1, "mg/dL"), (2, " mmol/L "), (300, "umol/L"), (4, "odd"), (5, None)],
                               "g int, u string")
    assert rows(normalize_units(df, GLUCOSE)) == sorted(
        [(1.0, "mg/dL"), (20.0, "mg/dL"), (3.0, "mg/dL"), (4.0, "odd"), (5.0, None)],
        key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows(unconverted_units(df, GLUCOSE)) == [("g", "odd", 1)]
    lowered = df.withColumn("u", F.lower("u"))
    assert normalize_units(lowered, GLUCOSE, F.lower).where("u = 'mg/dL'").count() == 3
    assert normalize_units(df, None) is df
    assert unconverted_units(df, []).count() == 0


def test_saved_pipeline_gives_the_same_rows(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from tidyforge.operators.clean import TableCleaner
    from tidyforge.operators.features import FeatureEngineer
    from tidyforge.operators.format import ModelFormatter
    from tidyforge.operators.impute import MissingValueImputer

    df = spark.createDataFrame(
        [(1, 2.0, " A ", 5.0), (2, None, "b", 7.0), (3, 4.5, None, 1.0), (4, 8.0, "B", None)] * 3,
        "ID int, v double, t string, w double")
    for encoding in ("columns", "sparse"):
        pipeline = Pipeline(stages=[
            TableCleaner(string_columns=["t"], string_options={"lowercase": True, "strip_whitespace": True},
                         category_mappings=[{"column": "t", "regex_mapping": {"^a$": "first"}}]),
            MissingValueImputer(["v"], "median"), MissingValueImputer(["t"], "mode"),
            MissingValueImputer(["w"], "constant", constant_val=0),
            FeatureEngineer([{"tool": "quantile_binning", "column": "v", "q": 2, "codes": True},
                             {"tool": "binarize", "column": "w", "threshold": 3}]),
            ModelFormatter(scale_method="robust", encoding=encoding)])
        path = str(tmp_path / encoding)
        pipeline.write().save(path + "-stages")
        model = Pipeline.load(path + "-stages").fit(df)
        model.write().save(path)
        want, got = pipeline.fit(df).transform(df), PipelineModel.load(path).transform(df)
        assert got.columns == want.columns == model.transform(df).columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_functions_cannot_be_saved(spark, tmp_path):
    from tidyforge.operators.features import FeatureEngineer
    step = {"tool": "custom_row_logic", "new_column_name": "x", "func": lambda row: row["v"], "uses": ["v"]}
    model = FeatureEngineer([step]).fit(spark.range(2).withColumnRenamed("id", "v"))
    assert model.transform(spark.range(2).withColumnRenamed("id", "v")).columns == ["v", "x"]
    with pytest.raises(ValueError, match="functions"):
        model.write().save(str(tmp_path / "f"))


def test_any_number_of_categories_and_names_that_differ_in_case(spark):
    from tidyforge.operators.encode import OneHotEncoder
    df = spark.range(2500).selectExpr("concat('v', id) AS t")
    assert len(OneHotEncoder(["t"], drop_first=False).fit(df).dummies()) == 2500
    with pytest.raises(ValueError, match="too many"):
        OneHotEncoder(["t"], max_categories=100).fit(df)
    both = spark.createDataFrame([("A",), ("a",), ("b",)], "t string")
    out = OneHotEncoder(["t"], drop_first=False).fit(both).transform(both)
    assert sorted(out.columns) == ["t_A_0", "t_a_1", "t_b"]
    assert sorted(map(tuple, out.select("t_A_0", "t_a_1", "t_b").collect())) == [
        (0, 0, 1), (0, 1, 0), (1, 0, 0)]


def test_quantiles_are_narrowed_at_any_size(spark, monkeypatch):
    from tidyforge.operators import stats
    narrowed = []
    real = stats._narrow
    monkeypatch.setattr(stats, "_narrow", lambda *a: (narrowed.append(1), real(*a))[1])
    df = spark.range(50).selectExpr("CAST(id AS DOUBLE) AS v")
    assert stats.exact_quantiles(df, {"v": [0.5, 1.0]}) == {"v": [24.5, 49.0]} and narrowed


# ---------------------------------------------------------------- vectors of dummies

def test_vector_encoding_of_any_number_of_categories(spark, tmp_path):
    rows = [(i, f"t{i % 900:03d}" if i % 7 else None, ["b", "a", None][i % 3], float(i % 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, t string, s string, x double").repartition(5)
    model = VectorOneHotEncoder(["t", "s", "x", "not_there"]).fit(df)
    names = {c: sorted({r[k] for r in rows if r[k] is not None}) for k, c in ((1, "t"), (2, "s"), (3, "x"))}
    places = {}
    for c in ("t", "s", "x"):
        for v in names[c][1:]:
            places[c, v] = len(places)
    assert model.size == len(places) == model.dictionary.count()
    out = model.transform(df)
    assert out.columns == ["i", "dummies"]
    for r in out.collect():
        own = rows[r["i"]]
        want = [places[c, own[k]] for k, c in ((1, "t"), (2, "s"), (3, "x")) if (c, own[k]) in places]
        assert r["dummies"].size == model.size and r["dummies"].indices.tolist() == want
    model.save(str(tmp_path / "m"))
    again = VectorOneHotModel.load(str(tmp_path / "m"))
    assert sorted(map(str, again.transform(df).collect())) == sorted(map(str, out.collect()))
    unseen = spark.createDataFrame([(1, "new", "a", None)], df.schema)
    assert model.transform(unseen).first()["dummies"].indices.tolist() == []
    every = one_hot_vector(df, ["s"], drop_first=False, output="v")
    assert every.columns == ["i", "t", "x", "v"] and every.first()["v"].size == 2
    assert one_hot_vector(df.limit(0), ["s"]).count() == 0


def test_formatter_with_vectors_saves_its_dictionary(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, "c")], "x double, s string")
    model = ModelFormatter(encoding="vector").fit(df)
    model.save(str(tmp_path / "f"))
    again = ModelFormatterModel.load(str(tmp_path / "f"))
    assert [str(r) for r in again.transform(df).collect()] == [str(r) for r in model.transform(df).collect()]
    assert again.transform(df).first()["dummies"].size == 2
    with pytest.raises(ValueError):
        ModelFormatter(encoding="vector", scale_dummies=True)
