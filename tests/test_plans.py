"""The whole run, its configuration, and tuning."""

import os

import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidyforge import StageReport, parameter_template, process_data, process_data_from_config
from tidyforge.operators.tune import (FOLD, HyperparameterTuner, assign_folds, grid_points,
                                      hyper_parameter_tuner, random_points)
from tidyforge.session import materialize, shared_folder

VITALS = """ID,BMI,Blood_Pressure,Smoking_Status,Cigarettes_Per_Day,Telomere_Length,Sparse,Site_Code
1,20.0,120,Never,0,1.0,,s1
2,NaN,130, never ,0,2.0,,s1
3,30.0,,SMOKER,10,3.0,x,s2
4,25.0,110,,,4.0,,s2
4,25.0,110,,,4.0,,s2
5,22.0,140,Never,5,5.0,,s1
"""


@pytest.fixture
def vitals(tmp_path):
    path = tmp_path / "vitals.csv"
    path.write_text(VITALS)
    return str(path)


def test_vitals_scenario(spark, vitals, tmp_path):
    out_file = str(tmp_path / "master.csv")
    report = StageReport()
    out = process_data(
        spark, vitals, out_file,
        clean_options={"lowercase": True, "strip_whitespace": True, "universal_text_scrubber": True},
        impute_strategies=[{"cols": ["BMI", "Blood_Pressure"], "method": "median"},
                           {"cols": ["Smoking_Status"], "method": "mode"}],
        feature_steps=[{"tool": "binarize", "column": "Cigarettes_Per_Day", "threshold": 0},
                       {"tool": "quantile_binning", "column": "Telomere_Length", "q": 4}],
        drop_threshold=40.0, scale_method="robust", exclude_scale_cols=["Cigarettes_Per_Day_binarized"],
        report=report)
    assert "Sparse" not in out.columns and "Site_Code" in out.columns
    assert "Smoking_Status_smoker" in out.columns and "Smoking_Status_never" not in out.columns
    assert [c for c in out.columns if c.startswith("Telomere_Length_q4_bins_")] == [
        "Telomere_Length_q4_bins_(2.0, 3.0]", "Telomere_Length_q4_bins_(3.0, 4.0]",
        "Telomere_Length_q4_bins_(4.0, 5.0]"]
    got = {r["ID"]: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    # BMI 20, 23.5 (median), 30, 25, 22: median 23.5, IQR 3
    assert got[2]["BMI"] == 0.0 and got[1]["BMI"] == pytest.approx(-3.5 / 3)
    assert [got[i]["Cigarettes_Per_Day_binarized"] for i in range(1, 6)] == [0, 0, 1, 0, 1]
    assert spark.read.csv(out_file, header=True).count() == 5
    found = {(r["stage"], r["metric"]): r["value"] for r in report.to_df(spark).collect()}
    assert found == {("load", "rows"): 6, ("deduplicate", "rows"): 5, ("impute", "dropped_columns"): 1,
                     ("save", "rows"): 5}
    assert StageReport().to_df(spark).columns == ["stage", "metric", "value"]


def test_config_run_discovers_and_merges(spark, tmp_path, vitals):
    extra = tmp_path / "extra"
    extra.mkdir()
    (extra / "labs.csv").write_text("ID,Lab,G,U,BMI\n1.0,First,5,MMOL,9\n1,second,6,MMOL,9\n2,A,7,mg,9\n")
    (extra / "site.csv").write_text("ID,kind\n 3 ,zzz\n")
    config = parameter_template()
    config |= {"primary_file": vitals, "output_file": None, "dir_path": str(extra), "on_keys": ["ID"],
               "scale_method": None, "drop_threshold": None, "encode_categorical": False,
               "lab_configs": [{"value_col": "G", "unit_col": "U", "canonical": "mg",
                                "conversions": {"Mmol": 10}}]}
    out = process_data_from_config(spark, config)
    got = {r["ID"]: r for r in out.collect()}
    assert got["1"]["Lab"] == "first" and got["1"]["G"] == 50.0 and got["1"]["U"] == "mg"
    assert got["2"]["G"] == 7.0 and got["3"]["kind"] == "zzz" and got["1"]["BMI"] == 20.0
    assert config["on_keys"] == ["ID"]


def test_merge_filters_see_cleaned_text_and_numeric_keys(spark):
    base = spark.createDataFrame([(1, "A"), (2, "B")], "ID int, t string")
    new = spark.createDataFrame([("1", "ABC", 4), ("2", "X", 5)], "ID string, SITE string, w int")
    out = process_data(spark, base, merge_configs=[
        {"file": new, "on": ["ID"], "filters": {"SITE": "ABC"}, "order_by": ["w"]}],
        scale_method=None, encode_categorical=False, drop_threshold=None)
    assert {r["ID"]: r["w"] for r in out.collect()} == {"1": 4, "2": None}


def test_config_errors(spark):
    with pytest.raises(TypeError):
        process_data_from_config(spark, ["x"])
    with pytest.raises(ValueError):
        process_data_from_config(spark, {})
    with pytest.raises(ValueError, match="unknown"):
        process_data_from_config(spark, {"primary_file": "x.csv", "colour": 1})


def test_tables_are_cut_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    before = len(os.listdir(folder))
    df = materialize(spark.range(5).withColumn("x.y", F.lit("a")).withColumn("(0, 1] =;", F.lit(None)))
    assert df.count() == 5 and df.columns == ["id", "x.y", "(0, 1] =;"] and len(os.listdir(folder)) == before + 1


# ------------------------------------------------------------------ tuning

def points(spark):
    return spark.range(300).select(
        "id", ((F.col("id") * 7) % 31).cast("double").alias("a"),
        ((F.col("id") * 13) % 17).cast("double").alias("b"),
        F.when(((F.col("id") * 7) % 31) + ((F.col("id") * 13) % 17) > 23, 1.0).otherwise(0.0).alias("y"),
        (((F.col("id") * 7) % 31) * 2.0 + 1).alias("z"))


def test_grid_and_random_points():
    space = {"p": [1, 2, 3], "q": ["a", "b"]}
    assert len(grid_points(space)) == 6 and {"p": 2, "q": "b"} in grid_points(space)
    drawn = random_points(space, 4, 42)
    assert drawn == random_points(space, 4, 42) and len({str(d) for d in drawn}) == 4
    assert len(random_points(space, 50, 1)) == 6
    assert len(random_points({"p": lambda rng: rng.random()}, 5, 1)) == 5


def test_folds_are_stratified_and_stable(spark):
    df = points(spark)
    folds = assign_folds(df, "y", ["id"], 5)
    counts = folds.groupBy("y", FOLD).count().collect()
    for label in (0.0, 1.0):
        sizes = [r["count"] for r in counts if r["y"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    again = assign_folds(df.repartition(7), "y", ["id"], 5)
    assert sorted(map(tuple, folds.select("id", FOLD).collect())) == \
        sorted(map(tuple, again.select("id", FOLD).collect()))


def test_copies_are_dealt_out_evenly(spark):
    copies = materialize(points(spark).withColumn("id", F.when(F.col("id") < 100, 0).otherwise(F.col("id"))))
    folds = assign_folds(copies.repartition(6), "y", ["id"], 5)
    for label in (0.0, 1.0):
        sizes = [r["count"] for r in folds.where(F.col("y") == label).groupBy(FOLD).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert folds.count() == 300 and folds.columns == [*copies.columns, FOLD]
    odd = assign_folds(points(spark).withColumn("y", F.lit(None).cast("double")), "y", ["id"], 3)
    assert sorted(r["count"] for r in odd.groupBy(FOLD).count().collect()) == [100, 100, 100]


def test_folds_do_not_follow_the_number_of_rows_per_task(spark, tmp_path):
    wanted = None
    for rows in (10, 100, 100_000):
        path = str(tmp_path / str(rows))
        points(spark).repartition(3).write.option("maxRecordsPerFile", rows).parquet(path)
        folds = assign_folds(spark.read.parquet(path), "y", ["id"], 5)
        found = sorted(map(tuple, folds.select("id", FOLD).collect()))
        assert wanted is None or found == wanted
        wanted = found


def test_scores_have_the_usual_meaning(spark):
    from tidyforge.operators.tune import evaluator_for
    scored = spark.createDataFrame(
        [(1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "prediction double, y double")
    assert evaluator_for("f1", True, "y").evaluate(scored) == pytest.approx(0.5)
    assert evaluator_for("f1_weighted", True, "y").evaluate(scored) == pytest.approx(2 / 3)
    tuner = HyperparameterTuner(LinearRegression(), {"regParam": [0.0, 50.0]}, "grid", cv=3,
                                scoring="neg_mean_squared_error")
    tuner.fit(points(spark), "z", ["a"], ["id"])
    assert tuner.best_params_ == {"regParam": 0.0} and -1 < tuner.best_score_ <= 0


def test_work_tables_are_released(spark):
    import os
    from tidyforge.session import WorkTables
    with WorkTables(spark) as tables:
        materialize(spark.range(3), "gone")
    kept = materialize(spark.range(3), "stays")
    folder = tables.paths[0].removeprefix("file:")
    assert len(tables.paths) == 1 and os.path.exists(folder)
    tables.release()
    assert not os.path.exists(folder) and kept.count() == 3


def test_chain_of_outer_merges(spark):
    from tidyforge.plans.prepare import merge_datasets
    base = spark.createDataFrame([(1, "a")], "k int, v string")
    rules = [{"file": spark.createDataFrame([(i, i), (1, i)], f"k int, w{i} int"), "on": "k",
              "how": "outer"} for i in (2, 3, 4)]
    out = merge_datasets(base, rules)
    assert sorted(map(tuple, out.select("k", "w2", "w3", "w4").collect()), key=str) == [
        ("1", 2, 3, 4), ("2", 2, None, None), ("3", None, 3, None), ("4", None, None, 4)]


def test_grid_search_on_a_classifier(spark):
    df = points(spark)
    tuner = hyper_parameter_tuner(LogisticRegression(maxIter=20), {"regParam": [0.0, 10.0]}, df, "y",
                                  ["a", "b"], method="grid", cv=3, order_by=["id"])
    assert tuner.get_best_params() == {"regParam": 0.0} == tuner.best_params_
    assert tuner.best_score_ > 0.9 and tuner.best_estimator_ is not None
    scored = tuner.predict_proba(df)
    assert dict(scored.dtypes)["probability"] == "array<double>" and scored.count() == 300
    assert set(tuner.predict(df).columns) == {"id", "a", "b", "y", "z", "prediction"}
    assert tuner.result.results.count() == 2
    area = hyper_parameter_tuner(LogisticRegression(), {"regParam": [0.1]}, df, "y", ["a", "b"],
                                 cv=2, scoring="roc_auc", order_by=["id"])
    assert area.best_score_ > 0.95


def test_random_search_on_a_regression(spark):
    tuner = HyperparameterTuner(LinearRegression(), {"regParam": [0.0, 1.0, 5.0]}, n_iter=2, cv=3)
    tuner.fit(points(spark), "z", ["a"], ["id"])
    assert tuner.result.results.count() == 2 and tuner.best_score_ > 0.8
    with pytest.raises(AttributeError):
        tuner.predict_proba(points(spark))


def test_tuner_errors(spark):
    with pytest.raises(RuntimeError):
        HyperparameterTuner(LinearSVC(), {}).predict(points(spark))
    with pytest.raises(ValueError):
        HyperparameterTuner(LinearSVC(), {}, method="halving").fit(points(spark), "y", ["a"])
    with pytest.raises(ValueError):
        HyperparameterTuner(LinearSVC(), {"regParam": [0.1]}, scoring="odd").fit(
            points(spark), "y", ["a"], ["id"])
