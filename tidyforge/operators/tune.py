"""Hyper-parameter search by cross-validation on Spark ML estimators."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, Evaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyforge.functions.names import ref
from tidyforge.operators.ranks import sums_before
from tidyforge.session import materialize

# Parts into which copies of one row are dealt, so that they are numbered by several tasks.
COPY_PARTS = 64
FEATURES = "__features"
FOLD = "__fold"


def is_classifier(estimator: Estimator) -> bool:
    return estimator.hasParam("probabilityCol") or estimator.hasParam("rawPredictionCol")


def assign_folds(df: DataFrame, label: str, order_by: list[str], folds: int,
                 stratified: bool = True) -> DataFrame:
    """Add the fold number 0..folds-1 of each row.

    Stratified folds number the rows of each label in the order of a hash of the label and the
    ordering columns, and deal the numbers out in turn, so folds are as even as they can be and
    depend on the rows alone, not on their number, order or files.  The numbers are running
    sums: of copies of a row, of rows within a range of hashes, of ranges.  Ranges are cut at
    points sampled from the rows, so no task numbers a whole label, however large, nor all
    copies of one row.  Which of several copies gets which
    number follows the task that reads it; pass a written table to keep that the same.
    """
    key = F.xxhash64(*map(ref, order_by))
    if not stratified:
        return df.withColumn(FOLD, F.pmod(key, F.lit(folds)).cast("int"))
    rows = df.withColumns({
        "__key": F.xxhash64(ref(label), *map(ref, order_by)),
        "__part": F.pmod(F.spark_partition_id(), F.lit(COPY_PARTS))})
    copies = rows.groupBy("__key", "__part").agg(
        F.count(F.lit(1)).alias("copies"), F.first(ref(label)).alias("label"))
    before = sums_before(copies, ["label", "__key", "__part"], "copies")
    firsts = before.groupBy("label").agg(F.min("before").alias("first"))
    starts = before.alias("c").join(firsts.alias("f"), F.col("c.label").eqNullSafe(
        F.col("f.label"))).select("__key", "__part", (F.col("before") - F.col("first")).alias("__start"))
    own = Window.partitionBy("__key", "__part").orderBy(*map(ref, order_by))
    number = F.col("__start") + F.row_number().over(own) - 1
    return rows.join(starts, ["__key", "__part"]).withColumn(
        FOLD, F.pmod(number, F.lit(folds)).cast("int")).select(*map(ref, df.columns), FOLD)


def grid_points(space: dict[str, list]) -> list[dict[str, object]]:
    points = [{}]
    for name, choices in space.items():
        points = [{**p, name: v} for p in points for v in choices]
    return points


def random_points(space: dict[str, object], n_iter: int, seed: int) -> list[dict[str, object]]:
    """Seeded draws; lists only are drawn without repetition, as a subset of the grid.

    A choice may also be a callable that takes a ``random.Random``.
    """
    rng = random.Random(seed)
    if all(isinstance(v, (list, tuple)) for v in space.values()):
        grid = grid_points(space)
        return rng.sample(grid, min(n_iter, len(grid)))
    return [{name: v(rng) if callable(v) else rng.choice(list(v)) for name, v in space.items()}
            for _ in range(n_iter)]


# Scoring names and the metric of Spark's evaluators.
CLASS_METRICS = {"accuracy": "accuracy", "f1_weighted": "f1", "f1": "fMeasureByLabel",
                 "precision_weighted": "weightedPrecision", "recall_weighted": "weightedRecall",
                 "neg_log_loss": "logLoss"}
BINARY_METRICS = {"roc_auc": "areaUnderROC", "average_precision": "areaUnderPR"}
REGRESSION_METRICS = {"r2": "r2", "neg_root_mean_squared_error": "rmse",
                      "neg_mean_squared_error": "mse", "neg_mean_absolute_error": "mae"}


def evaluator_for(scoring: str | Evaluator | None, classify: bool, label: str) -> Evaluator:
    """Evaluator by scoring name; the default is accuracy, or R² for regression."""
    if isinstance(scoring, Evaluator):
        return scoring
    name = scoring or ("accuracy" if classify else "r2")
    if name in CLASS_METRICS:
        return MulticlassClassificationEvaluator(labelCol=label, metricName=CLASS_METRICS[name],
                                                 metricLabel=1.0)
    if name in BINARY_METRICS:
        return BinaryClassificationEvaluator(labelCol=label, metricName=BINARY_METRICS[name])
    if name in REGRESSION_METRICS:
        return RegressionEvaluator(labelCol=label, metricName=REGRESSION_METRICS[name])
    raise ValueError(f"unknown scoring {scoring!r}")


@dataclass
class TuneResult:
    """Outcome of a search; the best model is refitted on all rows."""

    best_params: dict[str, object]
    best_score: float
    best_model: object
    results: DataFrame
    features: list[str]

    def predict(self, df: DataFrame) -> DataFrame:
        """The rows with a ``prediction`` column."""
        return self.best_model.transform(df).drop(FEATURES, "rawPrediction", "probability")

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """The rows with ``prediction`` and the class probabilities as an array."""
        scored = self.best_model.transform(df)
        if "probability" not in scored.columns:
            raise AttributeError("this model has no class probabilities")
        return (scored.withColumn("probability", vector_to_array("probability"))
                .drop(FEATURES, "rawPrediction"))


class HyperparameterTuner:
    """Grid or random search with k-fold cross-validation.

    Scores named ``neg_...`` are the negative of Spark's metric, so that more is better;
    ``f1`` is that of label 1.
    """

    def __init__(self, model: Estimator, param_space: dict[str, object], method: str = "random",
                 cv: int = 5, n_iter: int = 10, scoring: str | Evaluator | None = None,
                 n_jobs: int = 1, random_state: int = 42):
        self.model = model
        self.param_space = param_space
        self.method = method
        self.cv = cv
        self.n_iter = n_iter
        self.scoring = scoring
        self.n_jobs = n_jobs
        self.random_state = random_state
        self.result: TuneResult | None = None

    def _points(self) -> list[dict[str, object]]:
        if self.method == "grid":
            return grid_points(self.param_space)
        if self.method == "random":
            return random_points(self.param_space, self.n_iter, self.random_state)
        raise ValueError(f"unknown tuning method {self.method!r}; choose 'grid' or 'random'")

    def fit(self, df: DataFrame, label: str, features: list[str],
            order_by: list[str] | None = None) -> "HyperparameterTuner":
        """Search on the rows of ``df``.  ``order_by`` makes rows distinct for the folds."""
        points = self._points()
        spark = df.sparkSession
        classify = is_classifier(self.model)
        order_by = order_by or [c for c in df.columns if c != label]
        used = list(dict.fromkeys([*features, label, *order_by]))
        # Every fold and every parameter set reads the rows again.
        rows = materialize(df.select(*map(ref, used)), "tune")
        folded = assign_folds(rows, label, order_by, self.cv, classify)
        folded = materialize(folded.select(*map(ref, [*features, label, FOLD])), "folds")

        model = self.model.copy()
        model.set(model.getParam("labelCol"), label)
        model.set(model.getParam("featuresCol"), FEATURES)
        if model.hasParam("seed"):
            model.set(model.getParam("seed"), self.random_state)
        assembler = VectorAssembler(inputCols=features, outputCol=FEATURES)
        maps = [{model.getParam(k): v for k, v in p.items()} for p in points] or \
            ParamGridBuilder().build()
        evaluator = evaluator_for(self.scoring, classify, label)
        search = CrossValidator(
            estimator=Pipeline(stages=[assembler, model]), estimatorParamMaps=maps,
            evaluator=evaluator, numFolds=self.cv, seed=self.random_state,
            parallelism=max(1, self.n_jobs or 1), foldCol=FOLD)
        found = search.fit(folded)
        sign = -1.0 if isinstance(self.scoring, str) and self.scoring.startswith("neg_") else 1.0
        scores = [sign * s for s in found.avgMetrics]
        pick = max if evaluator.isLargerBetter() or sign < 0 else min
        best = scores.index(pick(scores))
        table = [(i, str(p), float(s)) for i, (p, s) in enumerate(zip(points, scores))]
        results = spark.createDataFrame(table, "candidate int, params string, avg_metric double")
        self.result = TuneResult(points[best], scores[best], found.bestModel, results, features)
        return self

    def _fitted(self) -> TuneResult:
        if self.result is None:
            raise RuntimeError("call fit() first")
        return self.result

    @property
    def best_params_(self):
        return self._fitted().best_params

    @property
    def best_score_(self):
        return self._fitted().best_score

    @property
    def best_estimator_(self):
        return self._fitted().best_model

    def get_best_params(self) -> dict[str, object]:
        return self._fitted().best_params

    def predict(self, df: DataFrame) -> DataFrame:
        return self._fitted().predict(df)

    def predict_proba(self, df: DataFrame) -> DataFrame:
        return self._fitted().predict_proba(df)


def hyper_parameter_tuner(model: Estimator, param_space: dict, df: DataFrame, label: str,
                          features: list[str], method: str = "random", cv: int = 5,
                          n_iter: int = 10, scoring=None, n_jobs: int = 1,
                          random_state: int = 42, order_by: list[str] | None = None
                          ) -> HyperparameterTuner:
    """Search in one call."""
    tuner = HyperparameterTuner(model, param_space, method, cv, n_iter, scoring, n_jobs,
                                random_state)
    return tuner.fit(df, label, features, order_by)
