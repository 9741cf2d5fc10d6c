"""Gradient-boosted trees on Spark ML: training, early stopping, scoring and persistence."""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.boosting import can_fit, fit_classifier
from gridloom.operators.ensemble import COPIES, model_nodes, staged_margins, staged_metrics
from gridloom.operators.metrics import REGRESSION_METRICS, class_weights, evaluate
from gridloom.session import checkpoint_root
from gridloom.sources.writers import read_document, write_document

# Default parameters and the patience of early stopping.
DEFAULT_PARAMS: dict[str, Any] = {
    "boosting_type": "gbdt",
    "learning_rate": 0.1,
    "num_leaves": 31,
    "feature_fraction": 0.8,
    "reg_lambda": 0.0,
    "n_estimators": 100,
    "min_data_in_leaf": 20,
    "class_weight": None,
}
INTEGER_PARAMS = ("num_leaves", "n_estimators", "min_data_in_leaf")
PATIENCE = 50

_WEIGHT = "__weight"
COMBINED_PER_TASK = 100_000  # combined rows that a task of the learner reads


def complete_params(params: dict[str, Any] | None) -> dict[str, Any]:
    """Given parameters over the defaults, whole-number parameters truncated."""
    merged = {**DEFAULT_PARAMS, **(params or {})}
    if "num_iterations" in merged:
        merged["n_estimators"] = merged.pop("num_iterations")
    for name in INTEGER_PARAMS:
        merged[name] = int(merged[name])
    return merged


def learner_options(params: dict[str, Any], max_arity: int = 0) -> dict[str, Any]:
    """Spark ML parameters for a complete parameter set."""
    if params["boosting_type"] != "gbdt":
        raise ValueError(f"unsupported boosting type: {params['boosting_type']}")
    if params["reg_lambda"]:
        warnings.warn("reg_lambda has no counterpart in the tree learner and is ignored", stacklevel=2)
    return {
        "stepSize": float(params["learning_rate"]),
        "maxIter": params["n_estimators"],
        "maxDepth": min(30, max(1, math.ceil(math.log2(max(2, params["num_leaves"]))))),
        "minInstancesPerNode": max(1, params["min_data_in_leaf"]),
        "featureSubsetStrategy": "all" if params["feature_fraction"] >= 1 else str(float(params["feature_fraction"])),
        "maxBins": max(32, max_arity),
    }


def best_length(losses: Sequence[float], patience: int = PATIENCE) -> int:
    """Trees to keep: the best round seen before ``patience`` rounds bring no improvement."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model, n_trees: int):
    """The same ensemble cut after ``n_trees`` trees.

    Boosting adds trees one by one, so the prefix equals a model trained with fewer
    rounds; the public constructor of the model class saves that second training.
    """
    if n_trees >= model.getNumTrees:
        return model
    sc = SparkSession.active().sparkContext
    name = "classification.GBTClassificationModel" if isinstance(model, GBTClassificationModel) else "regression.GBTRegressionModel"
    java_class = sc._jvm
    for part in f"org.apache.spark.ml.{name}".split("."):
        java_class = getattr(java_class, part)
    tree_class = sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = sc._gateway.new_array(tree_class, n_trees), sc._gateway.new_array(sc._jvm.double, n_trees)
    all_trees = model._java_obj.trees()
    for i in range(n_trees):
        trees[i], weights[i] = all_trees[i], float(model.treeWeights[i])
    cut = type(model)(java_class(model.uid, trees, weights))
    return model._copyValues(cut)


@dataclass
class TrainedModel:
    """A fitted ensemble with what is needed to score and explain."""

    model: Any
    problem_type: str
    params: dict[str, Any]
    slots: list[tuple[str, str]] = field(default_factory=list)  # (vector slot, source feature)
    train_metric: float | None = None

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``prediction`` first, then the kept columns: positive-class probability or regression value."""
        scored = self.model.transform(df)
        if self.problem_type == "classification":
            value = vector_to_array("probability")[1]
        else:
            value = F.col("prediction")
        return scored.select(value.alias("prediction"), *keep)

    def save(self, spark: SparkSession, path: str) -> str:
        self.model.write().overwrite().save(f"{path}/model")
        document = {"problem_type": self.problem_type, "params": self.params, "slots": self.slots, "train_metric": self.train_metric}
        write_document(spark, document, f"{path}/state")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TrainedModel:
        document = read_document(spark, f"{path}/state")
        kind = GBTClassificationModel if document["problem_type"] == "classification" else GBTRegressionModel
        slots = [tuple(slot) for slot in document.pop("slots")]
        return cls(model=kind.load(f"{path}/model"), slots=slots, **document)


@dataclass
class MulticlassModel:
    """One boosted ensemble per class over the same vectors; their margins give the probabilities."""

    models: list[TrainedModel]
    classes: list[float]
    params: dict[str, Any]
    slots: list[tuple[str, str]] = field(default_factory=list)
    train_metric: float | None = None
    problem_type: str = "classification"

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``prediction`` first, the probabilities of the classes in their order, then the kept columns."""
        scored, margins = df, []
        for i, trained in enumerate(self.models):
            names = [f"__raw{i}", f"__probability{i}", f"__class{i}"]
            model = trained.model.copy().setRawPredictionCol(names[0]).setProbabilityCol(names[1]).setPredictionCol(names[2])
            scored = model.transform(scored)
            margins.append(vector_to_array(names[0])[1])
        scored = scored.select(*keep, F.array(*margins).alias("__margins"))
        return scored.select(softmax(F.col("__margins")).alias("prediction"), *keep)

    def save(self, spark: SparkSession, path: str) -> str:
        for i, trained in enumerate(self.models):
            trained.save(spark, f"{path}/class_{i}")
        document = {"classes": self.classes, "params": self.params, "slots": self.slots, "train_metric": self.train_metric}
        write_document(spark, document, f"{path}/state")
        return path


def softmax(margins: Column) -> Column:
    """Probabilities of class margins, which are half log-odds as for two classes."""
    powers = F.transform(margins, lambda m: F.exp(2 * (m - F.array_max(margins))))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def load_model(spark: SparkSession, path: str) -> TrainedModel | MulticlassModel:
    """A saved model of either kind."""
    document = read_document(spark, f"{path}/state")
    if "classes" not in document:
        return TrainedModel.load(spark, path)
    document["slots"] = [tuple(slot) for slot in document["slots"]]
    return MulticlassModel(models=[TrainedModel.load(spark, f"{path}/class_{i}") for i in range(len(document["classes"]))], **document)


class BoostedTrees:
    """Unfitted boosted trees for a binary target, for ``classes`` (more than two values of the label), or for a number.

    ``many_rows`` fits two classes over binned rows in files where it can, see :mod:`~gridloom.operators.boosting`.
    """

    def __init__(
        self, problem_type: str, params: dict[str, Any] | None = None, label: str = "label", seed: int = 42, classes: Sequence[float] | None = None, many_rows: bool = False
    ):
        self.problem_type = problem_type
        self.classes = list(classes) if classes and len(classes) > 2 else None
        self.params = complete_params(params)
        self.label = label
        self.seed = seed
        self.many_rows = many_rows

    def _learner(self, max_arity: int):
        options = dict(learner_options(self.params, max_arity), labelCol=self.label, featuresCol="features", seed=self.seed)
        if self.problem_type == "regression":
            return GBTRegressor(lossType="squared", **options)
        return GBTClassifier(**options)

    def _weights(self, df: DataFrame) -> dict[float, float]:
        """Balanced class weights of the training rows; empty when rows count equally."""
        if self.problem_type == "regression" or self.params["class_weight"] != "balanced":
            return {}
        return {row[self.label]: row["weight"] for row in class_weights(df, self.label).collect()}

    def _weighted(self, df: DataFrame, weights: dict[float, float]) -> DataFrame:
        weight = F.lit(1.0)
        for value, w in weights.items():
            weight = F.when(F.col(self.label) == value, F.lit(w)).otherwise(weight)
        return df.withColumn(_WEIGHT, weight) if weights else df

    def _combined(self, df: DataFrame, slots: Sequence[tuple[str, str]]) -> DataFrame | None:
        """Equal rows once, with their number as weight, kept for the learners of all classes: what a tree reads of them is only sums.

        For vectors of one slot, whose values repeat if it is a category. Where leaves need several rows or rows have weights the learner must see each row.
        """
        if len(slots) != 1 or self.params["min_data_in_leaf"] > 1 or self.params["class_weight"] == "balanced":
            return None
        value = vector_to_array("features")[0].alias("__value")
        counts = df.select(self.label, value).groupBy(self.label, "__value").agg(F.count(F.lit(1)).cast("double").alias(COPIES))
        return counts.persist(StorageLevel.MEMORY_AND_DISK)

    def _losses(self, model: Any, validation: DataFrame, watch: str | None) -> list[float]:
        """One number per beginning of the ensemble, smaller is better; rows of one class tell nothing."""
        regression = self.problem_type == "regression"
        metric = watch if watch in (REGRESSION_METRICS if regression else ("rocauc",)) else "rmse" if regression else "rocauc"
        nodes = model_nodes(validation.sparkSession, model)
        staged = staged_margins(nodes, validation, vector_to_array("features"), [self.label])
        n_rows = 0 if regression else validation.count() * model.getNumTrees
        found = {r["n_trees"]: r["metric"] for r in staged_metrics(staged, self.label, metric, n_rows=n_rows).collect()}  # one row per tree
        sign = 1.0 if regression else -1.0
        return [sign * (found.get(i) or 0.0) for i in range(1, model.getNumTrees + 1)]

    def fit(
        self,
        df: DataFrame,
        slots: Sequence[tuple[str, str]] = (),
        max_arity: int = 0,
        validation: DataFrame | None = None,
        patience: int = PATIENCE,
        watch: str | None = None,
    ) -> TrainedModel | MulticlassModel:
        """Train on ``features`` and the label; with ``validation`` keep the best number of trees.

        Best by ``watch`` (``rocauc``, ``rmse`` or ``mae``): the area under the ROC curve for
        classes, the root of the mean squared error for numbers, if nothing is given.

        The learner bins the rows and keeps its own compact copy, so the input is not cached here.
        """
        if self.classes:
            return self._fit_classes(df, slots, max_arity, validation, patience)
        checkpoint_root(df.sparkSession)  # long boosting runs cut their lineage there
        learner, weights = self._learner(max_arity), self._weights(df)
        if weights:
            learner = learner.setWeightCol(_WEIGHT)
        elif COPIES in df.columns:
            learner = learner.setWeightCol(COPIES)
        if self.many_rows and can_fit(learner, df):
            model = fit_classifier(learner, df, self.label)
        else:
            model = learner.fit(self._weighted(df, weights))
        params = dict(self.params)
        if validation is not None:
            params["best_iteration"] = best_length(self._losses(model, validation, watch), patience)
            model = first_trees(model, params["best_iteration"])
        return TrainedModel(model, self.problem_type, params, list(slots))

    def _fit_classes(self, df: DataFrame, slots: Sequence[tuple[str, str]], max_arity: int, validation: DataFrame | None, patience: int) -> MulticlassModel:
        """An ensemble for each class against the others; each stops by its own area under the ROC curve."""

        def against(frame: DataFrame, value: float) -> DataFrame:
            return frame.withColumn(self.label, (F.col(self.label) == F.lit(value)).cast("double"))

        one = BoostedTrees(self.problem_type, self.params, self.label, self.seed)
        rows, combined = df, self._combined(df, slots)
        if combined is not None:
            rows = combined.coalesce(max(1, math.ceil(combined.count() / COMBINED_PER_TASK)))
            rows = rows.select(self.label, array_to_vector(F.array("__value")).alias("features"), COPIES)
        try:
            models = [one.fit(against(rows, c), slots, max_arity, None if validation is None else against(validation, c), patience) for c in self.classes]
        finally:
            if combined is not None:
                combined.unpersist()
        return MulticlassModel(models, self.classes, dict(self.params), list(slots))

    def fit_and_measure(self, df: DataFrame, metric: str, slots: Sequence[tuple[str, str]] = (), max_arity: int = 0) -> TrainedModel:
        """Train without early stopping and record the metric on the training rows."""
        trained = self.fit(df, slots, max_arity)
        row = evaluate(trained.score(df, [self.label]), self.problem_type, metric, self.label, "prediction", classes=self.classes).first()
        trained.train_metric = row["metric"]
        return trained
