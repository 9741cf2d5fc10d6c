"""Evaluation metrics as DataFrame aggregates, plain or per group (trial, fold, …)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.operators.score import argmax
from gridloom.session import scratch_path

ROWS_PER_RANGE = 1_000_000  # distinct scores one task should sort
MAX_RANGES = 20_000

# Accepted metric names.
CLASSIFICATION_METRICS = {
    "rocauc": "rocauc",
    "recall": "recall",
    "rec": "recall",
    "precision": "precision",
    "prec": "precision",
    "accuracy": "accuracy",
    "acc": "accuracy",
}
REGRESSION_METRICS = ("rmse", "mae")


def predicted_class(score: Column) -> Column:
    """1 when the score is strictly above one half."""
    return (score > 0.5).cast("int")


def _score_ranges(df: DataFrame, score: str, n_rows: int | None) -> DataFrame:
    """Add ``__range``, increasing with the score, with a bounded number of distinct scores in each range."""
    if n_rows is None:
        n_rows = df.count()
    n_ranges = min(MAX_RANGES, math.ceil(n_rows / ROWS_PER_RANGE))
    if n_ranges <= 1:
        return df.withColumn("__range", F.lit(0.0))
    # Any borders give the same result; quantiles of the rows keep the ranges even.
    probabilities = [i / n_ranges for i in range(1, n_ranges)]
    borders = sorted(set(df.approxQuantile(score, probabilities, 1 / (4 * n_ranges))))
    splits = [-math.inf, *borders, math.inf]
    return Bucketizer(splits=splits, inputCol=score, outputCol="__range").transform(df)


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), n_rows: int | None = None) -> DataFrame:
    """Exact area under the ROC curve per group, ties counted half; NULL when a group has one class only.

    Equal scores are combined first. Distinct scores are then ranked range by range
    and the ranges are chained through their totals, so no task sees all scores. A missing
    score, NULL or NaN, is an error at every size. ``n_rows``, a bound of the distinct scores, only decides the number of
    ranges; above one, or if it is not known, the combined scores are kept in the scratch folder.
    """
    by = list(by)
    value = F.col(score).cast("double")
    known = F.when(value.isNull() | F.isnan(value), F.raise_error(F.lit("the score has missing values"))).otherwise(value)
    rows = df.select(*by, F.col(label).cast("long").alias("__y"), known.alias("__s"))
    tied = rows.groupBy(*by, "__s").agg(F.sum("__y").cast("double").alias("pos"), F.sum(1 - F.col("__y")).cast("double").alias("neg"))
    if n_rows is None or n_rows > ROWS_PER_RANGE:
        # counting, the quantiles and the areas read it: the rows are made and combined once
        path = scratch_path(df.sparkSession, "scores")
        tied.write.parquet(path)
        tied = df.sparkSession.read.schema(tied.schema).parquet(path)
    tied = _score_ranges(tied, "__s", n_rows)
    inside = Window.partitionBy(*by, "__range").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0.0))
    ranges = (
        tied.withColumn("area", F.col("pos") * (below + F.col("neg") / 2))
        .groupBy(*by, "__range")
        .agg(F.sum("area").alias("area"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # one row per range: at most MAX_RANGES rows in a group
    earlier = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    chained = ranges.withColumn("area", F.col("area") + F.col("pos") * F.coalesce(F.sum("neg").over(earlier), F.lit(0.0)))
    totals = chained.groupBy(*by).agg(F.sum("area").alias("area"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return totals.select(*by, F.try_divide(F.col("area"), F.nullif(F.col("pos") * F.col("neg"), F.lit(0.0))).alias("rocauc"))


def threshold_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and recall, precision and accuracy at 0.5; 0/0 counts as 0."""
    y, p = F.col(label).cast("int"), predicted_class(F.col(score))
    counts = df.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by, "tp", "fp", "fn", "tn",
        share(tp, tp + fn).alias("recall"),
        share(tp, tp + fp).alias("precision"),
        share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )


def regression_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Root mean squared error and mean absolute error."""
    error = F.col(label).cast("double") - F.col(score).cast("double")
    return df.groupBy(*by).agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))


def check_metric(problem_type: str, metric: str) -> str:
    """Canonical metric name, or ValueError."""
    if problem_type == "classification" and metric in CLASSIFICATION_METRICS:
        return CLASSIFICATION_METRICS[metric]
    if problem_type == "regression" and metric in REGRESSION_METRICS:
        return metric
    raise ValueError(f"unsupported evaluation metric: {metric}")


def evaluate(
    df: DataFrame, problem_type: str, metric: str, label: str, score: str, by: Sequence[str] = (), n_rows: int | None = None,
    classes: Sequence[float] | None = None,
) -> DataFrame:
    """One ``metric`` column per group, by configured name; with ``classes`` the score is an array of their probabilities."""
    name = check_metric(problem_type, metric)
    if classes:
        return multiclass_metric(df, name, label, score, classes, by, n_rows)
    if name == "rocauc":
        result = roc_auc(df, label, score, by, n_rows)
    elif problem_type == "classification":
        result = threshold_metrics(df, label, score, by)
    else:
        result = regression_metrics(df, label, score, by)
    return result.select(*by, F.col(name).alias("metric"))


def multiclass_metric(
    df: DataFrame, metric: str, label: str, probabilities: str, classes: Sequence[float], by: Sequence[str] = (), n_rows: int | None = None
) -> DataFrame:
    """``metric`` per group for several classes: the share of rows whose most likely class is right, or the mean over the classes
    of recall, precision or the area under the ROC curve against the others; classes without rows do not count."""
    by, p = list(by), F.col(probabilities)
    values = F.array(*[F.lit(float(c)) for c in classes])
    rows = df.select(*by, F.col(label).cast("double").alias("__label"), p.alias("__p"), F.get(values, argmax(p)).alias("__best"))
    if metric == "accuracy":
        return rows.groupBy(*by).agg(F.avg((F.col("__label") == F.col("__best")).cast("double")).alias("metric"))
    each = rows.select(*by, "__label", "__best", F.posexplode("__p").alias("__at", "__score")).withColumn("__class", F.get(values, F.col("__at")))
    each = each.withColumn("__y", (F.col("__label") == F.col("__class")).cast("int"))
    if metric == "rocauc":
        found = roc_auc(each, "__y", "__score", [*by, "__class"], n_rows)
    else:
        found = threshold_metrics(each.withColumn("__hit", (F.col("__best") == F.col("__class")).cast("double")), "__y", "__hit", [*by, "__class"]).where("tp + fn > 0")
    return found.groupBy(*by).agg(F.avg(metric).alias("metric"))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights ``n / (number of classes * n of the class)``, one row per class."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n_rows"))
    everything = Window.partitionBy(F.lit(0))  # one row per class
    total = F.sum("n_rows").over(everything)
    classes = F.count(F.lit(1)).over(everything)
    return counts.select(target, "n_rows", (total / (classes * F.col("n_rows"))).alias("weight"))


def mean_over_folds(fold_metrics: DataFrame) -> DataFrame:
    """Average fold metric per trial; a trial with a failed fold has no value."""
    return fold_metrics.groupBy("trial_number").agg(
        F.when(F.count("metric") == F.count(F.lit(1)), F.avg("metric")).alias("value"),
        F.count(F.lit(1)).alias("n_folds"),
    )


def best_trial(trials: DataFrame, better_performance: str) -> DataFrame:
    """The trial with the best value: largest for ``gt``, smallest otherwise; ties go to the first trial."""
    value = F.desc_nulls_last("value") if better_performance == "gt" else F.asc_nulls_last("value")
    return trials.where(F.col("value").isNotNull()).orderBy(value, "trial_number").limit(1)
