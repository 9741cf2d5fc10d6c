"""Hyperparameter search by cross-validation."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.config import Dimension, sample_trials
from gridloom.operators.encode import FeatureEncoder, FittedEncoder
from gridloom.operators.metrics import check_metric, evaluate
from gridloom.operators.train import PATIENCE, BoostedTrees
from gridloom.sources.writers import study_frame


@dataclass
class FoldData:
    """One fold: its encoder, and all rows encoded with it."""

    number: int
    encoder: FittedEncoder
    frame: DataFrame  # ids, label, fold, features

    @property
    def training(self) -> DataFrame:
        return self.frame.where(F.col("fold") != self.number)

    @property
    def validation(self) -> DataFrame:
        return self.frame.where(F.col("fold") == self.number)


def encode_folds(df: DataFrame, encoder: FeatureEncoder, n_folds: int, label: str, ids: Sequence[str]) -> list[FoldData]:
    """Encode the table once per fold with the statistics of the other folds; lazy projections, no copies."""
    keep = [*ids, label, "fold"]
    return [FoldData(f, fitted, fitted.feature_frame(df, keep)) for f, fitted in enumerate(encoder.fit_folds(df, n_folds))]


@dataclass
class SearchResult:
    """History of a search."""

    history: list[dict[str, Any]]  # trial_number, params, value, state
    fold_metrics: list[dict[str, Any]] = field(default_factory=list)  # trial_number, fold, metric, error
    better_performance: str = "gt"

    @property
    def best(self) -> dict[str, Any]:
        finished = [h for h in self.history if h["value"] is not None]
        if not finished:
            errors = {m["error"] for m in self.fold_metrics if m["error"]}
            raise ValueError(f"no trial finished: {sorted(errors)}")
        sign = -1 if self.better_performance == "gt" else 1
        return min(finished, key=lambda h: (sign * h["value"], h["trial_number"]))

    def history_frame(self, spark: SparkSession) -> DataFrame:
        return study_frame(spark, self.history)

    def fold_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(m["trial_number"], m["fold"], m["metric"], m["error"]) for m in self.fold_metrics]
        return spark.createDataFrame(rows, "trial_number int, fold int, metric double, error string")


def run_fold(fold: FoldData, params: dict[str, Any], problem_type: str, metric: str, label: str, seed: int, patience: int = PATIENCE, classes: Sequence[float] | None = None) -> float | None:
    """Train on the other folds with early stopping on this one and return the validation metric."""
    trees = BoostedTrees(problem_type, params, label, seed, classes)
    trained = trees.fit(fold.training, fold.encoder.vector_slots(), fold.encoder.max_arity(), fold.validation, patience, metric)
    scored = trained.score(fold.validation, [label])
    return evaluate(scored, problem_type, metric, label, "prediction", classes=trees.classes).first()["metric"]


LEDGER_SCHEMA = "key string, params string, metric double, error string, trial_number int, fold int"


class SearchLedger:
    """Finished (trial, fold) pairs of a search under a shared folder, one small table each, so that a restarted search runs only the rest.

    A row counts for a search of the same parameter set, seed, patience, metric and number of folds; the
    table and its folds are the caller's: a ledger belongs to one of them.
    """

    def __init__(self, spark: SparkSession, path: str, *settings: Any):
        self.spark = spark
        self.path = path.rstrip("/")
        self.settings = settings

    def _key(self, params: dict[str, Any]) -> tuple[str, str]:
        text = json.dumps(params, sort_keys=True, default=str)
        return hashlib.sha256(json.dumps([text, *self.settings], default=str).encode()).hexdigest(), text

    def finished(self, trials: Sequence[dict[str, Any]]) -> dict[tuple[int, int], dict[str, Any]]:
        """The recorded outcomes of these trials; one row per trial and fold reaches the driver."""
        try:
            rows = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path).collect()
        except AnalysisException as err:
            if err.getCondition() == "PATH_NOT_FOUND":
                return {}
            raise
        keys = [self._key(params)[0] for params in trials]
        known = {(r["trial_number"], r["fold"]): r.asDict() for r in rows if r["trial_number"] < len(keys) and r["key"] == keys[r["trial_number"]]}
        return {at: {name: r[name] for name in ("trial_number", "fold", "metric", "error")} for at, r in known.items()}

    def record(self, outcome: dict[str, Any], params: dict[str, Any]) -> None:
        """A folder of its own, as several pairs may end at once; it is complete or not there."""
        key, text = self._key(params)
        row = self.spark.createDataFrame([(key, text, outcome["metric"], outcome["error"])], "key string, params string, metric double, error string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/trial_number={outcome['trial_number']}/fold={outcome['fold']}")


def cross_validate_search(
    folds: Sequence[FoldData],
    space: dict[str, Dimension],
    n_trials: int,
    problem_type: str,
    metric: str,
    better_performance: str,
    label: str,
    seed: int = 42,
    parallelism: int = 2,
    patience: int = PATIENCE,
    cache: bool = True,
    ledger: str | None = None,
    classes: Sequence[float] | None = None,
) -> SearchResult:
    """Random search: every trial is trained and scored on every fold.

    Each (trial, fold) pair is its own chain of Spark jobs; a few of them are
    submitted at a time so that the cluster stays busy between their stages. With
    ``cache`` the encoded folds stay in executor memory or on executor disk; without
    it every fit re-reads the source, which is the choice when folds times the table
    exceed the cluster's storage. A failed fold has no metric and its trial no value.
    With ``ledger``, a folder, finished pairs are kept there, and a search that was cut off goes on where it ended.
    """
    check_metric(problem_type, metric)
    trials = sample_trials(space, n_trials, seed)
    kept = SearchLedger(SparkSession.active(), ledger, seed, patience, problem_type, metric, len(folds)) if ledger else None
    known = kept.finished(trials) if kept else {}
    # nothing here reads the ids
    folds = [FoldData(fold.number, fold.encoder, fold.frame.select(label, "fold", "features")) for fold in folds]
    if cache:
        for fold in folds:
            fold.frame = fold.frame.persist(StorageLevel.MEMORY_AND_DISK)

    def one(task: tuple[int, FoldData]) -> dict[str, Any]:
        number, fold = task
        if (number, fold.number) in known:
            return known[number, fold.number]
        outcome = {"trial_number": number, "fold": fold.number, "metric": None, "error": None}
        try:
            outcome["metric"] = run_fold(fold, trials[number], problem_type, metric, label, seed, patience, classes)
        except (ValueError, IllegalArgumentException) as err:  # a bad parameter set must not end the search, a lost cluster must
            outcome["error"] = f"{type(err).__name__}: {str(err)[:500]}"
        if kept:
            kept.record(outcome, trials[number])
        return outcome

    tasks = [(number, fold) for number in range(n_trials) for fold in folds]
    try:
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            target = inheritable_thread_target(SparkSession.active())(one)
            outcomes = list(pool.map(target, tasks))
    finally:
        if cache:
            for fold in folds:
                fold.frame.unpersist()
    history = []
    for number, params in enumerate(trials):
        values = [o["metric"] for o in outcomes if o["trial_number"] == number]
        complete = all(v is not None for v in values)
        history.append(
            {
                "trial_number": number,
                "params": params,
                "value": sum(values) / len(values) if complete else None,
                "state": "COMPLETE" if complete else "FAIL",
            }
        )
    return SearchResult(history, outcomes, better_performance)
