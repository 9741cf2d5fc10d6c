"""Training and scoring runs from two configurations."""

from __future__ import annotations

import warnings
from typing import Any

from pyspark import StorageLevel
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.explain import METHODS, Explanation, explain
from gridloom.operators.search import SearchResult, cross_validate_search
from gridloom.operators.train import BoostedTrees, MulticlassModel, TrainedModel, load_model
from gridloom.plans.loading import TableLoader
from gridloom.plans.processing import LABEL, DataProcessor
from gridloom.session import build_session, scratch_path
from gridloom.sources.writers import default_name, write_study, write_table

MAX_CLASSES = 100  # of a classification target; each has an ensemble of its own


class TabularRun:
    """``TabularRun(model_config, data_config).run()`` trains or scores, as the data config says.

    A training run searches parameters over the folds, saves the history, refits on
    the whole table, saves preprocessor and model, and explains the model. A scoring
    run loads both and writes the predictions with their ids. ``cache`` keeps encoded
    rows on the executors while they are passed over repeatedly; switch it off when
    folds times the table exceed the cluster's storage.
    """

    def __init__(
        self,
        modeling_config: str | dict[str, Any],
        data_config: str | dict[str, Any],
        spark: SparkSession | None = None,
        output_dir: str = "trained_model_outputs_path",
        cache: bool = True,
    ):
        self.spark = spark or SparkSession.getActiveSession() or build_session()
        self.output_dir = output_dir.rstrip("/")
        self.cache = cache
        self.loader = TableLoader(self.spark, data_config, modeling_config)
        self.config = self.loader.model_config
        self.processor = DataProcessor(self.spark, self.loader.plan(), self.config, self.output_dir)
        self.search: SearchResult | None = None
        self.model: TrainedModel | MulticlassModel | None = None
        self.classes: list[float] | None = None
        self.explanation: Explanation | None = None
        self.predictions: DataFrame | None = None
        self.performance_metrics: dict[str, Any] = {}
        self.paths: dict[str, str] = {}

    def run(self) -> None:
        data = self.loader.get_data()
        if self.loader.data_config.training:
            self._train(data)
        else:
            self._score(data)

    # --- training ---

    def _path(self, *words: str) -> str:
        return f"{self.output_dir}/{default_name(self.config.target_variable, *words)}"

    def _materialised(self, data: DataFrame) -> DataFrame:
        """Training passes over its input many times: parse text once and keep the typed columns as Parquet.

        The table lies in the shared scratch folder, so it also survives lost executors.
        """
        if self.loader.data_config.input_data_source.upper() not in ("CSV", "JSON"):
            return data
        plan = self.processor.plan
        used = {*plan.ids, *plan.features, plan.target}
        if not self.config.keep_unused:
            data = data.select(*[f"`{name}`" for name in data.columns if name in used])
        return self.spark.read.parquet(write_table(data, scratch_path(self.spark, "typed"), "parquet"))

    def _train(self, data: DataFrame) -> None:
        config = self.config
        data = self._materialised(data)
        processed = self.processor.process_data(data, is_training=True, create_folds=True)
        self.classes = self._classes(data)
        self.search = cross_validate_search(
            processed.folds, config.space, config.num_hp_searches, config.problem_type, config.evaluation_metric,
            config.better_performance, LABEL, config.seed, config.parallelism, cache=self.cache,
            ledger=self._path(config.problem_type, config.model_type, "search_ledger") if config.resume_search else None, classes=self.classes,
        )
        self.save_hyperparameter_study()
        best = self.search.best
        self.performance_metrics = {"cv_average": best["value"], "best_trial": best["trial_number"]}
        if config.retrain_with_whole_dataset:
            self._refit(data, best["params"])

    def _classes(self, data: DataFrame) -> list[float] | None:
        """The values of a classification target with more than two, in order."""
        if self.config.problem_type != "classification":
            return None
        target = F.col(f"`{self.config.target_variable}`").cast("double").alias(LABEL)
        found = sorted(r[0] for r in data.select(target).where(F.col(LABEL).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect())
        if len(found) > MAX_CLASSES:
            raise ValueError(f"the target has more than {MAX_CLASSES} classes, each of which needs an ensemble")
        return found if len(found) > 2 else None

    def _refit(self, data: DataFrame, best_params: dict[str, Any]) -> None:
        config = self.config
        params = best_params if config.refit_params == "best" else None
        processed = self.processor.process_data(data, is_training=True, create_folds=False)
        frame = processed.frame.persist(StorageLevel.MEMORY_AND_DISK) if self.cache else processed.frame
        self.paths["preprocessor"] = self._path(config.problem_type, config.model_type, "data_processor")
        trees = BoostedTrees(config.problem_type, params, LABEL, config.seed, self.classes)
        encoder = processed.encoder
        self.model = trees.fit_and_measure(frame, config.evaluation_metric, encoder.vector_slots(), encoder.max_arity())
        self.performance_metrics["train"] = self.model.train_metric
        self.save_model()
        self._explain(frame, processed.ids)
        # the written values replace their computation for everything downstream
        self.explanation.values = self.spark.read.parquet(self.paths["importance_values"])
        self.save_importance_results()
        frame.unpersist()

    def _explain(self, frame: DataFrame, ids: list[str]) -> None:
        """Contributions by the configured method, or by the other one if that fails; ``importance_method`` says which was used."""
        config = self.config
        wanted = config.importance_extraction_method
        other = "treeinterpreter" if METHODS.get(wanted.lower()) == "shap" else "shap"
        for method in (wanted, other):
            self.explanation = explain(self.model, frame, ids, method, config.sample_for_contribution, config.seed)
            try:
                self.save_importance_values()
                break
            except PythonException as err:  # the method failed on a batch; a lost cluster is no reason to change it
                if method == other:
                    raise
                warnings.warn(f"importance method {method} failed, using {other}: {str(err)[:300]}", stacklevel=2)
        self.performance_metrics["importance_method"] = self.explanation.method

    def save_hyperparameter_study(self, path: str | None = None) -> str:
        if self.search is None:
            raise ValueError("no search history to save")
        path = path or self._path(self.config.problem_type, self.config.model_type, "hyperparameter_study.csv")
        self.paths["study"] = write_study(self.spark, self.search.history, path)
        return path

    def save_model(self, path: str | None = None) -> str:
        if self.model is None:
            raise ValueError("model has not been trained yet")
        path = path or self._path(self.config.problem_type, self.config.model_type)
        self.paths["model"] = self.model.save(self.spark, path)
        return path

    def save_importance_results(self, path: str | None = None) -> str:
        if self.explanation is None:
            raise ValueError("no feature importance results available")
        path = path or self._path(self.explanation.method, "feature_importance.csv")
        ordered = self.explanation.importance.orderBy("importance", ascending=False).coalesce(1)  # one row per feature
        self.paths["importance"] = write_table(ordered, path, "csv")
        return path

    def save_importance_values(self, path: str | None = None) -> str:
        if self.explanation is None:
            raise ValueError("no feature importance values available")
        path = path or self._path(self.explanation.method, "importance_values")
        self.paths["importance_values"] = write_table(self.explanation.values, path, "parquet")
        return path

    # --- scoring ---

    def _score(self, data: DataFrame) -> None:
        config = self.loader.data_config
        self.processor.load_preprocessor(config.data_processor_file_path)
        processed = self.processor.process_data(data, is_training=False)
        self.load_model(config.model_file_path)
        self.predictions = self.predict(processed.frame, processed.ids)
        self.paths["predictions"] = write_table(self.predictions, config.predictions_output_path)

    def load_model(self, path: str) -> None:
        self.model = load_model(self.spark, path)

    def predict(self, frame: DataFrame, ids: list[str]) -> DataFrame:
        if self.model is None:
            raise ValueError("model has not been trained yet")
        classes = len(self.model.classes) if isinstance(self.model, MulticlassModel) else 1
        return self.processor.add_ids_to_predictions(self.model.score(frame, ids), "prediction", ids, classes)

    # --- results ---

    def get_model_performances(self) -> list[dict[str, Any]]:
        """Metric of every trial and fold."""
        return [] if self.search is None else self.search.fold_metrics

    def get_performance_metrics(self) -> dict[str, Any]:
        return self.performance_metrics

    def get_study_results(self) -> list[dict[str, Any]]:
        return [] if self.search is None else self.search.history

    def get_best_params(self) -> dict[str, Any] | None:
        return None if self.search is None else self.search.best["params"]

    def get_importance_df(self) -> DataFrame | None:
        return None if self.explanation is None else self.explanation.importance

    def get_importance_values(self) -> DataFrame | None:
        return None if self.explanation is None else self.explanation.values

    def get_feature_rankings(self) -> DataFrame | None:
        return None if self.explanation is None else self.explanation.rankings
