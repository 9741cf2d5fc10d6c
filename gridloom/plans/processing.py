"""Preprocessing in its three modes: folds, full table, scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.config import ModelConfig
from gridloom.operators.encode import FeatureEncoder, FittedEncoder
from gridloom.operators.folds import assign_folds
from gridloom.operators.score import flat_output, multiclass_output
from gridloom.operators.search import FoldData, encode_folds
from gridloom.operators.typing import require_columns, scoring_columns, training_columns
from gridloom.sources.metadata import FeaturePlan
from gridloom.sources.writers import default_name

LABEL = "__label"  # internal name, so that no input column can clash with it


@dataclass
class Processed:
    """A processed table: folds for validation, or one encoded frame."""

    frame: DataFrame  # ids (and label, fold) with the feature vector, or the folded rows
    ids: list[str]
    encoder: FittedEncoder | None = None
    folds: list[FoldData] | None = None


class DataProcessor:
    """Fits and applies the preprocessing of a feature plan."""

    def __init__(self, spark: SparkSession, plan: FeaturePlan, config: ModelConfig, output_dir: str):
        self.spark = spark
        self.plan = plan
        self.config = config
        self.output_dir = output_dir
        self.encoder: FittedEncoder | None = None

    def _labelled(self, data: DataFrame) -> DataFrame:
        columns = training_columns(data, self.plan.ids, self.plan.target)
        if not self.config.keep_unused:
            # ids are distinct from features here, so pruning keeps the scan narrow
            columns = [name for name in columns if name in self.plan.features]
        target = F.col(f"`{self.plan.target}`").cast("double").alias(LABEL)
        return data.select(*[F.col(f"`{name}`") for name in [*self.plan.ids, *columns]], target)

    def _encoder(self) -> FeatureEncoder:
        plan = FeaturePlan(**{**self.plan.__dict__, "target": LABEL})
        return FeatureEncoder(plan, self.config.keep_unused)

    def create_folds(self, data: DataFrame) -> DataFrame:
        """The labelled rows with a fold number; stratified for classification."""
        target = LABEL if self.config.problem_type == "classification" else None
        return assign_folds(self._labelled(data), self.config.k_folds, self.plan.ids, target, self.config.seed)

    def preprocess_training_data(self, folded: DataFrame) -> list[FoldData]:
        """Every fold encoded with the statistics of its training rows."""
        return encode_folds(folded, self._encoder(), self.config.k_folds, LABEL, self.plan.ids)

    def fit_transform_full_dataset(self, data: DataFrame) -> DataFrame:
        """Fit on all rows and return ids, label and the feature vector."""
        labelled = self._labelled(data)
        self.encoder = self._encoder().fit(labelled)
        return self.encoder.feature_frame(labelled, [*self.plan.ids, LABEL])

    def preprocess_test_data(self, data: DataFrame) -> DataFrame:
        """Ids that exist and the feature vector, with the fitted statistics."""
        if self.encoder is None:
            raise ValueError("preprocessor has not been fitted or loaded yet")
        ids, _ = scoring_columns(data, self.plan.ids)
        return self.encoder.feature_frame(data, ids)

    def process_data(self, data: DataFrame, is_training: bool = True, create_folds: bool = True) -> Processed:
        """Dispatch on the mode of the run."""
        if not is_training:
            ids, _ = scoring_columns(data, self.plan.ids)
            return Processed(self.preprocess_test_data(data), ids, self.encoder)
        if create_folds:
            folded = self.create_folds(data)
            return Processed(folded, self.plan.ids, folds=self.preprocess_training_data(folded))
        frame = self.fit_transform_full_dataset(data)
        self.save_preprocessor()
        return Processed(frame, self.plan.ids, self.encoder)

    def save_preprocessor(self, path: str | None = None) -> str:
        if self.encoder is None:
            raise ValueError("preprocessor has not been fitted yet")
        name = default_name(self.plan.target, self.config.problem_type, self.config.model_type, "data_processor")
        return self.encoder.save(self.spark, path or f"{self.output_dir}/{name}")

    def load_preprocessor(self, path: str) -> None:
        self.encoder = FittedEncoder.load(self.spark, path)

    def add_ids_to_predictions(self, scored: DataFrame, score: str, ids: list[str], n_classes: int = 1) -> DataFrame:
        """Predictions first, then the ids that travelled with the rows."""
        require_columns(scored, [score, *ids], "prediction or id columns")
        return multiclass_output(scored, score, n_classes, ids) if n_classes > 1 else flat_output(scored, score, ids)
