"""Load and validate a table from its configuration."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from gridloom.config import DataConfig, ModelConfig, load_json
from gridloom.operators.typing import apply_types, validate_columns
from gridloom.sources.metadata import FeaturePlan, read_metadata
from gridloom.sources.readers import read_table, spread


class TableLoader:
    """Configurations, feature metadata and the typed input table."""

    def __init__(self, spark: SparkSession, data_config: str | dict[str, Any], model_config: str | dict[str, Any]):
        self.spark = spark
        data = load_json(data_config, spark) if isinstance(data_config, str) else data_config
        model = load_json(model_config, spark) if isinstance(model_config, str) else model_config
        self.data_config = DataConfig.from_dict(data)
        self.model_config = ModelConfig.from_dict(model)
        self.feature_metadata = read_metadata(spark, self.data_config.metadata_path)
        # one row per column of the table: plan input, bounded by the table's width
        self.metadata_rows = [row.asDict() for row in self.feature_metadata.collect()]
        self.input_data = read_table(spark, self.data_config.input_data_source, self.data_config.file_path, self.data_config.infer_types)
        target = self.model_config.target_variable if self.data_config.training else None
        validate_columns(self.input_data, self.metadata_rows, target)

    def get_data_config(self) -> DataConfig:
        return self.data_config

    def get_model_config(self) -> ModelConfig:
        return self.model_config

    def get_feature_metadata(self) -> DataFrame:
        return self.feature_metadata

    def plan(self) -> FeaturePlan:
        return FeaturePlan.from_rows(self.metadata_rows, self.model_config.id_variables, self.model_config.target_variable)

    def get_data(self) -> DataFrame:
        """The input with every column typed by its metadata; one lazy projection."""
        types = {row["feature_name"]: row["type"] for row in self.metadata_rows}
        typed = apply_types(self.input_data, types, self.data_config.missing_bool)
        return spread(typed) if self.data_config.training else typed
