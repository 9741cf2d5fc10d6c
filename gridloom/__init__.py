"""Metadata-driven tabular analytics and modelling on Spark DataFrames."""

from gridloom.config import DataConfig, ModelConfig
from gridloom.operators.encode import FeatureEncoder, FittedEncoder
from gridloom.operators.explain import Explanation, explain
from gridloom.operators.train import BoostedTrees, TrainedModel
from gridloom.plans.loading import TableLoader
from gridloom.plans.processing import DataProcessor
from gridloom.plans.run import TabularRun

__all__ = [
    "BoostedTrees",
    "DataConfig",
    "DataProcessor",
    "Explanation",
    "FeatureEncoder",
    "FittedEncoder",
    "ModelConfig",
    "TableLoader",
    "TabularRun",
    "TrainedModel",
    "explain",
]
