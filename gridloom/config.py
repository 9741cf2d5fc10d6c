"""Run configuration: loading, contracts and the hyperparameter space."""

from __future__ import annotations

import ast
import json
import math
import random
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession

# The fields every configuration must carry and the accepted words.
DATA_FIELDS = ("training", "metadata_file_path", "input_data_source", "file_path")
SCORING_FIELDS = ("data_processor_file_path", "model_file_path", "predictions_output_path")
MODEL_FIELDS = (
    "target_variable",
    "id_variables",
    "problem_type",
    "evaluation_metric",
    "better_performance",
    "models",
    "k_folds",
    "retrain_with_whole_dataset",
)
SUPPORTED_MODELS = ("lgbm",)
PROBLEM_TYPES = ("classification", "regression")


def load_json(path: str, spark: SparkSession | None = None) -> dict[str, Any]:
    """Read one JSON object; a ``scheme://`` path is read through Spark's file systems."""
    if spark is not None and "://" in path:
        text = spark.read.text(path, wholetext=True).first()["value"]
    else:
        try:
            with open(path, encoding="utf-8") as handle:
                text = handle.read()
        except FileNotFoundError:
            raise FileNotFoundError(f"configuration file {path} not found") from None
    try:
        return json.loads(text)
    except json.JSONDecodeError as err:
        raise ValueError(f"configuration file {path} is not valid JSON: {err}") from None


def _require(document: dict[str, Any], fields: tuple[str, ...], what: str) -> None:
    for name in fields:
        if name not in document:
            raise ValueError(f"required field '{name}' missing from {what}")


@dataclass(frozen=True)
class DataConfig:
    """Where the table and its metadata are, and where results go."""

    training: bool
    metadata_file_path: str
    input_data_source: str
    file_path: str
    data_processor_file_path: str | None = None
    model_file_path: str | None = None
    predictions_output_path: str | None = None
    strip_leading_slash: bool = False
    missing_bool: str = "null"
    infer_types: bool = False

    @classmethod
    def from_dict(cls, document: dict[str, Any]) -> DataConfig:
        _require(document, DATA_FIELDS, "data config")
        if not document["training"]:
            _require(document, SCORING_FIELDS, "scoring data config")
        known = {name: document[name] for name in cls.__dataclass_fields__ if name in document}
        return cls(**known)

    @property
    def metadata_path(self) -> str:
        """Metadata path, optionally without one leading slash."""
        path = self.metadata_file_path
        return path[1:] if self.strip_leading_slash and path.startswith("/") else path


@dataclass(frozen=True)
class ModelConfig:
    """What to predict, how to validate, what to search and how to explain."""

    target_variable: str
    id_variables: list[str]
    problem_type: str
    evaluation_metric: str
    better_performance: str
    models: list[str]
    k_folds: int
    retrain_with_whole_dataset: bool
    sample_for_contribution: float = 1.0
    importance_extraction_method: str = "shap"
    num_hp_searches: int = 10
    hyperparameter_space: dict[str, Any] = field(default_factory=dict)
    refit_params: str = "best"
    seed: int = 42
    parallelism: int = 2
    keep_unused: bool = False
    resume_search: bool = False

    @classmethod
    def from_dict(cls, document: dict[str, Any]) -> ModelConfig:
        _require(document, MODEL_FIELDS, "model config")
        for model in document["models"]:
            if model not in SUPPORTED_MODELS:
                raise ValueError(f"unsupported model type '{model}', expected one of {', '.join(SUPPORTED_MODELS)}")
        if document["problem_type"] not in PROBLEM_TYPES:
            raise ValueError("problem type must be 'classification' or 'regression'")
        known = {name: document[name] for name in cls.__dataclass_fields__ if name in document}
        return cls(**known)

    @property
    def model_type(self) -> str:
        return self.models[0]

    @property
    def space(self) -> dict[str, Dimension]:
        """Search space of the first model; only that one is trained."""
        return parse_space(self.hyperparameter_space.get(self.model_type, {}))


# --- hyperparameter space ----------------------------------------------------


@dataclass(frozen=True)
class Dimension:
    """One searched parameter: ``kind`` is categorical, uniform, loguniform or discrete."""

    kind: str
    choices: tuple[Any, ...] = ()
    low: float = 0.0
    high: float = 0.0
    step: float | None = None
    integer: bool = False

    def sample(self, rng: random.Random) -> Any:
        if self.kind == "categorical":
            return rng.choice(self.choices)
        if self.kind == "uniform":
            value = rng.uniform(self.low, self.high)
        elif self.kind == "loguniform":
            value = math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        else:
            steps = int(math.floor((self.high - self.low) / self.step + 1e-9))
            value = self.low + rng.randint(0, steps) * self.step
        return int(value) if self.integer else value


_SUGGEST = re.compile(r"^\s*(?P<int>int\(\s*)?trial\.suggest_(?P<kind>\w+)\(\s*(?P<args>.*?)\s*\)\s*\)?\s*$", re.DOTALL)
_KINDS = {
    "categorical": "categorical",
    "uniform": "uniform",
    "float": "uniform",
    "loguniform": "loguniform",
    "discrete_uniform": "discrete",
    "int": "discrete",
}


def _parse_dimension(name: str, spec: Any) -> Dimension:
    if isinstance(spec, dict):
        kind = spec["kind"]
        if kind not in ("categorical", "uniform", "loguniform", "discrete"):
            raise ValueError(f"unknown kind '{kind}' for hyperparameter '{name}'")
        fields = dict(spec, choices=tuple(spec.get("choices", ())))
        if kind == "discrete":
            fields.setdefault("step", 1)
        return Dimension(**fields)
    match = _SUGGEST.match(str(spec))
    if match is None or match["kind"] not in _KINDS:
        raise ValueError(f"cannot read hyperparameter '{name}': {spec!r}")
    # Text is never evaluated: only literals are accepted as arguments.
    try:
        arguments = ast.literal_eval(f"({match['args']},)")
    except (ValueError, SyntaxError):
        raise ValueError(f"cannot read hyperparameter '{name}': {spec!r}") from None
    kind = _KINDS[match["kind"]]
    if kind == "categorical":
        return Dimension(kind, choices=tuple(arguments[1]))
    step = None
    if kind == "discrete":
        step = arguments[3] if len(arguments) > 3 else 1
    integer = bool(match["int"]) or match["kind"] == "int"
    return Dimension(kind, low=arguments[1], high=arguments[2], step=step, integer=integer)


def parse_space(space: dict[str, Any]) -> dict[str, Dimension]:
    """Read a space given as declarative objects or as ``trial.suggest_*`` text."""
    return {name: _parse_dimension(name, spec) for name, spec in space.items()}


def sample_trials(space: dict[str, Dimension], n_trials: int, seed: int) -> list[dict[str, Any]]:
    """Seeded random parameter sets, one per trial."""
    rng = random.Random(seed)
    return [{name: dim.sample(rng) for name, dim in space.items()} for _ in range(n_trials)]
