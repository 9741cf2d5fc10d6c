"""Metadata-driven typing of a whole table and the column contract."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.coerce import nan_to_null, to_boolean, to_category, to_number
from gridloom.sources.metadata import NUMERIC_TYPES


def apply_types(df: DataFrame, types: Mapping[str, str], missing_bool: str = "null") -> DataFrame:
    """One projection that casts every column named in ``types`` (feature → metadata type).

    Names that are not columns are skipped; columns without a rule are kept as they are.
    """
    selected = []
    for entry in df.schema.fields:
        column, kind = F.col(f"`{entry.name}`"), types.get(entry.name)
        if kind == "category":
            column = to_category(column, entry.dataType)
        elif kind == "bool":
            column = to_boolean(column, entry.dataType, missing_bool)
        elif kind in NUMERIC_TYPES:
            column = to_number(column, entry.dataType)
        elif isinstance(entry.dataType, (T.FloatType, T.DoubleType)):
            column = nan_to_null(column)
        selected.append(column.alias(entry.name))
    return df.select(*selected)


def validate_columns(df: DataFrame, metadata: Iterable[Mapping[str, Any]], target: str | None) -> None:
    """Every used feature, and the target if given, must be a column."""
    for row in metadata:
        if row["use"] == 1 and row["feature_name"] not in df.columns:
            raise ValueError(f"feature '{row['feature_name']}' of the metadata is missing from the input data")
    if target is not None and target not in df.columns:
        raise ValueError(f"target variable '{target}' is missing from the training data")


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} missing from the data: {missing}")


def training_columns(df: DataFrame, ids: Iterable[str], target: str) -> list[str]:
    """Feature columns of a training table: everything but ids and target, which must exist."""
    ids = list(ids)
    require_columns(df, [*ids, target], "id or target columns")
    return [name for name in df.columns if name not in ids and name != target]


def scoring_columns(df: DataFrame, ids: Iterable[str]) -> tuple[list[str], list[str]]:
    """(ids that exist, feature columns) of a table to score; the target is not needed."""
    ids = list(ids)
    present = [name for name in ids if name in df.columns]
    return present, [name for name in df.columns if name not in ids]


def bool_to_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Booleans and numbers become 0.0/1.0 doubles; columns of other types are left alone."""
    wanted = set(columns)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if f.name in wanted and isinstance(f.dataType, (T.BooleanType, T.NumericType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
