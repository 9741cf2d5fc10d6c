"""Output tables of a scoring run; ids travel with the rows, so nothing is joined back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def argmax(probabilities: Column) -> Column:
    """Position of the largest entry, the first one on ties."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def multiclass_output(df: DataFrame, probabilities: str, n_classes: int, ids: Sequence[str]) -> DataFrame:
    """``prob_class_i`` columns, the most likely class as ``prediction``, then the ids."""
    p = F.col(probabilities)
    return df.select(*[p[i].alias(f"prob_class_{i}") for i in range(n_classes)], argmax(p).alias("prediction"), *ids)


def flat_output(df: DataFrame, score: str, ids: Sequence[str]) -> DataFrame:
    """``prediction`` and the ids, for one score per row."""
    return df.select(F.col(score).cast("double").alias("prediction"), *ids)


def logistic(margin: Column) -> Column:
    """Probability of a margin."""
    return 1 / (1 + F.exp(-margin))
