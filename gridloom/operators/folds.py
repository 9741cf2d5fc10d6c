"""Cross-validation folds, exact-size samples and ordered splits."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.keys import hash_key, order_key, row_key
from gridloom.operators.ranks import TooManyGroups, even_part, even_sizes, group_ranks, split_by_rank, sums_before


def _random_key(df: DataFrame, ids: Sequence[str], seed: int):
    return hash_key(ids, seed) if ids else row_key(df, seed)


def assign_folds(df: DataFrame, k: int, ids: Sequence[str], target: str | None = None, seed: int = 42, out: str = "fold") -> DataFrame:
    """Add a shuffled fold number 0…k-1; with ``target`` the folds are stratified.

    Rows are ordered by a hash of their ids and each class is cut into ``k`` ranges.
    Fold sizes differ by at most one, per class and in total, and depend only on the
    data and the seed, not on the partitioning.
    """
    if k < 2:
        raise ValueError("at least two folds are needed")

    def sizes(totals: dict) -> dict:
        if target is None:
            if sum(totals.values()) < k:
                raise ValueError(f"cannot make {k} folds of {sum(totals.values())} rows")
        elif max(totals.values()) < k:
            raise ValueError(f"cannot make {k} folds: no class has {k} rows")
        elif min(totals.values()) < k:
            warnings.warn(f"the smallest class has {min(totals.values())} rows, fewer than {k} folds", stacklevel=2)
        parts, start = {}, 0
        for value in sorted(totals):
            parts[value] = even_sizes(totals[value], k, start)
            start += totals[value]
        return parts

    try:
        return split_by_rank(df, _random_key(df, ids, seed), sizes, out, group=target)
    except TooManyGroups:
        return _many_class_folds(df, k, _random_key(df, ids, seed), target, out)


def _many_class_folds(df: DataFrame, k: int, key: Column, target: str, out: str) -> DataFrame:
    """The same folds with class totals and start offsets in tables instead of literals."""
    totals = df.groupBy(F.col(target).alias("__class")).agg(F.count(F.lit(1)).alias("__total"))
    least, most, missing = totals.agg(F.min("__total"), F.max("__total"), F.max(F.col("__class").isNull())).first()
    if missing:
        raise ValueError("the column that groups the rows contains missing values")
    if most < k:
        raise ValueError(f"cannot make {k} folds: no class has {k} rows")
    if least < k:
        warnings.warn(f"the smallest class has {least} rows, fewer than {k} folds", stacklevel=3)
    starts = sums_before(totals, [F.col("__class")], "__total", "__start")
    ranked = group_ranks(df, target, key, "__rank").join(starts, F.col(target) == F.col("__class"))
    return ranked.select(*df.columns, even_part(F.col("__rank"), F.col("__total"), k, F.col("__start")).cast("int").alias(out))


def train_rows(df: DataFrame, fold: int, column: str = "fold") -> DataFrame:
    return df.where(F.col(column) != fold)


def validation_rows(df: DataFrame, fold: int, column: str = "fold") -> DataFrame:
    return df.where(F.col(column) == fold)


def fold_sizes(df: DataFrame, target: str | None = None, column: str = "fold") -> DataFrame:
    """Rows per fold (and class)."""
    keys = [column] if target is None else [column, target]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def sample_size(n_rows: int, fraction: float) -> int:
    """Rows in a sample: the truncated share, at least one."""
    return max(1, int(n_rows * fraction))


def exact_sample(df: DataFrame, fraction: float, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """A random sample without replacement of exactly ``max(1, int(n * fraction))`` rows."""
    if fraction <= 0.0:
        raise ValueError("the sampled fraction must be greater than 0")
    if fraction >= 1.0:
        return df

    def sizes(totals: dict) -> dict:
        size = sample_size(totals[0], fraction)
        return {0: [size, totals[0] - size]}

    split = split_by_rank(df, _random_key(df, ids, seed), sizes, "__part")
    return split.where("__part = 0").drop("__part")


def ordered_split(df: DataFrame, n_first: int, order: Sequence[str], out: str = "part") -> DataFrame:
    """Mark the first ``n_first`` rows in column order with 0 and the rest with 1."""

    def sizes(totals: dict) -> dict:
        first = min(max(n_first, 0), totals[0])
        return {0: [first, totals[0] - first]}

    return split_by_rank(df, order_key(df, order), sizes, out, sorted_text=True)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """A preview of the first ``n`` rows in column order."""
    return df.orderBy(*order).limit(n)
