"""Per-row contributions of a trained ensemble and ranked global importances."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridloom.functions import trees
from gridloom.functions.trees import Tree
from gridloom.operators.ensemble import model_nodes
from gridloom.operators.folds import exact_sample, first_rows
from gridloom.operators.train import BoostedTrees, MulticlassModel, TrainedModel

# Method names a configuration may use.
METHODS = {"shap": "shap", "treeinterpreter": "path", "path": "path"}

# --- the ensemble as tables and arrays ---------------------------------------


def node_table(spark: SparkSession, trained: TrainedModel) -> DataFrame:
    """The nodes of a trained model, see :func:`~gridloom.operators.ensemble.model_nodes`."""
    return model_nodes(spark, trained.model)


def collect_trees(nodes: DataFrame) -> list[Tree]:
    """Collect the ensemble: its size is bounded by the training parameters, not by the data."""
    by_tree: dict[int, list[Any]] = {}
    for row in nodes.collect():
        by_tree.setdefault(row["tree"], []).append(row)
    ensemble = []
    for number in sorted(by_tree):
        rows = sorted(by_tree[number], key=lambda r: r["node"])
        inner = [r["left"] >= 0 for r in rows]
        nominal = np.array([i and r["codes"] is not None for i, r in zip(inner, rows)])
        # one place more than the largest code that goes left, for all codes beyond
        width = max([int(max(r["codes"], default=-1)) + 2 for r, n in zip(rows, nominal) if n], default=0)
        left_codes = np.zeros((len(rows), width), dtype=bool)
        for i, row in enumerate(rows):
            if nominal[i]:
                left_codes[i, [int(code) for code in row["codes"]]] = True
        ensemble.append(
            Tree(
                weight=rows[0]["weight"],
                left=np.array([r["left"] for r in rows]),
                right=np.array([r["right"] for r in rows]),
                slot=np.array([r["slot"] if i else 0 for i, r in zip(inner, rows)]),
                threshold=np.array([r["threshold"] if i and not n else 0.0 for i, n, r in zip(inner, nominal, rows)]),
                value=np.array([r["value"] for r in rows]),
                cover=np.array([float(r["cover"]) for r in rows]),
                nominal=nominal,
                left_codes=left_codes,
            )
        )
    return ensemble


# --- operators ---------------------------------------------------------------

# Tasks get the tree code by value: executors need numpy and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(trees)
_PREPARE = {"shap": trees.shap_batches, "path": trees.path_batches}


def contributions(trained: TrainedModel | MulticlassModel, df: DataFrame, keep: Sequence[str], method: str = "shap") -> DataFrame:
    """``keep`` columns, ``bias``, ``margin`` and the ``contributions`` array of every row.

    ``margin`` is bias plus all contributions: the raw score of the positive class, or
    the regression value. One narrow stage; rows travel to Python in Arrow batches. A model of
    several classes gives a row for each, with its ``class``.
    """
    if isinstance(trained, MulticlassModel):
        parts = [contributions(one, df, keep, method).withColumn("class", F.lit(float(c))) for one, c in zip(trained.models, trained.classes)]
        return reduce(DataFrame.unionByName, parts)
    return ensemble_contributions(node_table(df.sparkSession, trained), df, keep, method)


def ensemble_contributions(nodes: DataFrame, df: DataFrame, keep: Sequence[str], method: str = "shap") -> DataFrame:
    """The same for an ensemble that is given as a table of nodes."""
    kind = METHODS.get(method.lower())
    if kind is None:
        raise ValueError(f"unsupported importance method: {method}")
    spark = df.sparkSession
    # plain arrays, bounded by the training parameters
    ensemble = spark.sparkContext.broadcast([vars(tree) for tree in collect_trees(nodes)])
    prepare = _PREPARE[kind]
    fields = [df.schema[name] for name in keep]
    schema = T.StructType(
        [*fields, T.StructField("bias", T.DoubleType()), T.StructField("margin", T.DoubleType()), T.StructField("contributions", T.ArrayType(T.DoubleType()))]
    )

    def explain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch_values = prepare(ensemble.value)
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            column = batch.column(batch.num_columns - 1)
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(float)
            bias, values = batch_values(x)
            offsets = pa.array(np.arange(n + 1) * x.shape[1], type=pa.int32())
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays += [
                pa.array(np.full(n, bias)),
                pa.array(bias + values.sum(axis=1)),
                pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1))),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "bias", "margin", "contributions"])

    vectors = df.select(*keep, vector_to_array("features").alias("__x"))
    return vectors.mapInArrow(explain_batches, schema)


def mean_abs_importance(values: DataFrame, groups: Sequence[tuple[str, Sequence[int]]], column: str = "contributions") -> DataFrame:
    """``(feature, importance)``: mean absolute contribution per group of array positions.

    Positions of one group are added per row first. A single aggregate with one
    number per group, whatever the number of rows.
    """
    total = {i: sum((F.col(column)[p] for p in positions[1:]), F.col(column)[positions[0]]) for i, (_, positions) in enumerate(groups)}
    row = values.agg(*[F.avg(F.abs(expr)).alias(f"m{i}") for i, expr in total.items()])
    entries = [F.struct(F.lit(name).alias("feature"), F.col(f"m{i}").alias("importance")) for i, (name, _) in enumerate(groups)]
    return row.select(F.inline(F.array(*entries)))


def rank_importance(importance: DataFrame) -> DataFrame:
    """Add ``rank`` 1…n by descending importance; one row per feature, so one small window."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature")
    return importance.withColumn("rank", F.row_number().over(order))


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def slot_groups(slots: Sequence[tuple[str, str]], rollup: dict[str, str] | None = None, by_source: bool = False) -> list[tuple[str, list[int]]]:
    """Array positions per vector slot, per source feature, or per ``rollup`` name of the source."""
    groups: dict[str, list[int]] = {}
    for position, (slot, source) in enumerate(slots):
        name = rollup.get(source, source) if rollup is not None else source if by_source else slot
        groups.setdefault(name, []).append(position)
    return list(groups.items())


@dataclass
class Explanation:
    """Contributions and importances of one explanation run."""

    method: str
    values: DataFrame
    slots: list[tuple[str, str]]

    @property
    def importance(self) -> DataFrame:
        return mean_abs_importance(self.values, slot_groups(self.slots))

    @property
    def rankings(self) -> DataFrame:
        return rank_importance(self.importance)

    def by_source(self) -> DataFrame:
        """Importance per source feature."""
        return mean_abs_importance(self.values, slot_groups(self.slots, by_source=True))

    def by_group(self, super_category: dict[str, str]) -> DataFrame:
        """Importance per group of source features."""
        return mean_abs_importance(self.values, slot_groups(self.slots, rollup=super_category))


def explain(
    trained: TrainedModel, df: DataFrame, ids: Sequence[str], method: str = "shap", fraction: float = 1.0, seed: int = 42
) -> Explanation:
    """Sample rows, compute contributions and rank the features by their mean absolute contribution."""
    if method.lower() not in METHODS:
        raise ValueError(f"unsupported importance method: {method}")
    sample = exact_sample(df.select(*ids, "features"), fraction, ids, seed)
    values = contributions(trained, sample, ids, method)
    single = trained.models[0] if isinstance(trained, MulticlassModel) else trained
    slots = trained.slots or [(f"feature_{i}", f"feature_{i}") for i in range(single.model.numFeatures)]
    return Explanation(method.lower(), values, slots)


def split_counts(nodes: DataFrame) -> DataFrame:
    """``(slot, n_splits)`` of an ensemble's inner nodes."""
    return nodes.where("left >= 0").groupBy("slot").agg(F.count(F.lit(1)).alias("n_splits"))


def split_importance(spark: SparkSession, trained: TrainedModel) -> DataFrame:
    """How often each feature is split on, with the learner's gain importance."""
    splits = split_counts(node_table(spark, trained))
    gains = trained.model.featureImportances.toArray().tolist()
    rows = [(i, slot, float(gains[i]) if i < len(gains) else 0.0) for i, (slot, _) in enumerate(trained.slots)]
    names = spark.createDataFrame(rows, "slot int, feature string, gain_importance double")
    joined = names.join(splits, "slot", "left").select("feature", F.coalesce("n_splits", F.lit(0)).alias("n_splits"), "gain_importance")
    return joined.orderBy(F.desc("n_splits"), "feature")


def surrogate(
    trained: TrainedModel, df: DataFrame, ids: Sequence[str], max_rows: int | None = None, max_arity: int = 0, many_rows: bool = False
) -> TrainedModel:
    """A fresh classifier fitted to the hard decisions of a model on all rows, or on the first ``max_rows`` in id order."""
    rows = df if max_rows is None else first_rows(df.select(*ids, "features"), max_rows, ids)
    scored = trained.model.transform(rows.select("features"))
    decided = scored.select("features", (vector_to_array("probability")[1] > 0.5).cast("double").alias("label"))
    return BoostedTrees("classification", trained.params, many_rows=many_rows).fit(decided, trained.slots, max_arity)
