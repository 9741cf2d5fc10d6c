"""A tree ensemble as a table of nodes, walked by native expressions or in Arrow batches.

The table has one row per node: ``tree, node, left, right, slot, threshold, codes, value, cover, weight``. Nodes of a
tree are numbered from 0, its root, without gaps; a leaf has ``left`` below 0. A split sends a
row left if ``codes`` (where given) holds the value of its slot, else if that is at most ``threshold``. The table is
bounded by the parameters of the ensemble, so it is packed into one value that every task gets with the plan.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import trees
from gridloom.operators.metrics import REGRESSION_METRICS, regression_metrics, roc_auc
from gridloom.session import scratch_path

# Tasks get the code that walks a batch by value: executors need numpy and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(trees)
COPIES = "__copies"  # weight of a training row that stands for several equal ones
_FIELDS = ("node", "left", "right", "slot", "threshold", "codes", "value")


def model_nodes(spark: SparkSession, model: Any) -> DataFrame:
    """The nodes of a fitted Spark ML ensemble with the learner's ``gain``, read from the model's own Parquet form."""
    path = scratch_path(spark, "nodes")
    model.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    node, split = F.col("nodeData"), F.col("nodeData.split")
    nominal = split["numCategories"] >= 0
    combined = model.isDefined("weightCol") and model.getOrDefault("weightCol") == COPIES
    # the first of a node's statistics is its sum of weights
    cover = F.get(node["impurityStats"], 0).cast("long") if combined else node["rawCount"]
    return (
        spark.read.parquet(f"{path}/data")
        .select(
            F.col("treeID").alias("tree"),
            node["id"].alias("node"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            split["featureIndex"].alias("slot"),
            F.when(~nominal, F.get(split["leftCategoriesOrThreshold"], 0)).alias("threshold"),
            F.when(nominal, split["leftCategoriesOrThreshold"]).alias("codes"),
            node["prediction"].alias("value"),
            cover.alias("cover"),
            node["gain"].alias("gain"),
        )
        .join(weights, "tree")
    )


def packed(nodes: DataFrame) -> Column:
    """The ensemble as an array of ``(tree, weight, nodes)``, a scalar subquery that is run once."""
    trees = nodes.groupBy("tree").agg(F.first("weight").alias("weight"), F.sort_array(F.collect_list(F.struct(*_FIELDS))).alias("nodes"))
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees")).scalar()


def max_depth(nodes: DataFrame) -> int:
    """Steps of the longest walk, from the child links; one round per level of the deepest tree."""
    inner = nodes.where("left >= 0").select("tree", F.explode(F.array(*[F.struct("node", F.col(side).alias("child")) for side in ("left", "right")])).alias("e"))
    links = {(r["tree"], r["child"]): r["node"] for r in inner.select("tree", "e.node", "e.child").collect()}
    depth: dict[tuple[int, int], int] = {}
    for key in sorted(links):  # a parent has a smaller number than its children
        depth[key] = depth.get((key[0], links[key]), 0) + 1
    return max(depth.values(), default=0)


def _next(nodes: Column, at: Column, x: Column) -> Column:
    node = F.get(nodes, at)
    value = F.get(x, node["slot"])
    left = F.when(node["codes"].isNotNull(), F.array_contains(node["codes"], value)).otherwise(value <= node["threshold"])
    return F.when(node["left"] < 0, at).when(left, node["left"]).otherwise(node["right"])


def path_terms(trees: Column, x: Column, depth: int) -> Column:
    """``(slot, change)`` of every step of a row through all trees: the change of the node value, by the feature that is split."""
    steps = F.sequence(F.lit(1), F.lit(max(1, depth)))

    def terms(tree: Column) -> Column:
        nodes = tree["nodes"]
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<slot:int,change:double>>").alias("terms"))

        def step(acc: Column, _: Column) -> Column:
            node = F.get(nodes, acc["at"])
            child = _next(nodes, acc["at"], x)
            change = F.struct(node["slot"].cast("int").alias("slot"), (tree["weight"] * (F.get(nodes, child)["value"] - node["value"])).alias("change"))
            return F.struct(child.alias("at"), F.when(node["left"] < 0, acc["terms"]).otherwise(F.concat(acc["terms"], F.array(change))).alias("terms"))

        return F.aggregate(steps, start, step, lambda acc: acc["terms"])

    return F.flatten(F.transform(trees, terms))


def path_contributions(nodes: DataFrame, df: DataFrame, x: Column, n_slots: int, keep: list[str]) -> DataFrame:
    """``keep``, ``bias``, ``margin`` and ``contributions`` per slot, without a Python worker."""
    trees = packed(nodes)
    bias = F.aggregate(F.col("__trees"), F.lit(0.0), lambda total, tree: total + tree["weight"] * F.get(tree["nodes"], 0)["value"])
    walked = df.select(*keep, x.alias("__x")).withColumn("__trees", trees)
    walked = walked.withColumns({"bias": bias, "__terms": path_terms(F.col("__trees"), F.col("__x"), max_depth(nodes))}).drop("__trees", "__x")

    def of(slot: Column) -> Column:
        return F.aggregate(F.filter("__terms", lambda t: t["slot"] == slot), F.lit(0.0), lambda total, t: total + t["change"])

    out = walked.withColumn("contributions", F.transform(F.sequence(F.lit(0), F.lit(n_slots - 1)), of))
    margin = F.aggregate("contributions", F.col("bias"), lambda total, c: total + c)
    return out.select(*keep, "bias", margin.alias("margin"), "contributions")


def _walked_trees(nodes: DataFrame) -> list[dict[str, Any]]:
    """The node table as arrays for :func:`~gridloom.functions.trees.staged_batches`, bounded by the parameters of the ensemble."""
    by_tree: dict[Any, list[Any]] = {}
    for row in nodes.select("tree", "weight", *_FIELDS).collect():
        by_tree.setdefault(row["tree"], []).append(row)

    def numbers(rows: list[Any], name: str) -> np.ndarray:
        return np.array([np.nan if r[name] is None else r[name] for r in rows], dtype=float)

    found = []
    for number in sorted(by_tree, key=lambda t: (t is not None, t)):
        rows = sorted(by_tree[number], key=lambda r: r["node"])
        nominal = np.array([r["codes"] is not None for r in rows])
        known = np.unique([float(c) for r in rows for c in r["codes"] or () if c is not None])
        left_codes = np.array([np.isin(known, [float(c) for c in r["codes"] or () if c is not None]) for r in rows])
        found.append(
            {
                "weight": float(numbers(rows[:1], "weight")[0]),
                "left": np.array([r["left"] for r in rows], dtype=np.int64),
                "right": np.array([r["right"] for r in rows], dtype=np.int64),
                "slot": np.array([-1 if r["slot"] is None else r["slot"] for r in rows], dtype=np.int64),
                "threshold": numbers(rows, "threshold"),
                "value": numbers(rows, "value"),
                "empty": np.array([r["value"] is None for r in rows]),
                "nominal": nominal,
                "known": known,
                "left_codes": left_codes,
            }
        )
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows × slots of an array column; what a row does not have is NaN."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == lengths[0]).all():
        return values.reshape(len(column), -1) if lengths[0] else np.empty((len(column), 0))
    x = np.full((len(column), lengths.max()), np.nan)
    x[np.arange(x.shape[1]) < lengths[:, None]] = values
    return x


def staged_margins(nodes: DataFrame, df: DataFrame, x: Column, keep: list[str], out: str = "staged") -> DataFrame:
    """``keep`` and the margins of the first 1, 2, … trees as an array, in one pass over the rows in Arrow batches."""
    ensemble = df.sparkSession.sparkContext.broadcast(_walked_trees(nodes))
    depth, prepare, matrix = max_depth(nodes), trees.staged_batches, _matrix
    rows = df.select(*keep, F.coalesce(x, F.array().cast("array<double>")).alias("__x"))
    schema = T.StructType([*[rows.schema[name] for name in keep], T.StructField(out, T.ArrayType(T.DoubleType()))])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = prepare(ensemble.value, depth)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            sums, missing = margins(matrix(batch.column(batch.num_columns - 1)))
            offsets = pa.array(np.arange(batch.num_rows + 1) * sums.shape[1], type=pa.int32())
            staged = pa.ListArray.from_arrays(offsets, pa.array(sums.reshape(-1), mask=missing.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*kept, staged], names=[*keep, out])

    return rows.mapInArrow(walk, schema)


def staged_metrics(staged: DataFrame, label: str, metric: str, column: str = "staged", n_rows: int | None = None) -> DataFrame:
    """``n_trees, metric`` of every beginning of the ensemble, from one job: the area under the ROC curve of
    the margins, or the error of the values. ``n_rows`` of ``staged`` only decides the number of ranges."""
    rows = staged.select(F.col(label).alias("__label"), F.posexplode(column).alias("__at", "__score")).withColumn("n_trees", F.col("__at") + 1)
    if metric in REGRESSION_METRICS:
        found = regression_metrics(rows, "__label", "__score", ["n_trees"])
    else:
        found = roc_auc(rows, "__label", "__score", ["n_trees"], n_rows)
    return found.select("n_trees", F.col(metric).alias("metric"))
