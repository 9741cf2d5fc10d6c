"""Boosted trees of two classes over binned rows in files: the learner for tables of many rows.

It takes the thresholds and the rules of Spark's learner, so its trees are the same up to the order in which numbers are added. Spark's learner
keeps each row as objects, in memory or written out by Java, for all of its passes. Here a row is a byte per slot in a chunk of rows, written
once; a pass reads the chunks and gives sums per bin, whose size depends on nodes and bins alone. Margins are not kept but found again from the bins.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import bins as bin_code
from gridloom.sources.readers import scan_tasks
from gridloom.sources.writers import stored

# Tasks get the code by value: executors need numpy and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(bin_code)
MAX_DEPTH = 6  # a chunk meets every split of a tree
CHUNKS_PER_FILE, CHUNKS_PER_TASK = 50, 100  # of at most an Arrow batch of rows each
PARTIAL_SUMS = 64  # sums of so many tasks reach the driver; of more they are added up first
_LEAST = -1.7976931348623157e308
_EPSILON = 2.220446049250313e-16


def can_fit(learner: Any, df: DataFrame) -> bool:
    """Two classes, all slots at every node, numeric slots, a byte for a bin, rows of equal weight."""
    attributes = df.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    return (
        isinstance(learner, GBTClassifier)
        and not learner.isDefined("weightCol")
        and learner.getFeatureSubsetStrategy() == "all"
        and learner.getSubsamplingRate() == 1.0
        and learner.getMaxBins() <= 256
        and learner.getMaxDepth() <= MAX_DEPTH
        and "nominal" not in attributes
        and not any("vals" in a for a in attributes.get("binary", ()))
    )


# --- thresholds and chunks ---------------------------------------------------


def _java_object(package: Any, name: str) -> Any:
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def _thresholds(learner: GBTClassifier, df: DataFrame, n_rows: int) -> list[np.ndarray]:
    """Spark's own, which also checks labels and vectors of all rows."""
    jvm, gateway = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._gateway
    learner._transfer_params_to_java()
    rows = _java_object(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(learner._java_obj, df._jdf, jvm.scala.Some(2))
    n_slots = rows.first().features().size()
    limits = gateway.new_array(jvm.int, n_slots)
    for i in range(n_slots):
        limits[i] = min(learner.getMaxBins(), n_rows)
    collections, tree = jvm.scala.collection.immutable, jvm.org.apache.spark.mllib.tree
    metadata = jvm.org.apache.spark.ml.tree.impl.DecisionTreeMetadata(
        n_slots, n_rows, float(n_rows), 0, min(learner.getMaxBins(), n_rows), _java_object(collections, "Map").empty(), _java_object(collections, "Set").empty(), limits,
        _java_object(tree.impurity, "Variance"), _java_object(tree.configuration, "QuantileStrategy").Sort(),
        learner.getMaxDepth(), learner.getMinInstancesPerNode(), 0.0, learner.getMinInfoGain(), 1, n_slots,
    )
    found = _java_object(jvm.org.apache.spark.ml.tree.impl, "RandomForest").findSplits(rows, metadata, learner.getSeed())
    return [np.array([split.threshold() for split in found[i]], dtype=float) for i in range(n_slots)]


def _chunks(df: DataFrame, label: str, thresholds: list[np.ndarray]) -> DataFrame:
    """``n, label, bins`` of each Arrow batch of rows."""
    limits, code = df.sparkSession.sparkContext.broadcast(thresholds), bin_code

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            labels = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint8)
            cells = [pa.array([n], pa.int32()), pa.array([labels.tobytes()], pa.binary()), pa.array([code.binned(x, limits.value).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, names=["n", "label", "bins"])

    rows = df.select(F.col(label).cast("double"), vector_to_array("features"))
    return stored(rows.mapInArrow(pack, "n int, label binary, bins binary"), "bins", CHUNKS_PER_FILE)


def _sums(chunks: DataFrame, n_chunks: int, forest: list, shape: bin_code.Shape, nodes: list[int], sizes: list[int]) -> np.ndarray:
    """The histograms of all rows, in one pass over the chunks."""
    dims, groups, code = (3, len(nodes), sum(sizes)), bin_code.grouped(sizes), bin_code

    def result(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for n, label, bins in zip(*(batch.column(i) for i in range(3))):
                labels = np.frombuffer(label.as_buffer(), dtype=np.uint8)
                cells = np.frombuffer(bins.as_buffer(), dtype=np.uint8).reshape(-1, n.as_py())
                sums = code.histograms(labels, cells, forest, shape, nodes, sizes, groups)
                total = sums if total is None else np.add(total, sums, out=total)
        if total is not None:
            yield result(code.by_slot(total, sizes, groups))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims)
        for batch in batches:
            for sums in batch.column(1):
                total += np.frombuffer(sums.as_buffer()).reshape(dims)
        yield result(total)

    schema = "part int, sums binary"
    partial = chunks.mapInArrow(count, schema)
    if n_chunks > PARTIAL_SUMS * CHUNKS_PER_TASK:
        partial = partial.repartition(PARTIAL_SUMS).mapInArrow(add, schema)
    total = np.zeros(dims)
    for row in sorted(partial.collect(), key=lambda r: r["part"]):  # a fixed order of additions
        total += np.frombuffer(row["sums"]).reshape(dims)
    return total


# --- growing -------------------------------------------------------------------


@dataclass
class _Node:
    """A node with number, sum and sum of squares of its targets."""

    stats: np.ndarray
    impurity: float
    level: int
    leaf: bool = False
    gain: float = 0.0
    slot: int = -1
    split: int = -1  # last bin that goes left
    left: int = -1
    right: int = -1

    @property
    def value(self) -> float:
        return float(self.stats[1] / self.stats[0]) if self.stats[0] else 0.0


def _variance(n: Any, total: Any, squares: Any) -> Any:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, 0.0, (squares - total * total / n) / n)


def _best(cells: np.ndarray, sizes: list[int], parent: _Node | None, least_rows: int, least_gain: float) -> tuple[_Node, float, int, int, np.ndarray, np.ndarray]:
    """The node, gain, slot and split of the first of the best splits, and the statistics of its sides; a node's histograms are ``cells``."""
    best: tuple[float, int, int, Any, Any] = (-math.inf, -1, -1, None, None)
    start = 0
    for slot, size in enumerate(sizes):
        sums = np.cumsum(cells[:, start : start + size], axis=1)
        start += size
        if size == 1:
            continue
        left, right = sums[:, :-1], sums[:, -1:] - sums[:, :-1]
        if parent is None:
            stats = left[:, 0] + right[:, 0]
            parent = _Node(stats, float(_variance(*stats)), 0)
        n = left[0] + right[0]
        gains = parent.impurity - left[0] / n * _variance(*left) - right[0] / n * _variance(*right)
        gains = np.where((left[0] < least_rows) | (right[0] < least_rows) | (gains < least_gain), _LEAST, gains)
        i = int(np.argmax(gains))
        if gains[i] > best[0]:
            best = (float(gains[i]), slot, i, left[:, i], right[:, i])
    return parent, *best


def _grown(chunks: DataFrame, n_chunks: int, forest: list, sizes: list[int], learner: GBTClassifier) -> list[_Node]:
    """The nodes of the next tree, level by level."""
    nodes: list[_Node] = []
    open_nodes = [0]
    depth = learner.getMaxDepth()
    while open_nodes:
        cells = _sums(chunks, n_chunks, forest, _shape(nodes) or [(-1, -1, -1, -1)], open_nodes, sizes)
        following = []
        for i, number in enumerate(open_nodes):
            node, gain, slot, split, *sides = _best(cells[:, i], sizes, nodes[number] if nodes else None, learner.getMinInstancesPerNode(), learner.getMinInfoGain())
            if not nodes:
                nodes.append(node)
            if gain <= 0:
                node.leaf = True
                if gain == _LEAST:
                    node.impurity = -1.0
                continue
            node.gain, node.slot, node.split = gain, slot, split
            node.left, node.right = len(nodes), len(nodes) + 1
            for stats in sides:
                child = _Node(stats, float(_variance(*stats)), node.level + 1)
                child.leaf = child.level == depth or abs(child.impurity) < _EPSILON
                if not child.leaf:
                    following.append(len(nodes))
                nodes.append(child)
        open_nodes = following
    return nodes


def _shape(nodes: list[_Node]) -> bin_code.Shape:
    return [(n.slot, n.split, n.left, n.right) for n in nodes]


def _java_tree(jvm: Any, gateway: Any, nodes: list[_Node], thresholds: list[np.ndarray]) -> Any:
    """The tree as Spark's; leaves of equal value that share a parent become one."""
    tree = jvm.org.apache.spark.ml.tree

    def made(number: int) -> tuple[Any, float | None]:
        node = nodes[number]
        stats = gateway.new_array(jvm.double, 3)
        for i in range(3):
            stats[i] = float(node.stats[i])
        calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(node.stats[0]))
        if node.slot < 0:
            return tree.LeafNode(node.value, node.impurity, calculator), node.value
        (left, a), (right, b) = made(node.left), made(node.right)
        if a is not None and a == b:
            return tree.LeafNode(a, node.impurity, calculator), a
        split = tree.ContinuousSplit(node.slot, float(thresholds[node.slot][node.split]))
        return tree.InternalNode(node.value, node.impurity, node.gain, left, right, split, calculator), None

    return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(f"dtr_{uuid.uuid4().hex[:12]}", made(0)[0], len(thresholds))


def fit_classifier(learner: GBTClassifier, df: DataFrame, label: str) -> GBTClassificationModel:
    """The model that ``learner`` would fit to ``features`` and the label, see :func:`can_fit`."""
    n_rows = df.count()
    if not n_rows:
        return learner.fit(df)
    thresholds = _thresholds(learner, df, n_rows)
    sizes = [len(limits) + 1 for limits in thresholds]
    if max(sizes) == 1:  # no split is possible
        return learner.fit(df)
    chunks = _chunks(df, label, thresholds)
    n_chunks = chunks.count()
    forest: list[tuple[float, bin_code.Shape, np.ndarray]] = []
    grown = []
    with scan_tasks(chunks, CHUNKS_PER_TASK):
        for i in range(learner.getMaxIter()):
            nodes = _grown(chunks, n_chunks, forest, sizes, learner)
            forest.append((learner.getStepSize() if i else 1.0, _shape(nodes), np.array([n.value for n in nodes])))
            grown.append(nodes)

    sc = df.sparkSession.sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(grown))
    weights = gateway.new_array(jvm.double, len(grown))
    for i, nodes in enumerate(grown):
        trees[i], weights[i] = _java_tree(jvm, gateway, nodes, thresholds), float(forest[i][0])
    model = jvm.org.apache.spark.ml.classification.GBTClassificationModel(learner.uid, trees, weights, len(thresholds), 2)
    return learner._copyValues(GBTClassificationModel(model))
