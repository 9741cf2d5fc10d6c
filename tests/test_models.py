import itertools
import math
import os
import pathlib
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gridloom.config import parse_space
from gridloom.functions import bins as bin_code
from gridloom.functions import trees as tree_code
from gridloom.operators import boosting
from gridloom.operators import ensemble as en
from gridloom.operators import explain as ex
from gridloom.operators import metrics as m
from gridloom.operators import search
from gridloom.operators.encode import FeatureEncoder
from gridloom.operators.folds import assign_folds
from gridloom.operators.search import SearchResult, cross_validate_search, encode_folds
from gridloom.operators.train import BoostedTrees, TrainedModel, best_length, complete_params, first_trees, learner_options
from gridloom.sources.metadata import FeaturePlan
from gridloom.plans import catalog
from gridloom.sources.readers import scan_tasks, spread
from gridloom.sources.writers import stored

PARAMS = {"n_estimators": 6, "num_leaves": 8, "min_data_in_leaf": 5, "learning_rate": 0.3, "feature_fraction": 1.0}


@pytest.fixture(scope="module")
def frame(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_shipdate", "l_returnflag",
        F.when(F.col("l_discount") < 0.02, None).otherwise(F.col("l_discount")).alias("l_discount"),
        ((F.col("l_quantity") > 20) & (F.col("l_returnflag") != "N") | (F.col("l_tax") > 0.06)).cast("double").alias("label"),
    )
    plan = FeaturePlan(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "label",
                       numeric=["l_quantity", "l_tax", "l_discount"], categorical=["l_returnflag"], keep_missing=["l_discount"])
    return df.cache(), plan


@pytest.fixture(scope="module")
def trained(frame):
    df, plan = frame
    encoder = FeatureEncoder(plan).fit(df)
    data = encoder.feature_frame(df, [*plan.ids, "label"]).cache()
    return BoostedTrees("classification", PARAMS).fit(data, encoder.vector_slots(), encoder.max_arity()), data, plan.ids


def test_auc_equals_evaluator_with_ties(spark, frame, monkeypatch):
    df, _ = frame
    scored = df.select("label", (F.col("l_quantity") / 50).alias("p"), "l_returnflag")
    want = BinaryClassificationEvaluator(numBins=0, rawPredictionCol="p").evaluate(scored)
    assert m.roc_auc(scored, "label", "p").first()["rocauc"] == pytest.approx(want, abs=1e-12)
    monkeypatch.setattr(m, "ROWS_PER_RANGE", 100)
    assert m.roc_auc(scored, "label", "p").first()["rocauc"] == pytest.approx(want, abs=1e-12)
    groups = {r["l_returnflag"]: r["rocauc"] for r in m.roc_auc(scored, "label", "p", ["l_returnflag"]).collect()}
    for flag, value in groups.items():
        one = BinaryClassificationEvaluator(numBins=0, rawPredictionCol="p").evaluate(scored.where(F.col("l_returnflag") == flag))
        assert value == pytest.approx(one, abs=1e-12)


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, p double")
    assert m.roc_auc(df, "y", "p").first()["rocauc"] is None


def test_threshold_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.6), (0, 0.1), (1, 0.51)], "y int, p double")
    row = m.threshold_metrics(df, "y", "p").first()
    assert (row.tp, row.fp, row.fn, row.tn) == (2, 1, 1, 1)
    assert row.recall == pytest.approx(2 / 3) and row.precision == pytest.approx(2 / 3) and row.accuracy == pytest.approx(0.6)
    empty = m.threshold_metrics(df.where("p < 0.2"), "y", "p").first()
    assert empty.recall == 0.0 and empty.precision == 0.0


@pytest.mark.parametrize("problem,metric", [("classification", "rmse"), ("regression", "rocauc"), ("classification", "f1")])
def test_unknown_metric(problem, metric):
    with pytest.raises(ValueError):
        m.check_metric(problem, metric)


def test_best_trial(spark):
    trials = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.9), (3, None)], "trial_number int, value double")
    assert m.best_trial(trials, "gt").first()["trial_number"] == 1
    assert m.best_trial(trials, "lt").first()["trial_number"] == 0


def test_early_stopping_rule():
    assert best_length([3, 2, 1, 2, 3]) == 3
    assert best_length([3, 2, 2.5, 2.6, 1], patience=2) == 2
    assert best_length([1.0]) == 1


def test_parameter_mapping():
    options = learner_options(complete_params({"num_leaves": 150.0, "num_iterations": 7.9}))
    assert options["maxDepth"] == 8 and options["maxIter"] == 7
    with pytest.warns(UserWarning):
        learner_options(complete_params({"reg_lambda": 0.1}))
    with pytest.raises(ValueError):
        learner_options(complete_params({"boosting_type": "dart"}))


def test_prefix_equals_shorter_training(trained, tmp_path, spark):
    model, data, ids = trained
    short = BoostedTrees("classification", {**PARAMS, "n_estimators": 3}).fit(data, model.slots, 5)
    cut = TrainedModel(first_trees(model.model, 3), "classification", PARAMS)
    a = {tuple(r[1:]): r[0] for r in short.score(data, ids).collect()}
    b = {tuple(r[1:]): r[0] for r in cut.score(data, ids).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)
    cut.save(spark, str(tmp_path / "cut"))
    again = TrainedModel.load(spark, str(tmp_path / "cut"))
    assert {tuple(r[1:]): r[0] for r in again.score(data, ids).collect()} == b


@pytest.mark.parametrize("method", ["path", "shap", "treeinterpreter"])
def test_contributions_add_up(trained, method):
    model, data, ids = trained
    values = ex.contributions(model, data, ids, method).toPandas().set_index(ids)
    raw = model.model.transform(data).select(*ids, vector_to_array("rawPrediction")[1].alias("raw")).toPandas().set_index(ids)
    joined = values.join(raw)
    assert len(values) == data.count()
    assert np.allclose(joined["margin"], joined["raw"], atol=1e-9)
    sums = joined["bias"] + np.vstack(joined["contributions"]).sum(axis=1)
    assert np.allclose(sums, joined["raw"], atol=1e-9)


def _brute_force(tree, x):
    """Shapley values by enumerating coalitions with the path-dependent expectation."""
    slots = sorted({int(s) for s, left in zip(tree.slot, tree.left) if left >= 0})

    def value(node, known):
        if tree.left[node] < 0:
            return tree.value[node]
        left, right, s = tree.left[node], tree.right[node], int(tree.slot[node])
        if s in known:
            go = tree.goes_left(np.array([node]), np.array([x[s]]))[0]
            return value(left if go else right, known)
        return (tree.cover[left] * value(left, known) + tree.cover[right] * value(right, known)) / tree.cover[node]

    phi = np.zeros(len(x))
    for i in slots:
        others = [s for s in slots if s != i]
        for size in range(len(others) + 1):
            w = math.factorial(size) * math.factorial(len(slots) - size - 1) / math.factorial(len(slots))
            for subset in itertools.combinations(others, size):
                phi[i] += w * (value(0, {*subset, i}) - value(0, set(subset)))
    return tree.weight * phi


def _nominal(frame):
    """A model that splits a category by subsets of its codes, as models saved by older versions do."""
    df, plan = frame
    code = F.when(F.col("l_returnflag") == "A", 1.0).when(F.col("l_returnflag") == "N", 0.0).otherwise(2.0)
    flat = df.select(*plan.ids, "label", "l_quantity", code.alias("flag", metadata={"ml_attr": {"name": "flag", "type": "nominal", "vals": ["N", "A", "R"]}}))
    data = VectorAssembler(inputCols=["l_quantity", "flag"], outputCol="features").transform(flat)
    return BoostedTrees("classification", PARAMS).fit(data, [("q", "q"), ("flag", "flag")]), data, plan.ids


@pytest.mark.parametrize("nominal", [False, True])
def test_shap_equals_coalition_enumeration(spark, frame, trained, monkeypatch, nominal):
    model, data, ids = _nominal(frame) if nominal else trained
    trees = ex.collect_trees(ex.node_table(spark, model))
    arrays = [vars(t) for t in trees]
    assert any(t.nominal.any() for t in trees) == nominal
    x = np.array([r["features"].toArray() for r in data.orderBy(*ids).limit(25).collect()])
    want = np.array([sum(_brute_force(t, row) for t in trees) for row in x])
    run = tree_code.shap_batches(arrays)
    assert np.allclose(run(x)[1], want, atol=1e-10)
    assert np.allclose(run(x[:3])[1], want[:3], atol=1e-10)  # stored tables
    monkeypatch.setattr(tree_code, "SHAP_TABLE_CELLS", 0)
    assert np.allclose(tree_code.shap_batches(arrays)(x[:2])[1], want[:2], atol=1e-10)


@pytest.mark.parametrize("nominal", [False, True])
def test_native_walk_equals_the_model(spark, frame, trained, nominal):
    model, data, ids = _nominal(frame) if nominal else trained
    nodes, x = ex.node_table(spark, model), vector_to_array("features")
    native = en.path_contributions(nodes, data, x, len(model.slots), ids).toPandas().set_index(ids).sort_index()
    arrow = ex.contributions(model, data, ids, "path").toPandas().set_index(ids).sort_index()
    assert np.allclose(native["margin"], arrow["margin"], atol=1e-9)
    assert np.allclose(np.vstack(native["contributions"]), np.vstack(arrow["contributions"]), atol=1e-9)
    staged = en.staged_margins(nodes, data, x, [*ids, "label"])
    for n in (1, 3, 6):
        cut = TrainedModel(first_trees(model.model, n), "classification", PARAMS)
        raw = cut.model.transform(data).select(*ids, vector_to_array("rawPrediction")[1].alias("raw")).toPandas().set_index(ids).sort_index()["raw"]
        part = staged.select(*ids, F.col("staged")[n - 1].alias("m")).toPandas().set_index(ids).sort_index()["m"]
        assert np.allclose(raw, part, atol=1e-9)


def test_staged_margins_walk_rows_in_batches(spark):
    """Codes, missing cells, missing slots and missing values of nodes, without an expression per node and row."""
    schema = "tree int, node int, left int, right int, slot int, threshold double, codes array<double>, value double, weight double"
    nodes = spark.createDataFrame(
        [
            (0, 0, 1, 2, 0, 1.5, None, 0.0, 1.0), (0, 1, -1, -1, None, None, None, 1.0, 1.0), (0, 2, -1, -1, None, None, None, 2.0, 1.0),
            (1, 0, 1, 2, 1, None, [0.0, 3.0], 0.0, 0.5), (1, 1, -1, -1, None, None, None, 8.0, 0.5), (1, 2, -1, -1, None, None, None, None, 0.5),
            (2, 0, 1, 2, 7, 1.0, None, 0.0, 1.0), (2, 1, -1, -1, None, None, None, 16.0, 1.0), (2, 2, -1, -1, None, None, None, 32.0, 1.0),
        ],
        schema,
    )
    rows = [(1, [1.5, 3.0]), (2, [None, 0.0]), (3, [math.nan, 0.5]), (4, [1.0, None]), (5, None), (6, [1.0]), (7, [9.0, -1.0]), (None, [9.0, 4.0])]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    staged = en.staged_margins(nodes, df, F.col("x"), ["id"])
    assert "MapInArrow" in staged._jdf.queryExecution().toString()
    found = {r["id"]: r["staged"] for r in staged.collect()}
    left, right = [1.0, 5.0, 37.0], [2.0, 6.0, 38.0]
    assert found == {
        1: left, 2: right, 3: [2.0, None, 32.0], 4: [1.0, None, 32.0], 5: [2.0, None, 32.0], 6: [1.0, None, 32.0], 7: [2.0, None, 32.0], None: [2.0, None, 32.0],
    }


def test_auc_makes_its_rows_once(spark, monkeypatch):
    monkeypatch.setattr(m, "ROWS_PER_RANGE", 10)
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = spark.range(1000).selectExpr("id % 2 as y", "cast(id % 100 as double) as s")
    assert m.roc_auc(df.mapInArrow(count, df.schema), "y", "s").first()["rocauc"] == pytest.approx(0.51)
    assert made.value == 1000


def test_spread_bounds_the_rows_of_a_task(spark):
    df = spark.range(0, 1000, 1, 2)
    assert spread(df, 50).rdd.getNumPartitions() == 20
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_early_stopping_watches_the_metric(frame):
    """The number of trees is that of the best beginning, each scored alone."""
    df, plan = frame
    encoder = FeatureEncoder(plan).fit(df)
    noisy = F.when(F.xxhash64(*plan.ids) % 5 == 0, 1 - F.col("label")).otherwise(F.col("label"))
    data = encoder.feature_frame(df.withColumn("label", noisy), [*plan.ids, "label"]).cache()
    train, held_out = data.where(F.col("l_orderkey") % 4 != 0), data.where(F.col("l_orderkey") % 4 == 0)
    params = {**PARAMS, "n_estimators": 8, "learning_rate": 0.9, "num_leaves": 32}
    for problem, watch in (("classification", None), ("regression", "mae"), ("regression", None)):
        trees = BoostedTrees(problem, params)
        full = trees.fit(train, encoder.vector_slots(), encoder.max_arity())
        cuts = [TrainedModel(first_trees(full.model, n), problem, params).score(held_out, ["label"]) for n in range(1, 9)]
        metric = watch or ("rocauc" if problem == "classification" else "rmse")
        alone = [m.evaluate(c, problem, metric, "label", "prediction").first()["metric"] for c in cuts]
        best = best_length([-a for a in alone] if metric == "rocauc" else alone, 3)
        kept = trees.fit(train, encoder.vector_slots(), encoder.max_arity(), held_out, patience=3, watch=watch)
        assert kept.params["best_iteration"] == best == kept.model.getNumTrees


def test_explain_ranks_and_rolls_up(trained):
    model, data, ids = trained
    result = ex.explain(model, data, ids, "shap", fraction=0.2)
    assert result.values.count() == int(data.count() * 0.2)
    ranks = result.rankings.collect()
    assert [r["rank"] for r in sorted(ranks, key=lambda r: -r["importance"])] == list(range(1, len(model.slots) + 1))
    sources = {r["feature"] for r in result.by_source().collect()}
    assert sources == {"l_quantity", "l_tax", "l_discount", "l_returnflag"}
    groups = {r["feature"] for r in result.by_group({"l_tax": "money", "l_discount": "money"}).collect()}
    assert groups == {"money", "l_quantity", "l_returnflag"}
    assert ex.top_features(result.importance, 2).count() == 2
    with pytest.raises(ValueError):
        ex.explain(model, data, ids, "unknown")


def test_line_models_keep_no_rows_in_memory(spark, sf_dir):
    """A cache of rows and vectors took whole partitions of all lines into the memory of executors."""
    spark.catalog.clearCache()
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    scored = catalog.train_score_lines(spark, sf_dir)
    assert scored.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    kept = spark.sparkContext._jsc.getPersistentRDDs()
    levels = [kept[i].getStorageLevel() for i in kept if i not in before]
    assert levels and not any(level.useMemory() for level in levels)


def test_stored_rows_are_scanned_in_bounded_tasks(spark):
    df = stored(spark.range(20_000).repartition(2), "rows", 500)
    name, before = "spark.sql.files.minPartitionNum", spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        with scan_tasks(df, 1000):
            sizes = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().toPandas()["count"]
        assert len(sizes) >= 20 and sizes.max() <= 1500 and sizes.sum() == 20_000
        assert spark.conf.get(name, None) == before
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def _nodes(spark, trained):
    columns = ["tree", "node", "left", "right", "slot", "threshold", "value", "cover", "gain", "weight"]
    return ex.node_table(spark, trained).select(*columns).toPandas().sort_values(["tree", "node"]).reset_index(drop=True)


@pytest.mark.parametrize("params, chunk", [(PARAMS, 10_000), ({**PARAMS, "num_leaves": 32, "min_data_in_leaf": 1}, 97), ({**PARAMS, "min_data_in_leaf": 4000}, 97)])
def test_binned_rows_give_the_trees_of_the_learner(spark, frame, monkeypatch, params, chunk):
    """The same trees, scores and saved model as Spark's learner, from chunks of any size and sums that are added up first."""
    df, plan = frame
    # no number kept as missing: its two slots give equal splits, between which the order of additions decides
    plan = FeaturePlan(plan.ids, "label", numeric=plan.numeric, categorical=["l_returnflag"])
    encoder = FeatureEncoder(plan).fit(df)
    noisy = F.when(F.xxhash64(*plan.ids) % 5 == 0, 1 - F.col("label")).otherwise(F.col("label"))
    data = encoder.feature_frame(df.withColumn("label", noisy), [*plan.ids, "label"]).repartition(3).cache()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(chunk))
    if chunk < 1000:
        monkeypatch.setattr(boosting, "CHUNKS_PER_TASK", 1)
        monkeypatch.setattr(boosting, "PARTIAL_SUMS", 2)
    monkeypatch.setattr(GBTClassifier, "fit", lambda *args: pytest.fail("Spark's learner was used"))
    try:
        ours = BoostedTrees("classification", params, many_rows=True).fit(data, encoder.vector_slots(), encoder.max_arity())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        monkeypatch.undo()
    spark_trees = BoostedTrees("classification", params).fit(data, encoder.vector_slots(), encoder.max_arity())
    a, b = _nodes(spark, ours), _nodes(spark, spark_trees)
    for name in ("tree", "node", "left", "right", "slot", "threshold", "cover"):
        assert a[name].fillna(-9).tolist() == b[name].fillna(-9).tolist()
    for name in ("value", "gain", "weight"):
        assert a[name].to_numpy() == pytest.approx(b[name].to_numpy(), rel=1e-9, abs=1e-12)
    assert ours.model.featureImportances.toArray() == pytest.approx(spark_trees.model.featureImportances.toArray())
    assert ours.model.numFeatures == spark_trees.model.numFeatures
    scores = [sorted(tuple(r) for r in one.score(data, plan.ids).collect()) for one in (ours, spark_trees)]
    assert np.array(scores[0]) == pytest.approx(np.array(scores[1]), rel=1e-9)


def test_sums_of_binned_rows():
    """Sums over groups of slots equal those that are counted cell by cell."""
    rng, sizes, n = np.random.default_rng(1), [5, 256, 1, 2, 2, 40, 2], 3000
    bins, label = np.stack([rng.integers(0, s, n).astype(np.uint8) for s in sizes]), rng.integers(0, 2, n).astype(np.uint8)
    shape = [(1, 100, 1, 2), (5, 20, 3, 4), *[(-1, -1, -1, -1)] * 3]
    at = np.where(bins[1] <= 100, np.where(bins[5] <= 20, 3, 4), 2)
    assert (bin_code.places(shape, bins) == at).all()
    margin = np.array([0.0, 0.0, 0.5, -0.25, 1.0])[at]
    signs = 2.0 * label - 1
    target = 4 * signs / (1 + np.exp(2 * signs * margin))
    groups = bin_code.grouped(sizes)
    assert sorted(s for g in groups for s in g) == list(range(7)) and len(groups) < 7
    sums = bin_code.histograms(label, bins, [(0.5, shape, np.array([0, 0, 1.0, -0.5, 2.0]))], shape, [4, 2], sizes, groups)
    found, start = bin_code.by_slot(sums, sizes, groups), 0
    for slot, size in enumerate(sizes):
        for b in range(size):
            for i, node in enumerate((4, 2)):
                rows = (at == node) & (bins[slot] == b)
                assert found[:, i, start + b] == pytest.approx([rows.sum(), target[rows].sum(), (target[rows] ** 2).sum()])
        start += size


def test_binned_rows_are_checked(spark):
    bad = spark.createDataFrame([(1.0, 0.5), (0.0, 0.1), (None, 0.2)], "label double, x double")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(bad)
    with pytest.raises(Exception, match="[Ll]abel"):
        BoostedTrees("classification", PARAMS, many_rows=True).fit(data)


def test_split_importance_counts_every_split(spark, trained):
    model, _, _ = trained
    total = ex.node_table(spark, model).where("left >= 0").count()
    rows = ex.split_importance(spark, model).collect()
    assert sum(r["n_splits"] for r in rows) == total and len(rows) == len(model.slots)


def test_surrogate_agrees(trained):
    model, data, ids = trained
    copy = ex.surrogate(model, data, ids, 1000, max_arity=5)
    both = copy.score(data, ids).withColumnRenamed("prediction", "b").join(model.score(data, ids), ids)
    agree = both.agg(F.avg(((F.col("b") > 0.5) == (F.col("prediction") > 0.5)).cast("double"))).first()[0]
    assert agree > 0.9


def test_surrogate_is_fitted_to_all_rows(spark, sf_dir, trained, monkeypatch):
    model, data, ids = trained
    n_rows = data.count()
    assert n_rows > 1000

    def covered(copy):
        return ex.node_table(spark, copy).where("tree = 0 and node = 0").first()["cover"]

    assert covered(ex.surrogate(model, data, ids, max_arity=5)) == n_rows
    assert covered(ex.surrogate(model, data, ids, 1000, max_arity=5)) == 1000
    made, surrogate = [], ex.surrogate
    monkeypatch.setattr(ex, "surrogate", lambda *args, **more: made.append(surrogate(*args, **more)) or made[-1])
    assert catalog.surrogate_scores(spark, sf_dir).count() == n_rows == covered(made[0])


def test_search_history(spark, frame):
    df, plan = frame
    folded = assign_folds(df, 2, plan.ids, target="label")
    folds = encode_folds(folded, FeatureEncoder(plan), 2, "label", plan.ids)
    space = parse_space({"learning_rate": {"kind": "loguniform", "low": 0.1, "high": 0.4}, "n_estimators": {"kind": "discrete", "low": 3, "high": 5},
                         "num_leaves": {"kind": "categorical", "choices": [4, 8]}})
    result = cross_validate_search(folds, space, 2, "classification", "rocauc", "gt", "label", parallelism=2)
    assert [h["state"] for h in result.history] == ["COMPLETE", "COMPLETE"]
    assert result.best["value"] > 0.8
    assert result.history_frame(spark).count() == 2 and result.fold_frame(spark).count() == 4


@pytest.mark.parametrize("n_rows", [None, 20_000_000])
@pytest.mark.parametrize("score", [None, math.nan])
def test_missing_scores_are_errors_at_every_size(spark, n_rows, score):
    df = spark.createDataFrame([(0, 0.2), (1, 0.7), (1, score)], "y int, s double")
    with pytest.raises(Exception, match="missing values"):
        m.roc_auc(df, "y", "s", n_rows=n_rows).collect()


def test_a_search_goes_on_where_it_was_cut_off(spark, frame, monkeypatch, tmp_path):
    df, plan = frame
    folded = assign_folds(df, 2, plan.ids, target="label")
    folds = encode_folds(folded, FeatureEncoder(plan), 2, "label", plan.ids)
    space = parse_space({"learning_rate": {"kind": "loguniform", "low": 0.1, "high": 0.4}, "n_estimators": {"kind": "discrete", "low": 2, "high": 3},
                         "boosting_type": {"kind": "categorical", "choices": ["gbdt", "dart"]}})
    run, calls, left = search.run_fold, [], [3]

    def until_lost(fold, params, *rest):
        if not left[0]:
            raise RuntimeError("the cluster is gone")
        left[0] -= 1
        calls.append((params["learning_rate"], fold.number))
        return run(fold, params, *rest)

    go = lambda ledger: cross_validate_search(folds, space, 3, "classification", "rocauc", "gt", "label", parallelism=1, ledger=ledger)
    monkeypatch.setattr(search, "run_fold", until_lost)
    with pytest.raises(RuntimeError):
        go(str(tmp_path / "ledger"))
    left[0] = 100
    resumed = go(str(tmp_path / "ledger"))
    assert len(calls) == len(set(calls)) == 6
    whole = go(None)
    assert resumed.history == whole.history and resumed.fold_metrics == whole.fold_metrics
    assert go(str(tmp_path / "ledger")).history == whole.history and len(calls) == 12
    cross_validate_search(folds, space, 1, "classification", "rocauc", "gt", "label", seed=7, parallelism=1, ledger=str(tmp_path / "ledger"))
    assert len(calls) == 14  # other parameter sets are not taken from it


def test_failed_trial_has_no_value(frame):
    df, plan = frame
    folded = assign_folds(df, 2, plan.ids, target="label")
    folds = encode_folds(folded, FeatureEncoder(plan), 2, "label", plan.ids)
    space = parse_space({"boosting_type": {"kind": "categorical", "choices": ["dart"]}})
    result = cross_validate_search(folds, space, 1, "classification", "rocauc", "gt", "label")
    assert result.history[0]["state"] == "FAIL" and result.history[0]["value"] is None
    with pytest.raises(ValueError):
        result.best
    assert SearchResult([], [], "gt").history == []


def test_regression_and_balanced_weights(frame):
    df, plan = frame
    encoder = FeatureEncoder(plan).fit(df)
    data = encoder.feature_frame(df.withColumn("target", F.col("l_quantity") * 2), [*plan.ids, "target"])
    trained = BoostedTrees("regression", PARAMS, label="target").fit_and_measure(data, "rmse", encoder.vector_slots(), encoder.max_arity())
    assert trained.train_metric < 15
    rare = df.withColumn("label", (F.col("l_partkey") % 10 == 0).cast("double"))
    weighted = encoder.feature_frame(rare, [*plan.ids, "label"])
    trees = BoostedTrees("classification", {**PARAMS, "class_weight": "balanced"})
    balanced = trees.fit(weighted, encoder.vector_slots(), encoder.max_arity(), validation=weighted)
    plain = BoostedTrees("classification", PARAMS).fit(weighted, encoder.vector_slots(), encoder.max_arity())
    mean = [t.score(weighted, plan.ids).agg(F.avg("prediction")).first()[0] for t in (balanced, plain)]
    assert mean[0] > mean[1] + 0.01
    assert balanced.score(weighted, plan.ids).columns == ["prediction", *plan.ids]


def test_tasks_do_not_need_the_package(tmp_path, sf_dir):
    """Workers started outside the repository, as on a cluster, cannot import the package."""
    script = tmp_path / "job.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {str(pathlib.Path(__file__).resolve().parent.parent)!r})\n"
        "from gridloom.plans.catalog import QUERIES\n"
        "from gridloom.session import build_session\n"
        "spark = build_session('job', 'local[2]', spark__sql__shuffle__partitions='2')\n"
        f"print('rows', QUERIES['group_contributions_shap'](spark, {sf_dir!r}).count(), QUERIES['group_contributions_path'](spark, {sf_dir!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 6000 6000" in done.stdout, done.stderr[-2000:]


def test_search_keeps_only_what_it_reads(frame, monkeypatch):
    df, plan = frame
    folds = encode_folds(assign_folds(df, 2, plan.ids, target="label"), FeatureEncoder(plan), 2, "label", plan.ids)
    seen = []
    monkeypatch.setattr(search, "run_fold", lambda fold, *_: seen.append(fold.frame.columns) or 0.5)
    cross_validate_search(folds, parse_space({"n_estimators": {"kind": "discrete", "low": 3, "high": 5}}), 1, "classification", "rocauc", "gt", "label")
    assert seen == [["label", "fold", "features"]] * 2


def test_learners_of_several_classes_read_equal_rows_once(spark, monkeypatch):
    """The learners see each value of a label once, and give the values and covers of every single row."""
    rows = [(float(i % 3 if i % 7 else 2), float(i % 5 + (i % 11 == 0))) for i in range(600)]
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame(rows, "label double, x double")).select("label", "features")
    params = {"n_estimators": 2, "num_leaves": 4096, "min_data_in_leaf": 1, "feature_fraction": 1.0}
    seen = []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, data, *args: seen.append(data.count()) or fit(self, data, *args))
    slots = [("cat__x", "x")]
    combined = BoostedTrees("classification", params, classes=[0.0, 1.0, 2.0]).fit(df, slots, 256)
    assert seen == [len(set(rows))] * 3
    single = [BoostedTrees("classification", params).fit(df.withColumn("label", (F.col("label") == c).cast("double")), slots, 256) for c in (0.0, 1.0, 2.0)]
    columns = ["tree", "node", "left", "right", "threshold", "value", "cover"]
    for one, other in zip(combined.models, single):
        got, want = (sorted(tuple(r[c] for c in columns) for r in en.model_nodes(spark, x.model).collect()) for x in (one, other))
        assert [g[:4] + g[6:] for g in got] == [w[:4] + w[6:] for w in want]
        for i in (4, 5):
            assert [g[i] for g in got] == pytest.approx([w[i] for w in want], abs=1e-12)
    # leaves of several rows, class weights or several slots need every row
    for more, names in (({"min_data_in_leaf": 2}, slots), ({"class_weight": "balanced"}, slots), ({}, slots * 2)):
        assert BoostedTrees("classification", {**params, **more}, classes=[0.0, 1.0, 2.0])._combined(df, names) is None
