import json

import pytest
from pyspark.sql import functions as F

from gridloom import TabularRun
from gridloom.operators import explain
from gridloom.operators.metrics import evaluate
from gridloom.plans import frames as fr

METADATA = [
    ("n_chars", "float", 1, "mean", "", "text"),
    ("n_words", "number", 1, "mean", "", "text"),
    ("distinct_share", "float", 1, "leave as n/a", "", "text"),
    ("symbol_share", "float", 1, "mean", "", "text"),
    ("lang", "category", 1, "most_frequent", "one-hot", "origin"),
    ("source", "category", 1, "unknown", "", "origin"),
    ("toxic", "bool", 1, "zero", "", "label"),
    ("unused", "float", 0, "mean", "", ""),
]
MODEL = {
    "target_variable": "label", "id_variables": ["doc_id", "batch"], "problem_type": "classification", "evaluation_metric": "rocauc",
    "better_performance": "gt", "models": ["lgbm"], "k_folds": 2, "retrain_with_whole_dataset": True,
    "sample_for_contribution": 0.5, "importance_extraction_method": "treeinterpreter", "num_hp_searches": 2,
    "hyperparameter_space": {"lgbm": {
        "learning_rate": "trial.suggest_loguniform('learning_rate', 0.1, 0.3)",
        "num_leaves": "int(trial.suggest_discrete_uniform('num_leaves', 4, 8, 1))",
        "n_estimators": "int(trial.suggest_discrete_uniform('n_estimators', 3, 5, 1))",
        "min_data_in_leaf": "int(trial.suggest_discrete_uniform('min_data_in_leaf', 5, 20, 5))",
    }},
}


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory, sf_dir):
    root = tmp_path_factory.mktemp("run")
    docs = fr.doc_quality(spark, sf_dir).withColumn("batch", F.lit("1/1/2025")).withColumn("unused", F.lit("text"))
    docs.write.option("header", True).csv(str(root / "train.csv"))
    spark.createDataFrame(METADATA, "feature_name string, type string, use int, imputation string, transformation string, super_category string").write.parquet(str(root / "meta.parquet"))
    return root, docs


def training_config(root):
    return {"training": True, "metadata_file_path": str(root / "meta.parquet"), "input_data_source": "CSV", "file_path": str(root / "train.csv")}


def test_training_then_scoring(spark, inputs):
    root, docs = inputs
    for name, document in (("model.json", MODEL), ("train.json", training_config(root))):
        (root / name).write_text(json.dumps(document))
    run = TabularRun(str(root / "model.json"), str(root / "train.json"), spark, output_dir=str(root / "out"))
    run.run()

    assert len(run.get_study_results()) == 2 and len(run.get_model_performances()) == 4
    assert all(m["metric"] > 0.5 for m in run.get_model_performances())
    assert run.get_performance_metrics()["cv_average"] == run.search.best["value"]
    assert run.get_performance_metrics()["train"] > 0.9
    assert run.get_best_params().items() <= run.model.params.items()

    study = spark.read.option("header", True).option("escape", '"').csv(str(root / "out/label_classification_lgbm_hyperparameter_study.csv"))
    assert study.columns == ["trial_number", "params", "value", "state"] and study.count() == 2
    importance = spark.read.option("header", True).csv(str(root / "out/label_treeinterpreter_feature_importance.csv")).collect()
    values = [float(r["importance"]) for r in importance]
    assert values == sorted(values, reverse=True) and importance[0].asDict().keys() == {"feature", "importance"}
    assert spark.read.parquet(str(root / "out/label_treeinterpreter_importance_values")).count() == docs.count() // 2
    assert run.get_feature_rankings().count() == run.get_importance_df().count() == len(values)

    scoring = {
        **training_config(root), "training": False,
        "data_processor_file_path": str(root / "out/label_classification_lgbm_data_processor"),
        "model_file_path": str(root / "out/label_classification_lgbm"),
        "predictions_output_path": str(root / "out/predictions.csv"),
    }
    scorer = TabularRun(MODEL, scoring, spark, output_dir=str(root / "out"))
    scorer.run()
    written = spark.read.option("header", True).csv(str(root / "out/predictions.csv"))
    assert written.columns == ["prediction", "doc_id", "batch"]
    assert {r["doc_id"] for r in written.collect()} == {str(r["doc_id"]) for r in docs.select("doc_id").collect()}
    data = run.processor.preprocess_test_data(run.loader.get_data())
    direct = {r["doc_id"]: r["prediction"] for r in run.predict(data, ["doc_id", "batch"]).collect()}
    assert all(float(r["prediction"]) == pytest.approx(direct[r["doc_id"]], abs=1e-12) for r in written.collect())
    assert all(0 <= p <= 1 for p in direct.values())


def test_scoring_without_ids_or_target(spark, inputs):
    root, _ = inputs
    config = {**MODEL, "num_hp_searches": 1, "importance_extraction_method": "shap", "refit_params": "default"}
    small = {"n_estimators": {"kind": "categorical", "choices": [2]}}
    config["hyperparameter_space"] = {"lgbm": small}
    run = TabularRun(config, training_config(root), spark, output_dir=str(root / "out2"))
    run.config = type(run.config)(**{**run.config.__dict__, "retrain_with_whole_dataset": False})
    run.run()
    assert run.model is None and run.get_importance_df() is None
    with pytest.raises(ValueError):
        run.save_model()
    with pytest.raises(ValueError):
        run.save_importance_results()
    with pytest.raises(ValueError):
        run.processor.save_preprocessor()
    with pytest.raises(ValueError):
        run.processor.preprocess_test_data(run.loader.get_data())
    run.processor.fit_transform_full_dataset(run.loader.get_data())
    frame = run.processor.preprocess_test_data(run.loader.get_data().drop("batch", "label"))
    assert frame.columns == ["doc_id", "features"]


def test_regression_run(spark, sf_dir, tmp_path):
    fr.event_frame(spark, sf_dir).write.parquet(str(tmp_path / "events.parquet"))
    rows = [("hour", "float", 1, "mean", "", ""), ("minute", "float", 1, "mean", "", ""), ("event_type", "category", 1, "mode", "", "")]
    spark.createDataFrame(rows, "feature_name string, type string, use int, imputation string, transformation string, super_category string").write.json(str(tmp_path / "meta.json"))
    model = {**MODEL, "id_variables": ["event_id"], "problem_type": "regression", "evaluation_metric": "rmse", "better_performance": "lt",
             "importance_extraction_method": "shap", "num_hp_searches": 1,
             "hyperparameter_space": {"lgbm": {"n_estimators": {"kind": "categorical", "choices": [3]}, "num_leaves": {"kind": "categorical", "choices": [4]}}}}
    data = {"training": True, "metadata_file_path": str(tmp_path / "meta.json"), "input_data_source": "PARQUET", "file_path": str(tmp_path / "events.parquet")}
    run = TabularRun(model, data, spark, output_dir=str(tmp_path / "out"))
    run.run()
    assert 0 < run.get_performance_metrics()["cv_average"] < 200
    assert run.get_importance_df().count() == 3


def test_a_target_of_three_values(spark, inputs):
    """Search, refit, scores per class, contributions per class, and the same predictions from the saved model."""
    root, docs = inputs
    docs = docs.withColumn("kind", F.when(F.col("n_words") < 150, 0).when(F.col("n_words") < 400, 1).otherwise(4)).drop("label")
    docs.write.parquet(str(root / "kinds.parquet"))
    model = {**MODEL, "target_variable": "kind", "evaluation_metric": "accuracy", "importance_extraction_method": "shap", "num_hp_searches": 1, "sample_for_contribution": 1.0}
    train = {**training_config(root), "input_data_source": "PARQUET", "file_path": str(root / "kinds.parquet")}
    run = TabularRun(model, train, spark, output_dir=str(root / "kinds"))
    run.run()
    assert run.model.classes == [0.0, 1.0, 4.0] and run.get_performance_metrics()["train"] > 0.9
    assert all(m["metric"] > 0.7 for m in run.get_model_performances())
    values = run.get_importance_values()
    assert values.count() == 3 * docs.count() and {r["class"] for r in values.select("class").distinct().collect()} == {0.0, 1.0, 4.0}
    assert run.get_feature_rankings().orderBy("rank").first()["feature"] in ("num__n_words", "num__n_chars")
    scoring = {**train, "training": False, "data_processor_file_path": run.paths["preprocessor"], "model_file_path": run.paths["model"], "predictions_output_path": str(root / "kinds/predictions.parquet")}
    scorer = TabularRun(model, scoring, spark, output_dir=str(root / "kinds"))
    scorer.run()
    rows = spark.read.parquet(scorer.paths["predictions"]).join(docs.select("doc_id", "kind"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert sum([0, 1, 4][r["prediction"]] == r["kind"] for r in rows) > 0.9 * len(rows)
    for r in rows:
        p = [r[f"prob_class_{i}"] for i in range(3)]
        assert abs(sum(p) - 1) < 1e-9 and p.index(max(p)) == r["prediction"]


def test_multiclass_metrics(spark):
    rows = [(0, [0.7, 0.2, 0.1]), (0, [0.3, 0.4, 0.3]), (1, [0.1, 0.8, 0.1]), (1, [0.2, 0.5, 0.3]), (2, [0.3, 0.3, 0.4]), (2, [0.1, 0.6, 0.3])]
    df = spark.createDataFrame(rows, "y int, p array<double>")
    value = lambda name: evaluate(df, "classification", name, "y", "p", classes=[0.0, 1.0, 2.0]).first()["metric"]
    assert value("accuracy") == pytest.approx(4 / 6)
    assert value("recall") == pytest.approx((1 / 2 + 1 + 1 / 2) / 3) and value("precision") == pytest.approx((1 + 2 / 4 + 1) / 3)

    def area(c):
        pos, neg = [p[c] for y, p in rows if y == c], [p[c] for y, p in rows if y != c]
        return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)

    assert value("rocauc") == pytest.approx(sum(map(area, range(3))) / 3)


def test_importance_falls_back_to_the_other_method(spark, inputs, monkeypatch):
    root, _ = inputs

    def broken(arrays):
        def run(x):
            raise MemoryError("too many patterns")

        return run

    monkeypatch.setitem(explain._PREPARE, "shap", broken)
    model = {**MODEL, "importance_extraction_method": "shap", "num_hp_searches": 1}
    run = TabularRun(model, training_config(root), spark, output_dir=str(root / "fallback"))
    with pytest.warns(UserWarning, match="shap failed"):
        run.run()
    assert run.get_performance_metrics()["importance_method"] == "treeinterpreter"
    assert run.paths["importance"].endswith("label_treeinterpreter_feature_importance.csv") and run.get_feature_rankings().count() > 0
