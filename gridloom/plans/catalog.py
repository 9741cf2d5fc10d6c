"""The registered queries: every operator run over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.config import parse_space
from gridloom.operators import audit, explain, folds, metrics
from gridloom.operators.encode import FeatureEncoder, FittedEncoder, apply_dictionary, encode_non_numeric, first_seen_dictionary, out_of_fold
from gridloom.operators.score import flat_output, logistic, multiclass_output
from gridloom.operators.search import cross_validate_search, encode_folds
from gridloom.operators.train import BoostedTrees, TrainedModel
from gridloom.operators.typing import apply_types, bool_to_double, scoring_columns
from gridloom.plans import frames as fr
from gridloom.plans.frames import rounded
from gridloom.plans.run import TabularRun
from gridloom.plans.tree_queries import TREE_QUERIES
from gridloom.session import scratch_path
from gridloom.sources.metadata import FeaturePlan, route_features, wide_to_long
from gridloom.sources.readers import infer_types, read_table, with_inferred_types
from gridloom.sources.writers import write_table

Query = Callable[[SparkSession, str], DataFrame]

RAW_TYPES = {"qty_text": "float", "flag_text": "bool", "cat_text": "category", "tax_text": "number", "absent": "float"}
N_FOLDS = 5


# --- scans and typing ---------------------------------------------------------


def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_types(fr.raw_line(spark, sf_dir), RAW_TYPES)


def bool_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fr.raw_line(spark, sf_dir).select(*fr.LINE_IDS, F.col("flag_text").alias("as_null"), F.col("flag_text").alias("as_true"))
    nulls = apply_types(raw, {"as_null": "bool"})
    return apply_types(nulls, {"as_true": "bool"}, missing_bool="true")


def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose with quotes, commas and line breaks, and ids of 19 digits, through the writer and the reader."""
    docs = fr.table(spark, sf_dir, "documents").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), F.col("text"))
    turns = fr.table(spark, sf_dir, "conversations").select(F.lit("c").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text"))
    both = docs.unionByName(turns).withColumn("wide_id", F.col("id") + F.lit(9007199254740993000)).withColumn("text", F.concat(F.lit(' "'), "text", F.lit('", ')))
    path = write_table(both, scratch_path(spark, "csv"), "csv")
    return read_table(spark, "CSV", path, infer=True).select("kind", "id", "wide_id", F.sha2("text", 256).alias("text_sha256"))


def csv_stray_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes within cells that are not quoted, beside cells with line breaks and doubled quotes."""
    docs = fr.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit('" pipe')).alias("size"), F.concat(F.lit(' "x",\n"y" '), "text").alias("text"))
    path = scratch_path(spark, "csv")
    docs.write.option("header", True).option("escape", '"').option("escapeQuotes", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_table(spark, "CSV", path, infer=True).select("doc_id", "size", F.sha2("text", 256).alias("text_sha256"))


def csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_table(fr.raw_line(spark, sf_dir), scratch_path(spark, "csv"), "csv")
    return with_inferred_types(apply_types(read_table(spark, "CSV", path), RAW_TYPES))


def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sorted(infer_types(fr.raw_line(spark, sf_dir)).items())
    return spark.createDataFrame(rows, "column_name string, inferred_type string")


def metadata_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_to_long(fr.draft_sheet(spark, sf_dir), "attribute")


def feature_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_features(metadata_unpivot(spark, sf_dir), ["absent_id"], "absent_target")


def metadata_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata_unpivot(spark, sf_dir).groupBy("type", "use").agg(F.count(F.lit(1)).alias("n_features"))


def scoring_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fr.line_frame(spark, sf_dir).drop("label")
    ids, features = scoring_columns(df, [*fr.LINE_IDS, "not_there"])
    return df.select(*ids, *features)


# --- audit ---------------------------------------------------------------------


def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.profile_columns(fr.raw_line(spark, sf_dir))


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distinct_counts(fr.raw_line(spark, sf_dir), [*fr.LINE_IDS, *fr.RAW_COLUMNS])


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.value_counts(fr.raw_line(spark, sf_dir), fr.RAW_COLUMNS)


def problem_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.problem_strings(fr.raw_line(spark, sf_dir), fr.RAW_COLUMNS, fr.LINE_IDS)


def bad_numeric_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.bad_cells(fr.raw_line(spark, sf_dir), fr.LINE_IDS, ["qty_text", "tax_text"], limit=None)


def bad_numeric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.bad_cells(fr.raw_line(spark, sf_dir), fr.LINE_IDS, ["qty_text", "tax_text"], limit=10)


def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(audit.histogram(fr.scored_lines(spark, sf_dir), "score", 20))


# --- folds, samples, splits -----------------------------------------------------


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.assign_folds(fr.line_frame(spark, sf_dir), N_FOLDS, fr.LINE_IDS, target="label")


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).select(*fr.LINE_IDS, "label", "fold")


def plain_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.assign_folds(fr.event_frame(spark, sf_dir), N_FOLDS, ["event_id"]).select("event_id", "fold")


def fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.fold_sizes(_folded(spark, sf_dir), "label")


def fold_train_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = _folded(spark, sf_dir)
    held_out = 2
    count = F.count(F.lit(1)).alias("n_rows")
    train = folds.train_rows(folded, held_out).groupBy("label").agg(count).withColumn("part", F.lit("train"))
    return train.unionByName(folds.validation_rows(folded, held_out).groupBy("label").agg(count).withColumn("part", F.lit("validation")))


def ordered_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fr.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return folds.ordered_split(orders, 1000, ["o_orderpriority", "o_orderkey"])


def exact_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.exact_sample(fr.line_frame(spark, sf_dir), 0.2, fr.LINE_IDS).select(*fr.LINE_IDS, "price")


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.first_rows(fr.line_frame(spark, sf_dir).select(*fr.LINE_IDS, "price"), 1000, fr.LINE_IDS)


# --- preprocessing ----------------------------------------------------------------


def _plan(**lists: list[str]) -> FeaturePlan:
    return FeaturePlan(ids=fr.LINE_IDS, target="label", **lists)


def _encode_line(spark: SparkSession, sf_dir: str, **lists: list[str]) -> DataFrame:
    df = fr.line_frame(spark, sf_dir)
    return rounded(FeatureEncoder(_plan(**lists)).fit(df).transform(df, fr.LINE_IDS))


def scale_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = FeatureEncoder(_plan(numeric=["quantity", "price", "discount"])).fit(fr.line_frame(spark, sf_dir))
    rows = [(name, float(mean), float(std)) for name, (mean, std) in fitted.moments.items()]
    return rounded(spark.createDataFrame(rows, "feature string, mean double, std double"), 5)


def scale_impute_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encode_line(spark, sf_dir, numeric=["quantity", "price"])


def mode_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encode_line(spark, sf_dir, categorical=["ship_month"])


def bool_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encode_line(spark, sf_dir, binary=["is_f"])


def bool_as_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bool_to_double(fr.line_frame(spark, sf_dir), ["is_f", "high_tax", "ship_month"]).select(*fr.LINE_IDS, "is_f", "high_tax", "ship_month")


def onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encode_line(spark, sf_dir, one_hot=["line_no"])


def onehot_na(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encode_line(spark, sf_dir, one_hot=["ship_year"], keep_missing=["ship_year"])


def passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encode_line(spark, sf_dir, numeric=["discount"], binary=["high_tax"], keep_missing=["discount", "high_tax"])


def encoded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fr.line_frame(spark, sf_dir)
    return rounded(FeatureEncoder(fr.line_plan()).fit(df).transform(df, [*fr.LINE_IDS, "label"]))


def loo_fold_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(numeric=["quantity", "price"], categorical=["ship_month"])
    rows = []
    for f, fitted in enumerate(FeatureEncoder(plan).fit_folds(_folded(spark, sf_dir), N_FOLDS)):
        rows += [(f, name, float(mean), float(std), None) for name, (mean, std) in fitted.moments.items()]
        rows += [(f, name, None, None, mode) for name, mode in fitted.modes.items()]
    return rounded(spark.createDataFrame(rows, "fold int, feature string, mean double, std double, mode string"), 5)


def fold_encoded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _plan(numeric=["quantity", "price"], categorical=["ship_month"])
    folded = _folded(spark, sf_dir)
    fitted = FeatureEncoder(plan).fit_folds(folded, N_FOLDS)
    return rounded(out_of_fold(folded, fitted, [*fr.LINE_IDS, "label", "fold"]))


def document_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fr.doc_quality(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    folded = folds.assign_folds(df, N_FOLDS, ["doc_id"], target="label")
    return rounded(FeatureEncoder(fr.doc_plan()).fit(folded).transform(folded, ["doc_id", "label", "fold"]))


def category_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_seen_dictionary(fr.table(spark, sf_dir, "orders"), "o_custkey", ["o_orderkey"])


def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes learned on orders, applied to all customers: customers without an order are unseen values."""
    dictionary = first_seen_dictionary(fr.table(spark, sf_dir, "orders"), "o_custkey", ["o_orderkey"])
    return apply_dictionary(fr.table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", dictionary, "code")


# --- metrics ------------------------------------------------------------------------


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.class_weights(fr.line_frame(spark, sf_dir), "label"))


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.roc_auc(fr.scored_lines(spark, sf_dir), "label", "score"))


def auc_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same areas over several ranges of scores, as a table of many million rows would have."""
    many = 8 * metrics.ROWS_PER_RANGE
    return rounded(metrics.roc_auc(fr.scored_lines(spark, sf_dir), "label", "score", by=["l_returnflag"], n_rows=many))


def roc_auc_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.roc_auc(fr.scored_lines(spark, sf_dir), "label", "score", by=["l_returnflag"]))


def threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.threshold_metrics(fr.scored_lines(spark, sf_dir), "label", "score", by=["l_returnflag"]))


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fr.table(spark, sf_dir, "events").select("event_type", "value", (F.col("user_id") * 0.5).alias("guess"))
    return rounded(metrics.regression_metrics(events, "value", "guess", by=["event_type"]))


def _trial_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fr.scored_lines(spark, sf_dir).withColumn("trial_number", F.col("l_linenumber") - 1)
    folded = folds.assign_folds(scored, N_FOLDS, fr.LINE_IDS, target="label")
    return metrics.evaluate(folded, "classification", "rocauc", "label", "score", by=["trial_number", "fold"])


def cv_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.mean_over_folds(_trial_metrics(spark, sf_dir)))


def cv_best_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.best_trial(metrics.mean_over_folds(_trial_metrics(spark, sf_dir)), "gt"))


# --- outputs and importances -----------------------------------------------------------


def argmax_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(multiclass_output(fr.class_scores(spark, sf_dir), "p", 8, ["vec_id"]))


def flat_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    margins = fr.table(spark, sf_dir, "lineitem").select(*fr.LINE_IDS, logistic((F.col("l_quantity") - 25) / 10).alias("p"))
    return rounded(flat_output(margins, "p", fr.LINE_IDS))


_CONTRIBUTION_NAMES = [("quantity", [0]), ("price", [1]), ("discount", [2]), ("tax", [3])]


def mean_abs_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.mean_abs_importance(fr.contribution_lines(spark, sf_dir), _CONTRIBUTION_NAMES))


def importance_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.rank_importance(mean_abs_importance(spark, sf_dir))


def top_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.top_features(mean_abs_importance(spark, sf_dir), 2)


def importance_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = [("size", [0]), ("money", [1, 2, 3])]
    return rounded(explain.mean_abs_importance(fr.contribution_lines(spark, sf_dir), groups))


# --- models -------------------------------------------------------------------------------

_SMALL = {"n_estimators": 8, "num_leaves": 16, "min_data_in_leaf": 10, "learning_rate": 0.2, "feature_fraction": 1.0}


def _doc_model(spark: SparkSession, sf_dir: str, features: DataFrame | None = None) -> tuple[TrainedModel, FittedEncoder, DataFrame]:
    df = fr.doc_quality(spark, sf_dir, features).persist(StorageLevel.MEMORY_AND_DISK)
    encoder = FeatureEncoder(fr.doc_plan()).fit(df)
    data = encoder.feature_frame(df, ["doc_id", "label"])
    trained = BoostedTrees("classification", _SMALL).fit(data, encoder.vector_slots(), encoder.max_arity())
    return trained, encoder, data


def train_score_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the labelled documents, score every document."""
    # the text is read once; the few numbers per document serve every pass of fitting and scoring
    features = fr.document_features(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    trained, encoder, _ = _doc_model(spark, sf_dir, features)
    return trained.score(encoder.feature_frame(features, ["doc_id"]), ["doc_id"])


def _line_model(spark: SparkSession, sf_dir: str) -> tuple[TrainedModel, DataFrame, int]:
    # the narrow result of the joins is kept on disk, as a cache in memory takes whole partitions; statistics, learner and scores read it
    df = fr.line_flag(spark, sf_dir).persist(StorageLevel.DISK_ONLY)
    encoder = FeatureEncoder(fr.line_flag_plan()).fit(df)
    data = encoder.feature_frame(df, [*fr.LINE_IDS, "label"])
    trained = BoostedTrees("classification", _SMALL, many_rows=True).fit(data, encoder.vector_slots(), encoder.max_arity())
    return trained, data, encoder.max_arity()


def train_score_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, data, _ = _line_model(spark, sf_dir)
    return trained.score(data, fr.LINE_IDS)


def train_score_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fr.event_frame(spark, sf_dir)
    encoder = FeatureEncoder(fr.event_plan()).fit(df)
    data = encoder.feature_frame(df, ["event_id", "label"])
    return BoostedTrees("regression", _SMALL).fit(data, encoder.vector_slots(), encoder.max_arity()).score(data, ["event_id"])


def train_score_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fr.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    model = RandomForestClassifier(numTrees=10, maxDepth=5, seed=42).fit(df)
    scored = model.transform(df).select("vec_id", vector_to_array("probability").alias("p"))
    return multiclass_output(scored, "p", model.numClasses, ["vec_id"])


_SPACE = {
    "learning_rate": {"kind": "loguniform", "low": 0.05, "high": 0.4},
    "num_leaves": {"kind": "discrete", "low": 4, "high": 12, "step": 1, "integer": True},
    "n_estimators": {"kind": "discrete", "low": 3, "high": 6, "step": 1, "integer": True},
    "class_weight": {"kind": "categorical", "choices": [None, "balanced"]},
    "min_data_in_leaf": {"kind": "discrete", "low": 5, "high": 20, "step": 5, "integer": True},
}


def cv_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fr.doc_quality(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    folded = folds.assign_folds(df, 3, ["doc_id"], target="label")
    data = encode_folds(folded, FeatureEncoder(fr.doc_plan()), 3, "label", ["doc_id"])
    result = cross_validate_search(data, parse_space(_SPACE), 2, "classification", "rocauc", "gt", "label", parallelism=3)
    return result.history_frame(spark).withColumn("params", F.to_json("params"))


def early_stopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fr.event_frame(spark, sf_dir)
    folded = folds.assign_folds(df, N_FOLDS, ["event_id"])
    encoder = FeatureEncoder(fr.event_plan()).fit(folds.train_rows(folded, 0))
    data = encoder.feature_frame(folded, ["event_id", "label", "fold"])
    trees = BoostedTrees("regression", {**_SMALL, "n_estimators": 12, "learning_rate": 0.5})
    trained = trees.fit(
        folds.train_rows(data, 0), encoder.vector_slots(), encoder.max_arity(), folds.validation_rows(data, 0), patience=3
    )
    return trained.score(folds.validation_rows(data, 0), ["event_id"])


def path_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, data, _ = _line_model(spark, sf_dir)
    return explain.contributions(trained, data, fr.LINE_IDS, "path")


def shap_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, data, _ = _line_model(spark, sf_dir)
    return explain.contributions(trained, data, fr.LINE_IDS, "shap")


def shap_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, _, data = _doc_model(spark, sf_dir)
    return explain.explain(trained, data, ["doc_id"], "shap").rankings


def surrogate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, data, max_arity = _line_model(spark, sf_dir)
    return explain.surrogate(trained, data, fr.LINE_IDS, max_arity=max_arity, many_rows=True).score(data, fr.LINE_IDS)


def split_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, _, _ = _line_model(spark, sf_dir)
    return explain.split_importance(spark, trained)


# One tree that is deep enough to separate every value of one nominal feature predicts
# the mean of each value, so training, scoring, search and explanation have SQL twins.
_SATURATED = {"n_estimators": 1, "num_leaves": 4096, "min_data_in_leaf": 1, "feature_fraction": 1.0}


def _grouped_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FeaturePlan]:
    df = fr.line_frame(spark, sf_dir).select(*fr.LINE_IDS, (F.col("price") > 40000).cast("int").alias("label"), "line_no")
    return df, _plan(categorical=["line_no"], keep_missing=["line_no"])


def _group_model(spark: SparkSession, sf_dir: str) -> tuple[TrainedModel, DataFrame, int]:
    df, plan = _grouped_lines(spark, sf_dir)
    encoder = FeatureEncoder(plan).fit(df)
    data = encoder.feature_frame(df, [*fr.LINE_IDS, "label"])
    trained = BoostedTrees("classification", _SATURATED).fit(data, encoder.vector_slots(), encoder.max_arity())
    return trained, data, encoder.max_arity()


def group_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, data, _ = _group_model(spark, sf_dir)
    return rounded(trained.score(data, fr.LINE_IDS))


def group_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fr.event_frame(spark, sf_dir)
    plan = FeaturePlan(["event_id"], "label", categorical=["event_type"])
    encoder = FeatureEncoder(plan).fit(df)
    data = encoder.feature_frame(df, ["event_id", "label"])
    trained = BoostedTrees("regression", _SATURATED).fit(data, encoder.vector_slots(), encoder.max_arity())
    return rounded(trained.score(data, ["event_id"]))


def group_contributions_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, data, _ = _group_model(spark, sf_dir)
    values = explain.contributions(trained, data, fr.LINE_IDS, "path")
    return rounded(values.select(*fr.LINE_IDS, "bias", "margin", F.col("contributions")[0].alias("contribution")))


def group_contributions_shap(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, data, _ = _group_model(spark, sf_dir)
    values = explain.contributions(trained, data, fr.LINE_IDS, "shap")
    return rounded(values.select(*fr.LINE_IDS, "bias", "margin", F.col("contributions")[0].alias("contribution")))


def group_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, data, _ = _group_model(spark, sf_dir)
    return rounded(explain.explain(trained, data, fr.LINE_IDS, "shap").rankings)


def group_split_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, _, _ = _group_model(spark, sf_dir)
    return explain.split_importance(spark, trained).select("feature", "n_splits")


def group_train_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, plan = _grouped_lines(spark, sf_dir)
    encoder = FeatureEncoder(plan).fit(df)
    data = encoder.feature_frame(df, [*fr.LINE_IDS, "label"])
    trained = BoostedTrees("classification", _SATURATED).fit_and_measure(data, "rocauc", encoder.vector_slots(), encoder.max_arity())
    return rounded(spark.createDataFrame([("rocauc", trained.train_metric)], "metric string, value double"))


def group_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, data, max_arity = _group_model(spark, sf_dir)
    return rounded(explain.surrogate(trained, data, fr.LINE_IDS, 1000, max_arity).score(data, fr.LINE_IDS))


def group_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, plan = _grouped_lines(spark, sf_dir)
    folded = folds.assign_folds(df, 3, fr.LINE_IDS, target="label")
    data = encode_folds(folded, FeatureEncoder(plan), 3, "label", fr.LINE_IDS)
    space = parse_space({name: {"kind": "categorical", "choices": [value]} for name, value in _SATURATED.items()})
    result = cross_validate_search(data, space, 1, "classification", "rocauc", "gt", "label", parallelism=3)
    return rounded(result.fold_frame(spark).select("trial_number", "fold", "metric"))


# --- persistence and whole runs ---------------------------------------------------------------


def non_numeric_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fr.raw_line(spark, sf_dir).select(*fr.LINE_IDS, "qty_text", "tax_text", "cat_text")
    encoded, _ = encode_non_numeric(raw, ["qty_text", "tax_text", "cat_text"], fr.LINE_IDS)
    return encoded


def encoder_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fr.line_frame(spark, sf_dir)
    path = FeatureEncoder(fr.line_plan()).fit(df).save(spark, scratch_path(spark, "encoder"))
    return rounded(FittedEncoder.load(spark, path).transform(df, [*fr.LINE_IDS, "label"]))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, data, _ = _group_model(spark, sf_dir)
    path = trained.save(spark, scratch_path(spark, "model"))
    predictions = TrainedModel.load(spark, path).score(data, fr.LINE_IDS)
    written = write_table(predictions, scratch_path(spark, "predictions") + ".csv")
    return rounded(spark.read.option("header", True).schema(predictions.schema).csv(written))


def _event_run(spark: SparkSession, sf_dir: str) -> tuple[TabularRun, dict, dict]:
    """A whole training run on the events table, from configurations to result files."""
    root = scratch_path(spark, "run")
    metadata = [("event_type", "category", 1, "most_frequent", "", ""), ("user_id", "number", 0, "mean", "", "")]
    schema = "feature_name string, type string, use int, imputation string, transformation string, super_category string"
    spark.createDataFrame(metadata, schema).write.parquet(f"{root}/metadata.parquet")
    model = {
        "target_variable": "value", "id_variables": ["event_id"], "problem_type": "regression", "evaluation_metric": "rmse",
        "better_performance": "lt", "models": ["lgbm"], "k_folds": 3, "retrain_with_whole_dataset": True,
        "importance_extraction_method": "shap", "num_hp_searches": 1, "parallelism": 3,
        "hyperparameter_space": {"lgbm": {n: f"trial.suggest_categorical('{n}', [{v}])" for n, v in _SATURATED.items()}},
    }
    data = {
        "training": True, "input_data_source": "PARQUET", "file_path": f"{sf_dir}/events.parquet", "metadata_file_path": f"{root}/metadata.parquet",
        "data_processor_file_path": f"{root}/value_regression_lgbm_data_processor", "model_file_path": f"{root}/value_regression_lgbm",
        "predictions_output_path": f"{root}/predictions.csv",
    }
    run = TabularRun(model, data, spark, output_dir=root)
    run.run()
    return run, model, {**data, "training": False}


def run_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, model, scoring = _event_run(spark, sf_dir)
    scorer = TabularRun(model, scoring, spark, output_dir=run.output_dir)
    scorer.run()
    return rounded(spark.read.option("header", True).schema("prediction double, event_id bigint").csv(scorer.paths["predictions"]))


def run_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, _, _ = _event_run(spark, sf_dir)
    study = spark.read.option("header", True).option("escape", '"').csv(run.paths["study"])
    return rounded(study.select(F.col("trial_number").cast("int").alias("trial_number"), F.col("value").cast("double").alias("value"), "state"))


def run_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, _, _ = _event_run(spark, sf_dir)
    return rounded(spark.read.option("header", True).schema("feature string, importance double").csv(run.paths["importance"]))


def run_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, _, _ = _event_run(spark, sf_dir)
    values = spark.read.parquet(run.paths["importance_values"])
    return rounded(values.select("event_id", "bias", "margin", F.col("contributions")[0].alias("contribution")))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        typed_cast, bool_parity, csv_text_roundtrip, csv_stray_quotes, csv_scan_typed, inferred_types, metadata_unpivot, feature_routing, metadata_counts, scoring_projection,
        profile_columns, distinct_counts, value_counts, problem_strings, bad_numeric_cells, bad_numeric_report, score_histogram,
        stratified_folds, plain_folds, fold_sizes, fold_train_validation, ordered_split, exact_sample, first_rows,
        scale_fit, scale_impute_apply, mode_impute, bool_impute, bool_as_number, onehot, onehot_na, passthrough, encoded_table,
        loo_fold_stats, fold_encoded_table, document_slice, category_dictionary, category_codes,
        class_weights, roc_auc, auc_ranges, roc_auc_by_group, threshold_metrics, regression_metrics, cv_mean, cv_best_trial,
        argmax_prediction, flat_prediction, mean_abs_importance, importance_rank, top_importance, importance_by_group,
        train_score_binary, train_score_lines, train_score_regression, train_score_multiclass, cv_search, early_stopping,
        path_contributions, shap_contributions, shap_importance, surrogate_scores, split_importance,
        group_binary, group_regression, group_contributions_path, group_contributions_shap, group_importance, group_split_count,
        group_train_metric, group_surrogate, group_search,
        non_numeric_codes, encoder_roundtrip, model_roundtrip, run_predictions, run_study, run_importance, run_contributions,
        *TREE_QUERIES,
    )
}
