"""Queries over a given tree ensemble, category codes and the direction of missing values, with their SQL twins.

The ensemble is made from the rows of ``region`` (a tree each) and the ranges of the features in ``part`` by
expressions that both engines evaluate alike; its weights and values are sums of powers of two, so margins are exact.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import ensemble, explain
from gridloom.operators.encode import FeatureEncoder
from gridloom.operators.score import multiclass_output
from gridloom.operators.train import BoostedTrees, best_length, load_model
from gridloom.plans import frames as fr
from gridloom.plans.frames import rounded
from gridloom.plans.oracles import _auc
from gridloom.session import scratch_path
from gridloom.sources.metadata import FeaturePlan
from gridloom.sources.readers import spread

# --- a given ensemble ---------------------------------------------------------

SLOTS = ("p_size", "p_retailprice", "p_partkey")
_LEAF_COVER = "(1 + (tree + {}) % 5)"
_NODE_COLUMNS = {
    "left": "CASE WHEN node < 7 THEN 2 * node + 1 ELSE -1 END",
    "right": "CASE WHEN node < 7 THEN 2 * node + 2 ELSE -1 END",
    "slot": "(tree * 3 + node) % 3",
    "threshold": "CASE (tree * 3 + node) % 3 WHEN 0 THEN lo0 + (hi0 - lo0) * (2 * ((tree * 13 + node * 7) % 19) + 1) / 40.0E0 "
    "WHEN 1 THEN lo1 + (hi1 - lo1) * (2 * ((tree * 13 + node * 7) % 19) + 1) / 40.0E0 ELSE lo2 + (hi2 - lo2) * (2 * ((tree * 13 + node * 7) % 19) + 1) / 40.0E0 END",
    "value": "((tree * 17 + node * 11) % 23 - 11) / 8.0E0",
    "weight": "1.0E0 / (CASE tree WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 8 ELSE 16 END)",
    "cover": "CASE WHEN node >= 7 THEN {} WHEN node >= 3 THEN {} WHEN node >= 1 THEN {} ELSE {} END * 1.0E0".format(
        _LEAF_COVER.format("node"),
        " + ".join(_LEAF_COVER.format(f"2 * node + {k}") for k in (1, 2)),
        " + ".join(_LEAF_COVER.format(f"4 * node + {k}") for k in (3, 4, 5, 6)),
        " + ".join(_LEAF_COVER.format(k) for k in range(7, 15)),
    ),
}
_RANGES = ", ".join(f"CAST(min({c}) AS DOUBLE) AS lo{i}, CAST(max({c}) AS DOUBLE) AS hi{i}" for i, c in enumerate(SLOTS))
_COLUMNS = ", ".join(f'{sql} AS "{name}"' for name, sql in _NODE_COLUMNS.items())


def given_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node table: a tree of depth 3 for every row of ``region``."""
    ranges = fr.table(spark, sf_dir, "part").selectExpr(*_RANGES.split(", "))
    limits = F.array(*[ranges.select(name).scalar() for name in ranges.columns])
    nodes = fr.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("tree"), F.explode(F.sequence(F.lit(0), F.lit(14))).alias("node"))
    nodes = nodes.select("tree", "node", limits.alias("limits")).select("tree", "node", *[F.col("limits")[i].alias(name) for i, name in enumerate(ranges.columns)])
    columns = [f"{sql} AS `{name}`" for name, sql in _NODE_COLUMNS.items()]
    return nodes.selectExpr("tree", "node", *columns, "CAST(NULL AS array<double>) AS codes")


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    part = spread(fr.table(spark, sf_dir, "part"), fr.ROWS_PER_TASK)
    label = F.when((F.col("p_partkey") * 7 + F.col("p_size")) % 10 < 4, 1).otherwise(0)
    return part.withColumn("label", label), F.array(*[F.col(c).cast("double") for c in SLOTS])


def ensemble_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Margin and probability of every part."""
    df, x = _parts(spark, sf_dir)
    staged = ensemble.staged_margins(given_ensemble(spark, sf_dir), df, x, ["p_partkey"])
    margin = F.element_at("staged", -1)
    return rounded(staged.select("p_partkey", margin.alias("margin"), (1 / (1 + F.exp(-2 * margin))).alias("prediction")))


def ensemble_path_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path contributions as native expressions."""
    df, x = _parts(spark, sf_dir)
    values = ensemble.path_contributions(given_ensemble(spark, sf_dir), df, x, len(SLOTS), ["p_partkey"])
    return _contribution_columns(values)


def _contribution_columns(values: DataFrame, digits: int = 6) -> DataFrame:
    return rounded(values.select("p_partkey", "bias", "margin", *[F.col("contributions")[i].alias(f"c{i}") for i in range(len(SLOTS))]), digits)


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, x = _parts(spark, sf_dir)
    return df.select("p_partkey", array_to_vector(x).alias("features"))


def ensemble_path_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in Arrow batches, as trained models are explained."""
    return _contribution_columns(explain.ensemble_contributions(given_ensemble(spark, sf_dir), _vectors(spark, sf_dir), ["p_partkey"], "path"))


def ensemble_shap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contribution_columns(explain.ensemble_contributions(given_ensemble(spark, sf_dir), _vectors(spark, sf_dir), ["p_partkey"], "shap"), 9)


def ensemble_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = explain.ensemble_contributions(given_ensemble(spark, sf_dir), _vectors(spark, sf_dir), ["p_partkey"], "shap")
    ranked = explain.rank_importance(explain.mean_abs_importance(values, [(c, [i]) for i, c in enumerate(SLOTS)]))
    return rounded(ranked)


def ensemble_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.split_counts(given_ensemble(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, x = _parts(spark, sf_dir)
    return ensemble.staged_margins(given_ensemble(spark, sf_dir), df, x, ["p_partkey", "label"])


def staged_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area under the ROC curve of the first 1, 2, … trees."""
    return rounded(ensemble.staged_metrics(_staged(spark, sf_dir), "label", "rocauc"))


def staged_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ensemble.staged_metrics(_staged(spark, sf_dir), "label", "rmse"))


def best_length_by_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many trees early stopping keeps by that metric, with a patience of 2."""
    rows = sorted(ensemble.staged_metrics(_staged(spark, sf_dir), "label", "rocauc").collect())  # one row per tree
    return spark.createDataFrame([(best_length([-r["metric"] for r in rows], 2),)], "n_trees int")


# --- categories and missing values ---------------------------------------------


def category_rank_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of a category with far more values than the driver may hold here, kept as a table."""
    df = fr.table(spark, sf_dir, "lineitem").select(
        *fr.LINE_IDS, F.when(F.col("l_tax") != 0.08, F.col("l_partkey").cast("string")).alias("part"), (F.col("l_quantity") > 30).cast("int").alias("label")
    )
    plan = FeaturePlan(fr.LINE_IDS, "label", categorical=["part"], keep_missing=["part"])
    encoder = FeatureEncoder(plan, collected=10).fit(df)
    return encoder.feature_frame(df, fr.LINE_IDS).select(*fr.LINE_IDS, vector_to_array("features")[0].alias("code"))


def missing_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regression tree of one split over a number with missing cells, which it may send either way."""
    df = fr.table(spark, sf_dir, "lineitem").select(
        *fr.LINE_IDS,
        F.when(F.col("l_discount") >= 0.02, F.col("l_discount")).alias("x"),
        F.when(F.col("l_discount") >= 0.02, F.col("l_discount") * 1000).otherwise(F.lit(71.0)).alias("label"),
    )
    encoder = FeatureEncoder(FeaturePlan(fr.LINE_IDS, "label", numeric=["x"], keep_missing=["x"])).fit(df)
    data = encoder.feature_frame(df, [*fr.LINE_IDS, "label"])
    stump = BoostedTrees("regression", {"n_estimators": 1, "num_leaves": 2, "min_data_in_leaf": 1, "feature_fraction": 1.0})
    return rounded(stump.fit(data, encoder.vector_slots()).score(data, fr.LINE_IDS))


def group_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three classes: an ensemble for each, of one tree that separates every value of one category."""
    df = fr.table(spark, sf_dir, "lineitem").select(
        *fr.LINE_IDS, F.when(F.col("l_tax") != 0.08, F.col("l_linenumber").cast("string")).alias("line_no"),
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0).alias("label"),
    )
    encoder = FeatureEncoder(FeaturePlan(fr.LINE_IDS, "label", categorical=["line_no"], keep_missing=["line_no"])).fit(df)
    data = encoder.feature_frame(df, [*fr.LINE_IDS, "label"])
    params = {"n_estimators": 1, "num_leaves": 4096, "min_data_in_leaf": 1, "feature_fraction": 1.0}
    trained = BoostedTrees("classification", params, classes=[0.0, 1.0, 2.0]).fit(data, encoder.vector_slots(), encoder.max_arity())
    path = trained.save(spark, scratch_path(spark, "model"))
    return rounded(multiclass_output(load_model(spark, path).score(data, fr.LINE_IDS), "prediction", 3, fr.LINE_IDS))


TREE_QUERIES = (
    ensemble_scores, ensemble_path_native, ensemble_path_contributions, ensemble_shap, ensemble_importance, ensemble_split_counts,
    staged_auc, staged_rmse, best_length_by_auc, category_rank_codes, missing_direction, group_multiclass,
)

# --- SQL twins ------------------------------------------------------------------

_X = "CASE n.slot WHEN 0 THEN CAST(p.p_size AS DOUBLE) WHEN 1 THEN p.p_retailprice ELSE CAST(p.p_partkey AS DOUBLE) END"
_NODES = f"""limits AS (SELECT {_RANGES} FROM part),
nodes AS MATERIALIZED (SELECT tree, node, {_COLUMNS} FROM (SELECT r_regionkey AS tree, CAST(k AS INT) AS node FROM region, range(15) AS t(k)) AS grid, limits)"""
_WALK = f"""{_NODES},
walk(p_partkey, tree, node, next, slot, change) AS (
  SELECT p_partkey, tree, CAST(0 AS INT), CAST(0 AS INT), CAST(-1 AS INT), CAST(0 AS DOUBLE) FROM part, (SELECT DISTINCT tree FROM nodes) AS trees
  UNION ALL
  SELECT w.p_partkey, w.tree, n.node, c.node, CAST(n.slot AS INT), n.weight * (c.value - n.value)
  FROM walk w JOIN part p USING (p_partkey) JOIN nodes n ON n.tree = w.tree AND n.node = w.next AND n."left" >= 0
  JOIN nodes c ON c.tree = n.tree AND c.node = CASE WHEN {_X} <= n.threshold THEN n."left" ELSE n."right" END
),
leaves AS (SELECT w.p_partkey, w.tree, n.weight * n.value AS margin FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.next WHERE n."left" < 0),
staged AS (
  SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey ORDER BY tree) AS n_trees, sum(margin) OVER (PARTITION BY p_partkey ORDER BY tree) AS score FROM leaves
),
labelled AS (SELECT CAST(n_trees AS INT) AS n_trees, score, CASE WHEN (p_partkey * 7 + p_size) % 10 < 4 THEN 1 ELSE 0 END AS label FROM staged JOIN part USING (p_partkey))"""
_PATH = f"""WITH RECURSIVE {_WALK}, bias AS (SELECT sum(weight * value) AS bias FROM nodes WHERE node = 0)
SELECT p_partkey, round(any_value(bias), 6) AS bias, round(any_value(bias) + sum(change), 6) AS margin,
  {", ".join(f"round(coalesce(sum(change) FILTER (WHERE slot = {i}), 0), 6) AS c{i}" for i in range(3))}
FROM walk CROSS JOIN bias GROUP BY p_partkey"""
_LEVEL = """{name} AS (
  SELECT p.p_partkey, n.tree, n.node, l.mask, CASE WHEN (l.mask >> n.slot) & 1 = 1 THEN CASE WHEN {x} <= n.threshold THEN l.v ELSE r.v END
    ELSE (cl.cover * l.v + cr.cover * r.v) / n.cover END AS v
  FROM {below} l JOIN nodes n ON n.tree = l.tree AND n."left" = l.node JOIN {below} r ON r.p_partkey = l.p_partkey AND r.tree = n.tree AND r.node = n."right" AND r.mask = l.mask
  JOIN nodes cl ON cl.tree = n.tree AND cl.node = n."left" JOIN nodes cr ON cr.tree = n.tree AND cr.node = n."right" JOIN part p ON p.p_partkey = l.p_partkey
)"""
_SHAP = f"""{_NODES}, masks AS (SELECT CAST(m AS INT) AS mask FROM range(8) AS t(m)),
v3 AS (SELECT p_partkey, tree, node, mask, value AS v FROM part, nodes, masks WHERE node >= 7),
{_LEVEL.format(name="v2", below="v3", x=_X)}, {_LEVEL.format(name="v1", below="v2", x=_X)}, {_LEVEL.format(name="v0", below="v1", x=_X)},
game AS MATERIALIZED (SELECT p_partkey, mask, sum(weight * v) AS v FROM v0 JOIN nodes USING (tree, node) GROUP BY p_partkey, mask),
shap AS MATERIALIZED (
  SELECT a.p_partkey, i, sum((b.v - a.v) / CASE bit_count(a.mask) WHEN 1 THEN 6.0 ELSE 3.0 END) AS phi
  FROM game a JOIN (SELECT CAST(s AS INT) AS i FROM range(3) AS t(s)) AS players ON (a.mask >> i) & 1 = 0 JOIN game b ON b.p_partkey = a.p_partkey AND b.mask = a.mask | (1 << i)
  GROUP BY a.p_partkey, i
)"""

TREE_ORACLES = {
    "ensemble_scores": f"""WITH RECURSIVE {_WALK}
SELECT p_partkey, round(sum(margin), 6) AS margin, round(1 / (1 + exp(-2 * sum(margin))), 6) AS prediction FROM leaves GROUP BY p_partkey""",
    "ensemble_path_native": _PATH,
    "ensemble_path_contributions": _PATH,
    "ensemble_shap": f"""WITH {_SHAP}
SELECT p_partkey, round(any_value(e.v), 9) AS bias, round(any_value(g.v), 9) AS margin, {", ".join(f"round(max(phi) FILTER (WHERE i = {i}), 9) AS c{i}" for i in range(3))}
FROM shap JOIN (SELECT p_partkey, v FROM game WHERE mask = 0) AS e USING (p_partkey) JOIN (SELECT p_partkey, v FROM game WHERE mask = 7) AS g USING (p_partkey) GROUP BY p_partkey""",
    "ensemble_importance": f"""WITH {_SHAP}, means AS (SELECT CASE i WHEN 0 THEN 'p_size' WHEN 1 THEN 'p_retailprice' ELSE 'p_partkey' END AS feature, avg(abs(phi)) AS m FROM shap GROUP BY i)
SELECT feature, round(m, 6) AS importance, CAST(row_number() OVER (ORDER BY m DESC, feature) AS INT) AS rank FROM means""",
    "ensemble_split_counts": f"""WITH {_NODES} SELECT slot, count(*) AS n_splits FROM nodes WHERE "left" >= 0 GROUP BY slot""",
    "staged_auc": f"WITH RECURSIVE {_WALK} SELECT n_trees, round(auc, 6) AS metric FROM ({_auc('labelled', ['n_trees'])})",
    "staged_rmse": f"WITH RECURSIVE {_WALK} SELECT n_trees, round(sqrt(avg((label - score) * (label - score))), 6) AS metric FROM labelled GROUP BY n_trees",
    # the best round before two rounds in a row bring nothing
    "best_length_by_auc": f"""WITH RECURSIVE {_WALK}, areas AS ({_auc('labelled', ['n_trees'])}),
running AS (SELECT n_trees, auc, max(auc) OVER (ORDER BY n_trees) AS top FROM areas),
firsts AS (SELECT r.n_trees, (SELECT min(n_trees) FROM areas a WHERE a.auc = r.top) AS best FROM running r),
stops AS (SELECT coalesce(min(n_trees), (SELECT max(n_trees) FROM areas)) AS stop FROM firsts WHERE n_trees - best >= 2)
SELECT CAST(best AS INT) AS n_trees FROM firsts, stops WHERE firsts.n_trees = stop""",
    "category_rank_codes": """WITH line AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_tax <> 0.08 THEN CAST(l_partkey AS VARCHAR) END AS part, CASE WHEN l_quantity > 30 THEN 1.0E0 ELSE 0.0E0 END AS label FROM lineitem
), prior AS (SELECT sum(label) / count(*) AS prior FROM line
), means AS (SELECT part, (sum(label) + any_value(prior) * 10.0E0) / (count(*) + 10.0E0) AS m FROM line, prior GROUP BY part
), codes AS (SELECT part, CAST(row_number() OVER (ORDER BY m, part NULLS FIRST) - 1 AS DOUBLE) AS code FROM means)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, code FROM line JOIN codes ON line.part IS NOT DISTINCT FROM codes.part""",
    "group_multiclass": """WITH line AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_tax <> 0.08 THEN l_linenumber END AS line_no, l_returnflag AS flag FROM lineitem
), margins AS (
  SELECT line_no, avg(CASE WHEN flag = 'A' THEN 1.0E0 ELSE -1.0E0 END) AS a, avg(CASE WHEN flag = 'N' THEN 1.0E0 ELSE -1.0E0 END) AS n,
    avg(CASE WHEN flag NOT IN ('A', 'N') THEN 1.0E0 ELSE -1.0E0 END) AS r FROM line GROUP BY line_no
), powers AS (SELECT line_no, exp(2 * a) AS a, exp(2 * n) AS n, exp(2 * r) AS r FROM margins)
SELECT round(a / (a + n + r), 6) AS prob_class_0, round(n / (a + n + r), 6) AS prob_class_1, round(r / (a + n + r), 6) AS prob_class_2,
  CAST(CASE WHEN a >= n AND a >= r THEN 0 WHEN n >= r THEN 1 ELSE 2 END AS INT) AS prediction, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM line JOIN powers ON line.line_no IS NOT DISTINCT FROM powers.line_no""",
    "missing_direction": """WITH line AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount >= 0.02 THEN l_discount END AS x, CASE WHEN l_discount >= 0.02 THEN l_discount * 1000 ELSE 71.0 END AS label FROM lineitem
), cuts AS (
  SELECT x AS cut, low FROM (SELECT DISTINCT x FROM line WHERE x IS NOT NULL), (VALUES (TRUE), (FALSE)) AS t(low)
), sides AS (
  SELECT cut, low, coalesce(x <= cut, low) AS goes_left, sum(label) AS s, count(*) AS n FROM line, cuts GROUP BY ALL
), gains AS (
  SELECT cut, low, sum(s * s / n) AS gain FROM sides GROUP BY cut, low HAVING count(*) = 2
), best AS (SELECT cut, low FROM gains ORDER BY gain DESC, cut, low LIMIT 1
), means AS (SELECT goes_left, s / n AS m FROM sides JOIN best USING (cut, low))
SELECT round(m, 6) AS prediction, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM line CROSS JOIN best JOIN means ON means.goes_left = coalesce(x <= cut, low)""",
}
