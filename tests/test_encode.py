import math

import pytest
from pyspark.sql import functions as F

from gridloom.operators import encode
from gridloom.operators.encode import FeatureEncoder, FittedEncoder, apply_dictionary, first_seen_dictionary
from gridloom.operators.folds import assign_folds
from gridloom.sources.metadata import FeaturePlan

ROWS = [
    (1, 1.0, 10.0, 5.0, "b", "x", "u", True, None, 0),
    (2, 2.0, None, 5.0, "a", "y", None, None, True, 1),
    (3, None, 30.0, 5.0, None, "x", "v", False, False, 0),
    (4, 4.0, 40.0, 5.0, "a", None, "u", True, True, 1),
    (5, 9.0, 50.0, 5.0, "b", "y", "v", False, None, 0),
]
SCHEMA = "id int, n double, raw double, const double, cat string, oh string, oh_na string, flag boolean, flag_na boolean, y int"


def metadata(extra=()):
    rows = [
        ("n", "float", "mean", ""),
        ("raw", "number", "Leave as N/A", ""),
        ("const", "float", "mean", ""),
        ("cat", "category", "most_frequent", ""),
        ("oh", "category", "most_frequent", "One-Hot"),
        ("oh_na", "category", "unknown", "one-hot"),
        ("flag", "bool", "zero", ""),
        ("flag_na", "bool", "", ""),
        *extra,
    ]
    return [dict(feature_name=a, type=b, use=1, imputation=c, transformation=d, super_category="g") for a, b, c, d in rows]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def plan():
    return FeaturePlan.from_rows(metadata(), ["id"], "y")


def test_flat_output(table, plan):
    fitted = FeatureEncoder(plan).fit(table)
    out = fitted.transform(table, ["id"])
    assert out.columns == [
        "id", "num__n", "num__const", "cat__cat", "onehot__oh_x", "onehot__oh_y",
        "onehot_na__oh_na_u", "onehot_na__oh_na_v", "onehot_na__oh_na_nan", "bin__flag", "remainder__raw", "remainder__flag_na",
    ]
    rows = {r["id"]: r for r in out.collect()}
    std = math.sqrt(sum((v - 4) ** 2 for v in (1, 2, 4, 9)) / 4)
    assert rows[1]["num__n"] == pytest.approx((1 - 4) / std)
    assert rows[3]["num__n"] == 0.0
    assert all(r["num__const"] == 0.0 for r in rows.values())
    assert rows[3]["cat__cat"] == "a"  # a and b tie, the smaller value wins
    assert (rows[4]["onehot__oh_x"], rows[4]["onehot__oh_y"]) == (1.0, 0.0)
    assert rows[2]["onehot_na__oh_na_nan"] == 1.0 and rows[2]["onehot_na__oh_na_u"] == 0.0
    assert rows[2]["bin__flag"] == 0.0 and rows[1]["bin__flag"] == 1.0
    assert rows[2]["remainder__raw"] is None and rows[1]["remainder__flag_na"] is None


def test_unknown_category_and_extra_columns(spark, table, plan):
    fitted = FeatureEncoder(plan).fit(table)
    new = spark.createDataFrame([(9, 4.0, 1.0, 5.0, "zz", "zz", "zz", None, None, 1)], SCHEMA).withColumn("extra", F.lit(1))
    row = fitted.transform(new, ["id"]).first()
    assert row["onehot__oh_x"] == row["onehot__oh_y"] == row["onehot_na__oh_na_nan"] == row["onehot_na__oh_na_u"] == 0.0
    vector = fitted.feature_frame(new).first()["features"]
    assert len(vector) == len(fitted.vector_slots())
    with pytest.raises(ValueError, match="missing"):
        fitted.transform(new.drop("n"))


def test_vector_has_no_missing_and_keeps_names(table, plan):
    fitted = FeatureEncoder(plan).fit(table)
    frame = fitted.feature_frame(table, ["id"])
    attrs = frame.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    assert [names[i] for i in sorted(names)] == [name for name, _ in fitted.vector_slots()]
    assert all(not math.isnan(v) for r in frame.collect() for v in r["features"].toArray())
    assert "nominal" not in attrs
    at = [name for name, _ in fitted.vector_slots()].index("remainder__raw")
    raw = {r["id"]: tuple(r["features"].toArray()[at : at + 2]) for r in frame.collect()}
    assert raw == {1: (10.0, 10.0), 2: (encode.MISSING_LOW, encode.MISSING_HIGH), 3: (30.0, 30.0), 4: (40.0, 40.0), 5: (50.0, 50.0)}
    assert fitted.vector_slots()[at : at + 2] == [("remainder__raw", "raw"), ("remainder__raw__high", "raw")]


def test_category_codes_are_ranks_of_mean_labels(spark):
    rows = [(i, "abcde"[i % 5], [0.0, 4.0, 2.0, 9.0, 2.0][i % 5]) for i in range(100)]
    rows += [(i, None, 6.0) for i in range(100, 120)] + [(120, "rare", 1000.0)]
    df = spark.createDataFrame(rows, "id int, c string, y double")
    kept = FeatureEncoder(FeaturePlan(["id"], "y", categorical=["c"], keep_missing=["c"])).fit(df)
    assert kept.orders["c"] == ["a", "c", "e", "b", None, "d", "rare"] and kept.unknown["c"] == 4.0
    new = spark.createDataFrame([(1, "d"), (2, None), (3, "new"), (4, "a")], "id int, c string")
    assert {r["id"]: r["features"][0] for r in kept.feature_frame(new, ["id"]).collect()} == {1: 5.0, 2: 4.0, 3: 4.0, 4: 0.0}
    filled = FeatureEncoder(FeaturePlan(["id"], "y", categorical=["c"])).fit(df)
    assert filled.modes["c"] == "a" and None not in filled.orders["c"] and filled.unknown["c"] % 1 == 0.5
    assert {r["id"]: r["features"][0] for r in filled.feature_frame(new, ["id"]).collect()}[2] == filled.orders["c"].index("a")


@pytest.mark.parametrize("limit", [0, 10])
def test_stored_sizes_change_no_vector(spark, sf_dir, monkeypatch, limit, tmp_path):
    """Dictionaries in the plan, joined or kept as tables, for the whole table and for folds: the same codes, also of missing and unknown values."""
    df = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", F.when(F.col("p_size") > 3, F.col("p_type")).alias("t"), F.when(F.col("p_size") < 48, F.col("p_brand")).alias("b"),
        F.col("p_size").cast("string").alias("s"), F.when(F.col("p_size") != 9, F.substring("p_name", 1, 3)).alias("o"), (F.col("p_retailprice") > 1400).cast("int").alias("label"),
    )
    plan = FeaturePlan(["p_partkey"], "label", categorical=["t", "b"], one_hot=["s", "o"], keep_missing=["b", "o"])
    folded = assign_folds(df, 3, ["p_partkey"], target="label")
    new = folded.withColumns({"t": F.when(F.col("p_partkey") % 7 == 0, F.lit("new")).otherwise(F.col("t")), "s": F.when(F.col("p_partkey") % 5 == 0, F.lit("new")).otherwise(F.col("s"))})

    def vectors():
        encoders = [FeatureEncoder(plan).fit(df), *FeatureEncoder(plan).fit_folds(folded, 3)]
        loaded = FittedEncoder.load(spark, encoders[0].save(spark, str(tmp_path / f"enc{encode.COLLECTED_CATEGORIES}")))
        return [e.vector_slots() for e in encoders], [{r[0]: tuple(r[1].toArray()) for r in e.feature_frame(new, ["p_partkey"]).collect()} for e in [*encoders, loaded]]

    want = vectors()
    assert want[1][0] == want[1][-1]
    for name in ("LITERAL_CATEGORIES", "COLLECTED_CATEGORIES", "COLLECTED_TOTAL"):
        monkeypatch.setattr(encode, name, limit)
    assert vectors() == want
    flat = FeatureEncoder(plan).fit(df).transform(new, ["p_partkey"])
    assert {"onehot__s"} | ({"onehot_na__o"} if not limit else set()) <= set(flat.columns) and flat.count() == df.count()


def test_all_missing_columns_are_dropped(spark, plan):
    df = spark.createDataFrame([(1, None, None, 1.0, None, None, None, None, None, 0)], SCHEMA)
    columns = FeatureEncoder(plan).fit(df).transform(df).columns
    assert columns == ["num__const", "onehot_na__oh_na_nan", "bin__flag", "remainder__raw", "remainder__flag_na"]


@pytest.mark.parametrize("limit", [10_000, 0])
def test_fold_statistics_equal_direct_fit(spark, sf_dir, limit, monkeypatch):
    monkeypatch.setattr(encode, "COLLECTED_CATEGORIES", limit)
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.when(F.col("o_totalprice") < 20000, None).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority").startswith("1"), None).otherwise(F.col("o_orderpriority")).alias("prio"), "o_orderstatus",
    )
    plan = FeaturePlan(["o_orderkey"], "o_orderstatus", numeric=["price"], categorical=["prio"])
    folded = assign_folds(df, 3, ["o_orderkey"], target="o_orderstatus")
    for f, got in enumerate(FeatureEncoder(plan).fit_folds(folded, 3)):
        want = FeatureEncoder(plan).fit(folded.where(F.col("fold") != f))
        assert got.moments["price"] == pytest.approx(want.moments["price"], rel=1e-12)
        assert got.modes == want.modes and got.categories == want.categories and got.saw_missing == want.saw_missing and got.unknown == want.unknown
        va = {r[0]: r[1][1] for r in got.feature_frame(folded, ["o_orderkey"]).collect()}
        assert len(va) == folded.count()
        assert va == {r[0]: r[1][1] for r in want.feature_frame(folded, ["o_orderkey"]).collect()}


def test_large_dictionary_joins_equal_literals(spark, sf_dir, monkeypatch, tmp_path):
    df = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type", "p_size")
    plan = FeaturePlan(["p_partkey"], None, numeric=["p_size"], categorical=["p_type"])
    literal = FeatureEncoder(plan).fit(df)
    want = {r[0]: r[1] for r in literal.feature_frame(df, ["p_partkey"]).collect()}
    monkeypatch.setattr(encode, "LITERAL_CATEGORIES", 0)
    assert want == {r[0]: r[1] for r in literal.feature_frame(df, ["p_partkey"]).collect()}
    monkeypatch.setattr(encode, "COLLECTED_CATEGORIES", 0)
    large = FeatureEncoder(plan).fit(df)
    assert want == {r[0]: r[1] for r in large.feature_frame(df, ["p_partkey"]).collect()}
    large.save(spark, str(tmp_path / "enc"))
    again = FittedEncoder.load(spark, str(tmp_path / "enc"))
    assert want == {r[0]: r[1] for r in again.feature_frame(df, ["p_partkey"]).collect()}


def test_save_and_load_both_layouts(spark, table, plan, tmp_path):
    fitted = FeatureEncoder(plan).fit(table)
    fitted.save(spark, str(tmp_path / "enc"))
    again = FittedEncoder.load(spark, str(tmp_path / "enc"))
    assert again.transform(table).exceptAll(fitted.transform(table)).count() == 0
    bare = FittedEncoder.from_dict(fitted.to_dict()["preprocessor"])
    assert bare.to_dict() == fitted.to_dict()


def test_keep_unused(table):
    plan = FeaturePlan.from_rows(metadata()[:1], ["id"], "y")
    out = FeatureEncoder(plan, keep_unused=True).fit(table).transform(table)
    assert out.columns[0] == "num__n" and "remainder__cat" in out.columns and "remainder__id" not in out.columns


def test_first_seen_dictionary(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None), (5, "c")], "id int, v string")
    dictionary = first_seen_dictionary(df, "v", ["id"])
    assert {r["value"]: r["code"] for r in dictionary.collect()} == {"b": 0, "a": 1, None: 2, "c": 3}
    new = spark.createDataFrame([("a",), ("zz",), (None,)], "v string")
    assert {r["v"]: r["code"] for r in apply_dictionary(new, "v", dictionary, "code").collect()} == {"a": 1, "zz": None, None: 2}
