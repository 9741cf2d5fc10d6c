import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from gridloom.config import DataConfig, Dimension, ModelConfig, load_json, parse_space, sample_trials
from gridloom.functions.coerce import NULL_TOKENS, to_boolean, to_category, to_number
from gridloom.functions.keys import hash_key
from gridloom.operators import audit
from gridloom.operators.typing import apply_types, bool_to_double, scoring_columns, training_columns, validate_columns
from gridloom.sources.csv_records import csv_lines, has_open_lines, state_after
from gridloom.sources.metadata import FeaturePlan, read_metadata, route_features
from gridloom.sources.readers import infer_types, read_table, with_inferred_types
from gridloom.sources.writers import write_study, write_table

MODEL = {
    "target_variable": "y", "id_variables": ["id"], "problem_type": "classification", "evaluation_metric": "rocauc",
    "better_performance": "gt", "models": ["lgbm"], "k_folds": 3, "retrain_with_whole_dataset": True,
}
DATA = {"training": True, "metadata_file_path": "/m.csv", "input_data_source": "CSV", "file_path": "x.csv"}


def test_json_errors(tmp_path):
    with pytest.raises(FileNotFoundError, match="not found"):
        load_json(str(tmp_path / "none.json"))
    bad = tmp_path / "bad.json"
    bad.write_text("{oops")
    with pytest.raises(ValueError, match="not valid JSON"):
        load_json(str(bad))


@pytest.mark.parametrize("field", list(DATA))
def test_data_contract(field):
    with pytest.raises(ValueError, match=field):
        DataConfig.from_dict({k: v for k, v in DATA.items() if k != field})


@pytest.mark.parametrize("field", ["data_processor_file_path", "model_file_path", "predictions_output_path"])
def test_scoring_contract(field):
    full = {**DATA, "training": False, "data_processor_file_path": "p", "model_file_path": "m", "predictions_output_path": "o"}
    assert DataConfig.from_dict(full).model_file_path == "m"
    with pytest.raises(ValueError, match=field):
        DataConfig.from_dict({k: v for k, v in full.items() if k != field})


@pytest.mark.parametrize("field", list(MODEL))
def test_model_contract(field):
    with pytest.raises(ValueError, match=field):
        ModelConfig.from_dict({k: v for k, v in MODEL.items() if k != field})


def test_model_values():
    with pytest.raises(ValueError, match="unsupported model"):
        ModelConfig.from_dict({**MODEL, "models": ["lgbm", "svm"]})
    with pytest.raises(ValueError, match="problem type"):
        ModelConfig.from_dict({**MODEL, "problem_type": "ranking"})


def test_leading_slash_is_optional():
    assert DataConfig.from_dict(DATA).metadata_path == "/m.csv"
    assert DataConfig.from_dict({**DATA, "strip_leading_slash": True}).metadata_path == "m.csv"


def test_space_from_text_and_objects():
    space = parse_space({
        "boosting_type": "trial.suggest_categorical('boosting_type', ['gbdt'])",
        "learning_rate": "trial.suggest_loguniform('learning_rate', 0.01, 0.2)",
        "num_leaves": "int(trial.suggest_discrete_uniform('num_leaves', 30, 150, 5))",
        "feature_fraction": "trial.suggest_uniform('feature_fraction', 0.1, 1.0)",
        "class_weight": "trial.suggest_categorical('class_weight', [None, 'balanced'])",
        "n_estimators": {"kind": "discrete", "low": 100, "high": 200, "integer": True},
    })
    assert space["num_leaves"] == Dimension("discrete", low=30, high=150, step=5, integer=True)
    trials = sample_trials(space, 50, seed=1)
    assert trials == sample_trials(space, 50, seed=1) != sample_trials(space, 50, seed=2)
    for trial in trials:
        assert 0.01 <= trial["learning_rate"] <= 0.2 and trial["num_leaves"] in range(30, 151, 5)
        assert isinstance(trial["num_leaves"], int) and 100 <= trial["n_estimators"] <= 200
        assert trial["boosting_type"] == "gbdt" and trial["class_weight"] in (None, "balanced")


@pytest.mark.parametrize("text", ["__import__('os').getcwd()", "trial.suggest_uniform('x', open('f'), 2)", "trial.suggest_magic('x', 1, 2)"])
def test_space_text_is_never_evaluated(text):
    with pytest.raises(ValueError):
        parse_space({"x": text})


def test_boolean_spellings(spark):
    texts = ["True", "true", "1", "False", "false", "0", "yes", "T", "1.0", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    dtype = df.schema["t"].dataType
    got = [tuple(r) for r in df.select(to_boolean(F.col("t"), dtype), to_boolean(F.col("t"), dtype, "true")).collect()]
    assert [g[0] for g in got] == [True] * 3 + [False] * 3 + [None] * 5
    assert [g[1] for g in got] == [True] * 3 + [False] * 3 + [True] * 5
    with pytest.raises(ValueError):
        to_boolean(F.col("t"), dtype, "maybe")


def test_boolean_from_numbers(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 0), (2.0, 2), (None, None)], "d double, i int")
    out = df.select(to_boolean(F.col("d"), df.schema["d"].dataType), to_boolean(F.col("i"), df.schema["i"].dataType)).collect()
    assert [tuple(r) for r in out] == [(True, True), (False, False), (None, None), (None, None)]


def test_numeric_texts(spark):
    texts = ["1", " 1.5 ", "-2e3", "inf", "abc", "nan", "", "1d", "2f", "0x10", None, ".5", "3."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(to_number(F.col("t"), df.schema["t"].dataType)).collect()]
    assert got == [1.0, 1.5, -2000.0, float("inf"), None, None, None, None, None, None, None, 0.5, 3.0]


def test_category_and_nan(spark):
    df = spark.createDataFrame([("a", 1.0, True), ("nan", float("nan"), False), (None, None, None)], "s string, d double, b boolean")
    out = df.select(*[to_category(F.col(c), df.schema[c].dataType) for c in "sdb"]).collect()
    assert [tuple(r) for r in out] == [("a", "1.0", "True"), (None, None, "False"), (None, None, None)]


def test_untyped_columns_are_kept(spark):
    df = spark.createDataFrame([(1, float("nan"), "2024")], "id int, y double, d string")
    out = apply_types(df, {"d": "date", "missing": "float"})
    assert out.dtypes == df.dtypes and out.first()["y"] is None and out.first()["d"] == "2024"


def test_column_contract(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, a double")
    rows = [dict(feature_name="a", use=1), dict(feature_name="b", use=0)]
    validate_columns(df, rows, None)
    with pytest.raises(ValueError, match="'b'"):
        validate_columns(df, [dict(feature_name="b", use=1)], None)
    with pytest.raises(ValueError, match="target"):
        validate_columns(df, rows, "y")
    with pytest.raises(ValueError):
        training_columns(df, ["id", "date"], "a")
    assert scoring_columns(df, ["id", "date"]) == (["id"], ["a"])
    assert bool_to_double(df.withColumn("t", F.lit("x")), ["id", "t"]).dtypes == [("id", "double"), ("a", "double"), ("t", "string")]


WIDE = """Unnamed: 0,id,a,b,c,d,y
type,category,float,category,bool,date,number
use,0,1,1,1,1,1
imputation,,mean,Leave as N/A,None,,mean
category_transformation,,,One-Hot,,,
super_category,,g1,g2,g2,,
"""


def test_metadata_layouts(spark, tmp_path):
    wide = tmp_path / "wide.csv"
    wide.write_text(WIDE)
    table = read_metadata(spark, str(wide))
    rows = table.collect()
    assert [r["feature_name"] for r in rows] == ["id", "a", "b", "c", "d", "y"]
    assert rows[2].asDict() == dict(feature_name="b", type="category", use=1, imputation="Leave as N/A", transformation="One-Hot", super_category="g2")
    table.write.parquet(str(tmp_path / "long.parquet"))
    long = read_metadata(spark, str(tmp_path / "long.parquet"))
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, rows))
    plan = FeaturePlan.from_metadata(table, ["id"], "y")
    assert (plan.numeric, plan.one_hot, plan.binary, plan.categorical) == (["a"], ["b"], ["c"], [])
    assert plan.keep_missing == ["b", "c"] and plan.features == ["a", "b", "c", "d"]
    routed = {r["feature_name"]: r["feature_group"] for r in route_features(table, ["id"], "y").collect()}
    assert routed == {"a": "num", "b": "onehot_na", "c": "remainder", "d": "none"}


def test_metadata_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_metadata(spark, str(tmp_path / "none.csv"))
    (tmp_path / "odd.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError):
        read_metadata(spark, str(tmp_path / "odd.csv"))
    (tmp_path / "short.csv").write_text("Unnamed: 0,a\ntype,float\nuse,1\n")
    with pytest.raises(ValueError, match="lacks"):
        read_metadata(spark, str(tmp_path / "short.csv"))


def test_csv_scan(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,n,flag,mixed,q\n1,1,True,x,"a ""b"" c"\n2,NA,False,null,\n3,2.5,True,3,<NA>\n')
    df = read_table(spark, "CSV", str(tmp_path / "in.csv"))
    assert set(dict(df.dtypes).values()) == {"string"}
    assert infer_types(df) == {"id": "bigint", "n": "double", "flag": "boolean", "mixed": "string", "q": "string"}
    rows = [tuple(r) for r in with_inferred_types(df).collect()]
    assert rows == [(1, 1.0, True, "x", 'a "b" c'), (2, None, False, None, None), (3, 2.5, True, "3", None)]
    assert read_table(spark, "csv", str(tmp_path / "in.csv"), infer=True).dtypes[0] == ("id", "bigint")


def test_csv_keeps_line_breaks_blanks_and_wide_ids(spark, tmp_path):
    rows = [(" a ", 'x\ny "z", w', 9007199254740993001), ("b", " ", 9007199254740993002)]
    path = write_table(spark.createDataFrame(rows, "id string, t string, wide long"), str(tmp_path / "out"), "csv")
    back = read_table(spark, "CSV", path, infer=True)
    assert dict(back.dtypes)["wide"] == "bigint"
    got = sorted(map(tuple, back.select("id", "wide", F.coalesce("t", F.lit(" "))).collect()))
    assert got == [(" a ", rows[0][2], rows[0][1]), ("b", rows[1][2], " ")]


def test_quotes_within_cells_are_data(spark, tmp_path):
    (tmp_path / "in.csv").write_text('a,b\n5" pipe,3\n"x, ""y""",\n ""z"", "\n')
    assert [tuple(r) for r in read_table(spark, "CSV", str(tmp_path / "in.csv")).collect()] == [('5" pipe', "3"), ('x, "y"', None), (' ""z""', ' "')]


def _cells(rng):
    plain = rng.choice(["", "x", '5" pipe', "a b", '""', ' "', "NA", "12", 'q"'])
    if not plain.startswith('"') and rng.random() < 0.5:
        return plain
    return '"' + "".join(rng.choice(["a", ",", "\n", '""', " ", "\r\n", "b,c", '""""', "é"]) for _ in range(rng.randrange(9))) + '"'


@pytest.mark.parametrize("seed", range(4))
def test_records_of_many_pieces(spark, tmp_path, seed):
    """Files cut into pieces of some hundred bytes, with records that span several pieces, against Python's reader."""
    rng = random.Random(seed)
    want = []
    for name in ("a.csv", "b.csv"):
        end = rng.choice(["\n", "\r\n"])
        lines = [",".join([str(i), _cells(rng), _cells(rng)]) for i in range(300)]
        lines[40] = '40,"' + "long\n" * 400 + '",x'
        if seed % 2:
            lines[3:3] = [""]
        text = end.join(["id,b,c", *lines, ""])
        (tmp_path / name).write_bytes(text.encode())
        want += [tuple(None if cell in NULL_TOKENS else cell for cell in row) for row in list(csv.reader(io.StringIO(text, newline="")))[1:] if row]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = csv_lines(spark, str(tmp_path))
        assert lines.select("file", "start").distinct().count() > 20 and has_open_lines(lines)
        got = [tuple(r) for r in read_table(spark, "CSV", str(tmp_path)).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_states_of_lines(spark):
    cases = {'a,"b': (1, 0), 'a"b': (0, 0), '"a","b"': (0, 0), '"a""': (1, 1), 'x","y': (0, 1), "plain": (0, 1), '5" pipe,"z': (1, 0), '""': (0, 1), '","': (0, 1), '': (0, 1)}
    rows = spark.createDataFrame([(k,) for k in cases], "v string").select("v", state_after(F.col("v"), False), state_after(F.col("v"), True)).collect()

    def slow(line, inside):
        i, field = 0, True
        while i < len(line):
            c = line[i]
            if inside:
                if c == '"' and line[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    inside, field = False, False
            elif c == '"' and field:
                inside = True
            else:
                field = c == ","
            i += 1
        return int(inside)

    assert {r[0]: (r[1], r[2]) for r in rows} == {k: (slow(k, False), slow(k, True)) for k in cases}


def test_an_e_in_a_number_counts_in_a_mixed_column(spark):
    df = spark.createDataFrame([(1, "1e5", "1e5"), (2, "abc", "2")], "id int, t string, n string")
    rows = {r["column_name"]: r["contains_e"] for r in audit.problem_strings(df, ["t", "n"], ["id"]).collect()}
    assert rows == {"t": True, "n": False}


def test_whole_numbers_beyond_64_bits_stay_text(spark):
    df = spark.createDataFrame([("9223372036854775807", "9223372036854775808"), ("1", "2")], "a string, b string")
    assert infer_types(df) == {"a": "bigint", "b": "string"}


def test_other_sources(spark, tmp_path, sf_dir):
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    region.write.json(str(tmp_path / "r.json"))
    region.createOrReplaceTempView("region_view")
    assert read_table(spark, "PARQUET", f"{sf_dir}/region.parquet").count() == 5
    assert read_table(spark, "JSON", str(tmp_path / "r.json")).count() == 5
    assert read_table(spark, "TABLE", "region_view").count() == 5
    with pytest.raises(ValueError, match="unsupported"):
        read_table(spark, "XLSX", "x")
    with pytest.raises(FileNotFoundError):
        read_table(spark, "CSV", str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        read_table(spark, "TABLE", "no_such_table")


def test_study_formats(spark, tmp_path):
    history = [dict(trial_number=0, params={"a": 1, "b": None}, value=0.5, state="COMPLETE"), dict(trial_number=1, params={"a": 2}, value=None, state="FAIL")]
    write_study(spark, history, str(tmp_path / "study.csv"))
    rows = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "study.csv")).collect()
    assert json.loads(rows[0]["params"]) == {"a": "1", "b": "None"} and [r["trial_number"] for r in rows] == ["0", "1"]
    write_study(spark, history, str(tmp_path / "study.parquet"))
    assert spark.read.parquet(str(tmp_path / "study.parquet")).count() == 2
    with pytest.raises(ValueError):
        write_study(spark, [], str(tmp_path / "none.csv"))


def test_audit_edges(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 2.0)], "id int, t string, p double")
    rows = {r["column_name"]: r for r in audit.profile_columns(df).collect()}
    assert rows["t"]["n_missing"] == 2 and rows["t"]["n_not_numeric"] == 0
    flat = audit.histogram(df, "p", 4).orderBy("bin").collect()
    assert [r["n_rows"] for r in flat] == [0, 0, 2, 0] and flat[0]["bin_start"] == 1.5
    assert sum(r["n_rows"] for r in audit.histogram(df.where("id > 5"), "p", 4).collect()) == 0
    strings = {r["column_name"]: r for r in audit.problem_strings(df, ["t"], ["id"]).collect()}
    assert strings["t"]["is_numeric"] and not strings["t"]["contains_e"] and strings["t"]["samples"] is None


def test_problem_samples_with_one_hot_key(spark):
    # almost all bad cells share one id, whose key may lie above the bound
    df = spark.range(2000).select(F.when(F.col("id") < 1995, 7).otherwise(F.col("id")).alias("id"), F.concat(F.lit("t"), F.col("id")).alias("t"))
    row = audit.problem_strings(df, ["t"], ["id"]).first()
    keys = df.select("t", hash_key(["id"], 42).alias("k")).orderBy("k", "t").limit(5)
    assert row["samples"].split(" | ") == [r["t"] for r in keys.collect()]
    assert row["n_not_numeric"] == 2000
