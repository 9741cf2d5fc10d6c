from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridloom.functions.keys import hash_key
from gridloom.operators import ranks
from gridloom.operators.folds import assign_folds, exact_sample, ordered_split, sample_size

IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def lineitem(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def test_folds_are_disjoint_covering_and_balanced(spark, sf_dir):
    df = lineitem(spark, sf_dir)
    folds = assign_folds(df, 5, IDS, target="l_returnflag")
    assert folds.columns == [*df.columns, "fold"]
    rows = folds.groupBy("l_returnflag", "fold").count().collect()
    per_class = {}
    for row in rows:
        per_class.setdefault(row["l_returnflag"], []).append(row["count"])
    assert all(len(v) == 5 and max(v) - min(v) <= 1 for v in per_class.values())
    totals = Counter()
    for row in rows:
        totals[row["fold"]] += row["count"]
    assert max(totals.values()) - min(totals.values()) <= 1
    assert sum(totals.values()) == df.count()
    assert folds.exceptAll(df.withColumn("fold", F.lit(-1))).count() == df.count()


def test_folds_do_not_depend_on_partitioning_or_pass_width(spark, sf_dir, monkeypatch):
    df = lineitem(spark, sf_dir)
    base = {tuple(r) for r in assign_folds(df, 5, IDS, target="l_returnflag").select(*IDS, "fold").collect()}
    monkeypatch.setattr(ranks, "SETTLE_ROWS", 0)
    monkeypatch.setattr(ranks, "MAX_WIDTH", 1)
    again = {tuple(r) for r in assign_folds(df.repartition(7), 5, IDS, target="l_returnflag").select(*IDS, "fold").collect()}
    assert base == again


def test_folds_match_plain_window(spark, sf_dir):
    df = lineitem(spark, sf_dir)
    got = {tuple(r[:-1]): r[-1] for r in assign_folds(df, 3, IDS).select(*IDS, "fold").collect()}
    keyed = df.select(*IDS, hash_key(IDS, 42).alias("h")).toPandas().sort_values("h")
    sizes = ranks.even_sizes(len(keyed), 3)
    expected = [f for f, n in enumerate(sizes) for _ in range(n)]
    want = {tuple(r): f for r, f in zip(keyed[IDS].itertuples(index=False), expected)}
    assert got == want


def test_hot_copies_are_dealt_out(spark):
    # a third of the rows are copies of one row, another third share one id
    hot = spark.range(3000).select(F.lit(7).alias("id"), F.lit("x").alias("v"), F.lit(1).alias("y"))
    same_id = spark.range(3000).select(F.lit(9).alias("id"), F.col("id").cast("string").alias("v"), F.lit(1).alias("y"))
    rest = spark.range(3000).select((F.col("id") + 100).cast("int").alias("id"), F.lit("z").alias("v"), (F.col("id") % 2).cast("int").alias("y"))
    df = hot.unionByName(same_id).unionByName(rest)
    folds = assign_folds(df, 5, ["id"], target="y")
    rows = folds.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in rows if r["y"] == y]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    assert folds.drop("fold").exceptAll(df).count() == 0
    assert df.exceptAll(folds.drop("fold")).count() == 0


def test_copies_are_written_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(ranks, "COPY_CHUNK", 7)
    df = spark.range(100).select(F.lit("a").alias("id"), F.lit(1.5).alias("x"))
    counts = Counter(r["fold"] for r in assign_folds(df, 3, ["id"]).collect())
    assert sorted(counts.values()) == [33, 33, 34]


def test_many_classes_and_no_ids(spark):
    df = spark.range(3000).select((F.col("id") % 60).alias("y"), F.col("id").alias("x"))
    folds = assign_folds(df, 5, [], target="y")
    assert folds.count() == 3000
    assert {r["count"] for r in folds.groupBy("y", "fold").count().collect()} == {10}
    assert {r["count"] for r in folds.groupBy("fold").count().collect()} == {600}


def test_fold_contract(spark):
    few = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id int, y int")
    with pytest.raises(ValueError):
        assign_folds(few, 5, ["id"], target="y")
    with pytest.raises(ValueError):
        assign_folds(few, 5, ["id"])
    with pytest.warns(UserWarning):
        assert assign_folds(few, 2, ["id"], target="y").count() == 3
    with pytest.raises(ValueError):
        assign_folds(spark.createDataFrame([(1, None), (2, 1)], "id int, y int"), 2, ["id"], target="y")


@pytest.mark.parametrize("fraction", [1e-9, 0.2, 0.5, 1.0])
def test_exact_sample(spark, sf_dir, fraction):
    df = lineitem(spark, sf_dir)
    n = df.count()
    sample = exact_sample(df, fraction, IDS)
    assert sample.count() == sample_size(n, fraction)
    assert sample.exceptAll(df).count() == 0


def test_exact_sample_rejects_zero(spark, sf_dir):
    with pytest.raises(ValueError):
        exact_sample(lineitem(spark, sf_dir), 0.0, IDS)


@pytest.mark.parametrize("order", [["l_shipdate", "l_orderkey"], ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]])
def test_ordered_split(spark, sf_dir, order):
    df = lineitem(spark, sf_dir)
    split = ordered_split(df, 1000, order).toPandas()
    assert (split["part"] == 0).sum() == 1000
    tail = split[split["part"] == 1][order].apply(tuple, axis=1)
    head = split[split["part"] == 0][order].apply(tuple, axis=1)
    assert head.max() <= tail.min()


def test_ordered_split_negative_numbers_and_nulls(spark):
    df = spark.createDataFrame([(-5,), (None,), (3,), (-300,), (0,)], "x long")
    first = {r["x"] for r in ordered_split(df, 3, ["x"]).where("part = 0").collect()}
    assert first == {None, -300, -5}
    assert ordered_split(df, 99, ["x"]).where("part = 0").count() == 5
    assert ordered_split(df, 0, ["x"]).where("part = 0").count() == 0


def test_row_numbers(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    out = ranks.row_numbers(df, [F.col("o_totalprice"), F.col("o_orderkey")], "i").toPandas().sort_values("i")
    assert list(out["i"]) == list(range(1, len(out) + 1))
    assert out["o_totalprice"].is_monotonic_increasing


def test_folds_of_many_classes_equal_the_window_form(spark):
    """More classes than the driver holds, one of them a third of the rows, with copies of a row."""
    small = spark.range(9000).select((F.col("id") % 3000).cast("string").alias("y"), F.col("id"))
    hot = spark.range(5000).select(F.lit("1700x").alias("y"), (F.col("id") + 10_000).alias("id"))
    df = small.unionByName(hot).withColumn("v", F.lit(1))
    folds = assign_folds(df, 4, ["id"], target="y")
    got = {r["id"]: r["fold"] for r in folds.collect()}
    keyed = df.select("id", "y", hash_key(["id"], 42).alias("h")).toPandas().sort_values(["y", "h"])
    start, want = 0, {}
    for _, rows in keyed.groupby("y", sort=True):
        cuts = [f for f, n in enumerate(ranks.even_sizes(len(rows), 4, start)) for _ in range(n)]
        want.update(zip(rows["id"], cuts))
        start += len(rows)
    assert got == want and folds.columns == [*df.columns, "fold"]
    sizes = Counter(got.values())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    with pytest.raises(ValueError, match="no class"):
        assign_folds(small, 4, ["id"], target="id")
    with pytest.raises(ValueError, match="missing"):
        assign_folds(df.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS y, 5L AS id, 1 AS v")), 4, ["id"], target="y")


def test_number_of_classes_changes_no_fold(spark, sf_dir, monkeypatch):
    df = lineitem(spark, sf_dir)
    df = df.unionByName(df.limit(3)).unionByName(df.limit(3))
    count = lambda: Counter(tuple(r) for r in assign_folds(df, 5, IDS, target="l_returnflag").select(*IDS, "fold").collect())
    few = count()
    monkeypatch.setattr(ranks, "MAX_GROUPS", 0)
    assert count() == few
