"""Input frames over the driver tables, used by the registered queries, tests and the bench.

The tables are clean, so missing cells and dirty text are derived from the values
of each row; every row of every table is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.metadata import FeaturePlan
from gridloom.sources.readers import spread

LINE_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ROWS_PER_TASK = 500_000  # narrow rows that one task of a repeated pass should hold
RAW_COLUMNS = ["qty_text", "flag_text", "cat_text", "tax_text"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that both engines print the same value."""
    return df.select(*[F.round(F.col(f"`{n}`"), digits).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes])


def raw_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a text scan would deliver it: spaces, words among numbers, many boolean spellings."""
    line = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("int").cast("string")
    return line.select(
        *LINE_IDS,
        F.when(F.col("l_discount") == 0.0, F.lit("three"))
        .when(F.col("l_discount") == 0.01, F.lit(None))
        .when(F.col("l_discount") == 0.02, F.concat(F.lit(" "), quantity, F.lit(".5 ")))
        .when(F.col("l_discount") == 0.03, F.concat(quantity, F.lit("e1")))
        .when(F.col("l_discount") == 0.04, F.concat(quantity, F.lit("d")))
        .otherwise(quantity)
        .alias("qty_text"),
        F.when(F.col("l_linenumber") == 1, "True")
        .when(F.col("l_linenumber") == 2, "false")
        .when(F.col("l_linenumber") == 3, "1")
        .when(F.col("l_linenumber") == 4, "0")
        .when(F.col("l_linenumber") == 5, "yes")
        .when(F.col("l_linenumber") == 6, F.lit(None))
        .otherwise("T")
        .alias("flag_text"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_tax") < 0.03), "nan").otherwise(F.col("l_returnflag")).alias("cat_text"),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("tax_text"),
    )


def line_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with typed features of every group, some of them with missing cells."""
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        *LINE_IDS,
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.when(F.col("l_tax") != 0.0, F.col("l_quantity")).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_discount") < 0.09, F.col("l_discount")).alias("discount"),
        F.when(F.month("l_shipdate") != 12, F.month("l_shipdate").cast("string")).alias("ship_month"),
        F.when(F.col("l_tax") != 0.08, F.col("l_linenumber").cast("string")).alias("line_no"),
        F.when(F.col("l_discount") != 0.0, F.year("l_shipdate").cast("string")).alias("ship_year"),
        F.when(F.col("l_quantity") >= 3, F.col("l_linestatus") == "F").alias("is_f"),
        F.when(F.col("l_discount") != 0.05, F.col("l_tax") > 0.04).alias("high_tax"),
    )


def line_plan() -> FeaturePlan:
    features = ["quantity", "price", "discount", "ship_month", "line_no", "ship_year", "is_f", "high_tax"]
    return FeaturePlan(
        ids=LINE_IDS,
        target="label",
        numeric=["quantity", "price", "discount"],
        categorical=["ship_month"],
        one_hot=["line_no", "ship_year"],
        binary=["is_f", "high_tax"],
        keep_missing=["discount", "ship_year", "high_tax"],
        features=features,
        super_category={name: ("money" if name in ("price", "discount", "high_tax") else "shipping") for name in features},
    )


def line_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order, customer and part; target: returned or not."""
    line = spread(table(spark, sf_dir, "lineitem"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    joined = (
        line.join(orders, line["l_orderkey"] == orders["o_orderkey"])
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(part, line["l_partkey"] == part["p_partkey"])
    )
    return joined.select(
        *LINE_IDS,
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice", "c_acctbal", "p_retailprice",
        F.col("p_size").cast("double").alias("p_size"),
        "o_orderpriority", "c_mktsegment", "p_brand", "p_type",
        (F.col("l_linestatus") == "F").alias("is_f"),
    )


def line_flag_plan() -> FeaturePlan:
    numeric = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice", "c_acctbal", "p_retailprice", "p_size"]
    return FeaturePlan(
        ids=LINE_IDS, target="label", numeric=numeric, categorical=["p_brand", "p_type"],
        one_hot=["o_orderpriority", "c_mktsegment"], binary=["is_f"],
        features=[*numeric, "p_brand", "p_type", "o_orderpriority", "c_mktsegment", "is_f"],
    )


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics of every document, over its whole text."""
    words = F.split("text", " ")
    stats = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars", "lang", "source")).select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("n_words"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("distinct_share"),
        (F.length(F.regexp_replace("text", "[A-Za-z0-9 ]", "")) / F.greatest(F.length("text"), F.lit(1))).alias("symbol_share"),
        "lang",
        "source",
    )
    return stats.withColumn("n_words", F.when(F.col("n_words") >= 20, F.col("n_words")))


def doc_quality(spark: SparkSession, sf_dir: str, features: DataFrame | None = None) -> DataFrame:
    """Labelled documents; target: quality."""
    labels = table(spark, sf_dir, "labels")
    features = document_features(spark, sf_dir) if features is None else features
    joined = features.join(labels, "doc_id")
    return joined.withColumn("label", F.col("quality").cast("int")).drop("quality")


def doc_plan() -> FeaturePlan:
    numeric = ["n_chars", "n_words", "distinct_share", "symbol_share"]
    return FeaturePlan(
        ids=["doc_id"], target="label", numeric=numeric, categorical=["source"], one_hot=["lang"],
        features=[*numeric, "source", "lang"],
        super_category={**dict.fromkeys(numeric, "text"), "source": "origin", "lang": "origin"},
    )


def event_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a number to predict."""
    events = spread(table(spark, sf_dir, "events"), ROWS_PER_TASK)
    return events.select(
        "event_id",
        F.hour("ts").cast("double").alias("hour"),
        F.minute("ts").cast("double").alias("minute"),
        "event_type",
        F.col("value").alias("label"),
    )


def event_plan() -> FeaturePlan:
    return FeaturePlan(
        ids=["event_id"], target="label", numeric=["hour", "minute"], categorical=["event_type"], features=["hour", "minute", "event_type"]
    )


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic score in [0, 1] for every line with a label it predicts in part."""
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        *LINE_IDS,
        "l_returnflag",
        F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("label"),
        (F.col("l_extendedprice") / 105000.0).alias("score"),
    )


def contribution_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic contribution array for every line."""
    line = table(spark, sf_dir, "lineitem")
    values = F.array(
        F.col("l_quantity") - 25.5,
        (F.col("l_extendedprice") - 50000) / 1000,
        (F.col("l_discount") - 0.05) * 100,
        (F.col("l_tax") - 0.04) * 100,
    )
    return line.select(*LINE_IDS, values.alias("contributions"))


def class_scores(spark: SparkSession, sf_dir: str, n_classes: int = 8) -> DataFrame:
    """Class probabilities of every vector: the energy share of equal slices of the embedding."""
    width = 64 // n_classes

    def energy(start: int):
        return F.aggregate(F.slice("embedding", start + 1, width), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))

    vectors = table(spark, sf_dir, "embeddings")
    energies = vectors.select("vec_id", F.array(*[energy(i * width) for i in range(n_classes)]).alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda acc, x: acc + x)
    return energies.withColumn("total", total).select("vec_id", F.transform("e", lambda x: x / F.col("total")).alias("p"))


def draft_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide metadata sheet drafted from the data: one column per raw column, one row per attribute."""
    raw = raw_line(spark, sf_dir)
    number = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)\s*$"
    names = RAW_COLUMNS
    checks = []
    for i, name in enumerate(names):
        column = F.col(name)
        checks += [
            F.count_if(column.rlike(number)).alias(f"numbers{i}"),
            F.count(column).alias(f"present{i}"),
            F.count_if(column.isin("True", "true", "False", "false")).alias(f"bools{i}"),
            F.max(F.length(column)).alias(f"width{i}"),
            F.min(column).alias(f"low{i}"),
            F.max(column).alias(f"high{i}"),
        ]
    row = raw.agg(F.count(F.lit(1)).alias("n"), *checks)

    def attribute(label: str, cell):
        return F.struct(F.lit(label).alias("attribute"), *[cell(i).cast("string").alias(name) for i, name in enumerate(names)])

    return row.select(
        F.inline(
            F.array(
                attribute("type", lambda i: F.when(F.col(f"bools{i}") > 0, "bool").when(F.col(f"numbers{i}") * 2 > F.col(f"present{i}"), "float").otherwise("category")),
                attribute("use", lambda i: (F.col(f"low{i}") != F.col(f"high{i}")).cast("int")),
                attribute("imputation", lambda i: F.when(F.col(f"present{i}") < F.col("n"), "Unknown").otherwise("mean")),
                attribute("category_transformation", lambda i: F.when(F.col(f"width{i}") <= 3, "One-Hot").otherwise("none")),
                attribute("super_category", lambda i: F.when(F.col(f"width{i}") <= 3, "short").otherwise("long")),
            )
        )
    )
