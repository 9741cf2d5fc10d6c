"""Data audit: profile, unparsable values, value counts and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.coerce import is_unparsable
from gridloom.functions.keys import hash_key


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, missing cells and non-numeric texts of every column, in one aggregate.

    The result has one row per column; only one row per task is shuffled.
    """
    columns = list(columns or df.columns)
    dtypes = dict(df.dtypes)
    counts = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(columns):
        column = F.col(f"`{name}`")
        counts.append(F.count(column).alias(f"present{i}"))
        bad = F.count_if(is_unparsable(column)) if dtypes[name] == "string" else F.lit(0).cast("long")
        counts.append(bad.alias(f"bad{i}"))
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(dtypes[name]).alias("data_type"),
            F.col("n").alias("n_rows"),
            (F.col("n") - F.col(f"present{i}")).alias("n_missing"),
            F.col(f"bad{i}").alias("n_not_numeric"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*counts).select(F.inline(F.array(*entries)))


def _long(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    text = [F.col(f"`{name}`").cast("string").alias(name) for name in columns]
    keys = [F.col(f"`{name}`") for name in ids]
    return df.select(*keys, *text).unpivot(list(ids), list(columns), "column_name", "value")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often every value of every column occurs; counted before the shuffle."""
    return _long(df, [], columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct present values per column, in two aggregations without expansion per column."""
    return (
        value_counts(df, columns)
        .where(F.col("value").isNotNull())
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )


def _key_limit(n_bad: int, wanted: int) -> str:
    """A hash-key bound that about sixteen times the wanted cells fall below."""
    share = min(1.0, 16 * wanted / max(n_bad, 1))
    return "g" if share >= 1.0 else f"{int(share * 16**12):012x}"  # 'g' is above every hex key


def _sample_cells(keyed: DataFrame, limits: dict[str, str], n_samples: int) -> DataFrame:
    """The first unparsable cells per column in key order, among the keys below each column's bound."""
    order = Window.partitionBy("column_name").orderBy("sample_key", "value")
    bound = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("column_name")]
    return (
        _long(keyed.where(F.col("sample_key") < max(limits.values())), ["sample_key"], list(limits))
        .where((F.col("sample_key") < bound) & is_unparsable(F.col("value")))
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= n_samples)
    )


def problem_strings(df: DataFrame, columns: Sequence[str], ids: Sequence[str], n_samples: int = 5, seed: int = 42) -> DataFrame:
    """For every text column: is it numeric, does it contain an ``e`` if not, and some unparsable texts.

    The sample holds the ``n_samples`` unparsable cells with the smallest key hash. The
    counts tell how small a hash bound leaves just enough cells, so the second pass
    drops nearly all rows before anything is sorted; columns that came out short
    because keys repeat are sampled again without a bound. The report has one row
    per column.
    """
    counts = []
    for i, name in enumerate(columns):
        column = F.col(f"`{name}`")
        counts += [
            F.count_if(is_unparsable(column)).alias(f"bad{i}"),
            F.coalesce(F.bool_or(F.contains(column, F.lit("e"))), F.lit(False)).alias(f"e{i}"),
        ]
    summary = df.agg(*counts).first()
    n_bad = {name: summary[f"bad{i}"] for i, name in enumerate(columns)}
    keyed = df.select(hash_key(ids, seed).alias("sample_key"), *columns)
    samples: dict[str, list[str]] = {}
    limits = {name: _key_limit(n, n_samples) for name, n in n_bad.items() if n}
    while limits:
        found: dict[str, list[tuple[int, str]]] = {}
        for row in _sample_cells(keyed, limits, n_samples).collect():
            found.setdefault(row["column_name"], []).append((row["position"], row["value"]))
        short = [name for name in limits if len(found.get(name, [])) < min(n_samples, n_bad[name])]
        samples.update({name: [text for _, text in sorted(cells)] for name, cells in found.items()})
        limits = dict.fromkeys(short, "g")
    rows = [
        (name, n_bad[name], n_bad[name] == 0, n_bad[name] > 0 and summary[f"e{i}"], " | ".join(samples[name]) if name in samples else None)
        for i, name in enumerate(columns)
    ]
    schema = "column_name string, n_not_numeric long, is_numeric boolean, contains_e boolean, samples string"
    return df.sparkSession.createDataFrame(rows, schema)


def bad_cells(df: DataFrame, ids: Sequence[str], columns: Sequence[str], limit: int | None = 10) -> DataFrame:
    """Cells that should be numbers but are not: row ids, column and value.

    ``limit`` keeps the first cells in id order (each task keeps its own first cells); None returns all.
    """
    cells = _long(df, ids, columns).where(is_unparsable(F.col("value")))
    return cells if limit is None else cells.orderBy(*ids, "column_name", "value").limit(limit)


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram; every bin is listed and the last one includes its upper edge."""
    value = F.col(f"`{column}`").cast("double")
    edges = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    low, high = edges["low"], edges["high"]
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    position = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(bins)).cast("int")
    counted = (
        df.where(value.isNotNull())
        .groupBy(F.least(position, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (high - low) / bins
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n_rows"),
    )
