"""Table scans."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.coerce import NUMERIC_TEXT, blank_to_null
from gridloom.sources.csv_records import csv_lines, has_open_lines, read_csv_records
from gridloom.sources.spreadsheet import ROW, read_spreadsheet

_INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
_BOOLEAN_TEXT = ("True", "TRUE", "true", "False", "FALSE", "false")
_FORMATS = {"PARQUET": "parquet", "JSON": "json", "ORC": "orc"}


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header as text columns, null tokens turned into NULL.

    Types are not inferred, so unused columns are pruned by the parser. Files stay
    splittable: where no record goes on in a second line they are parsed line by line, else by
    :func:`~gridloom.sources.csv_records.read_csv_records`. A quote opens only at the beginning of a cell.
    """
    lines = csv_lines(spark, path)
    if has_open_lines(lines):
        raw = read_csv_records(spark, path, lines)
    else:
        raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return raw.select(*[blank_to_null(F.col(f"`{name}`")).alias(name) for name in raw.columns])


def infer_types(df: DataFrame) -> dict[str, str]:
    """Type of every text column from one aggregate over the whole table.

    boolean: every value spells a boolean. bigint: whole numbers of 64 bits and none missing.
    double: numbers. string: everything else, columns without any value, and columns that hold
    only whole numbers of which some are wider than 64 bits, since ids must not be rounded.
    """
    texts = [name for name, dtype in df.dtypes if dtype == "string"]
    if not texts:
        return {}
    counts = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(texts):
        column = F.col(f"`{name}`")
        counts += [
            F.count(column).alias(f"present{i}"),
            F.count_if(column.rlike(_INTEGER_TEXT)).alias(f"digits{i}"),
            F.count_if(column.rlike(_INTEGER_TEXT) & F.trim(column).try_cast("bigint").isNotNull()).alias(f"whole{i}"),
            F.count_if(column.rlike(NUMERIC_TEXT)).alias(f"number{i}"),
            F.count_if(column.isin(*_BOOLEAN_TEXT)).alias(f"boolean{i}"),
        ]
    row = df.agg(*counts).first()
    types = {}
    for i, name in enumerate(texts):
        present = row[f"present{i}"]
        if present == 0:
            types[name] = "string"
        elif row[f"boolean{i}"] == present:
            types[name] = "boolean"
        elif row[f"whole{i}"] == row["n"]:
            types[name] = "bigint"
        elif row[f"digits{i}"] == present and row[f"whole{i}"] < present:
            types[name] = "string"
        elif row[f"number{i}"] == present:
            types[name] = "double"
        else:
            types[name] = "string"
    return types


def with_inferred_types(df: DataFrame) -> DataFrame:
    """Cast text columns to the types found by :func:`infer_types`."""
    types = infer_types(df)
    return df.select(
        *[
            (F.col(f"`{name}`").cast(types[name]) if types.get(name, "string") != "string" else F.col(f"`{name}`")).alias(name)
            for name in df.columns
        ]
    )


def read_table(spark: SparkSession, source: str, path: str, infer: bool = False) -> DataFrame:
    """Scan ``path`` as ``source``: CSV, PARQUET, JSON, ORC, EXCEL (the first sheet) or TABLE."""
    kind = source.upper()
    if kind not in ("CSV", "EXCEL", "TABLE", *_FORMATS):
        raise ValueError(f"unsupported data source type: {source}")
    try:
        if kind == "CSV":
            df = read_csv_text(spark, path)
        elif kind == "EXCEL":
            raw = read_spreadsheet(spark, path).drop(ROW)
            df = raw.select(*[blank_to_null(F.col(f"`{name}`")).alias(name) for name in raw.columns])
        elif kind == "TABLE":
            df = spark.table(path)
        else:
            df = spark.read.format(_FORMATS[kind]).load(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            raise FileNotFoundError(f"input data {path} not found") from err
        raise ValueError(f"cannot load input data {path}: {err}") from err
    return with_inferred_types(df) if infer else df


def spread(df: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Rebalance a scan that yields fewer tasks than there are cores.

    Only small inputs have that few splits, so at most one split per core is moved;
    a large table already has more splits than cores and is returned unchanged. Apply it to a
    scan that feeds repeated passes, such as training. With ``rows_per_task`` tasks also grow in number
    with the rows, for narrow rows of which a split holds many millions; counting a scan reads no column.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if rows_per_task:
        tasks = max(tasks, math.ceil(df.count() / rows_per_task))
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


@contextmanager
def scan_tasks(df: DataFrame, rows_per_task: int) -> Iterator[None]:
    """Scans of the files of ``df`` that are planned within give a task about ``rows_per_task`` rows, as far as files can be split.

    For a learner that keeps the rows of a task as objects; nothing is moved.
    """
    spark, name = df.sparkSession, "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(df.count() / rows_per_task))
    spark.conf.set(name, str(max(tasks, int(before or 0))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
