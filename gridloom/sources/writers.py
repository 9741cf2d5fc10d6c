"""Result files and their default names."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import scratch_path

STUDY_SCHEMA = "trial_number int, params map<string,string>, value double, state string"


def default_name(target: str, *words: str) -> str:
    return "_".join([target, *words])


def _format_of(path: str, fallback: str) -> str:
    for suffix in ("csv", "parquet", "json"):
        if path.lower().endswith("." + suffix):
            return suffix
    return fallback


def write_table(df: DataFrame, path: str, fmt: str | None = None) -> str:
    """Overwrite ``path`` as a folder of part files; CSV gets a header and keeps blanks, quotes and line breaks."""
    fmt = fmt or _format_of(path, "parquet")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.save(path)
    return path


def stored(df: DataFrame, name: str, rows_per_file: int) -> DataFrame:
    """Written to the scratch folder, in files of at most ``rows_per_file`` rows, and read again: for a table that many passes read.

    A cache takes whole partitions while it is filled; this takes a row group of each task.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def study_frame(spark: SparkSession, history: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Search history as a table, one row per trial."""
    rows = [
        (h["trial_number"], {k: str(v) for k, v in h["params"].items()}, h["value"], h["state"])
        for h in history
    ]
    return spark.createDataFrame(rows, STUDY_SCHEMA)


def write_study(spark: SparkSession, history: list[Mapping[str, Any]], path: str) -> str:
    """Search history; CSV holds the parameters as JSON text, Parquet keeps the map."""
    if not history:
        raise ValueError("no search history to save")
    df = study_frame(spark, history)
    if _format_of(path, "csv") == "csv":
        df = df.withColumn("params", F.to_json("params"))
        return write_table(df.coalesce(1).sortWithinPartitions("trial_number"), path, "csv")
    return write_table(df, path)


def write_document(spark: SparkSession, document: Mapping[str, Any], path: str) -> str:
    """A small JSON document, written through Spark so that any file system works."""
    text = json.dumps(document, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_document(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads("\n".join(row["value"] for row in spark.read.text(path).collect()))
