"""Shared expressions: words, keys of documents, folds by checksum, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import scratch_path

BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Any character beyond ASCII that is not a lower-case letter: only then may ``lower`` do more than A-Z.
NOT_PLAIN = r"[^\x00-\x7F&&[^\p{Ll}]]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, text, *more``; a null text is empty. Other columns, whatever their names, stay behind."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *[F.col(name) for name in more])


def words(text: Column) -> Column:
    """The maximal runs without blanks, as an array."""
    return F.array_remove(F.split(text, BLANKS), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` is the fast way where it does the same."""
    return F.when(text.rlike(NOT_PLAIN), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, also if lambdas below refer to it."""
    return F.transform(F.array(value), body)[0]


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text; a null id counts as remainder -1, so it is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(-1))


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Written to the shared scratch folder and read again: later steps neither repeat the work nor depend on its executors. ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Sent:
    """A broadcast value of a class that the executors do not have; it is sent by value and read once per task."""

    def __init__(self, spark: SparkSession, value: Any):
        self.box = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __getstate__(self) -> dict:
        return {"box": self.box}

    @property
    def value(self) -> Any:
        if "read" not in self.__dict__:
            self.read = cloudpickle.loads(self.box.value)
        return self.read


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is not in the one column of ``ids``; null equals null.

    The ids are stored first: their size is then known, and Spark moves the documents only if the ids are too many to broadcast.
    """
    gone = stored(ids.select(F.col(ids.columns[0]).alias("__gone")), "gone")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__gone"]), "left_anti")
