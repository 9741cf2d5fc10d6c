"""A corpus in five stages: quality, line deduplication, near-duplicates, decontamination, mixture of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import stored, table, without
from gridloom.llm.decontaminate import contaminated
from gridloom.llm.line_dedup import dedup_lines
from gridloom.llm.mixing import mixed_documents
from gridloom.llm.quality_gam import score_documents
from gridloom.llm.simhash import drop_near_duplicates

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; a null id is never rejected."""
    scored = score_documents(docs, table(spark, sf_dir, "labels"))
    return without(docs, scored.where((F.col("predicted") == 0) & F.col("doc_id").isNotNull()).select("doc_id").distinct())


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents hold go; ``n_chars`` follows the text."""
    columns = docs.columns
    kept = dedup_lines(docs)
    if "n_chars" in columns:
        kept = kept.withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*[F.col(f"`{name}`") for name in columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; others stay, also if they share its id or have none."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("__id"), F.col("doc_hash").alias("__hash")).distinct()
    gone = stored(found, "contaminated")
    same = docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["__hash"])
    return docs.join(gone, same, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture with ``copies``, the passes that the target weights give them."""
    return mixed_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
