"""Line deduplication: lines found in many documents go, the others stay in their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import BLANK_CHARS, ascii_lower, let, stored, table, texts

MIN_DOCUMENTS = 10


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANK_CHARS)))


def _digest(key: Column) -> Column:
    """96 bits that stand for a key."""
    return F.struct(F.xxhash64(key).alias("h"), F.hash(key).alias("g"))


def document_lines(docs: DataFrame, min_length: int = 1) -> DataFrame:
    """``i, t, pos, h, g``: id and text hash of the row, position and digest of each line whose key has ``min_length`` code points."""
    rows = texts(docs).select(F.col("doc_id").alias("i"), F.xxhash64("text").alias("t"), F.posexplode(F.transform(F.split("text", "\n"), line_key)).alias("pos", "key"))
    return rows.where(F.length("key") >= min_length).select("i", "t", "pos", _digest(F.col("key")).alias("d")).select("i", "t", "pos", "d.h", "d.g")


def repeated_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_length: int = 1) -> DataFrame:
    """``h, g`` of each line key that at least ``min_documents`` rows of ``docs`` hold, whatever their ids.

    Each key counts once per row, so counts combine before the shuffle and a line
    that is everywhere costs one row per task.
    """
    keys = F.array_distinct(F.transform(F.split("text", "\n"), line_key))
    return (
        texts(docs)
        .select(F.explode(F.filter(keys, lambda k: F.length(k) >= min_length)).alias("key"))
        .select(_digest(F.col("key")).alias("d"))
        .groupBy("d.h", "d.g")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") >= min_documents)
        .select("h", "g")
    )


def frequent_lines(held: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``h, g, documents`` of the line keys of ``held`` (rows of :func:`document_lines`) that at least ``min_documents`` documents hold.

    Rows with one id are one document; rows without an id are one if their texts are equal.
    """
    document = F.coalesce(F.col("i").cast("string"), F.concat(F.lit("text "), F.col("t").cast("string")))
    counted = held.select("h", "g", document.alias("document")).distinct().groupBy("h", "g").agg(F.count(F.lit(1)).alias("documents"))
    return counted.where(F.col("documents") >= min_documents)


def dedup_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_length: int = 1) -> DataFrame:
    """All columns of ``docs`` with the frequent lines taken out of ``text``, and ``__n_lines``, ``__n_dropped``.

    Lines that enough rows hold are found first, from counts that combine before the shuffle;
    only their (document, position, digest) rows are kept, and distinct documents are counted
    among them. Only dropped positions are grouped by document, so the texts move at most once and
    a line of a third of all documents splits like any skewed join side.

    Null text: one empty line. Rows that share an id are one document when lines are
    counted; rows without an id are one if their texts are equal. Each row loses its own
    lines. Keys shorter than ``min_length`` code points always stay. No rows: no rows.
    """
    base = docs.withColumns({"__text": F.coalesce("text", F.lit("")), "__hash": F.xxhash64(F.coalesce("text", F.lit("")))})
    repeated = stored(repeated_lines(docs, min_documents, min_length), "repeated-lines")
    held = stored(document_lines(docs, min_length).join(repeated, ["h", "g"]), "held-lines")
    frequent = stored(frequent_lines(held, min_documents).select("h", "g"), "frequent-lines")
    dropped = held.join(frequent, ["h", "g"]).groupBy(F.col("i").alias("__i"), F.col("t").alias("__t")).agg(F.collect_set("pos").alias("__gone"))
    dropped = stored(dropped, "dropped-lines")
    joined = base.join(dropped, base["doc_id"].eqNullSafe(dropped["__i"]) & (base["__hash"] == dropped["__t"]), "left")
    gone = F.coalesce("__gone", F.array().cast("array<int>"))
    kept = let(
        F.split("__text", "\n"),
        lambda ls: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), gone), lambda i: F.get(ls, i)), "\n"),
    )
    out = {name: F.col(f"`{name}`") for name in docs.columns} | {"text": F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(kept)}
    return joined.select(
        *[column.alias(name) for name, column in out.items()],
        F.size(F.split("__text", "\n")).cast("long").alias("__n_lines"),
        F.size(gone).cast("long").alias("__n_dropped"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.col("text"), 256).alias("kept_sha256"),
    )


OP8_SQL = r"""
WITH line AS (
  SELECT doc_id, md5(coalesce(text, '')) AS t, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, 'text ' || t)) >= 10
), marked AS (
  SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
