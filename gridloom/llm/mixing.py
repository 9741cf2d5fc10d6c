"""Mixing sources to target weights: tempered token shares, realised as permutations in blocks under a token budget."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import stored, table, words

BLOCK = 1024
KEY_BITS = 60


@dataclass(frozen=True)
class MixTarget:
    """``entropy``: least entropy of the weights, as a share of the entropy of equal weights; ``repetition``: most
    passes over a source; ``budget``: tokens of the mixture as a multiple of the tokens there are; ``seed`` of the order."""

    entropy: float = 0.95
    repetition: float = 4.0
    budget: float = 1.0
    seed: int = 17


def source_tokens(docs: DataFrame) -> DataFrame:
    """``source, n_docs, tokens`` over all rows; a null source is the source ''."""
    return (
        docs.select(F.coalesce("source", F.lit("")).alias("source"), F.size(words(F.coalesce("text", F.lit("")))).cast("long").alias("tokens"))
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").alias("tokens"))
    )


def temperature(shares: DataFrame, target: MixTarget) -> float:
    """The exponent in [0, 1] for the token shares: the largest that reaches the entropy, or the smallest that keeps
    the repetition limit if that is larger (the limit comes first).

    Both are bisected together, 15 inner points of either bracket in one aggregate over
    the sources, five times: 20 binary digits. Only the sums reach the driver.
    """
    known = shares.where(F.col("tokens") > 0)
    facts = known.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not facts["t"]:
        return 1.0
    share = F.col("tokens") / F.lit(float(facts["t"]))

    def sums(a: float, i: int) -> list[Column]:
        p = F.pow(share, F.lit(a))
        return [F.sum(p).alias(f"s{i}"), F.sum(p * F.log(share)).alias(f"l{i}"), F.max(p / share).alias(f"r{i}")]

    def entropy_holds(row, i: int, a: float) -> bool:
        import math

        return math.log(row[f"s{i}"]) - a * row[f"l{i}"] / row[f"s{i}"] >= target.entropy * math.log(facts["n"]) - 1e-12

    def repetition_holds(row, i: int) -> bool:
        return row[f"r{i}"] / row[f"s{i}"] * target.budget <= target.repetition + 1e-12

    even, spare = (0.0, 1.0), (0.0, 1.0)  # the entropy holds at the left end, the limit is first kept after the left end
    ends = known.agg(*sums(0.0, 0), *sums(1.0, 1)).first()
    if entropy_holds(ends, 1, 1.0):
        even = (1.0, 1.0)
    if repetition_holds(ends, 0):
        spare = (0.0, 0.0)
    for _ in range(5):
        cuts = [[lo + (hi - lo) * k / 16 for k in range(17)] for lo, hi in (even, spare)]
        row = known.agg(*[c for j, points in enumerate(cuts) for k in range(1, 16) for c in sums(points[k], j * 16 + k)]).first()
        last = max((k for k in range(1, 16) if entropy_holds(row, k, cuts[0][k])), default=0)
        even = (cuts[0][last], cuts[0][last + 1])
        first = min((k for k in range(1, 16) if repetition_holds(row, 16 + k)), default=16)
        spare = (cuts[1][first - 1], cuts[1][first])
    return max(even[0], spare[1])


def mixture_weights(shares: DataFrame, target: MixTarget) -> DataFrame:
    """``source, n_docs, tokens, weight, quota, epochs, rest, blocks``; quota = epochs * tokens + rest."""
    exponent = temperature(shares, target)
    total = shares.agg(F.sum("tokens")).first()[0] or 0
    budget = int(total * target.budget)
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(max(1, total))), F.lit(exponent))).otherwise(0.0)
    norm = shares.agg(F.sum(power)).first()[0] or 1.0
    weight = F.round(power / F.lit(float(norm)), 9)
    quota = F.floor(weight * F.lit(float(budget))).cast("long")
    epochs = F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.greatest("tokens", F.lit(1)))).otherwise(0).cast("int")
    return (
        shares.withColumn("weight", weight)
        .withColumn("quota", quota)
        .withColumn("epochs", epochs)
        .withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens"))
        .withColumn("blocks", F.ceil(F.col("n_docs") / BLOCK).cast("long"))
    )


def mixture(docs: DataFrame, target: MixTarget = MixTarget()) -> DataFrame:
    """``doc_id, doc_hash, source, epoch, block, slot``: the documents of the mixture in their order.

    Epochs 0, 1, ... of a source are permutations of all its documents; the last one
    stops where the budget of the source is used up. Keys from md5 give the
    permutation; equal parts of the key range are blocks of about ``BLOCK`` rows. Where the
    budget ends is found by descending from totals of 1024 blocks to totals of blocks to the
    rows of one block, so no source, however large, is ordered in one task.

    Null text or no words: no tokens, which no budget refuses. Null source: the source ''.
    Null ids are ids. Equal rows are separate documents and may share a key; ties go by
    the text's hash. No rows: no rows. Sources without any token have weight 0 and one pass.
    """
    rows = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("doc_hash"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.size(words(F.coalesce("text", F.lit("")))).cast("long").alias("tokens"),
    )
    rows = stored(rows, "mix-rows")
    shares = stored(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").alias("tokens")), "mix-shares")
    plan = stored(mixture_weights(shares, target).select("source", "epochs", "rest", "blocks"), "mix-plan")

    text_key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("epoch").cast("string"), F.lit(str(target.seed))))
    key = F.conv(F.substring(text_key, 1, KEY_BITS // 4), 16, 10).cast("long")
    dealt = (
        rows.join(plan, "source")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs"))))
        .withColumn("key", key)
        .withColumn("block", F.shiftright(F.shiftright("key", 30) * F.col("blocks"), 30))
    )
    last = dealt.where(F.col("epoch") == F.col("epochs"))

    def border(parts: DataFrame, unit: str, room: Column) -> DataFrame:
        """Per source the first unit in which the running total passes ``room``, and the total before it."""
        before = F.coalesce(F.sum("t").over(Window.partitionBy("source").orderBy(unit).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        over = parts.withColumn("before", before).where(F.col("before") + F.col("t") > room)
        return over.groupBy("source").agg(F.min_by(F.struct(unit, "before"), unit).alias("b")).select("source", f"b.{unit}", "b.before")

    wide = last.groupBy("source", "rest", F.shiftright("block", 10).alias("super")).agg(F.sum("tokens").alias("t"))
    at_super = border(wide, "super", F.col("rest")).select("source", F.col("super").alias("at_super"), F.col("before").alias("before_super"))
    inner = last.join(at_super, "source").where(F.shiftright("block", 10) == F.col("at_super"))
    narrow = inner.groupBy("source", "rest", "before_super", "block").agg(F.sum("tokens").alias("t"))
    at_block = border(narrow, "block", F.col("rest") - F.col("before_super")).select("source", F.col("block").alias("at_block"), F.col("before").alias("before_block"))
    ends = stored(plan.join(at_super, "source", "left").join(at_block, "source", "left").select("source", "epochs", "rest", "at_block", (F.col("before_super") + F.col("before_block")).alias("used")), "mix-ends")

    order = [F.col("key"), F.col("doc_id"), F.col("doc_hash")]
    in_block = Window.partitionBy("source", "epoch", "block").orderBy(*order)
    placed = (
        dealt.drop("rest", "epochs").join(ends, "source")
        .where((F.col("epoch") < F.col("epochs")) | F.col("at_block").isNull() | (F.col("block") <= F.col("at_block")))
        .withColumn("slot", F.row_number().over(in_block))
        .withColumn("so_far", F.sum("tokens").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    )
    cut = (F.col("epoch") == F.col("epochs")) & (F.col("block") == F.col("at_block")) & (F.col("used") + F.col("so_far") > F.col("rest"))
    return placed.where(~F.coalesce(cut, F.lit(False))).select("doc_id", "doc_hash", "source", "epoch", "block", "slot")


def mixed_documents(docs: DataFrame, target: MixTarget = MixTarget()) -> DataFrame:
    """``docs`` with ``copies``, how often a pass over the mixture meets the row, in place of a column of that name; rows outside the mixture go."""
    times = mixture(docs, target).groupBy(F.col("doc_id").alias("__i"), F.col("doc_hash").alias("__x")).agg(F.max("epoch").alias("__e"))
    times = stored(times, "mix-times")
    keyed = docs.withColumn("__hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = keyed.join(times, keyed["doc_id"].eqNullSafe(times["__i"]) & (keyed["__hash"] == times["__x"]))
    return joined.select(*[keyed[f"`{name}`"] for name in docs.columns if name != "copies"], (F.col("__e") + 1).cast("int").alias("copies"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("doc_hash")


OP9_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens FROM documents
), src AS (
  SELECT source, count(*) AS n_docs, sum(tokens)::BIGINT AS tokens FROM doc GROUP BY source
), all_src AS (
  SELECT list(tokens::DOUBLE / total ORDER BY source) AS p, any_value(total) AS total
  FROM (SELECT *, (SELECT sum(tokens) FROM src)::DOUBLE AS total FROM src WHERE tokens > 0)
), search(step, elo, ehi, rlo, rhi) AS (
  SELECT 0, 0::DOUBLE, 1::DOUBLE, 0::DOUBLE, 1::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN e THEN em ELSE elo END, CASE WHEN e THEN ehi ELSE em END, CASE WHEN r THEN rlo ELSE rm END, CASE WHEN r THEN rm ELSE rhi END
  FROM (
    SELECT s.*, (elo + ehi) / 2 AS em, (rlo + rhi) / 2 AS rm,
      ln(list_sum(list_transform(p, lambda x: x ** ((elo + ehi) / 2)))) - (elo + ehi) / 2 * list_sum(list_transform(p, lambda x: x ** ((elo + ehi) / 2) * ln(x)))
        / list_sum(list_transform(p, lambda x: x ** ((elo + ehi) / 2))) >= 0.95 * ln(len(p)) - 1e-12 AS e,
      list_max(list_transform(p, lambda x: x ** ((rlo + rhi) / 2) / x)) / list_sum(list_transform(p, lambda x: x ** ((rlo + rhi) / 2))) <= 4 + 1e-12 AS r
    FROM search s, all_src WHERE step < 20
  )
), expo AS (
  SELECT greatest(
      CASE WHEN -list_sum(list_transform(p, lambda x: x * ln(x))) >= 0.95 * ln(len(p)) - 1e-12 THEN 1 ELSE elo END,
      CASE WHEN list_max(list_transform(p, lambda x: 1 / x)) / len(p) <= 4 + 1e-12 THEN 0 ELSE rhi END) AS a, total
  FROM search, all_src WHERE step = 20
), tempered AS (
  SELECT src.*, total, CASE WHEN tokens > 0 THEN (tokens / total) ** a ELSE 0 END AS q FROM src, expo
), quotas AS (
  SELECT *, floor(round(q / (SELECT sum(q ORDER BY source) FROM tempered), 9) * total)::BIGINT AS quota FROM tempered
), plan AS (
  SELECT source, CASE WHEN tokens > 0 THEN quota // tokens ELSE 0 END AS epochs, quota, tokens AS all_tokens, (n_docs + 1023) // 1024 AS blocks FROM quotas
), dealt AS (
  SELECT doc_id, source, tokens, epochs, epoch, quota - epochs * all_tokens AS rest, blocks,
         ('0x' || substr(md5(doc_id || '|' || epoch || '|17'), 1, 15))::BIGINT AS key
  FROM (SELECT doc.*, plan.* EXCLUDE (source), unnest(range(0, epochs + 1)) AS epoch FROM doc JOIN plan USING (source))
), placed AS (
  SELECT *, ((key >> 30) * blocks) >> 30 AS block, sum(tokens) OVER (PARTITION BY source, epoch ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS so_far FROM dealt
)
SELECT doc_id, source, epoch::INT AS epoch, block, row_number() OVER (PARTITION BY source, epoch, block ORDER BY key, doc_id)::INT AS slot
FROM placed WHERE epoch < epochs OR so_far <= rest
"""
