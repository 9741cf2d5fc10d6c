"""Quality rules as a ledger: every rule is evaluated once and leaves a bit, policies are masks over the bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import let, table, texts, words

#: Rule → its failure over the measurements; the order gives the bit.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "2 * word_chars < 5 * n_words OR word_chars > 12 * n_words",
    "capitals": "2 * n_capitals > word_chars",
}
BASE = ("few_words", "repeated_windows")
#: Version → the rules that reject a document.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": (*BASE, "symbols", "repeated_lines", "word_length", "capitals"),
}


def mask(rules: tuple[str, ...] | list[str]) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in set(rules))


def repeated_words(tokens: Column) -> Column:
    """How many words lie in a 3-word window that the text holds twice or more.

    Windows are hashed and, only where a hash repeats, sorted with their positions;
    each repeated window adds the words that the one before it does not cover.
    """

    def covered(pairs: Column) -> Column:
        hash_at = lambda k: F.get(pairs, k)["h"]
        twice = F.transform(pairs, lambda x, k: F.when((hash_at(k - 1) == x["h"]) | (hash_at(k + 1) == x["h"]), x["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            F.sort_array(F.filter(twice, lambda i: i.isNotNull())),
            start,
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    def over(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, covered))

    def windows(ws: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(ws) - 3)
        return let(F.transform(at, lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))), over)

    return let(tokens, lambda ws: F.when(F.size(ws) < 4, F.lit(0)).otherwise(windows(ws)))


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements (long) and ``failure_bits``, one row per row of ``docs`` and without a shuffle.

    Null text: no words, one empty line. No rows: no rows. Equal rows give equal rows.
    """

    def measure(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            repeated_words(ws).cast("long").alias("n_repeat_words"),
        )

    def repeats(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), F.size(F.array_distinct(lines)).alias("distinct"))

    text = F.col("text")
    spoken = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    measured = texts(docs).select(
        "doc_id",
        let(words(text), measure).alias("w"),
        let(spoken, repeats).alias("l"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
    )
    flat = measured.select(
        "doc_id",
        "w.n_words",
        "w.word_chars",
        "n_symbols",
        (F.col("l.n") - F.col("l.distinct")).cast("long").alias("n_dup_lines"),
        "w.n_repeat_words",
        "n_lines",
        "n_capitals",
    )
    bits = [F.when(F.expr(failure), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, failure in enumerate(RULES.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return flat.withColumn("failure_bits", total)


def passes(policy: str, bits: Column | None = None) -> Column:
    """Whether a ledger row has no failure that the policy counts."""
    return (F.col("failure_bits") if bits is None else bits).bitwiseAND(mask(POLICIES[policy])) == 0


def ablations(rows: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """``policy, rule, rejected, only_by_rule, kept_without`` for every rule of every policy, from the bits alone.

    The ledger is counted by its bits first (at most 2**rules rows), so asking more
    policies costs no further pass over the documents. An empty ledger gives zeros.
    """
    spark = rows.sparkSession
    counts = rows.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("n"))
    asked = [(name, rule, mask(chosen), mask([rule])) for name, chosen in policies.items() for rule in chosen]
    cases = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(m).alias("mask"), F.lit(b).alias("bit")) for p, r, m, b in asked])
    hit = F.col("failure_bits").bitwiseAND(F.col("c.mask"))
    measured = (
        counts.select("failure_bits", "n", F.explode(cases).alias("c"))
        .groupBy("c.policy", "c.rule")
        .agg(
            F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("rejected"),
            F.sum(F.when(hit == F.col("c.bit"), F.col("n")).otherwise(0)).alias("only_by_rule"),
            F.sum(F.when(hit.bitwiseAND(F.bitwise_not(F.col("c.bit"))) == 0, F.col("n")).otherwise(0)).alias("kept_without"),
        )
    )
    names = spark.createDataFrame([(p, r) for p, r, _, _ in asked], "policy string, rule string")
    return names.join(measured, ["policy", "rule"], "left").fillna(0)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes("base")).alias("base_failed"),
        passes("v2").alias("kept"),
        "failure_bits",
    )


def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every rule of every policy does to the whole table, from the bits of one ledger."""
    return ablations(ledger(table(spark, sf_dir, "documents")))


OP6_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, unnest(list_transform(range(1, len(ws) - 1), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2])) AS g
  FROM doc WHERE len(ws) >= 3
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n >= 2
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) o(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM doc
), dup AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE spoken) - count(DISTINCT line) FILTER (WHERE spoken) AS n
  FROM (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS spoken FROM lines) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, dup.n::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         dup.n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals
  FROM doc d JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)
), b AS (
  SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT + 8 * (10 * n_dup_lines > 3 * n_lines)::INT
         + 16 * (2 * word_chars < 5 * n_words OR word_chars > 12 * n_words)::INT + 32 * (2 * n_capitals > word_chars)::INT AS failure_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failure_bits & 3) <> 0 AS base_failed, failure_bits = 0 AS kept, failure_bits FROM b
"""

_RULE_BITS = ", ".join(f"('{rule}', {mask([rule])})" for rule in RULES)
_POLICY_MASKS = ", ".join(f"('{name}', {mask(chosen)})" for name, chosen in POLICIES.items())
ABLATIONS_SQL = f"""
WITH ledger AS ({OP6_SQL}), asked(policy, mask) AS (VALUES {_POLICY_MASKS}), rules(rule, bit) AS (VALUES {_RULE_BITS})
SELECT policy, rule, count(*) FILTER (WHERE (failure_bits & mask) <> 0) AS rejected, count(*) FILTER (WHERE (failure_bits & mask) = bit) AS only_by_rule,
       count(*) FILTER (WHERE (failure_bits & (mask - bit)) = 0) AS kept_without
FROM asked JOIN rules ON (mask & bit) <> 0 CROSS JOIN ledger GROUP BY policy, rule
"""
