"""Benchmark decontamination by templates: numbers, names and units become typed placeholders, windows of
templates are joined by hash, and the values in the placeholders must change consistently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import let, stored, table, words

WINDOW = 8
MIN_TOKENS = 5
MIN_COVER = 0.5
#: Or a run of consecutive windows of so many words, of which so many must be the same words or values.
MIN_RUN, MIN_SAME = 13, WINDOW
MIN_AGREEMENT = 0.8
#: Windows of the benchmark up to this many rows (24 bytes each) are broadcast, more are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000

NUMBER, UNIT, NAME = "\ue000", "\ue001", "\ue002"
#: Units that may follow a number.
UNITS = "km|cm|mm|m|kg|mg|g|l|ml|s|ms|min|h|hours|minutes|seconds|days|weeks|years|miles|feet|inches|pounds|dollars|euros|percent|°C|°F|%|\\$|€|£"


def template_tokens(text: Column) -> Column:
    """The words as templates: numbers, their units and capitalised words within a sentence as placeholders; lower case, no punctuation."""
    numbers = F.regexp_replace(text, r"\d+(?:[.,:/]\d+)*", NUMBER)
    units = F.regexp_replace(numbers, rf"(?<={NUMBER}\s?)(?:{UNITS})(?![\p{{L}}\p{{N}}])", UNIT)
    names = F.regexp_replace(units, r"(?<=[\p{L}\p{N},;]\s)\p{Lu}\p{Ll}+", NAME)
    return words(F.regexp_replace(F.lower(names), rf"[^\p{{L}}\p{{M}}\p{{N}}{NUMBER}-{NAME}\x09-\x0D\x20]+", ""))


def plain_tokens(text: Column) -> Column:
    """The same words with their values, position by position."""
    unit_sign = F.regexp_replace(text, r"(?<=\d\s?)[%$€£]", "q")
    return words(F.regexp_replace(F.lower(unit_sign), rf"[^\p{{L}}\p{{M}}\p{{N}}{NUMBER}-{NAME}\x09-\x0D\x20]+", ""))


def _windows(tokens: Column, lengths: list[int]) -> Column:
    """``(pos, len, h)`` of every window of each length."""

    def of(ts: Column, n: int) -> Column:
        at = F.sequence(F.lit(0), F.size(ts) - n)
        rows = F.transform(at, lambda i: F.struct(i.alias("pos"), F.lit(n).alias("len"), F.xxhash64(*[F.get(ts, i + k) for k in range(n)]).alias("h")))
        return F.when(F.size(ts) >= n, rows).otherwise(F.array().cast("array<struct<pos:int,len:int,h:bigint>>"))

    return let(tokens, lambda ts: F.concat(*[of(ts, n) for n in lengths]))


def _tokens(df: DataFrame, *key: str) -> DataFrame:
    """``*key, t, v``: the words of a text as templates and as they are."""
    body = F.coalesce("text", F.lit(""))
    return df.select(*key, template_tokens(body).alias("t"), plain_tokens(body).alias("v"))


def _benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, key, t, v`` of the items with words, those of equal words once; ``key`` is what windows are taken of, the plain words of items below ``MIN_TOKENS``."""
    items = _tokens(benchmark, "item_id").where(F.size("t") > 0).groupBy("t", "v").agg(F.min("item_id").alias("item_id"))
    short = F.size("t") < MIN_TOKENS
    return stored(items.select("item_id", F.when(short, F.col("v")).otherwise(F.col("t")).alias("key"), short.alias("plain"), "t", "v"), "benchmark-items")


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, doc_hash, item_id, n_windows, cover, shift, first, last, run``: alignments of documents with :func:`_benchmark_items`.

    ``shift`` is the offset of an alignment and ``first`` to ``last`` the item's positions that it
    spans: the whole item where the windows of the shift cover ``MIN_COVER`` of it, or are the most
    of a pair whose windows do so together, and each run of ``MIN_RUN`` words (``run`` is true).
    Windows of the documents meet the distinct windows of the templates first; the rest never
    leaves its task. A matched template stands for all items that have it.
    """
    spark = docs.sparkSession
    templates = items.groupBy("key", "plain").agg(F.min("item_id").alias("template"))
    templates = stored(templates.select("template", "key", "plain", F.size("key").alias("n_tokens")), "benchmark-templates")
    kinds = templates.select("plain", F.least("n_tokens", F.lit(WINDOW)).alias("n")).distinct().collect()  # at most WINDOW values and MIN_TOKENS
    lengths = {plain: sorted(r["n"] for r in kinds if r["plain"] == plain) for plain in (False, True)}
    if not kinds:
        columns = "doc_id {}, doc_hash bigint, item_id {}, n_windows bigint, cover double, shift int, first int, last int, run boolean"
        return spark.createDataFrame([], columns.format(docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()))
    own = None
    for plain in (p for p in lengths if lengths[p]):
        some = templates.where(F.col("plain") == plain).select("template", "plain", "n_tokens", F.explode(_windows(F.col("key"), lengths[plain])).alias("w"))
        own = some if own is None else own.unionByName(some)
    own = stored(
        own.where(F.col("w.len") == F.least(F.col("n_tokens"), F.lit(WINDOW))).select(
            "template", "plain", "n_tokens", F.col("w.pos").alias("item_pos"), F.col("w.len").alias("len"), F.col("w.h").alias("h")
        ),
        "benchmark-windows",
    )
    small = own.count() <= BROADCAST_WINDOWS
    body = F.coalesce("text", F.lit(""))
    found = None
    for plain in (p for p in lengths if lengths[p]):
        tokens = plain_tokens(body) if plain else template_tokens(body)
        some = docs.select("doc_id", F.xxhash64(body).alias("doc_hash"), F.explode(_windows(tokens, lengths[plain])).alias("w")).select(
            "doc_id", "doc_hash", F.lit(plain).alias("plain"), F.col("w.pos").alias("pos"), F.col("w.len").alias("len"), F.col("w.h").alias("h")
        )
        found = some if found is None else found.unionByName(some)
    hit = found.join(F.broadcast(own) if small else own, ["h", "len", "plain"])
    per_shift = hit.groupBy("doc_id", "doc_hash", "template", "n_tokens", "len", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.array_sort(F.collect_set("item_pos")).alias("at")
    )
    start = F.struct((-F.col("len")).alias("last"), F.lit(0).alias("n"))
    covered = lambda at: F.aggregate(at, start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.col("len"), i - a["last"])).alias("n")), lambda a: a["n"])
    per_shift = per_shift.withColumn("own_cover", covered("at") / F.col("n_tokens"))
    best = F.max_by("shift", F.struct(F.size("at"), -F.col("shift")))
    per_template = per_shift.groupBy("doc_id", "doc_hash", "template", "n_tokens", "len").agg(
        best.alias("best"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("at")))).alias("at"),
        F.collect_list(F.struct("shift", "own_cover", F.col("at").alias("own_at"))).alias("shifts"),
    )
    per_template = per_template.select("*", F.size("at").cast("long").alias("n_windows"), (covered("at") / F.col("n_tokens")).alias("cover"))
    each = per_template.select("doc_id", "doc_hash", "template", "n_tokens", "len", "n_windows", "cover", "best", F.explode("shifts").alias("s"))
    ends = F.filter(F.col("s.own_at"), lambda i: ~F.array_contains(F.col("s.own_at"), i + 1))
    starts = F.filter(F.col("s.own_at"), lambda i: ~F.array_contains(F.col("s.own_at"), i - 1))
    span = lambda first, last, run: F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"), F.lit(run).alias("run"))
    runs = F.filter(F.zip_with(starts, ends, lambda a, b: span(a, b + F.col("len") - 1, True)), lambda r: r["last"] - r["first"] + 1 >= MIN_RUN)
    whole = (F.col("s.own_cover") >= MIN_COVER) | ((F.col("cover") >= MIN_COVER) & (F.col("s.shift") == F.col("best")))
    spans = F.concat(F.when(whole, F.array(span(F.lit(0), F.col("n_tokens") - 1, False))).otherwise(F.array().cast("array<struct<first:int,last:int,run:boolean>>")), runs)
    aligned = each.select("doc_id", "doc_hash", "template", "n_windows", "cover", F.col("s.shift").alias("shift"), F.explode(spans).alias("r"))
    members = stored(items.join(templates, ["key", "plain"]).select("item_id", "template"), "benchmark-members")
    return aligned.join(members, "template").select("doc_id", "doc_hash", "item_id", "n_windows", "cover", "shift", "r.first", "r.last", "r.run")


def slot_agreement(docs: DataFrame, items: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, doc_hash, item_id, shift, first, last, n_slots, n_same, agreement`` of alignments with placeholders in common.

    Along the shift, each value of the item has one value in the document that it meets
    most often, and each value of the document one of the item; agreement is the share
    of placeholders that follow both, ``n_same`` the number of those with equal values. A
    copy and a question with exchanged numbers have 1.
    """
    slots = (
        items.select("item_id", "v", F.posexplode("t").alias("item_pos", "kind"))
        .where(F.col("kind").rlike(f"[{NUMBER}-{NAME}]"))
        .select("item_id", "item_pos", "kind", F.get("v", F.col("item_pos")).alias("item_value"))
    )
    inside = found.join(slots, "item_id").where(F.col("item_pos").between(F.col("first"), F.col("last")))
    wanted = inside.select(
        F.col("doc_id").alias("i"), F.col("doc_hash").alias("x"), "item_id", "shift", "first", "last", "kind", "item_value", (F.col("item_pos") + F.col("shift")).alias("pos")
    )
    of = ["item_id", "shift", "first", "last"]
    wanted = wanted.where(F.col("pos") >= 0).groupBy("i", "x").agg(F.collect_list(F.struct(*of, "kind", "item_value", "pos")).alias("slots"))
    wanted = stored(wanted, "benchmark-slots")  # of known size: the texts move only if it is too large to broadcast
    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("doc_hash"))
    picked = keyed.join(wanted, keyed["doc_id"].eqNullSafe(wanted["i"]) & (keyed["doc_hash"] == wanted["x"])).dropDuplicates(["doc_id", "doc_hash"])
    met = _tokens(picked, "doc_id", "doc_hash", "slots")
    met = met.select(
        "doc_id",
        "doc_hash",
        F.explode(
            let(
                F.struct("t", "v"),
                lambda d: F.transform(
                    F.filter("slots", lambda s: F.get(d["t"], s["pos"]) == s["kind"]),
                    lambda s: F.struct(*[s[c].alias(c) for c in of], s["item_value"].alias("a"), F.get(d["v"], s["pos"]).alias("b")),
                ),
            )
        ).alias("s"),
    ).select("doc_id", "doc_hash", "s.*")
    key = ["doc_id", "doc_hash", *of]
    pairs = met.groupBy(*key, "a", "b").agg(F.count(F.lit(1)).alias("n"))
    by_item, by_doc = Window.partitionBy(*key, "a"), Window.partitionBy(*key, "b")  # values of one alignment
    both = pairs.withColumns({"top_a": F.max(F.struct("n", "b")).over(by_item), "top_b": F.max(F.struct("n", "a")).over(by_doc)})
    follows = (F.col("top_a.b") == F.col("b")) & (F.col("top_b.a") == F.col("a"))
    share = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    return both.groupBy(*key).agg(F.sum("n").alias("n_slots"), share(F.col("a") == F.col("b")).alias("n_same"), (share(follows) / F.sum("n")).alias("agreement"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, doc_hash, item_id, n_windows, cover, n_slots, agreement`` of documents that hold a benchmark item.

    A pair counts if one of its alignments does: template windows cover ``MIN_COVER`` of the
    item, or a run of ``MIN_RUN`` words of it with ``MIN_SAME`` equal ones, and the placeholders
    there, if any, agree to ``MIN_AGREEMENT``; the figures are of the alignment that agrees most.
    Items of fewer than ``MIN_TOKENS`` words are met word by word, with their values. Items of
    equal words are reported under the smallest id, those of equal templates each under its
    own. Null texts are empty and match nothing; a null id is an id; repeated rows give
    one pair. No documents or no items: no rows.
    """
    items = _benchmark_items(benchmark)
    found = stored(matches(docs, items), "benchmark-matches")
    slots = slot_agreement(docs, items, found).select(
        F.col("doc_id").alias("i"), F.col("doc_hash").alias("x"), F.col("item_id").alias("m"), F.col("shift").alias("s"), F.col("first").alias("f"), F.col("last").alias("l"), "n_slots", "n_same", "agreement"
    )
    same = found["doc_id"].eqNullSafe(slots["i"]) & (found["doc_hash"] == slots["x"]) & found["item_id"].eqNullSafe(slots["m"])
    same = same & (found["shift"] == slots["s"]) & (found["first"] == slots["f"]) & (found["last"] == slots["l"])
    n_slots, agreement = F.coalesce("n_slots", F.lit(0)), F.coalesce("agreement", F.lit(1.0))
    equal = F.col("last") - F.col("first") + 1 - n_slots + F.coalesce("n_same", F.lit(0))
    agreed = found.join(slots, same, "left").where((agreement >= MIN_AGREEMENT) & (~F.col("run") | (equal >= MIN_SAME)))
    figures = F.struct(agreement.alias("agreement"), n_slots.alias("n_slots"))
    best = agreed.groupBy("doc_id", "doc_hash", "item_id", "n_windows", "cover").agg(F.max(figures).alias("b"))
    return best.select("doc_id", "doc_hash", "item_id", "n_windows", "cover", "b.n_slots", "b.agreement")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contaminated(docs, benchmark).drop("doc_hash").distinct()
