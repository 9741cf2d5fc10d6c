"""Exact splits of a table by row rank without sorting or shuffling the table.

Assigning rows to parts by their rank (folds, exact-size samples, ordered
splits) needs only the keys at the part borders. They are found by counting key
prefixes: each pass is a scan of the key and group columns with a map-side
combined count, and every pass looks only into the prefixes that hold a border.
The assignment itself is then a narrow projection with literal borders, so the
wide rows never move. Rows that share a border key are told apart by a hash of
the whole row; exact copies are counted, dealt out by number and written back,
so that even a group of copies holding a large share of all rows is spread over
many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.keys import row_key
from gridloom.session import checkpoint_root

MAX_WIDTH = 4  # prefix characters added by one pass
MAX_COUNTS = 200_000  # prefix counts one pass may bring to the driver
MAX_GROUPS = 1_000  # groups whose totals the driver may hold; more are ranked by a sort
SETTLE_ROWS = 20_000  # border rows few enough to list by full key
COPY_CHUNK = 50_000  # copies written back by one output row of the chunk table



class TooManyGroups(ValueError):
    """More groups than the driver may hold; :func:`group_ranks` takes any number."""


Sizes = Callable[[dict[Any, int]], dict[Any, list[int]]]


@dataclass(frozen=True)
class _Border:
    """Rows up to ``key`` lie before the border; of the ``copies`` equal to it, ``taken`` do."""

    key: str
    taken: int
    copies: int


def even_sizes(total: int, k: int, start: int = 0) -> list[int]:
    """Sizes of ``k`` parts when rows ``start, start+1, …`` are dealt round-robin."""
    return [total // k + (1 if (part - start) % k < total % k else 0) for part in range(k)]


def _width(n_open: int, n_borders: int, n_rows: int, natural: bool) -> int:
    """Characters to add: enough to settle the borders after this pass, no more than the driver may hold.

    Hash keys spread evenly, so the need is known; keys of natural order often share
    their next characters and take the full width.
    """
    wanted = MAX_WIDTH if natural else math.ceil(math.log(max(16.0, n_rows / n_open * n_borders / max(1, SETTLE_ROWS)), 16))
    allowed = int(math.log(max(16.0, MAX_COUNTS / n_open), 16))
    return max(1, min(wanted, allowed, MAX_WIDTH))


def _in_prefixes(opened: dict[int, dict[str, Any]], width: int) -> Column:
    """Rows under an open prefix; the key appears once, so it is hashed once per row."""
    texts = [f"{group}:{prefix}" for group, prefixes in opened.items() for prefix in prefixes]
    return F.concat(F.col("g").cast("string"), F.lit(":"), F.substring("k", 1, width)).isin(*texts)


def _common(low: str, high: str) -> int:
    """Length of the common start of two texts."""
    return next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))


def _count(narrow: DataFrame, prefix: Column, natural: bool) -> dict[int, list[tuple[str, int, int, int]]]:
    """(prefix, rows, longest key, characters shared by its keys) per group, in prefix order."""
    ends = [F.min("k").alias("low"), F.max("k").alias("high")] if natural else []
    rows = narrow.groupBy("g", prefix.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max(F.length("k")).alias("len"), *ends).collect()
    counts: dict[int, list[tuple[str, int, int, int]]] = {}
    for row in rows:
        shared = _common(row["low"], row["high"]) if natural else len(row["p"])
        counts.setdefault(row["g"], []).append((row["p"], row["n"], row["len"], shared))
    for entries in counts.values():
        entries.sort()
    return counts


def _locate(narrow: DataFrame, totals: list[int], ranks: list[set[int]], skip: int, natural: bool) -> list[dict[int, _Border]]:
    """The border key at every wanted 1-based rank of every group; groups are numbered in ``g``."""
    found: list[dict[int, _Border]] = [{} for _ in ranks]
    # open ranks: group -> prefix -> [(rank, rank inside the prefix)]
    opened: dict[int, dict[str, list[tuple[int, int]]]] = {g: {"": [(r, r) for r in wanted]} for g, wanted in enumerate(ranks) if wanted}
    open_rows = sum(totals[g] for g in opened)
    depth, text_depth, shared_depth = 0, skip, skip
    while opened:
        rows = narrow if depth == 0 else narrow.where(_in_prefixes(opened, text_depth))
        exhaustive = open_rows <= SETTLE_ROWS
        n_open = sum(len(prefixes) for prefixes in opened.values())
        n_borders = sum(len(wanted) for prefixes in opened.values() for wanted in prefixes.values())
        text_depth = shared_depth + _width(n_open, n_borders, open_rows, natural)
        counts = _count(rows, F.col("k") if exhaustive else F.substring("k", 1, text_depth), natural)
        deeper: dict[int, dict[str, list[tuple[int, int]]]] = {}
        open_rows, depth, shared_depth = 0, depth + 1, None
        for group, prefixes in opened.items():
            for prefix, wanted in prefixes.items():
                entries = [e for e in counts[group] if e[0].startswith(prefix)]
                for rank, inside in wanted:
                    before = 0
                    for text, n, length, shared in entries:
                        if before + n < inside:
                            before += n
                            continue
                        if exhaustive or length <= len(text):
                            found[group][rank] = _Border(text, inside - before, n)
                        else:
                            slot = deeper.setdefault(group, {})
                            if text not in slot:
                                open_rows += n
                                shared_depth = shared if shared_depth is None else min(shared_depth, shared)
                            slot.setdefault(text, []).append((rank, inside - before))
                        break
        opened = deeper
    return found


def _case(group: Column, values: dict[Any, Column]) -> Column:
    result = None
    for value, expression in values.items():
        branch = group == F.lit(value)
        result = F.when(branch, expression) if result is None else result.when(branch, expression)
    return result


def _split(df: DataFrame, key: Column, group: Column, sizes: Sizes, out: str, level: int, skip: int = 0, natural: bool = False) -> DataFrame:
    columns = df.columns
    # reads the group column only, or just the row counts of the files when there is none
    rows = df.select(group.alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n")).limit(MAX_GROUPS + 1).collect()
    totals = {row["g"]: row["n"] for row in rows}
    if None in totals:
        raise ValueError("the column that groups the rows contains missing values")
    if len(totals) > MAX_GROUPS:
        raise TooManyGroups(f"more than {MAX_GROUPS} groups of rows")
    if not totals:
        return df.withColumn(out, F.lit(0))
    parts = sizes(totals)
    borders = {g: [sum(parts[g][: i + 1]) for i in range(len(parts[g]) - 1)] for g in totals}
    inner = {g: {r for r in borders[g] if 0 < r < totals[g]} for g in totals}
    numbers = {g: i for i, g in enumerate(totals)}
    narrow = df.select(_case(group, {g: F.lit(i) for g, i in numbers.items()}).alias("g"), key.alias("k"))
    found = _locate(narrow, list(totals.values()), list(inner.values()), skip, natural)

    plain: dict[Any, Column] = {}
    ties: list[tuple[Any, str, int, list[int]]] = []  # group, key, parts before, sizes inside
    for g in totals:
        at = [found[numbers[g]].get(r) for r in borders[g]]
        part = F.lit(sum(1 for r in borders[g] if r <= 0))
        for border in at:
            if border is not None:
                part = part + (F.col("__k") > F.lit(border.key)).cast("int")
        plain[g] = part
        for text in sorted({b.key for b in at if b is not None and b.taken < b.copies}):
            before = sum(1 for r, b in zip(borders[g], at) if r <= 0 or (b is not None and b.key < text))
            cuts = [b.taken for b in at if b is not None and b.key == text]
            copies = next(b.copies for b in at if b is not None and b.key == text)
            edges = [0, *cuts, copies]
            ties.append((g, text, before, [hi - lo for lo, hi in zip(edges, edges[1:])]))

    keyed = df.withColumn("__g", group).withColumn("__k", key)
    if not ties:
        return keyed.withColumn(out, _case(F.col("__g"), plain).cast("int")).select(*columns, out)

    tie_id = None
    for number, (g, text, _, _) in enumerate(ties):
        branch = (F.col("__g") == F.lit(g)) & (F.col("__k") == F.lit(text))
        tie_id = F.when(branch, F.lit(number)) if tie_id is None else tie_id.when(branch, F.lit(number))
    tie = f"__t{level}"
    keyed = keyed.withColumn(tie, tie_id)
    settled = keyed.where(F.col(tie).isNull()).withColumn(out, _case(F.col("__g"), plain).cast("int"))
    tied = keyed.where(F.col(tie).isNotNull()).select(*columns, tie)
    offset = _case(F.col(tie), {i: F.lit(before) for i, (_, _, before, _) in enumerate(ties)})
    inside = {i: inner_sizes for i, (_, _, _, inner_sizes) in enumerate(ties)}
    if level == 0:
        split = _split(tied, row_key(df, 0), F.col(tie), lambda _: inside, out, level=1)
    else:
        split = _deal_copies(tied, tie, inside, out)
    split = split.withColumn(out, (F.col(out) + offset).cast("int"))
    return settled.select(*columns, out).unionByName(split.select(*columns, out))


def _deal_copies(df: DataFrame, tie: str, inside: dict[int, list[int]], out: str) -> DataFrame:
    """Deal exact copies: count them, allot the counts to parts, write the copies back in chunks."""
    columns = [name for name in df.columns if name != tie]
    distinct = df.groupBy(*columns, tie).agg(F.count(F.lit(1)).alias("__n"))
    allot = _case(
        F.col(tie),
        {i: F.array(*[F.struct(F.lit(p).alias("part"), F.lit(n).cast("long").alias("n")) for p, n in enumerate(sizes)]) for i, sizes in inside.items()},
    )
    chunk = F.lit(COPY_CHUNK)
    chunks = (
        distinct.withColumn("__a", F.explode(allot))
        .where("__a.n > 0")
        .withColumn("__c", F.explode(F.sequence(F.lit(0), F.floor((F.col("__a.n") - 1) / chunk).cast("int"))))
        .withColumn("__m", F.least(chunk.cast("long"), F.col("__a.n") - F.col("__c").cast("long") * chunk).cast("int"))
        .repartition(F.col(tie), F.col("__a.part"), F.col("__c"))
    )
    return (
        chunks.withColumn(out, F.col("__a.part"))
        .withColumn("__x", F.explode(F.array_repeat(F.lit(True), F.col("__m"))))
        .select(*columns, tie, out)
    )


def split_by_rank(df: DataFrame, key: Column, sizes: Sizes, out: str, group: str | None = None, sorted_text: bool = False) -> DataFrame:
    """Add ``out``: the part every row falls into when each group is cut by key rank.

    ``sizes`` receives the group totals and returns the part sizes per group.
    ``sorted_text`` marks keys of natural order, whose common leading characters
    are skipped so that the first counting pass already discriminates.
    """
    group_column = F.lit(0) if group is None else F.col(group)
    skip = 0
    if sorted_text:
        low, high = df.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
        if low is not None:
            skip = _common(low, high)
    return _split(df, key, group_column, sizes, out, level=0, skip=skip, natural=sorted_text)


def row_numbers(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Add a global 1-based row number in the given order, computed range by range.

    Meant for derived tables such as dictionaries. The range-partitioned rows are
    checkpointed first: the ranges come from a sample, so numbers and offsets must
    be taken from one and the same materialised layout.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n_ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(n_ranges, *order).withColumn("__r", F.spark_partition_id()).checkpoint()
    # one row per range, so this small window is the only unpartitioned one
    sizes = ranged.groupBy("__r").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__r", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__o"))
    inside = Window.partitionBy("__r").orderBy(*order)
    return (
        ranged.withColumn("__i", F.row_number().over(inside))
        .join(offsets, "__r")
        .withColumn(out, (F.col("__i") + F.col("__o")).cast("long"))
        .drop("__r", "__i", "__o")
    )


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows dealt by range and checkpointed in that layout, with ``__r``, the number of the range."""
    checkpoint_root(df.sparkSession)
    n_ranges = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartitionByRange(n_ranges, *order).withColumn("__r", F.spark_partition_id()).checkpoint()


def sums_before(df: DataFrame, order: Sequence[Column], value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over all rows that come before, range by range; rows must differ in ``order``."""
    ranged = _ranged(df, order)
    earlier = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("__r").agg(F.sum(value).alias("__n")).select("__r", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__o"))
    inside = Window.partitionBy("__r").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.withColumn("__i", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(offsets, "__r").withColumn(out, F.col("__i") + F.col("__o")).drop("__r", "__i", "__o")


def group_ranks(df: DataFrame, group: str, key: Column, out: str) -> DataFrame:
    """Add the 0-based rank by ``key`` in the group, for any number of groups of any size.

    The table is sorted once, in ranges: a large group lies in several of them and is chained
    through its counts. Equal keys go by a hash of the row, exact copies by their place.
    """
    columns = df.columns
    keyed = df.withColumns({"__k": key, "__h": row_key(df, 0), "__c": F.monotonically_increasing_id()})
    ranged = _ranged(keyed, [F.col(group), F.col("__k"), F.col("__h"), F.col("__c")])
    pieces = ranged.groupBy(F.col(group).alias("__g"), F.col("__r").alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    # a group has at most as many pieces as there are ranges
    earlier = Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("__g", "__p", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__o"))
    inside = Window.partitionBy(group, "__r").orderBy("__k", "__h", "__c")
    numbered = ranged.withColumn("__i", F.row_number().over(inside) - 1)
    joined = numbered.join(pieces, (F.col(group) == F.col("__g")) & (F.col("__r") == F.col("__p")))
    return joined.select(*columns, (F.col("__i") + F.col("__o")).alias(out))


def even_part(rank: Column, total: Column, k: int, start: Column) -> Column:
    """The part of a rank when a group is cut as by :func:`even_sizes`."""
    part, end = F.lit(0), F.lit(0)
    for p in range(k - 1):
        end = end + F.floor(total / k) + F.when(F.pmod(F.lit(p) - start, F.lit(k)) < total % k, 1).otherwise(0)
        part = part + (rank >= end).cast("int")
    return part
