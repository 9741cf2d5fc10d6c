"""SimHash near-duplicates: fingerprints of shingles, linked by a generalised pigeonhole search, grouped by components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import stored, table, texts, without

BITS = 64
SEED = 42
#: A bucket of more fingerprints than this is split by further bits before its members are compared.
BUCKET = 256
#: How often a bucket is split. What stays large then shares most bits; it is compared where it is, in slices that Spark cuts from a skewed join.
SPLITS = 1
#: Cost of one probe row against one compared pair: a probe is hashed, shuffled and sorted (1 to 2 microseconds), a pair is one comparison within a join.
PROBE_COST = 32.0

_VALUES = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLANES = (np.arange(8) * 256)[None, :]
_CHUNK = 1 << 16


def fingerprint(text: str | bytes, width: int = 3) -> int:
    """64 bits; bit j is set if more than half of the shingle hashes have it. No words: 0.

    The hashes are counted byte by byte in 8 histograms, chunk by chunk, so memory does not depend on the length.
    """
    raw = text if isinstance(text, bytes) else text.encode("utf-8", "replace")
    tokens = raw.lower().split()  # of bytes: A-Z and the six ASCII blanks only
    if not tokens:
        return 0
    n = max(1, len(tokens) - width + 1)
    counts = np.zeros(2048, dtype=np.int64)
    for start in range(0, n, _CHUNK):
        hashes = [xxhash.xxh64_intdigest(b" ".join(tokens[i : i + width]), SEED) for i in range(start, min(n, start + _CHUNK))]
        planes = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8) + _PLANES
        counts += np.bincount(planes.ravel(), minlength=2048)
    bits = (2 * (counts.reshape(8, 256) @ _VALUES) > n).ravel()
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) for every row; null texts have no words."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([fingerprint(t, width) for t in batch], dtype=np.uint64).astype(np.int64))

    return texts(docs).select("doc_id", of("text").alias("fp"))


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and, for each pair of bits, how many have both set; a 64 x 64 sum per task."""

    def count(batches):
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch["fp"].to_numpy(np.int64)
            for part in np.array_split(values, max(1, len(values) // _CHUNK)):
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                n, both = n + len(part), both + bits.T @ bits
        yield pd.DataFrame({"n": [n] + [0] * (BITS * BITS - 1), "cell": range(BITS * BITS), "both": both.ravel()})

    rows = fps.select("fp").mapInPandas(count, "n long, cell int, both double").groupBy("cell").agg(F.sum("both").alias("both"), F.sum("n").alias("n")).collect()
    both = np.zeros(BITS * BITS)
    for row in rows:  # 4,096 rows
        both[row["cell"]] = row["both"]
    return sum(row["n"] for row in rows), both.reshape(BITS, BITS)


def correlated_parts(n: int, both: np.ndarray, bits: list[int], count: int) -> list[list[int]]:
    """``bits`` in ``count`` parts of nearly equal size; a part starts from the most correlated free bit and takes those that go with it."""
    p = np.diag(both) / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tie = np.abs(both / max(1, n) - np.outer(p, p)) / np.outer(spread, spread)
    free, parts = list(bits), []
    for left in range(count, 0, -1):
        size = len(free) // left
        if not size:
            parts.append([])
            continue
        part = [max(free, key=lambda b: (tie[b, free].sum(), -b))]
        free.remove(part[0])
        while len(part) < size:
            take = max(free, key=lambda b: (tie[b, part].sum(), -b))
            part.append(take)
            free.remove(take)
        parts.append(sorted(part))
    return parts


def candidates_within(n: int, both: np.ndarray, part: list[int], most: int) -> list[float]:
    """Expected fingerprints within 0..most bits of one, on the bits of a part: the distribution of the sum of independent differences."""
    p = np.diag(both)[part] / max(1, n)
    distribution = np.zeros(most + 1)
    distribution[0] = 1.0
    for q in 2 * p * (1 - p):
        distribution = distribution * (1 - q) + np.concatenate([[0], distribution[:-1]]) * q
    return list(n * np.cumsum(distribution))


def allocate(n: int, both: np.ndarray, parts: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """Cheapest thresholds, one per part, -1 for not probed, of sum ``distance - len(parts) + 1``.

    If every part i differs in more than t_i bits, the whole differs in at least
    sum(t_i + 1) = distance + 1, so a pair within the distance meets in some part. Dynamic
    programming over the parts; the cost of a part is its probes and expected candidates.
    """
    from math import comb

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in parts:
        near = candidates_within(n, both, part, distance)
        cost, probes = {-1: 0.0}, 0
        for t in range(distance + 1):
            probes += comb(len(part), t)
            cost[t] = PROBE_COST * probes + near[t]
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, chosen) in best.items():
            for t, c in cost.items():
                total = (so_far + c, [*chosen, t])
                if t + 1 <= len(part) and used + t + 1 <= distance + 1 and total < step.get(used + t + 1, (float("inf"), [])):
                    step[used + t + 1] = total
        best = step
    return best.get(distance + 1, (float("inf"), []))


def plan_parts(n: int, both: np.ndarray, bits: list[int], distance: int) -> list[tuple[list[int], int]]:
    """The parts and thresholds of the cheapest division into 1 to ``distance + 3`` parts, those that are not probed left out."""
    options = []
    for count in range(1, distance + 4):
        parts = correlated_parts(n, both, bits, count)
        cost, chosen = allocate(n, both, parts, distance)
        options.append((cost, count, parts, chosen))
    _, _, parts, chosen = min(options, key=lambda o: o[:2])
    return [(part, t) for part, t in zip(parts, chosen) if t >= 0]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _probes(part: list[int], threshold: int) -> list[int]:
    """Masks of all changes of up to ``threshold`` bits of a part."""
    from itertools import combinations

    return [_signed(sum(1 << b for b in chosen)) for t in range(threshold + 1) for chosen in combinations(part, t)]


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """``a, b`` (a < b): all pairs of ``node`` of ``fps(node, fp, group)`` of different groups whose ``fp`` differ in at most ``distance`` bits.

    Every fingerprint stands in one bucket per probed part and looks into the buckets of
    its changed values; a pair is compared where they meet. Large buckets agree in the bits
    of their part, so they are divided again over the remaining bits, with a plan of their
    own, ``SPLITS`` times. A bucket is large from ``BUCKET`` fingerprints, or from where the
    probes of a division cost less than comparing. Only links leave a comparison.
    Without ``node`` and ``group`` each fingerprint is its own.
    """
    label = "node" if "node" in fps.columns else "fp"
    group = "group" if "group" in fps.columns else label
    columns = list(dict.fromkeys([label, "fp", group]))
    n, both = bit_statistics(fps)
    empty = fps.sparkSession.createDataFrame([], "a bigint, b bigint")
    if n < 2:
        return empty
    found, level = [], 0
    rows = fps.select(*columns, F.lit(0).cast("long").alias("bucket"))
    pending = [(rows, rows, list(range(BITS)), SPLITS)]
    while pending:
        owners, seekers, left, splits = pending.pop()
        for part, threshold in plan_parts(n, both, left, distance):
            rest = [b for b in left if b not in part]
            part_mask, level = F.lit(_signed(sum(1 << b for b in part))), level + 1

            def key(value, at=level, mask=part_mask):
                return F.xxhash64("bucket", F.lit(at), value.bitwiseAND(mask))

            own = owners.select(*columns, key(F.col("fp")).alias("bucket"))
            looks = [key(F.col("fp").bitwiseXOR(F.lit(m))) for m in _probes(part, threshold)]
            seek = seekers.select(*columns, F.explode(F.array(*looks)).alias("bucket"))
            if rest and splits:
                probes = sum(len(_probes(p, t)) for p, t in plan_parts(n, both, rest, distance))
                large = max(BUCKET, int(4 * PROBE_COST * probes))
                sizes = own.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
                hot = stored(sizes.where(F.col("size") > large).select("bucket"), "simhash-hot")
                if not hot.isEmpty():
                    again = [stored(side.join(hot, "bucket", "left_semi"), "simhash-again") for side in (own, seek)]
                    pending.append((*again, rest, splits - 1))
                    own, seek = own.join(hot, "bucket", "left_anti"), seek.join(hot, "bucket", "left_anti")
            a = own.select(*[F.col(c).alias(f"a_{c}") for c in columns], "bucket")
            b = seek.select(*[F.col(c).alias(f"b_{c}") for c in columns], F.col("bucket").alias("other"))
            near = (F.col(f"a_{group}") != F.col(f"b_{group}")) & (F.bit_count(F.col("a_fp").bitwiseXOR(F.col("b_fp"))) <= distance)
            pairs = a.join(b, (F.col("bucket") == F.col("other")) & near)
            found.append(pairs.select(F.least(f"a_{label}", f"b_{label}").alias("a"), F.greatest(f"a_{label}", f"b_{label}").alias("b")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of ``edges(a, b)``.

    Large-star and small-star steps in turn: each node hangs its neighbours on the smallest
    one it sees, until every component is a star. Smallest neighbours combine before the
    shuffle, and each round is written to the shared folder.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both_ways = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both_ways.groupBy("u").agg(F.min("v").alias("m"))
        large = both_ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        down = stored(large.where("u <> v").distinct(), "edges-large")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "edges-small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def near_duplicates(docs: DataFrame, distance: int = 3, width: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: documents whose fingerprints link, directly or over others, share the smallest id.

    Equal fingerprints are one class from the start, so a text that fills a third of the
    table is one fingerprint in the search. Null and empty texts have fingerprint 0 and link
    like others. Rows with the same id belong to one document in the sense of the smallest
    id; a null id never is a component's id unless all its ids are null. No rows: no rows.
    """
    rows = stored(fingerprints(docs, width), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    linked = components(links(classes.select("fp"), distance))
    named = linked.join(classes.withColumnRenamed("fp", "node"), "node")
    smallest = named.groupBy("component").agg(F.min("first").alias("root"))
    roots = named.join(smallest, "component").select(F.col("node").alias("fp"), "root")
    final = classes.join(roots, "fp", "left").select("fp", F.coalesce("root", "first").alias("component_id"))
    # stored, so that both sides of the last join are plain shuffles and Spark can split a fingerprint with many copies
    return rows.join(stored(final, "fingerprint-components"), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, distance: int = 3, width: int = 3) -> DataFrame:
    """``docs`` with the smallest id of each component of :func:`near_duplicates`; rows that share an id stay or go together, null ids stay."""
    found = near_duplicates(docs, distance, width)
    return without(docs, found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct())


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
