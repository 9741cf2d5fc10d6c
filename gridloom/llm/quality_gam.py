"""Quality classifier: an additive model with pairwise interactions over text statistics.

Shallow trees are boosted cyclically, one feature at a time, and add up to one lookup
table per feature; then the pairs that explain most of the rest get tables of their
own. A score is a sum of looked-up values, whole columns at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import Sent, fold, stored, table, texts

FOLD, HELD_OUT = 5, 0
THRESHOLD = 0.3
#: Labelled rows that the model is fitted on at most; a sample by hash beyond that.
MAX_TRAINING_ROWS = 20_000

FEATURES = (
    "log_words", "word_length", "longest_word", "short_words", "symbols", "pipes", "capitals", "digits", "exclamations",
    "sentence_words", "commas", "non_ascii", "distinct_words", "repeated_neighbours", "top_word", "repeated_lines",
)


def _set(chars: str) -> np.ndarray:
    mask = np.zeros(256, dtype=np.int64)
    mask[list(chars.encode())] = 1
    return mask


_CLASSES = np.stack([_set("#*$%&<>"), _set("|"), _set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _set("0123456789"), _set("!?"), _set(".!?"), _set(",;:"), (np.arange(256) >= 128).astype(np.int64)])


def text_features(text: str) -> list[float]:
    """The 16 statistics of a whole text; all zero for one without words."""
    raw = text.encode("utf-8", "replace")
    tokens = raw.split()
    if not tokens:
        return [0.0] * len(FEATURES)
    n, size = len(tokens), len(raw)
    symbols, pipes, capitals, digits, marks, stops, commas, wide = _CLASSES @ np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=n)
    counts: dict[bytes, int] = {}
    for token in tokens:
        counts[token] = counts.get(token, 0) + 1
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        float(np.log1p(n)), float(lengths.mean()), float(min(lengths.max(), 1000)), float((lengths <= 3).mean()), symbols / n, pipes / n, capitals / size,
        digits / size, marks / n, n / (1 + stops), commas / n, wide / size, len(counts) / n, sum(map(eq, tokens, tokens[1:])) / n,
        max(counts.values()) / n, 1 - len(set(lines)) / len(lines),
    ]


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every row; null texts are empty."""

    @F.pandas_udf(", ".join(f"{name} double" for name in FEATURES))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([text_features(t) for t in batch], columns=list(FEATURES), dtype=float)

    return texts(docs).select("doc_id", of("text").alias("f")).select("doc_id", "f.*")


def _step(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Leaf values of the best tree of up to four leaves over ordered bins with gradient and hessian sums."""

    def split(lo: int, hi: int) -> int | None:
        if hi - lo < 2:
            return None
        gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
        gr, hr = g[lo:hi].sum() - gl, h[lo:hi].sum() - hl
        gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge)
        best = int(np.argmax(gain))
        return lo + best + 1 if gain[best] > (gl[-1] + gr[-1]) ** 2 / (hl[-1] + hr[-1] + ridge) + 1e-9 else None

    edges = [0, len(g)]
    for _ in range(2):
        edges = sorted({*edges, *(c for a, b in zip(edges, edges[1:]) if (c := split(a, b)) is not None)})
    out = np.empty(len(g))
    for a, b in zip(edges, edges[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _cross_step(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Leaf values of the best tree over two binned features: one cut of the first, then one of the second on each side."""
    best, out = -np.inf, np.zeros_like(g)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for cut in range(1, a.shape[0]):
            value, gain = np.empty_like(a), 0.0
            for rows in (slice(0, cut), slice(cut, None)):
                gs, hs = a[rows].sum(0), b[rows].sum(0)
                gl, hl = np.cumsum(gs)[:-1], np.cumsum(hs)[:-1]
                gr, hr = gs.sum() - gl, hs.sum() - hl
                score = gl**2 / (hl + ridge) + gr**2 / (hr + ridge)
                k = int(np.argmax(score))
                gain += score[k]
                value[rows, : k + 1], value[rows, k + 1 :] = gl[k] / (hl[k] + ridge), gr[k] / (hr[k] + ridge)
            if gain > best:
                best, out = gain, value.T if flip else value
    return out


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; ``margin`` adds them up."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    @staticmethod
    def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
        return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, bins: int = 48, pair_bins: int = 8, max_pairs: int = 8, ridge: float = 2.0) -> AdditiveModel:
        """Without rows the score is 0.5; with one class only it stays near its share."""
        if not len(y):
            return cls()
        share = (y.sum() + 0.5) / (len(y) + 1)
        model = cls(base=float(np.log(share / (1 - share))))
        width = x.shape[1]
        model.edges = [cls._cuts(x[:, j], bins) for j in range(width)]
        model.coarse = [cls._cuts(x[:, j], pair_bins) for j in range(width)]
        binned = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
        rough = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
        model.tables = [np.zeros(len(e) + 1) for e in model.edges]
        margin = np.full(len(y), model.base)

        def sums(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-margin))
            return np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size)

        for _ in range(rounds):
            for j in range(width):
                change = rate * _step(*sums(binned[j], len(model.tables[j])), ridge)
                model.tables[j] += change
                margin += change[binned[j]]
        gains = {}
        for a, b in combinations(range(width), 2):
            shape = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
            g, h = sums(rough[a] * shape[1] + rough[b], shape[0] * shape[1])
            gains[a, b] = float((g**2 / (h + ridge)).sum())
        chosen = sorted(gains, key=lambda k: (-gains[k], k))[:max_pairs]
        model.pairs = {(a, b): np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in chosen if len(model.coarse[a]) and len(model.coarse[b])}
        for _ in range(rounds // 4):
            for (a, b), cells in model.pairs.items():
                at = rough[a] * cells.shape[1] + rough[b]
                g, h = (s.reshape(cells.shape) for s in sums(at, cells.size))
                change = rate * _cross_step(g, h, ridge)
                cells += change
                margin += change.ravel()[at]
        return model

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            out += t[np.searchsorted(e, x[:, j], side="right")]
        for (a, b), cells in self.pairs.items():
            out += cells[np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -50, 50)))


def fit_model(measured: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> AdditiveModel:
    """Fitted on labelled rows outside the held-out fold, on at most ``max_rows`` of them, drawn by a hash of the id.

    A document with several labels counts with their mean, rounded up from one half; null labels do not count.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    rows = stored(measured.where(fold(F.col("doc_id"), FOLD) != HELD_OUT).join(known, "doc_id"), "labelled")
    n = rows.count()
    if n > max_rows:  # a tenth less than the bound is expected, so that the bound holds
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * 0.9 * max_rows / n)).limit(max_rows)
    sample = rows.select(*FEATURES, "y").toPandas().sort_values([*FEATURES, "y"], kind="stable")
    return AdditiveModel.fit(sample[list(FEATURES)].to_numpy(float), sample["y"].to_numpy(float))


def score_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    The texts are read once; their 16 statistics are stored and serve for fitting and for
    scoring. Null and empty texts are scored like any other, with statistics of zero.
    Repeated rows get equal scores; a null id is held in no fold and has no label.
    Without labels every score is 0.5. No rows: no rows.
    """
    measured = stored(features(docs), "quality-features")
    model = Sent(docs.sparkSession, fit_model(measured, labels, max_rows))

    @F.pandas_udf("double")
    def of(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(model.value.score(np.column_stack([c.to_numpy(float) for c in columns])))

    scored = measured.select("doc_id", (fold(F.col("doc_id"), FOLD) == HELD_OUT).alias("held_out"), of(*FEATURES).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
