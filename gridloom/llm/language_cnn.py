"""Language identification by a byte convolutional network: filters of several widths, max pooling, softmax.

Texts are cut into fixed windows of bytes. A filter over one-hot bytes is a sum of looked-up
weights, so the network runs as table look-ups over whole batches of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import Sent, fold, stored, table

FOLD, HELD_OUT = 4, 2
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Documents of one language that the network is fitted on at most, and windows of each.
MAX_PER_LANGUAGE = 1_000
WINDOWS_PER_DOCUMENT = 2
#: Windows that are scored at once.
BATCH = 256


def windows(text: str) -> np.ndarray:
    """All bytes of the lower-cased text in rows of ``WINDOW``; rows overlap by one filter width, the last is padded with 0."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    step = WINDOW - max(WIDTHS) + 1
    count = max(1, -(-(len(raw) - (WINDOW - step)) // step))
    padded = np.zeros((count - 1) * step + WINDOW, dtype=np.uint8)
    padded[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step]


@dataclass
class ByteNetwork:
    """``filters[w]`` is (w, 256, FILTERS); ``out`` maps the pooled responses and a constant to ``languages``."""

    languages: list[str]
    filters: dict[int, np.ndarray]
    out: np.ndarray

    @classmethod
    def fit(cls, rows: np.ndarray, labels: list[str], epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 7) -> ByteNetwork:
        """Adam on the cross entropy; the gradient of a pooled response goes to the bytes under its maximum."""
        languages = sorted(set(labels))
        rng = np.random.default_rng(seed)
        parts = {w: rng.normal(0, 0.3, (w, 256, FILTERS)) for w in WIDTHS} | {0: rng.normal(0, 0.1, (len(WIDTHS) * FILTERS + 1, max(1, len(languages))))}
        first, second = ({k: np.zeros_like(v) for k, v in parts.items()} for _ in range(2))
        y, step = np.array([languages.index(label) for label in labels], dtype=int), 0
        for _ in range(epochs if len(languages) > 1 else 0):
            order = rng.permutation(len(y))
            for start in range(0, len(y), batch):
                x, t = rows[order[start : start + batch]], y[order[start : start + batch]]
                pooled, where = [], []
                for w in WIDTHS:
                    length = WINDOW - w + 1
                    response = sum(parts[w][k][x[:, k : k + length]] for k in range(w))
                    where.append(response.argmax(1))
                    pooled.append(np.take_along_axis(response, where[-1][:, None], 1)[:, 0])
                hidden = np.maximum(np.concatenate([*pooled, np.ones((len(t), 1))], axis=1), 0)
                logits = hidden @ parts[0]
                p = np.exp(logits - logits.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(t)), t] -= 1
                p /= len(t)
                grads = {0: hidden.T @ p}
                back = (p @ parts[0].T) * (hidden > 0)
                for j, w in enumerate(WIDTHS):
                    grads[w] = np.zeros_like(parts[w])
                    for k in range(w):
                        seen = np.take_along_axis(x, where[j] + k, 1)
                        np.add.at(grads[w][k], (seen, np.arange(FILTERS)), back[:, j * FILTERS : (j + 1) * FILTERS])
                step += 1
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    parts[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return cls(languages, {w: parts[w].astype(np.float32) for w in WIDTHS}, parts[0].astype(np.float32))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The filters over pairs of bytes: at t for all widths, at t + 2 for width 4, and single bytes at t + 2 for width 3."""
        pair = lambda f, k: (f[k][:, None, :] + f[k + 1][None, :, :]).reshape(65536, -1)
        start = np.concatenate([pair(self.filters[w], 0) for w in (2, 3, 4)], axis=1)
        return np.ascontiguousarray(start), np.ascontiguousarray(pair(self.filters[4], 2)), np.ascontiguousarray(self.filters[3][2])

    def probabilities(self, rows: np.ndarray, tables: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        start, tail, third = tables
        result = np.empty((len(rows), self.out.shape[1]), dtype=np.float32)
        n2, n3, n4 = WINDOW - 1, WINDOW - 2, WINDOW - 3
        for begin in range(0, len(rows), BATCH):
            x = rows[begin : begin + BATCH].astype(np.int32)
            pairs = (x[:, :n2] << 8) | x[:, 1:]
            response = start[pairs]
            response[:, :n3, FILTERS : 2 * FILTERS] += third[x[:, 2:]]
            response[:, :n4, 2 * FILTERS :] += tail[pairs[:, 2:]]
            pooled = np.concatenate(
                [response[:, :n2, :FILTERS].max(1), response[:, :n3, FILTERS : 2 * FILTERS].max(1), response[:, :n4, 2 * FILTERS :].max(1), np.ones((len(x), 1), np.float32)], axis=1
            )
            logits = np.maximum(pooled, 0) @ self.out
            p = np.exp(logits - logits.max(1, keepdims=True))
            result[begin : begin + BATCH] = p / p.sum(1, keepdims=True)
        return result


def fit_network(docs: DataFrame, max_per_language: int = MAX_PER_LANGUAGE) -> ByteNetwork:
    """Fitted on labelled documents outside the held-out fold: of each language about 0.9 * ``max_per_language``
    at most, drawn by a hash of the id, and ``WINDOWS_PER_DOCUMENT`` windows of each at positions drawn from the whole text."""
    taught = docs.where((fold(F.col("doc_id"), FOLD) != HELD_OUT) & F.col("lang").isNotNull())
    known = taught.where(F.col("text").rlike(r"\p{L}")).select("doc_id", "text", F.col("lang").alias("l"))
    counts = taught.groupBy(F.col("lang").alias("l")).agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "language-counts")  # of known size, so that no text is moved to the count of its language
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(float(1 << 30)) * 0.9 * max_per_language / F.col("n")

    @F.pandas_udf("array<binary>")
    def some(ids: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for i, text in zip(ids, texts):
            rows = windows(text)
            picks = np.random.default_rng(abs(int(i))).integers(0, len(rows), WINDOWS_PER_DOCUMENT)
            out.append([rows[p].tobytes() for p in picks])
        return pd.Series(out)

    sample = known.join(counts, "l").where(drawn).select("l", "doc_id", F.posexplode(some(F.xxhash64("doc_id"), "text")).alias("p", "w"))
    pdf = stored(sample, "language-windows").toPandas().sort_values(["doc_id", "p", "w"], kind="stable")
    rows = np.frombuffer(b"".join(pdf["w"]), dtype=np.uint8).reshape(-1, WINDOW)
    return ByteNetwork.fit(rows, list(pdf["l"]))


def identify(docs: DataFrame, max_per_language: int = MAX_PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    Every window of the whole text is scored; the language with the highest mean
    probability wins, of equal ones the first by name, and that mean is the score. Null
    texts and texts without a letter are ``und`` with score 0, as is everything if no labelled
    text exists. Null ids are in no fold and null languages teach nothing. No rows: no rows.
    """
    network = fit_network(docs, max_per_language)
    sent = Sent(docs.sparkSession, network)

    @F.pandas_udf("lang_pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = sent.value
        tables = model.tables()
        for batch in batches:
            means = []
            for text in batch:
                if text is None or not model.languages or not any(map(str.isalpha, text)):
                    means.append(("und", 0.0))
                    continue
                p = model.probabilities(windows(text), tables).mean(0)
                means.append((model.languages[int(p.argmax())], float(min(1.0, p.max()))))
            yield pd.DataFrame(means, columns=["lang_pred", "score"])

    scored = docs.select("doc_id", (fold(F.col("doc_id"), FOLD) == HELD_OUT).alias("held_out"), of("text").alias("r"))
    return scored.select("doc_id", "held_out", "r.lang_pred", "r.score")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
