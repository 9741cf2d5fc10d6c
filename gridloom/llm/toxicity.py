"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

Lexicons are a fixed list of insults and the words and word beginnings that go with toxic labels in
a bounded sample. A text is read once and leaves the bits of its voters and the lexicon entries it
holds. The label model is a mixture of two classes over the votes of all training documents, with
each voter's rate in both classes and the correlations of voters within a class; a known label is one
more voter with an accuracy of its own. Its posteriors train the linear classifier that scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import fold, stored, table, texts

FOLD, HELD_OUT = 5, 0
THRESHOLD = 0.5
#: Labelled rows that the lexicons are learned from at most, training rows of the classifier at most, lexicon entries at most.
MAX_LABELLED, MAX_TRAINING, MAX_ENTRIES = 20_000, 20_000, 1_000
#: An entry is held by so many toxic texts of the sample at least, that are no near copies of each other, and its log-likelihood ratio is at least this.
MIN_TOXIC, MIN_RATIO = 3, 24.0
PREFIXES = (4, 5, 6)

#: Insults in four languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid trash scum loser losers clown worthless pathetic disgusting dumb filth vermin jerk imbecile "
    "dumm trottel abschaum widerlich versager dreckig imbécile crétin ordure minable stupide idiota estúpido basura imbécil asqueroso patético".split()
)
#: Words that address or name a person.
PERSONS = frozenset("you your youre he she they them these du ihr sie tu vous ils tú usted ustedes ellos".split())

VOTERS = (
    "insult", "insults", "toxic_word", "toxic_words", "likely_word", "toxic_beginning", "toxic_beginnings", "likely_beginning",
    "dense", "person_near", "hits_near", "shouted", "no_hit", "one_hit_in_long_text",
)
INSULT, WORD, LIKELY_WORD, BEGINNING, LIKELY_BEGINNING = range(5)
COUNTS = 7  # measurements beside the votes
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _WORD.findall(text.lower())


def units_of(word: str) -> list[str]:
    """The word, and its beginnings where it goes on for two letters at least."""
    return [word, *(f"{word[:k]}-" for k in PREFIXES if len(word) >= k + 2)]


def text_key(words: list[str]) -> int:
    """The least hash of a five-word window: near copies mostly share it, other texts do not."""
    windows = range(max(1, len(words) - 4))
    return min(xxhash.xxh64_intdigest(" ".join(words[i : i + 5])) for i in windows) - (1 << 63)


def learn_lexicon(sample: DataFrame) -> dict[str, int]:
    """Entry → kind, from ``text, y``: units of toxic texts with their log-likelihood ratio against all texts; the strongest ``MAX_ENTRIES``.

    Of texts that share a five-word window key one counts, so a copied text does not make its words toxic.
    """

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(key=[text_key(words_of(t)) for t in pdf["text"]])[["key", "y", "text"]]

    once = stored(sample.select("text", "y").mapInPandas(keyed, "key long, y int, text string").groupBy("key").agg(F.max(F.struct("y", "text")).alias("r")).select("r.*"), "toxic-sample")

    def count(batches: Iterator[pd.DataFrame], wanted=None) -> Iterator[pd.DataFrame]:
        known = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                units = {u for w in set(words_of(text)) for u in units_of(w)}
                known.update(units if wanted is None else units & wanted.value)
        if known:
            yield pd.DataFrame({"unit": list(known.keys()), "n": list(known.values())})

    def counted(rows: DataFrame, wanted=None) -> DataFrame:
        return rows.select("text").mapInPandas(lambda batches: count(batches, wanted), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))

    sizes = once.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("t")).first()
    total, toxic = sizes["n"], sizes["t"] or 0
    if not toxic or toxic == total:
        return {}
    held = {r["unit"]: r["n"] for r in counted(once.where("y = 1")).where(F.col("n") >= MIN_TOXIC).collect()}  # bounded by the sample
    everywhere = counted(once, once.sparkSession.sparkContext.broadcast(frozenset(held))).collect()
    share, found = toxic / total, []
    for unit, n in ((r["unit"], r["n"]) for r in everywhere):
        t = held[unit]
        precision = (t + 2 * share) / (n + 2)
        outside = (toxic - t) / max(1, total - n)
        ratio = 2 * (_entropy(t, n, t / n) + _entropy(toxic - t, total - n, outside) - _entropy(toxic, total, share))
        if ratio >= MIN_RATIO and precision >= 0.5:
            found.append((-ratio, unit, precision))
    kinds = {}
    for _, unit, precision in sorted(found)[:MAX_ENTRIES]:
        kinds[unit] = (BEGINNING if precision >= 0.9 else LIKELY_BEGINNING) if unit.endswith("-") else (WORD if precision >= 0.9 else LIKELY_WORD)
    return kinds


def _entropy(t: float, n: float, p: float) -> float:
    """Log-likelihood of ``t`` of ``n`` at rate ``p``."""
    return (t * np.log(p) if t else 0.0) + ((n - t) * np.log(1 - p) if n > t else 0.0)


class Voters:
    """The votes over a text; ``entries`` number the lexicon's entries from 0."""

    def __init__(self, lexicon: dict[str, int]):
        self.entries = [*sorted(INSULTS - lexicon.keys()), *sorted(lexicon)]
        self.number = {e: i for i, e in enumerate(self.entries)}
        self.kinds = [{INSULT} if e not in lexicon else {lexicon[e], INSULT} if e in INSULTS else {lexicon[e]} for e in self.entries]
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            found = tuple(self.number[u] for u in units_of(word) if u in self.number)
            if len(self.known) < 500_000:
                self.known[word] = found
        return found

    def __call__(self, text: str) -> tuple[int, list[int], list[float]]:
        """The voters' bits, the entries held, and ``COUNTS`` measurements."""
        words = words_of(text)
        hits = [(i, found) for i, found in enumerate(map(self.of_word, words)) if found]
        if not hits:
            return (1 << VOTERS.index("no_hit") if words else 0), [], [0.0] * COUNTS
        per_kind, held = [0] * 5, {}
        for _, found in hits:
            for entry in found:
                held[entry] = held.get(entry, 0) + 1
            for kind in set().union(*(self.kinds[e] for e in found)):
                per_kind[kind] += 1
        distinct = [sum(k in self.kinds[e] for e in held) for k in range(5)]
        places = [i for i, _ in hits]
        votes = (
            per_kind[INSULT] > 0, per_kind[INSULT] > 1, per_kind[WORD] > 0, distinct[WORD] > 1, per_kind[LIKELY_WORD] > 0, per_kind[BEGINNING] > 0,
            per_kind[BEGINNING] > 2, per_kind[LIKELY_BEGINNING] > 0, 100 * len(hits) >= len(words), any(not PERSONS.isdisjoint(words[max(0, i - 3) : i]) for i in places),
            any(b - a <= 8 for a, b in zip(places, places[1:])), any(words[i].upper() in text for i in places if len(words[i]) > 3) or "!!" in text,
            False, len(hits) == 1 and len(words) >= 200,
        )
        counts = [float(np.log1p(n)) for n in per_kind] + [float(np.log1p(len(hits))), min(1.0, len(hits) / len(words) * 10)]
        return sum(1 << k for k, vote in enumerate(votes) if vote), sorted(held), counts


def vote(docs: DataFrame, lexicon: dict[str, int]) -> DataFrame:
    """``doc_id, votes, entries, counts`` of every row of ``docs``; null texts are empty."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("votes int, entries array<int>, counts array<float>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        voters = Voters(sent.value)
        for batch in batches:
            yield pd.DataFrame([voters(t) for t in batch], columns=["votes", "entries", "counts"])

    return texts(docs).select("doc_id", of("text").alias("v")).select("doc_id", "v.*")


def bits_of(votes: np.ndarray) -> np.ndarray:
    return ((votes[:, None] >> np.arange(len(VOTERS))) & 1).astype(float)


@dataclass
class LabelModel:
    """Rates of the voters in both classes, their correlations within a class, the share of the toxic class and the accuracy of known labels."""

    rates: np.ndarray
    correlations: np.ndarray
    share: float
    accuracy: np.ndarray  # of a label in (clean, toxic)

    @classmethod
    def fit(cls, votes: np.ndarray, labels: np.ndarray, n: np.ndarray, rounds: int = 40) -> LabelModel:
        """Expectation and maximisation over distinct (votes, label) with their counts; label -1: not known.

        Starts from the labels, and from the fixed and learned word lists where there is none.
        """
        x = bits_of(votes)
        start = 0.05 + 0.9 * (x[:, [0, 2, 5]].max(axis=1) if len(x) else np.zeros(0))
        p = np.where(labels < 0, start, np.where(labels == 1, 0.95, 0.05))
        model = None
        for _ in range(rounds):
            w0, w1 = n * (1 - p), n * p
            totals = np.array([w0.sum(), w1.sum()]) + 1.0
            rates = np.stack([(w @ x + 0.5) / (t + 1) for w, t in zip((w0, w1), totals)]).clip(1e-6, 1 - 1e-6)
            covariance = sum(((x - r) * w[:, None]).T @ (x - r) for w, r in zip((w0, w1), rates)) / totals.sum()
            spread = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
            related = (covariance / np.outer(spread, spread)).clip(-1, 1)
            np.fill_diagonal(related, 1.0)
            right = [(np.where(labels == c, w, 0).sum() + 9.5) / (np.where(labels >= 0, w, 0).sum() + 10) for c, w in ((0, w0), (1, w1))]
            model = cls(rates, related, float(totals[1] / totals.sum()), np.array(right))
            p = model.posterior(votes, labels)
        return model

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Probability of the toxic class. Each vote counts with its log-likelihood ratio, divided by the voter's squared correlations, itself
        included: voters that copy each other share one vote."""
        x, (r0, r1) = bits_of(votes), self.rates
        share = 1 / (self.correlations**2).sum(axis=0)
        odds = x @ (share * np.log(r1 / r0)) + (1 - x) @ (share * np.log((1 - r1) / (1 - r0))) + np.log(self.share / (1 - self.share))
        odds += np.where(labels == 1, np.log(self.accuracy[1] / (1 - self.accuracy[0])), np.where(labels == 0, np.log((1 - self.accuracy[1]) / self.accuracy[0]), 0.0))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def design(votes: np.ndarray, entries: list, counts: list, width: int) -> np.ndarray:
    """Rows of votes, measurements and entries held."""
    out = np.zeros((len(votes), len(VOTERS) + COUNTS + width), dtype=np.float32)
    out[:, : len(VOTERS)] = bits_of(votes)
    if len(votes):
        out[:, len(VOTERS) : len(VOTERS) + COUNTS] = np.stack([np.asarray(c, dtype=np.float32) for c in counts])
    for i, held in enumerate(entries):
        out[i, np.asarray(held, dtype=np.int64) + len(VOTERS) + COUNTS] = 1
    return out


def fit_linear(x: np.ndarray, p: np.ndarray, penalty: float = 1.0, rounds: int = 300) -> np.ndarray:
    """Weights and intercept of a logistic model for probabilities ``p``, by accelerated gradient steps."""
    x = np.column_stack([x, np.ones(len(x), np.float32)])
    w = look = np.zeros(x.shape[1])
    if not len(p):
        return w
    step = 1 / (0.25 * float((x**2).sum(axis=1).mean()) + penalty / len(p))
    shrink = np.full(len(w), penalty / len(p))
    shrink[-1] = 0
    for k in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(x @ look, -30, 30))) - p
        now = look - step * (x.T @ error / len(p) + shrink * look)
        look, w = now + k / (k + 3) * (now - w), now
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_training: int = MAX_TRAINING) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Lexicons and the classifier are fitted on bounded samples, drawn by a hash of the id outside
    the held-out fold; the label model counts the votes of all rows outside of it (at most three rows for each of
    the 2 ** 14 sets of votes reach the driver). Null and empty texts are scored like any
    other, without hits. A document with several labels has their mean, rounded up from one half;
    null labels do not count. A null id is in no fold and has no label. Repeated rows get
    equal scores. Without toxic labels only the fixed list votes. No rows: no rows.
    """
    spark = docs.sparkSession
    ours = fold(F.col("doc_id"), FOLD) != HELD_OUT
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ours).groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("y"))
    known = stored(known, "toxic-labels")
    drawn = _sample(known, max_labelled)
    base = texts(docs)
    lexicon = learn_lexicon(base.join(F.broadcast(drawn), "doc_id"))  # ids and labels of at most ``max_labelled`` rows
    voted = stored(vote(docs, lexicon), "toxic-votes")
    train = stored(voted.where(ours).join(known, "doc_id", "left").withColumn("y", F.coalesce("y", F.lit(-1))), "toxic-training")
    patterns = train.groupBy("votes", "y").agg(F.count(F.lit(1)).alias("n")).orderBy("votes", "y").toPandas()
    label_model = LabelModel.fit(patterns["votes"].to_numpy(np.int64), patterns["y"].to_numpy(np.int64), patterns["n"].to_numpy(float))
    rows = _sample(train, max_training).toPandas().sort_values(["doc_id", "votes"], kind="stable")
    votes = rows["votes"].to_numpy(np.int64)
    width = len(Voters(lexicon).entries)
    weights = fit_linear(design(votes, list(rows["entries"]), list(rows["counts"]), width), label_model.posterior(votes, rows["y"].to_numpy(np.int64)))
    sent = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def of(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for v, entries, counts in batches:
            x = design(v.to_numpy(np.int64), list(entries), list(counts), width)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ sent.value[:-1] + sent.value[-1], -30, 30))))

    scored = voted.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLD) == HELD_OUT, F.lit(False)).alias("held_out"), of("votes", "entries", "counts").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, drawn by a hash of the id; a tenth less is expected, so that the bound holds."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * 0.9 * most / n)).limit(most)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
