import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import toxicity as tx
from gridloom.llm.common import fold


def bit(votes, name):
    return votes >> tx.VOTERS.index(name) & 1


def test_votes_of_texts():
    voters = tx.Voters({"vequais": tx.WORD, "lowe-": tx.BEGINNING, "maybe": tx.LIKELY_WORD, "trash": tx.WORD})
    votes, entries, counts = voters("You IDIOT and trash, vequais loweient lowei. Maybe!")
    for name in ("insult", "insults", "toxic_word", "toxic_words", "likely_word", "toxic_beginning", "dense", "person_near", "hits_near", "shouted"):
        assert bit(votes, name), name
    assert not bit(votes, "no_hit") and not bit(votes, "likely_beginning") and not bit(votes, "toxic_beginnings")
    assert {voters.entries[e] for e in entries} == {"idiot", "trash", "vequais", "lowe-", "maybe"} and len(counts) == tx.COUNTS
    assert voters("")[0] == 0 and voters("nothing here")[0] == 1 << tx.VOTERS.index("no_hit")
    votes, entries, _ = voters("a quiet moron among them " + "word " * 300)
    assert bit(votes, "one_hit_in_long_text") and not bit(votes, "dense") and not bit(votes, "insults")


def test_label_model_recovers_accuracies_and_correlations():
    """Two voters that copy each other count less than two that agree on their own, and rates come out without labels."""
    rng = np.random.default_rng(2)
    n = 40_000
    y = rng.random(n) < 0.2
    hit = lambda p1, p0: rng.random(n) < np.where(y, p1, p0)
    columns = np.zeros((n, len(tx.VOTERS)), dtype=np.int64)
    columns[:, 0], columns[:, 2], columns[:, 5], columns[:, 8] = hit(0.8, 0.02), hit(0.7, 0.03), hit(0.6, 0.01), hit(0.5, 0.1)
    columns[:, 9] = np.where(rng.random(n) < 0.95, columns[:, 8], 1 - columns[:, 8])
    votes = columns @ (1 << np.arange(len(tx.VOTERS)))
    patterns, counts = np.unique(votes, return_counts=True)
    model = tx.LabelModel.fit(patterns, np.full(len(patterns), -1), counts.astype(float))
    assert abs(model.share - 0.2) < 0.03
    for k, p1, p0 in ((0, 0.8, 0.02), (2, 0.7, 0.03), (5, 0.6, 0.01), (8, 0.5, 0.1)):
        assert abs(model.rates[1][k] - p1) < 0.06 and abs(model.rates[0][k] - p0) < 0.03
    related = model.correlations
    assert related[8, 9] > 0.5 and abs(related[0, 2]) < 0.15
    assert ((model.posterior(votes, np.full(n, -1)) >= 0.5) == y).mean() > 0.93


def test_toxicity_on_held_out_documents(spark):
    path = "/root/testdata/sf0.1"
    scored = tx.op11_toxicity(spark, path)
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    print("toxic caught", np.mean(toxic), "clean kept", 1 - np.mean(clean))
    assert np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.02


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (3, None, "x"), (None, 1, "x"), (4, 0, "x")], "doc_id long, toxic int, votes string")
    out = tx.score_toxicity(odd_docs, labels)
    rows = out.collect()
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and len(rows) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows) and not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    assert tx.score_toxicity(no_docs, labels).count() == 0
    assert tx.score_toxicity(odd_docs, labels.where("1 = 0")).count() == len(rows)


@pytest.mark.parametrize("change", ["labels", "languages"])
def test_held_out_labels_teach_nothing(spark, sf_dir, change):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    held = fold(F.col("doc_id"), tx.FOLD) == tx.HELD_OUT
    if change == "labels":
        other = docs, labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    else:
        other = docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")}), labels
    first, second = (sorted((tuple(r) for r in tx.score_toxicity(*pair).collect())) for pair in ((docs, labels), other))
    assert first == second
