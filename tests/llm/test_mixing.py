import math

import pytest

from gridloom.llm import mixing as mx


def test_exponent_meets_entropy_and_limit(spark):
    shares = spark.createDataFrame([("a", 10, 9000), ("b", 10, 600), ("c", 10, 300), ("d", 2, 0)], "source string, n_docs long, tokens long")
    p = [0.9091, 0.0606, 0.0303]

    def entropy(a):
        q = [x**a for x in p]
        return -sum(x / sum(q) * math.log(x / sum(q)) for x in q)

    a = mx.temperature(shares, mx.MixTarget(entropy=0.8, repetition=1e9))
    assert entropy(a) == pytest.approx(0.8 * math.log(3), abs=1e-3)
    b = mx.temperature(shares, mx.MixTarget(entropy=0.99, repetition=2.0))
    weights = {r["source"]: r for r in mx.mixture_weights(shares, mx.MixTarget(entropy=0.99, repetition=2.0)).collect()}
    assert b > 0 and weights["c"]["weight"] * 9900 / 300 == pytest.approx(2.0, abs=1e-3) and weights["d"]["weight"] == 0
    assert mx.temperature(shares, mx.MixTarget(entropy=0.0)) == 1.0
    assert mx.temperature(shares.where("tokens = 0"), mx.MixTarget()) == 1.0


def test_budget_is_filled_by_whole_permutations(spark, monkeypatch):
    monkeypatch.setattr(mx, "BLOCK", 4)
    rows = [(i, "w " * (1 + i % 7), "big" if i % 3 else f"s{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = mx.MixTarget(entropy=0.9, repetition=3.0)
    plan = {r["source"]: r for r in mx.mixture_weights(mx.source_tokens(docs), target).collect()}
    tokens = {i: 1 + i % 7 for i, _, _ in rows}
    out = mx.mixture(docs, target).collect()
    by_epoch = {}
    for r in out:
        by_epoch.setdefault((r["source"], r["epoch"]), []).append(r)
    for source, p in plan.items():
        for e in range(p["epochs"]):
            assert sorted(r["doc_id"] for r in by_epoch[source, e]) == [i for i, _, s in rows if s == source]
        used = sum(tokens[r["doc_id"]] for r in by_epoch.get((source, p["epochs"]), []))
        assert p["rest"] - 7 < used <= p["rest"] or used == 0 and p["rest"] < 7
    assert len({(r["source"], r["epoch"], r["block"], r["slot"]) for r in out}) == len(out)


def test_odd_rows(odd_docs, no_docs):
    out = mx.mixture(odd_docs).collect()
    assert {r["source"] for r in out} <= {"", "a", "b", "c"}
    mixed = mx.mixed_documents(odd_docs)
    assert mixed.columns == [*odd_docs.columns, "copies"] and mixed.count() <= odd_docs.count()
    assert mx.mixture(no_docs).count() == 0 and mx.mixed_documents(no_docs).count() == 0
