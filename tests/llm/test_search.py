import math
import random
import re
from collections import Counter

import numpy as np

from gridloom.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow_search(docs, items, top=50):
    counts = [(i, Counter(slow_terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    N, L, df = len(counts), sum(n for _, _, n in counts), Counter(t for _, c, _ in counts for t in c)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(slow_terms(t))
    out = []
    for item, terms in queries.items():
        scores = []
        for i, c, n in counts:
            m = 50 + (50 * n * N) // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                scores.append((-s, i is not None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_varint_round_trip():
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(0, 1 << int(b), 200) for b in rng.integers(1, 33, 30)] + [[0, 127, 128, (1 << 32) - 1]])
    raw, starts = ls.varint(values)
    assert (ls.unvarint(raw) == values).all() and starts[-1] == len(raw)
    part = raw[starts[10] : starts[20]]
    assert (ls.unvarint(part) == values[10:20]).all()


def test_query_against_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(ls.op13_ranked_search(spark, sf_dir)) == slow_search(docs, items)


def test_blocks_and_shards(spark, monkeypatch):
    """Small blocks and shards, skewed words, many equal scores, several batches of items: the same rows, and blocks that are never read."""
    monkeypatch.setattr(ls, "BLOCK", 4)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(rng.randrange(3000), " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for _ in range(900)]
    docs += [(i, "W1 w1. rare") for i in range(5000, 5040)] + [(7, None), (8, " -- "), (None, "w2 Rare rare"), (9, "rare " * 400)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 30)))) for i in range(25)] + [(30, "rare W1"), (30, "w5"), (31, None), (32, "unknown"), (None, "w3"), (33, "rare w0 w1 w2 w3 w4 w5")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(3)
    index = ls.stored_index(frame, shard_bytes=9_000)
    assert index.count() > 6
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    for top, batch in ((50, 10_000), (5, 60)):
        assert rows(ls.search(index, benchmark, top, batch)) == slow_search(docs, items, top)
    ids, texts = zip(*[(i, ls.terms_of(t)) for i, t in docs if ls.terms_of(t)])
    row = ls.build_shard(list(ids), list(texts))
    shard = ls.Shard(row["terms"], row["blob"], row["n_docs"], row["n_terms"])
    found, scores = shard.search([shard.term_at[t] for t in (b"rare", b"w0", b"w1", b"w2")], [9000, 10, 10, 10], 3, 0)
    assert shard.decoded < int(shard.first[[shard.term_at[t] + 1 for t in (b"rare", b"w0", b"w1", b"w2")]].sum() - shard.first[[shard.term_at[t] for t in (b"rare", b"w0", b"w1", b"w2")]].sum()) / 2


def test_search_of_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "alpha BETA word"), (2, "")], "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert rows(ls.search(ls.stored_index(odd_docs), items)) == slow_search(docs, [(1, "alpha BETA word"), (2, "")])
    assert ls.search(ls.stored_index(no_docs), items).count() == 0
    assert ls.search(ls.stored_index(odd_docs), items.where("1 = 0")).count() == 0
