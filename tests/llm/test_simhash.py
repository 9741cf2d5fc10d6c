import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from gridloom.llm import simhash as sh


def slow_fingerprint(text):
    low = "".join(c.lower() if c.isascii() else c for c in text)
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def slow_components(fps, distance):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprint_counts_bits():
    for text in ("", " \n", "one", "one Two", "Äpfel und Birnen und\tÄpfel und Birnen", "A b C " * 50):
        assert sh.fingerprint(text) == slow_fingerprint(text)


def test_query_against_all_pairs(spark, sf_dir):
    rows = sorted(map(tuple, sh.op1_simhash(spark, sf_dir).collect()))
    docs = sorted(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    fps = [slow_fingerprint(t or "") for _, t in docs]
    assert [r[:2] for r in rows] == [(d, f"{fp:016x}") for (d, _), fp in zip(docs, fps)]
    assert [r[2] for r in rows] == [docs[i][0] for i in slow_components(fps, 3)]


def test_dense_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(sh, "BUCKET", 8)
    monkeypatch.setattr(sh, "PROBE_COST", 8.0)  # so that buckets of this size are split
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(60)}
    for _ in range(300):
        value = centre
        for _ in range(rng.randint(0, 4)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    values = sorted(values)
    want = {(min(a, b), max(a, b)) for i, a in enumerate(values) for b in values[:i] if bin(a ^ b).count("1") <= 3}
    frame = spark.createDataFrame([(sh._signed(v),) for v in values], "fp long")
    got = sh.links(frame, 3).select(F.hex("a"), F.hex("b")).collect()
    assert len(got) == len(want)
    assert {tuple(sorted((int(a, 16), int(b, 16)))) for a, b in got} == want


def test_thresholds_cover_every_pair():
    both = np.full((64, 64), 250.0) + np.eye(64) * 250
    for n in (1_000, 10**12):
        scaled = both * n / 1000
        plan = sh.plan_parts(n, scaled, list(range(64)), 3)
        assert sum(t + 1 for _, t in plan) == 4
        assert len({b for part, _ in plan for b in part}) == sum(len(part) for part, _ in plan)
    assert sum(sh.allocate(10**12, both * 10**9, sh.correlated_parts(10**12, both * 10**9, list(range(64)), 2), 3)[1]) == 2


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = dict(map(tuple, sh.components(edges).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_odd_rows(odd_docs, no_docs):
    got = [(r["doc_id"], r["component_id"]) for r in sh.near_duplicates(odd_docs).collect()]
    assert len(got) == odd_docs.count()
    assert {c for d, c in got if d in (1, 2, 8)} == {1}
    assert {c for d, c in got if d in (3, 4, 6)} == {3}
    kept = sh.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 2 and 2 not in ids and 8 not in ids and ids.count(None) == 2
    assert sh.near_duplicates(no_docs).count() == 0 and sh.drop_near_duplicates(no_docs).count() == 0
