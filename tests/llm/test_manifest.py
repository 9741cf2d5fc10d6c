import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from gridloom.llm import merkle as mk


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_tree(nodes):
    """Root, and for every node its (place, run) from below to the root."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i in range(len(steps)):
            start = at[i] // 8 * 8
            steps[i].append((at[i] % 8, nodes[start : start + 8]))
            at[i] //= 8
        nodes = [H(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], steps


def slow_leaf(doc):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in doc))


def slow_manifest(docs):
    trees = defaultdict(list)
    for doc in docs:
        trees[(doc[2] is not None, (doc[2] or "").encode())].append(doc)
    subroots, rows = [], []
    for key in sorted(trees):
        members = sorted(trees[key], key=lambda d: (d[0] is not None, d[0] or 0, slow_leaf(d)))
        subroot, steps = slow_tree([slow_leaf(d) for d in members])
        subroots.append(subroot)
        rows.append([(d, s) for d, s in zip(members, steps)])
    root, tops = slow_tree(subroots)
    out = []
    for subroot, members, top in zip(subroots, rows, tops):
        for d, steps in members:
            node = leaf = slow_leaf(d)
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and d[4] is not None:
                node = slow_leaf((*d[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in d[4])))
            proof = []
            for at, run in [*steps, *top]:
                proof += run[:at] + run[at + 1 :]
                node = H(*run[:at], node, *run[at + 1 :])
            out.append((d[0], leaf, subroot, root, H(*proof), node, node == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def tampered():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


def test_manifest_against_brute_force(spark):
    """Several superblocks and rounds, many trees, null fields and ids, ties and repeated rows."""
    rng = random.Random(4)
    langs = [None, "", "-", "=", "de", "zz", "\u00e9", *[f"l{i}" for i in range(15)]]
    docs = [(i if i % 50 else None, rng.choice(["a", None]), "en" if i % 2 else rng.choice(langs), rng.choice([None, i]), rng.choice([None, "", "Text É\n", "low"])) for i in range(700)]
    docs += [docs[1]] * 20 + [(5, None, "en", 1, "Z")]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA + ", leaf string, pos int")
    want = slow_manifest(docs)
    for levels in (1, 3):
        got = mk.manifest(mk.document_leaves(frame, tampered()), levels=levels)
        assert got.columns == COLUMNS
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert {r[-1] for r in want} == {True, False}


def test_small_manifests(spark, odd_docs, no_docs):
    one = spark.createDataFrame([(1, None, "en", None, "A")], SCHEMA)
    row = mk.manifest(mk.document_leaves(one), proofs=True).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof"] == "" and row["verified"]
    assert row["proof_sha256"] == H() and row["leaf"] == H("1:1", "-", "2:en", "-", "1:A")
    with_count = odd_docs.withColumn("n_chars", F.length("text"))
    rows = mk.manifest(mk.document_leaves(with_count)).collect()
    assert len(rows) == odd_docs.count() and all(r["verified"] for r in rows) and len({r["root"] for r in rows}) == 1
    assert mk.manifest(mk.document_leaves(no_docs.withColumn("n_chars", F.lit(1)))).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted((tuple(r) for r in mk.op12_merkle_manifest(spark, sf_dir).collect()), key=str) == slow_manifest(docs)
