import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from gridloom.llm import language_cnn as cnn
from gridloom.llm import ngram_lm as lm
from gridloom.llm import quality_gam as gam
from gridloom.llm.elias_fano import EliasFano, Section, build_section, pack, unpack


def held(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_quality_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = gam.op2_quality_classifier(spark, sf_dir).toPandas()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert rows["score"].between(0, 1).all()
    assert (rows["held_out"] == [held(d, 5) == 0 for d in rows["doc_id"]]).all()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    both = rows[rows["held_out"]].merge(labels, on="doc_id")
    assert (both["predicted"] == both["quality"]).mean() > 0.9


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = gam.AdditiveModel.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.9
    assert gam.AdditiveModel.fit(x[:0], y[:0]).score(x).tolist() == [0.5] * 4000


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, None), (2, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 1), (7, None, 1)], "doc_id long, quality int, toxic int")
    rows = gam.score_documents(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False, False]
    assert {r["score"] for r in gam.score_documents(odd_docs, labels.where("1 = 0")).collect()} == {0.5}
    assert gam.score_documents(no_docs, labels).count() == 0


def test_quality_training_bound(spark, odd_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, quality int")
    measured = labels.selectExpr("doc_id", *[f"cast(doc_id % {k + 2} as double) as {name}" for k, name in enumerate(gam.FEATURES)])
    assert isinstance(gam.fit_model(measured, labels, max_rows=200), gam.AdditiveModel)


def test_language_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = cnn.op5_language_id(spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "n_chars").toPandas()
    both = rows.merge(docs, on="doc_id")
    assert len(both) == len(docs) and set(rows["lang_pred"]) <= {*docs["lang"], "und"}
    assert (both["held_out"] == [held(d, 4) == 2 for d in both["doc_id"]]).all()
    part = both[both["held_out"]]
    assert (part["lang_pred"] == part["lang"]).mean() > 0.95


def test_network_equals_direct_convolution():
    rng = np.random.default_rng(2)
    filters = {w: rng.normal(size=(w, 256, cnn.FILTERS)).astype(np.float32) for w in cnn.WIDTHS}
    model = cnn.ByteNetwork(["a", "b"], filters, rng.normal(size=(len(cnn.WIDTHS) * cnn.FILTERS + 1, 2)).astype(np.float32))
    rows = cnn.windows("Der Weg ist das Ziel. " * 40)
    got = model.probabilities(rows, model.tables())
    for x, p in zip(rows, got):
        pooled = []
        for w in cnn.WIDTHS:
            one_hot = np.eye(256, dtype=np.float32)[x]
            pooled += [max((one_hot[t : t + w] * filters[w][:, :, f]).sum() for t in range(len(x) - w + 1)) for f in range(cnn.FILTERS)]
        logits = np.maximum([*pooled, 1], 0) @ model.out
        assert np.allclose(p, np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum(), atol=1e-4)


def test_windows_hold_every_byte():
    for n in (0, 1, 252, 253, 256, 257, 1000):
        text = "".join(chr(97 + i % 23) for i in range(n))
        rows = cnn.windows(text)
        step = cnn.WINDOW - max(cnn.WIDTHS) + 1
        joined = b"".join(r[:step].tobytes() for r in rows[:-1]) + rows[-1].tobytes()
        assert joined.rstrip(b"\0") == text.encode() and len(joined) - n < cnn.WINDOW + step


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    rows = cnn.identify(odd_docs.drop("score")).collect()
    assert len(rows) == odd_docs.count()
    assert {(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (3, 4, 6)} == {("und", 0.0)}
    assert all(0 <= r["score"] <= 1 for r in rows)
    nothing = odd_docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in cnn.identify(nothing).collect()} == {"und"}
    assert cnn.identify(no_docs).count() == 0


@pytest.mark.parametrize("universe", [50, 10_000, 1 << 61])
def test_elias_fano_round_trip(universe):
    rng = np.random.default_rng(3)
    values = np.sort(rng.integers(0, universe, 3000, dtype=np.uint64))
    seq = EliasFano(unpack(memoryview(pack(EliasFano.build(values, universe, "s")))), "s")
    assert (seq.at(np.arange(len(values))) == values).all()
    asked = np.concatenate([values[::7], rng.integers(0, universe, 2000, dtype=np.uint64), np.array([0, universe - 1], np.uint64)])
    at, same = seq.successor(asked)
    assert (at == np.searchsorted(values, asked)).all() and (same == np.isin(asked, values)).all()


def test_empty_elias_fano():
    seq = EliasFano(pack_of([], 10), "s")
    at, same = seq.successor(np.array([0, 9], np.uint64))
    assert at.tolist() == [0, 0] and not same.any()


def pack_of(values, universe):
    return unpack(memoryview(pack(EliasFano.build(np.array(values, np.uint64), universe, "s"))))


def test_section_look_ups():
    words = np.array([5, 900, 20, 1 << 60], np.uint64)
    blob = build_section(0, 1 << 61, words, np.array([3, 1, 7, 2]), np.array([-0.5, 0.0, -0.25, 0.0]), words[[0, 0, 2]], np.array([1 << 62, 1 << 40, 77 << 30], np.uint64), np.array([1.0, 2.0, 3.0]))
    section = Section(memoryview(blob), 0)
    node, count = section.find(np.array([5, 6, 20, 900, 1 << 60], np.uint64))
    assert count.tolist() == [3, 0, 7, 1, 2] and (node >= 0).tolist() == [True, False, True, True, True]
    gains = section.after(node[[0, 0, 2, 3]], np.array([1 << 62, 1 << 41, 77 << 30, 5], np.uint64))
    assert np.allclose(gains, [1.0, -0.5, 3.0, 0.0], atol=0.2)


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def test_language_model_against_brute_force(spark, sf_dir):
    rows = {r["doc_id"]: r for r in lm.op10_lm_scoring(spark, sf_dir).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    count, pairs, mass = Counter(), Counter(), Counter()
    for i, text in docs.items():
        if held(i, 7) != 2:
            ts = tokens(text)
            count.update(ts)
            pairs.update(zip([b"\n", *ts], ts))
    kept = {k: n for k, n in pairs.items() if n >= lm.MIN_PAIRS}
    for (a, _), n in kept.items():
        mass[a] += n - lm.DISCOUNT
    total, size = sum(count.values()), len(count)
    p = lambda w: (count[w] + 1) / (total + size + 1)
    assert set(rows) == set(docs)
    for i, text in docs.items():
        ts, r, exact = tokens(text), rows[i], 0.0
        for a, b in zip([b"\n", *ts], ts):
            rest = 1 - mass[a] / count[a] if count[a] else 1
            exact += math.log10(rest * p(b) + ((kept[a, b] - lm.DISCOUNT) / count[a] if (a, b) in kept else 0))
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i, 7) == 2, len(ts), sum(count[w] > 0 for w in ts), total)
        assert r["base_score"] == pytest.approx(sum(math.log10(p(w)) for w in ts), abs=1e-6)
        assert r["score"] == pytest.approx(exact, abs=0.1 * len(ts))


def test_pairs_seen_once_are_scored(spark):
    docs = spark.createDataFrame([(1, "red fox ran"), (2, "blue owl sat")], "doc_id long, text string")
    assert {r["c"] for r in lm.count_pairs(docs).collect()} == {1} and lm.count_pairs(docs).count() == 8
    asked = spark.createDataFrame([(1, "red fox"), (2, "red owl")], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in lm.score_texts(asked, docs).collect()}
    assert score[1] > score[2] + 0.2


def test_rounds_and_sections_add_up(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    one = {r["doc_id"]: r for r in lm.score_texts(docs, docs, entries=4000).collect()}
    many = {r["doc_id"]: r for r in lm.score_texts(docs, docs, entries=4000, round_bytes=40_000).collect()}
    whole = {r["doc_id"]: r for r in lm.score_texts(docs, docs).collect()}  # no word is hot, one section
    for i, r in one.items():
        assert r["n_known"] == whole[i]["n_known"] and r["base_score"] == pytest.approx(whole[i]["base_score"])
        assert r["score"] == pytest.approx(whole[i]["score"], abs=0.05 * r["n_tokens"])
        assert many[i]["n_known"] == r["n_known"] and many[i]["score"] == pytest.approx(r["score"]) and many[i]["base_score"] == pytest.approx(r["base_score"])


def test_language_model_of_odd_rows(odd_docs, no_docs):
    rows = lm.score_texts(odd_docs, odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 6)} == {1}
    assert [r["score"] for r in rows if r["doc_id"] == 1][0] == [r["score"] for r in rows if r["doc_id"] == 2][0]
    assert lm.score_texts(no_docs, no_docs).count() == 0
    untaught = lm.score_texts(odd_docs, no_docs).collect()
    assert {r["train_tokens"] for r in untaught} == {0} and {r["score"] for r in untaught} == {0.0}


def test_sections_of_a_round_are_not_copied(spark):
    docs = spark.createDataFrame([(1, "red fox red owl"), (2, "grey fox")], "doc_id long, text string")
    sections, places, _, _ = lm.build_trie(docs.select("text"))
    blob = bytes(sections.first()["blob"])
    trie = lm.RoundTrie([(0, False, blob)], places, {})
    assert np.shares_memory(trie.parts[0][0].gain, np.frombuffer(blob, np.uint8))


def test_unseen_follower_in_an_empty_slice_of_a_frequent_word(spark):
    docs = spark.createDataFrame([(i, "x a") for i in range(8)], "doc_id long, text string")
    places = lm.build_trie(docs.select("text"), entries=4)[1]
    at = lambda w: int(places.of(*(np.array([xxhash.xxh64_intdigest(v)], np.uint64) for v in (b"x", w.encode())))[0])
    free = next(f"w{i}" for i in range(100) if at(f"w{i}") != at("a"))
    row = lm.score_texts(spark.createDataFrame([(1, f"x {free}")], "doc_id long, text string"), docs, entries=4).first()
    pairs, p_end, p_new = (8 - 0.75) / 8, 9 / 28, 1 / 28  # N = 24, V = 3
    rest = 0.75 / 8  # both the end token and x have one follower, seen 8 times
    exact = math.log10(pairs + rest * 9 / 28) + math.log10(rest * p_new) + math.log10(p_end)
    assert row["n_known"] == 2 and row["score"] == pytest.approx(exact, abs=0.02)


def test_rounds_read_the_texts_once_and_the_model_where_it_is(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    plan = lm.score_texts(docs, docs, entries=4000, round_bytes=40_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("MapInArrow") == 1  # several rounds joined a pass over the texts each


def test_a_sequence_that_is_asked_often_is_decoded_and_answers_the_same():
    values = np.unique(np.random.default_rng(5).integers(0, 1 << 40, 4000, dtype=np.uint64))
    asked = np.concatenate([values[::3], values[::5] + np.uint64(1), np.array([0, (1 << 40) - 1], np.uint64)])
    arrays = EliasFano.build(values, 1 << 40, "s")
    few, many = EliasFano(arrays, "s"), EliasFano(arrays, "s")
    for part in np.array_split(asked, 200):
        few.sought = 0
        assert all(np.array_equal(a, b) for a, b in zip(few.successor(part), many.successor(part)))
    assert "values" in vars(many) and "values" not in vars(few)
    assert np.array_equal(many.values, values)


def test_rounds_cut_texts_into_words_like_bytes_do_without_a_list_of_tokens():
    texts = ["", None, " ", " A  b\t\x0b\x0c\r\nB ", "\x1c a\x85b \u00c9 \u00e9", "x " * 30, "y"]
    batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array(range(i, j)), "text": pa.array(texts[i:j], pa.string())}) for i, j in ((0, 0), (0, 3), (3, 7))]
    for most in (1, 4, 1000):
        seen = []
        for ids, lengths, tokens, words, end in lm._rounds(iter(batches), most):
            assert words[end] == lm.END and (np.diff(words.astype(object)) > 0).all()
            for doc_id, found in zip(pa.chunked_array(ids).to_pylist(), np.split(words[tokens], np.cumsum(lengths)[:-1])):
                seen.append((doc_id, found.tolist()))
        expected = [[*map(lm.xxhash.xxh64_intdigest, (t or "").encode().lower().split()), lm.END] for t in texts]
        assert seen == list(enumerate(expected))
    split, counts = lm._words(batches[2].column("text"))
    assert isinstance(split, pa.Array) and counts.tolist() == [3, 4, 30, 1]
