import corpus_pipeline as cp
from gridloom.llm import decontaminate, quality_gam, simhash


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = [docs]
    for _, stage in cp.STAGES:
        steps.append(cp.stored(stage(spark, steps[-1], sf_dir), "test-stage"))
    assert all(s.columns == docs.columns for s in steps[:-1]) and steps[-1].columns == [*docs.columns, "copies"]
    ids = [{r["doc_id"]: r["text"] for r in s.collect()} for s in steps]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = {r["doc_id"]: r["predicted"] for r in quality_gam.score_documents(docs, labels).collect()}
    assert set(ids[1]) == {d for d in ids[0] if scored[d]}
    assert set(ids[2]) == set(ids[1])
    roots = {r["component_id"] for r in simhash.near_duplicates(steps[2]).collect()}
    assert set(ids[3]) == roots
    leaked = {r["doc_id"] for r in decontaminate.contaminated(steps[3], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert set(ids[4]) == set(ids[3]) - leaked
    assert set(ids[5]) <= set(ids[4])
    assert sorted(map(str, cp.run(spark, sf_dir).collect())) == sorted(map(str, steps[-1].collect()))


def test_stages_of_odd_rows(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns and out.count() <= docs.count()
        out = cp.mix(spark, docs, sf_dir)
        assert out.columns == [*docs.columns, "copies"] and out.count() <= docs.count()


def test_a_leak_without_id_removes_only_itself(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    rows = [(None, f"Before it. {item}"), (None, "nothing of the kind"), (None, None), (1, item), (1, "another text"), (2, "clean")]
    left = cp.decontaminate(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir).collect()
    assert sorted(map(str, (tuple(r) for r in left))) == sorted(map(str, [rows[1], rows[2], rows[4], rows[5]]))
