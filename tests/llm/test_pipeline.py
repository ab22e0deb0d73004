"""The pipeline against a brute-force version of each stage, each on the rows that the one before kept."""

from collections import Counter

import corpus_pipeline
import pytest

from lexarium.llm import mixing, shard, toxicity

from .test_operators import brute_components, brute_contamination, brute_fingerprint


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, sf_dir), "test-pipeline")
        out.append(docs)
    return out


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert steps[-1].columns == [*steps[0].columns, "shard", "slot", "bucket"]


def test_toxicity_stage(spark, sf_dir, steps):
    model = toxicity.train(steps[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.with_score(steps[0], model).collect()}
    assert {r["doc_id"] for r in steps[1].collect()} == {d for d, s in scores.items() if s < 0.3}


def test_near_duplicate_stage(steps):
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in steps[1].collect()}
    assert Counter(r["doc_id"] for r in steps[2].collect()) == Counter(set(brute_components(prints).values()))


def test_contamination_stage(spark, sf_dir, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = set()
    for r in steps[2].collect():
        n, hit, _ = brute_contamination(r["text"], items)
        if not (hit and 20 * hit >= n):
            want.add(r["doc_id"])
    assert {r["doc_id"] for r in steps[3].collect()} == want


def test_mixing_stage(steps):
    before, after = {r["doc_id"] for r in steps[3].collect()}, Counter(r["doc_id"] for r in steps[4].collect())
    assert set(after) == before and max(after.values()) <= mixing.MAX_REPEATS


def test_sharding_stage(steps):
    rows = steps[5].collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in steps[4].collect())
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) <= set(range(shard.SHARDS)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run(spark, sf_dir, steps):
    key = lambda df: sorted((r["doc_id"], r["shard"], r["slot"]) for r in df.select("doc_id", "shard", "slot").collect())
    assert key(corpus_pipeline.run(spark, sf_dir)) == key(steps[-1])


def test_stages_on_odd_rows(spark, sf_dir):
    """Null, empty, long and repeated rows, and columns named like what the stages add, come through as they are."""
    texts = [(1, None), (2, ""), (3, "plain words of a text that is clean " * 3), (4, "alpha beta " * 20000), (5, "one two three"), (5, "one two three"), (None, "ones two three four"), (None, None), (6, "x" * 5000)]
    docs = spark.createDataFrame([(i, t, "en" if k % 2 else None, None if k % 3 else "s", k, "own", 1.5, "z") for k, (i, t) in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars int, epoch string, n_words double, component_id string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and {r["epoch"] for r in rows} == {"own"} and {r["n_words"] for r in rows} == {1.5}, name
        assert {(r["doc_id"], r["text"]) for r in rows} <= set(texts), name
        assert {3, 4, 6} <= {r["doc_id"] for r in rows}, name
        assert stage(spark, docs.where("false"), sf_dir).count() == 0, name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, sf_dir).count() == len(texts) and last(spark, docs.where("false"), sf_dir).count() == 0
