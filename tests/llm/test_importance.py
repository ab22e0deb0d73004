"""Importance resampling against a plain version over Python's own words and CRCs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from lexarium.llm import importance, queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {65 + k: 97 + k for k in range(26)}
COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), Counter(zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1))


def brute(docs, target):
    own = [(i, *features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in own:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    S, T = s.total(), t.total()
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (S + 10000) / ((s[k] + 1) * (T + 10000))))
    rows = []
    for i, n, f in own:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(k) * m for k, m in f.items())
        rows.append([i, f.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(fit[: 5 * len(fit) // 100]):
        r[4] = k + 1
    return sorted((r[:5] for r in rows), key=repr)


def rows_of(df):
    return sorted(([r[c] for c in COLUMNS] for r in df.collect()), key=repr)


def test_resampling_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    assert rows_of(queries.op12_importance_resampling(spark, sf_dir)) == brute(docs, target)


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_resampling_odd(spark, monkeypatch, block):
    """Null, empty and wordless texts, 19 and 20 words, ties, repeated rows and ids, a long text, letters beyond ASCII, other columns."""
    monkeypatch.setattr(importance, "BLOCK", block)
    texts = [None, "", " .,;", "one", "one two", "w " * 19, "w " * 20, "É é ÀB àb 漢字 x_y-z 9", "alpha beta gamma " * 4000]
    docs = [*enumerate(texts), *((k % 40 or None, f"Tie {k % 3} " * 15) for k in range(200)), *((7, "same words here now " * 9) for _ in range(30))]
    target = [None, "", "alpha beta", "tie 1 tie 1 tie"]
    df = spark.createDataFrame([(i, t, -1, "f") for i, t in docs], "doc_id long, text string, rank int, buckets string").repartition(5)
    assert rows_of(importance.resample(df, spark.createDataFrame([(t, "s") for t in target], "text string, score string"))) == brute(docs, target)


def test_resampling_draws_many_ranges_in_order(spark):
    """Ranks run on over the ranges, whatever their number."""
    scores = spark.range(5000).selectExpr("id AS doc_id", "100L AS n_features", "id % 50 AS weight", "id * 37 % 400 AS score")
    got = importance.drawn(scores, share=(30, 100)).where("rank IS NOT NULL").orderBy("rank").collect()
    want = sorted(((k * 37 % 400, k) for k in range(5000)), key=lambda x: (-x[0], x[1]))[:1500]
    assert [(r["score"], r["doc_id"]) for r in got] == want and [r["rank"] for r in got] == [*range(1, 1501)]


def test_resampling_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert importance.resample(none, some).collect() == []
    assert rows_of(importance.resample(some, none)) == brute([(1, "a b c")], [])


def test_features_of_words():
    assert [importance.features_of(n) for n in (0, 1, 2, 3, 20)] == [0, 1, 3, 6, 57]


def test_run_crcs_are_those_of_zlib():
    """Words of any length in bytes, empty lists, chunks and slices."""
    words = ["é漢9"[k % 3] * (k // 2) + "a" * (k % 5 + 1) for k in range(150)]
    lists = [[], ["a"], ["a", "b"], words, [], ["b" * n for n in (7, 63, 64, 65, 4095, 4096, 4097, 300000, 1)], words[:3], []]
    want = [[zlib.crc32(" ".join(w[i : i + n]).encode()) for i in range(len(w)) for n in (1, 2, 3) if i + n <= len(w)] for w in lists]
    chunks = pa.chunked_array([lists[:3], lists[3:]], pa.list_(pa.string()))
    for column in (pa.array(lists), chunks, pa.array([["z", "y"], *lists, ["q"]]).slice(1, len(lists))):
        assert importance.run_crcs(column).to_pylist() == want
    assert importance.run_crcs(pa.array([[], []], pa.list_(pa.string()))).to_pylist() == [[], []]


def test_runs_get_their_crcs_from_their_words(monkeypatch):
    """The work of a run is a few table steps: no string is made of it, and zlib is not called for it."""
    crc32, calls = zlib.crc32, []
    monkeypatch.setattr(zlib, "crc32", lambda *a: calls.append(1) or crc32(*a))
    db = importance.connect()
    db.register("texts", pa.table({"row": [0, 1], "text": ["Some words here " * 500, "x" * 100 + " y"]}))
    rows = db.execute(importance.SQL.format(buckets=10000)).fetchall()
    assert len(calls) < 10
    for k, text in enumerate(["Some words here " * 500, "x" * 100 + " y"]):
        assert {b: n for r, b, n in rows if r == k} == features(text)[1]


@pytest.mark.parametrize("buckets", [7, 1 << 16, 100_000])
def test_features_are_packed_without_loss(spark, monkeypatch, buckets):
    """Two or four bytes a bucket and one a count; counts of 255, 256 and many times that, rows without features, blocks of a few rows."""
    texts = [None, "", "a " * 255, "b " * 256, "c " * 255 * 3, "one two three four", "", "d " * 5000 + "e", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    made = importance.with_features(df, keep=["doc_id"], buckets=buckets).orderBy("doc_id").toArrow().combine_chunks().to_batches()[0]
    monkeypatch.setattr(importance, "BLOCK", 3)
    got, total = [Counter() for _ in texts], Counter()
    for i, j, at, n, ends in importance._unpacked(made["buckets"], made["counts"], importance._kind(buckets)):
        for k in range(i, j):
            for b, m in zip(at[ends[k - i] : ends[k - i + 1]].tolist(), n[ends[k - i] : ends[k - i + 1]].tolist()):
                got[k][b] += m
    for k, text in enumerate(texts):
        w = WORD.findall(text or "")
        want = Counter(zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1))
        assert got[k] == want and made["n_features"][k].as_py() == want.total()
        total += want
    assert Counter({b: n for b, n in enumerate(importance.bucket_counts(importance.with_features(df, keep=[], buckets=buckets), buckets)) if n}) == total
