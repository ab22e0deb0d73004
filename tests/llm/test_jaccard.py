"""The Jaccard join against all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexarium.llm import jaccard, queries

LOWER = {65 + k: 97 + k for k in range(26)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """(doc_id, n_shingles, component_id) by comparing all that share a shingle."""
    sets = [shingles(t) for _, t in docs]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            holders[g].append(k)
    parent = [*range(len(docs))]

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j > k).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n) and root(k) != root(j):
                parent[root(j)] = root(k)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(([i, len(sets[k]), least.get(root(k))] for k, (i, _) in enumerate(docs)), key=repr)


def rows_of(df):
    return sorted(([r["doc_id"], r["n_shingles"], r["component_id"]] for r in df.collect()), key=repr)


def test_jaccard_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = rows_of(queries.op13_jaccard_join(spark, sf_dir))
    assert got == brute(docs) and sum(r[0] != r[2] for r in got) > 5


@pytest.fixture(scope="module")
def planted():
    """Texts around the threshold: chains of edits, groups of near copies, unrelated texts that share most of a passage or one line,
    short texts, and sizes apart."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    texts = []
    for n in (1, 3, 4, 5, 6, 9, 14, 40, 120, 400):
        base = [word() for _ in range(n)]
        texts += [" ".join(base), " ".join(base)]
        for share in (0.005, 0.02, 0.04, 0.06, 0.1):
            for _ in range(4):
                own = [word() if rng.random() < share else w for w in base]
                texts += [" ".join(own), " ".join(own[: max(1, int(n * 0.85))]), " ".join(own).upper()]
    line = [word() for _ in range(12)]
    texts += [" ".join([*line, *(word() for _ in range(k % 6))]) for k in range(60)]
    passages = [[word() for _ in range(60)] for _ in range(4)]
    texts += [" ".join([*rng.choice(passages), *rng.choice(passages), *(word() for _ in range(k % 40))]) for k in range(80)]
    hot = [word() for _ in range(150)]
    texts += [" ".join(word() if rng.random() < 0.022 else w for w in hot) for _ in range(150)]  # few of these pairs link
    rng.shuffle(texts)
    return [*enumerate(texts)]


@pytest.mark.parametrize("task_tokens", [2000, 1 << 20])
def test_jaccard_links(spark, planted, task_tokens):
    """No link is lost, whether components are verified in one task or by pivots and lots."""
    df = spark.createDataFrame(planted, "doc_id long, text string").repartition(7)
    assert rows_of(jaccard.similar(df, task_tokens=task_tokens)) == brute(planted)


def test_jaccard_at_the_threshold(spark):
    """Of 9 shingles each, 8 shared are 0.8; sets of 8 and 10 with 8 shared too; one fewer isn't enough."""
    w = [f"w{k}" for k in range(40)]
    docs = [(1, " ".join(w[:13])), (2, " ".join([*w[:12], "x"])), (11, " ".join(w[20:32])), (12, " ".join([*w[20:32], "y", "z"])), (21, " ".join([*w[20:32], "p", "q", "r"]))]
    assert rows_of(jaccard.similar(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_jaccard_odd(spark, monkeypatch):
    texts = [None, None, "", " \t\n", "one", "ONE", "one two three", "one two three", "é ü 漢字 😀 " * 30, "É ü 漢字 😀 " * 30, "alpha beta gamma " * 3000, "x" * 5000, "x" * 5000]
    docs = [(k if k != 5 else None, t) for k, t in enumerate(texts)] + [(None, "only nulls here " * 3), (None, "only nulls here " * 3), (3, "one two three")]
    df = spark.createDataFrame([(i, t, -1, "g") for i, t in docs], "doc_id long, text string, size int, node string").repartition(4)
    assert rows_of(jaccard.similar(df)) == brute(docs)
    assert jaccard.similar(df.limit(0)).collect() == []
    assert rows_of(jaccard.similar(df.where("text = 'one'"))) == [[4, 1, 4]]


def test_jaccard_sets_with_one_name(spark, monkeypatch):
    """Names that clash for one seed are made again with the next."""
    made = jaccard.nodes_of
    monkeypatch.setattr(jaccard, "nodes_of", lambda tokens, ends, seed: (made(tokens, ends, seed)[0] * (seed > 1), made(tokens, ends, seed)[1]))
    docs = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h i j k")]
    sets = jaccard._with_node(spark.createDataFrame(docs, "doc_id long, text string"), 1)
    assert sets.select("node").distinct().count() == 1 and sets.select("check").distinct().count() == 2
    assert rows_of(jaccard.similar(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


@pytest.mark.parametrize("sides", [False, True])
def test_forest_spans_all_links(sides):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 40, 80)
    tokens = [np.unique(np.r_[base[rng.random(80) > rng.choice([0, 0.05, 0.1, 0.3])], rng.integers(0, 1 << 40, rng.integers(0, 9))]) for _ in range(300)]
    size, label = np.array([len(t) for t in tokens]), np.arange(300) // 2
    side = rng.integers(0, 2, 300) if sides else None
    links = jaccard.forest(size, label, tokens, side)
    sets = [set(t.tolist()) for t in tokens]
    good = [(i, j) for i in range(300) for j in range(i) if label[i] != label[j] and (side is None or side[i] != side[j]) and jaccard.linked(len(sets[i] & sets[j]), len(sets[i]), len(sets[j]))]

    def classes(pairs):
        root = dict(enumerate(label.tolist()))
        for i, j in pairs:
            a, b = root[i], root[j]
            root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
        return root

    assert classes(links) == classes(good) and len(links) == len(set(label.tolist())) - len(set(classes(good).values()))


def test_first_order_counts_common_tokens_once_a_batch(spark):
    """A token that many sets have leaves one row a batch, and every set still gets its count."""
    texts = [f"own{k} common words stand in every one of these texts here" for k in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    rows = df.mapInArrow(jaccard._first_rows(1), "token long, node long, n long")
    assert rows.where("n <= 0").groupBy("token").count().agg(F.max("count")).first()[0] <= 2
    met = rows.repartition(4, "token").sortWithinPartitions("token").mapInArrow(jaccard._met, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    assert met.count() == 500
