"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its distinct words, the first ``STEM`` letters of longer ones (a stem that any language has), word pairs and
pairs with one word between them, hashed to ``1 << BITS`` coordinates.
Training takes a bounded sample of labelled rows, chosen by a hash of id and text, and makes one pass after another with a learning
rate for each coordinate; the L1 term leaves few weights that are not zero, so the model is small enough to broadcast whatever the
corpus (at most ``1 << BITS`` weights). Scoring is one vectorised pass over the bytes of every whole text.

Rows fall in four folds by the crc32 of their id. Fold ``HELD_OUT`` is never learned from, nor were the rates chosen on it: ``tune``
learns from folds 0 and 1 and judges on fold 3.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, LOWER, attach, fresh, prefix_hash, span_hash, staged, text_blocks, mix, word_spans

BITS = 20
STEM = 5
#: Most labelled rows, and bytes of their texts, of each label in the training sample, on average; longer texts are not in it.
SAMPLE = {1: 6000, 0: 10000}
SAMPLE_BYTES, TEXT_BYTES = 64 << 20, 1 << 20
PASSES, ALPHA, BETA, L1, L2 = 2, 2.0, 1.0, 5.0, 0.1
THRESHOLD = 0.3
SEED = 5
FOLDS, HELD_OUT = 4, 2

_W = [np.uint64(w) for w in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, modulo FOLDS; null for a null id."""
    return F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % FOLDS


def held_out(doc_id: str) -> Column:
    """Whether the id is of fold HELD_OUT; a null id is not."""
    return F.coalesce(fold(doc_id) == HELD_OUT, F.lit(False))


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, coordinate) of every word, stem, pair and skip pair of a block, repeats included."""
    low = LOWER[buf]
    s, e, first = word_spans(low, offs, ALNUM)
    acc = prefix_hash(low)
    h = span_hash(acc, s, e)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    shift = np.uint64(64 - BITS)
    parts = [(text, h >> shift)]
    letters = np.flatnonzero((low & 0xC0) != 0x80)
    stop = np.append(letters, len(low))[np.minimum(np.searchsorted(letters, s) + STEM, len(letters))]
    some = stop < e
    parts.append((text[some], mix(span_hash(acc, s[some], stop[some]) * _W[0]) >> shift))
    for gap, a, b in ((1, _W[0], _W[1]), (2, _W[2], _W[3])):
        if len(h) > gap:
            own = text[:-gap] == text[gap:]
            parts.append((text[:-gap][own], mix(h[:-gap] * a + h[gap:] * b)[own] >> shift))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int64)


@dataclass
class Model:
    bias: float
    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS)
        w[self.index] = self.weight
        return w


def score(column: pa.Array, model: Model, dense: np.ndarray) -> np.ndarray:
    out = []
    for i, j, buf, offs in text_blocks(column):
        text, at = features(buf, offs)
        some = dense[at] != 0
        pairs = np.unique((text[some] << BITS) | at[some])
        out.append(np.bincount(pairs >> BITS, weights=dense[pairs & ((1 << BITS) - 1)], minlength=j - i) + model.bias)
    x = np.concatenate(out) if out else np.empty(0)
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(examples: list[tuple[np.ndarray, int]], passes: int = PASSES, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Model:
    """FTRL-proximal with a rate for each coordinate; the last coordinate is the bias, without L1."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    penalty = l1

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        w = -(zi - np.sign(zi) * penalty) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(zi) <= penalty] = 0
        if at[-1] == size:
            w[-1] = -zi[-1] / ((beta + math.sqrt(n[size])) / alpha + l2)
        return w

    for k in range(passes):
        for i in np.random.default_rng([SEED, k]).permutation(len(examples)):
            at, y = examples[i]
            at = np.append(at, size)
            w = weights(at)
            p = 1 / (1 + math.exp(-max(-40.0, min(40.0, float(w.sum())))))
            g = p - y
            ni = n[at]
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] += g - step * w
            n[at] = ni + g * g
    w = weights(np.arange(size + 1))
    some = np.flatnonzero(w[:size])
    return Model(float(w[size]), some, w[some])


def _distinct(column: pa.Array) -> dict[str, pa.Array]:
    out = []
    for i, j, buf, offs in text_blocks(column):
        text, at = features(buf, offs)
        pairs = np.unique((text << BITS) | at)
        cut = np.searchsorted(pairs >> BITS, np.arange(j - i + 1))
        out += [(pairs[a:b] & ((1 << BITS) - 1)).astype(np.int32) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return {"features": pa.array(out, pa.list_(pa.int32()))}


def examples(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", label: str = "toxic", sample: dict[int, int] | None = None, sample_bytes: int = SAMPLE_BYTES, folds: tuple[int, ...] = (0, 1, 3)) -> DataFrame:
    """(id, h, label, features) of the training sample: rows of docs that labels name, of the given folds.

    Rows with a null id or label are not in it; rows that repeat id, text and label are one. Per label, the share of rows keeps both
    their number and their bytes within the bounds on average, so the keys that are broadcast and the rows are few whatever the tables.
    """
    if HELD_OUT in folds:
        raise ValueError("the held-out fold is not for learning")
    sample = sample or SAMPLE
    known = labels.select(F.col(f"`{label_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).where(fold("id").isin(*folds)).distinct()
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).alias("size"))
    rows = staged(rows.where(F.col("size") <= TEXT_BYTES).distinct().join(known, "id"), "toxicity-labelled")
    counts = {r["label"]: r for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()}
    at = F.pmod(F.xxhash64(F.lit(SEED), "id", "h"), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.where(F.expr("false"))
    for y, most in sample.items():
        if y in counts:
            chosen = chosen.unionByName(rows.where((F.col("label") == y) & (at < min(most / counts[y]["n"], sample_bytes / max(1, counts[y]["size"])))))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("text"))
    made = attach(texts.join(F.broadcast(chosen.select("id", "h", "label")), ["id", "h"]), "text", _distinct, T.StructType([T.StructField("features", T.ArrayType(T.IntegerType()))]), keep=["id", "h", "label"])
    return made.select(F.col("id").cast("string").alias("id"), "h", "label", "features").dropDuplicates(["id", "h", "label"])


def _in_order(batches: Iterator[pa.RecordBatch]) -> list[tuple[np.ndarray, int]]:
    """The examples of (id, h, label, features) batches, ordered by id, hash and label."""
    seen = []
    for b in batches:
        c = b.column(3)
        flat, cut = c.flatten().to_numpy(), np.concatenate(([0], np.cumsum(pa.compute.list_value_length(c).to_numpy())))
        seen += zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), (flat[x:y].copy() for x, y in zip(cut[:-1], cut[1:], strict=True)), strict=True)
    seen.sort(key=lambda r: r[:3])
    return [(at, y) for _, _, y, at in seen]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", label: str = "toxic", sample: dict[int, int] | None = None, sample_bytes: int = SAMPLE_BYTES, folds: tuple[int, ...] = (0, 1, 3), **how) -> Model:
    """The model of labels on the docs they name, from ``examples`` of folds that are not held out; one task learns.

    Without any labelled row, as with empty tables, the score is a half for all texts.
    """
    made = examples(docs, labels, doc_id, text, label_id, label, sample, sample_bytes, folds)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = fit(_in_order(batches), **how)
        index, weight = np.append(m.index, -1), np.append(m.weight, m.bias)
        yield pa.RecordBatch.from_arrays([pa.array(index, pa.int64()), pa.array(weight, pa.float64())], names=["index", "weight"])

    weights = staged(made.repartition(1).mapInArrow(one, "index long, weight double"), "toxicity-weights").toPandas()
    bias = weights["weight"][weights["index"] < 0]
    rest = weights[weights["index"] >= 0].sort_values("index")
    return Model(float(bias.iloc[0]) if len(bias) else 0.0, rest["index"].to_numpy(np.int64), rest["weight"].to_numpy(np.float64))


def tune(docs: DataFrame, labels: DataFrame, grid: list[dict], **names) -> list[tuple[dict, float, float, float]]:
    """For each setting of ``fit`` in grid: (setting, log loss, share of toxic rows found, share of others found) on fold 3, learned from folds 0 and 1. Both samples are bounded as in ``examples``."""
    own, other = (_in_order(examples(docs, labels, folds=f, **names).toArrow().to_batches()) for f in ((0, 1), (3,)))
    out = []
    for how in grid:
        model = fit(own, **how)
        dense = model.dense()
        p = np.array([1 / (1 + math.exp(-max(-40.0, min(40.0, float(dense[at].sum()) + model.bias)))) for at, _ in other])
        y = np.array([y for _, y in other])
        loss = -np.mean(np.log(np.where(y == 1, p, 1 - p).clip(1e-12)))
        out.append((how, float(loss), float((p[y == 1] >= THRESHOLD).mean()), float((p[y == 0] >= THRESHOLD).mean())))
    return out


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """docs with the score, 0 to 1, of each row's whole text; a column of that name is replaced.

    A null or empty text has the score of no features; repeated rows have equal scores; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    dense: list[np.ndarray] = []

    def scored(column: pa.Array) -> dict[str, pa.Array]:
        if not dense:
            dense.append(shared.value.dense())
        return {name: pa.array(score(column, shared.value, dense[0]), pa.float64())}

    return attach(docs, text, scored, T.StructType([T.StructField(name, T.DoubleType())]), keep)


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score under the threshold, with the columns of docs. A model that has learned nothing, as from no labelled row, is
    an error: it would call all texts alike."""
    if not len(model.index) and not model.bias and not docs.isEmpty():
        raise ValueError("the model has learned from no labelled row")
    (own,) = fresh(docs, "toxicity_score")
    return with_score(docs, model, text, own).where(F.col(own) < threshold).select(*(F.col(f"`{c}`") for c in docs.columns))
