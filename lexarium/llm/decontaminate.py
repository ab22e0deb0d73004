"""Benchmark decontamination: a broadcast hash set of benchmark n-grams, scanned over every document's word windows.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. A window is ``n`` consecutive words of a
benchmark item; an item of fewer words, but not none, is one window. Window hashes of a document are looked up in the set, each
hit is verified word by word, and the words of all occurrences are the hit spans.

The set is arrays: the items' words in one buffer, and for each window its hash, in order, and its first word. It takes under five
bytes for each byte of item text (``Grams.nbytes``). It is broadcast in blocks of at most ``block_bytes`` of item text, so a larger
benchmark takes more scans and never a larger broadcast; then the documents are written once with a row number, each scan gives the
rows that it hits, and these are joined by that number. (A single item beyond the bound is a block of its own.)
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, LOWER, attach, fresh, prefix_hash, span_hash, staged, text_blocks, window_hash, word_spans

N = 13
#: Most bytes of item text in one broadcast.
BLOCK_BYTES = 128 << 20
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

SPANS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("hit_spans", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))])


class Grams:
    """The windows of some items (name, text): by length, a bit table over hash prefixes, the sorted hashes, and each one's first word in ``buf``."""

    def __init__(self, items: Iterable[tuple[str, str | None]], n: int):
        self.names: list[str] = []
        bufs, sizes, firsts, found = [], [np.zeros(1, np.uint32)], [], {}
        total = 0
        for names, texts in _batches(items):
            self.names += names
            for _, _, raw, offs in text_blocks(pa.array(texts, pa.string())):
                low = LOWER[raw]
                s, e, first = word_spans(low, offs, ALNUM)
                bufs.append(_spaced(low, s, e))
                sizes.append((e - s + 1).astype(np.uint32))
                firsts.append(first[:-1] + total)
                h, count = span_hash(prefix_hash(low), s, e), np.diff(first)
                for size in np.unique(np.minimum(count, n)):
                    if size:
                        own = np.repeat(count if size == n else np.where(count == size, count, 0), count)
                        at = np.arange(len(s)) - np.repeat(first[:-1], count)
                        at = np.flatnonzero((own >= size) & (at + size <= own))
                        found.setdefault(int(size), []).append((window_hash(h, size)[at], (at + total).astype(np.uint32)))
                total += len(s)
        self.buf = np.concatenate(bufs) if bufs else np.empty(0, np.uint8)
        self.start = np.cumsum(np.concatenate(sizes), dtype=np.uint32 if len(self.buf) < 1 << 32 else np.uint64)
        self.first = np.concatenate(firsts).astype(np.uint32) if firsts else np.empty(0, np.uint32)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.bits: dict[int, tuple[int, np.ndarray]] = {}
        for size, parts in sorted(found.items()):
            h, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            self.by_size[size] = h[order], at[order]
            width = min(30, max(16, (16 * len(h)).bit_length()))
            table = np.zeros(1 << (width - 3), np.uint8)
            prefix = h >> np.uint64(64 - width)
            np.bitwise_or.at(table, prefix >> np.uint64(3), np.uint8(1) << (prefix & np.uint64(7)).astype(np.uint8))
            self.bits[size] = width, table

    @property
    def nbytes(self) -> int:
        own = [self.buf, self.start, self.first, *(x for pair in self.by_size.values() for x in pair), *(t for _, t in self.bits.values())]
        return sum(x.nbytes for x in own) + sum(map(len, self.names))

    def known(self, size: int, hashes: np.ndarray) -> np.ndarray:
        """The places of those hashes that are of the set; the bits sort out most of the others."""
        width, table = self.bits[size]
        prefix = hashes >> np.uint64(64 - width)
        at = np.flatnonzero(table[prefix >> np.uint64(3)] >> (prefix & np.uint64(7)).astype(np.uint8) & 1)
        own = self.by_size[size][0]
        return at[own[np.minimum(np.searchsorted(own, hashes[at]), len(own) - 1)] == hashes[at]]

    def owners(self, size: int, h: np.uint64, words: bytes) -> set[str]:
        """The items with a window of these words, each followed by a space."""
        hashes, at = self.by_size[size]
        out = set()
        for k in range(int(np.searchsorted(hashes, h)), int(np.searchsorted(hashes, h, side="right"))):
            w = int(at[k])
            if self.buf[int(self.start[w]) : int(self.start[w + size])].tobytes() == words:
                out.add(self.names[int(np.searchsorted(self.first, w, side="right")) - 1])
        return out


def _batches(items: Iterable[tuple[str, str | None]], size: int = 4 << 20) -> Iterable[tuple[list[str], list[str]]]:
    names, texts, total = [], [], 0
    for name, text in items:
        names.append(name)
        texts.append(text or "")
        total += len(texts[-1])
        if total >= size:
            yield names, texts
            names, texts, total = [], [], 0
    if names:
        yield names, texts


def _spaced(low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The words, each followed by one space."""
    size = e - s
    ends = np.cumsum(size + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    shift = ends - size - 1 - s
    at = np.arange(int(size.sum())) + np.repeat(s - np.cumsum(size) + size, size)
    out[at + np.repeat(shift, size)] = low[at]
    return out


def scan(column: pa.Array, grams: Grams) -> dict[str, pa.Array]:
    """For each text its number of words, the word spans that windows of ``grams`` cover (start, end, start, ...) and the items of these windows."""
    n_words, spans, items = [], [], []
    for i, j, buf, offs in text_blocks(column):
        low = LOWER[buf]
        s, e, first = word_spans(low, offs, ALNUM)
        n_words.append(np.diff(first))
        found: dict[int, list] = {}
        if len(s):
            h = span_hash(prefix_hash(low), s, e)
            last = np.repeat(first[1:], np.diff(first))  # for each word the first word of the next text
            for size in grams.bits:
                w = window_hash(h, size)
                at = grams.known(size, w)
                at = at[at + size <= last[at]]
                for k in at.tolist():
                    if owners := grams.owners(size, w[k], b"".join(low[s[x] : e[x]].tobytes() + b" " for x in range(k, k + size))):
                        d = int(np.searchsorted(first, k, side="right")) - 1
                        got = found.setdefault(d, [[], set()])
                        got[0].append((k - int(first[d]), k - int(first[d]) + size))
                        got[1].update(owners)
        for d in range(j - i):
            spans.append(_merge(found[d][0]) if d in found else [])
            items.append(sorted(found[d][1]) if d in found else [])
    return {"n_words": pa.array(np.concatenate(n_words) if n_words else [], pa.int64()), "hit_spans": pa.array(spans, pa.list_(pa.int64())), "items": pa.array(items, pa.list_(pa.string()))}


def _merge(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = N, block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of docs (None: all) with n_words, hit_spans (word spans: start, end, start, ...) and items (sorted).

    A null or empty text has no words and no hits; a null item id reads ``null``; repeated rows are judged each for itself; an
    empty benchmark hits nothing, and an empty table gives none. Columns of docs named like the results are replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"), F.col(item_text).alias("t"))
    total = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    keep = docs.columns if keep is None else keep

    def block(b: int):
        part = items if n_blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == b)
        return spark.sparkContext.broadcast(Grams(((r["i"], r["t"]) for r in part.toLocalIterator()), n))

    if n_blocks == 1:
        shared = block(0)
        return attach(docs, text, lambda c: scan(c, shared.value), SPANS, keep)
    stay = [c for c in keep if c.lower() not in SPANS.names]
    row, own = fresh(docs, "row", "scanned")
    rows = docs.select(*(F.col(f"`{c}`") for c in stay), F.col(f"`{text}`").alias(own), F.monotonically_increasing_id().alias(row))
    rows = staged(attach(rows, own, lambda c: {"n_words": _count_words(c)}, T.StructType([SPANS["n_words"]])), "decontaminate-rows")
    hits = None
    for b in range(n_blocks):
        shared = block(b)
        one = staged(attach(rows.select(row, own), own, lambda c, g=shared: scan(c, g.value), SPANS, [row]).where(F.size("items") > 0).drop("n_words"), "decontaminate-hits")
        shared.destroy()
        hits = one if hits is None else hits.unionByName(one)
    per_row = hits.groupBy(row).agg(F.flatten(F.collect_list("hit_spans")).alias("hit_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))  # no more than the words of a text and the items
    per_row = attach(per_row, "hit_spans", _merged, T.StructType([SPANS["hit_spans"]]))
    none = lambda c: F.coalesce(F.col(c), F.array().cast(SPANS[c].dataType)).alias(c)
    return rows.join(per_row, row, "left").select(*(F.col(f"`{c}`") for c in stay), "n_words", none("hit_spans"), none("items"))


def _count_words(column: pa.Array) -> pa.Array:
    counts = [np.diff(word_spans(LOWER[buf], offs, ALNUM)[2]) for _, _, buf, offs in text_blocks(column)]
    return pa.array(np.concatenate(counts) if counts else [], pa.int64())


def _merged(column: pa.Array) -> dict[str, pa.Array]:
    return {"hit_spans": pa.array([_merge(list(zip(x[::2], x[1::2], strict=True))) for x in column.to_pylist()], pa.list_(pa.int64()))}


def hit_words(spans: str = "hit_spans") -> Column:
    """The number of words in flat spans."""
    return F.expr(f"aggregate(transform({spans}, (x, i) -> if(i % 2 = 0, -x, x)), 0L, (acc, x) -> acc + x)")


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    """At least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents that are not contaminated, with the columns of docs."""
    own = fresh(docs, "n_hit")[0]
    if not {"n_words", "hit_spans", "items"} & {c.lower() for c in docs.columns}:
        found = find_contamination(docs, benchmark, **how)
        return found.withColumn(own, hit_words()).where(~is_contaminated(F.col("n_words"), F.col(own))).select(*(F.col(f"`{c}`") for c in docs.columns))
    # columns named like the results travel in a struct
    text = how.get("text", "text")
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("row"), F.col(f"`{text}`").alias("scanned"))
    found = find_contamination(inner, benchmark, **(how | {"text": "scanned"})).withColumn("n_hit", hit_words())
    return found.where(~is_contaminated(F.col("n_words"), F.col("n_hit"))).select(*((F.col("scanned") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns))


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """docs with every hit word, and what stands between hit words of one span, cut out of the text; the rest stays byte for byte."""
    found = find_contamination(docs, benchmark, text=text, **how)

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        return pd.Series([_cut(t, sp) for t, sp in zip(texts, spans, strict=True)], dtype=object)

    return found.withColumn(text, F.when(F.size("hit_spans") > 0, cut(F.col(text), F.col("hit_spans"))).otherwise(F.col(text))).drop("n_words", "hit_spans", "items")


def _cut(t: str | None, spans) -> str | None:
    if t is None:
        return None
    raw = t.encode()
    at = [m.span() for m in WORD.finditer(raw.lower())]
    out, last = [], 0
    for k in range(0, len(spans), 2):
        out.append(raw[last : at[spans[k]][0]])
        last = at[spans[k + 1] - 1][1]
    return b"".join([*out, raw[last:]]).decode()


def items_sha256(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
