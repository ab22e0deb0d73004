"""SimHash near-duplicates with deletion-variant signatures.

Fingerprints: 64-bit majority of the XXH64 (seed 42) values of all 3-word shingles. Fingerprints at ``2`` or fewer differing bits
link. A fingerprint is cut into two 32-bit segments, so one segment of a linked pair differs by at most one bit: each segment is
indexed under its 32 one-wildcard variants, variants are joined by equality, and candidates are verified on all 64 bits.

Equal fingerprints are one node, whatever their number. A variant shared by two nodes gives its pair from the minimum and the
maximum alone. Larger buckets are cut again: what a bucket leaves free is cut into parts of which one must be equal, until a
bucket holds no more than ``BUCKET`` nodes or so few bits are free that it cannot hold more than ``1 << FREE_BITS`` distinct
fingerprints. A bucket then yields a spanning forest of its links, never all pairs. Components follow by min-label contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, fresh, longs, row_hash, staged, text_blocks, unstage

SEED, SHINGLE, DISTANCE = 42, 3, 2
#: A bucket of more nodes is cut further, while more than FREE_BITS bits are free.
BUCKET, FREE_BITS = 512, 13
#: Nodes whose variants a task makes.
TASK_NODES = 1 << 16


# --------------------------------------------------------------------------- fingerprints


def fingerprints(column: pa.Array) -> np.ndarray:
    """The fingerprint of each text; zero for a null or a text without words."""
    out = np.zeros(len(column), np.uint64)
    for i, j, buf, offs in text_blocks(column):
        raw = buf.tobytes().lower()
        for d in range(j - i):
            if words := raw[offs[d] : offs[d + 1]].split():
                out[i + d] = _majority(_shingle_hashes(words))
    return out


def _shingle_hashes(words: list[bytes]) -> np.ndarray:
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][: -SHINGLE + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter([digest(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)], np.uint64, len(starts))


def _majority(h: np.ndarray) -> np.uint64:
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16 if len(h) < 1 << 14 else np.int64)
    return np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0]


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", keep: list[str] | None = None) -> DataFrame:
    """docs with the fingerprint as a (signed) long."""
    return attach(docs, text, lambda c: {name: longs(fingerprints(c).view(np.int64))}, T.StructType([T.StructField(name, T.LongType())]), keep)


def as_hex(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fingerprint)), 16, "0"))


# --------------------------------------------------------------------------- links

_LOW = np.uint64(0xFFFFFFFF)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node 64 rows: the key of a one-wildcard variant of a segment (segment, wildcard and the other 31 bits), and the node."""
    bit = np.uint64(1) << np.arange(32, dtype=np.uint64)
    for batch in batches:
        f = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(f), 4096):
            part = f[k : k + 4096, None]
            keys = []
            for seg in (0, 1):
                own = (part >> np.uint64(32 * seg)) & _LOW
                tag = (np.uint64(seg * 32) + np.arange(32, dtype=np.uint64)) << np.uint64(32)
                keys.append((own & ~bit) | tag)
            yield pa.RecordBatch.from_arrays([longs(np.concatenate(keys, axis=1).ravel().view(np.int64)), longs(np.repeat(part, 64).view(np.int64))], names=["key", "f"])


def _forest(f: np.ndarray) -> list[tuple[int, int]]:
    """Links that span the components of the distinct fingerprints f, in blocks of rows."""
    parent = np.arange(len(f))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for k in range(0, len(f), 256):
        block = f[k : k + 256]
        at, to = np.nonzero(_popcount(block[:, None] ^ f[None, k:]) <= DISTANCE)
        to = to + k
        for i, j in zip((at + k)[at + k < to].tolist(), to[at + k < to].tolist(), strict=True):
            if (a := root(i)) != (b := root(j)):
                parent[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets as (f: array) rows to links."""
    for batch in batches:
        a, b = [], []
        for members in batch.column(0).to_pylist():
            f = np.array(members, np.int64).view(np.uint64)
            signed = f.view(np.int64)
            for i, j in _forest(f):
                a.append(int(signed[i]))
                b.append(int(signed[j]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links(nodes: DataFrame, node: str = "fingerprint", bucket: int = BUCKET) -> DataFrame:
    """Verified links (a, b) between the distinct values of nodes whose components are those of all links at DISTANCE or fewer bits."""
    own = nodes.select(F.col(node).alias("f"))
    parts = max(nodes.sparkSession.sparkContext.defaultParallelism, -(-own.count() // TASK_NODES))
    variants = own.repartition(parts, "f").mapInArrow(_variants, "key long, f long")
    counted = staged(variants.groupBy("key").agg(F.count("*").alias("n"), F.min("f").alias("a"), F.max("f").alias("b")).where("n >= 2"), "simhash-variants")
    near = lambda df: df.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
    found = [near(counted.where("n = 2").select("a", "b"))]
    rest = staged(variants.join(counted.where("n > 2").select("key", "n").hint("merge"), "key"), "simhash-buckets")
    # key, fixed: the bits that all members of a bucket share
    rest = rest.select(F.xxhash64("key").alias("key"), "f", "n", F.expr(f"if(key < {1 << 37}, {0xFFFFFFFF}L, {-(1 << 32)}L) & ~shiftleft(1L, cast(shiftright(key, 32) AS int))").alias("fixed"))
    while True:
        small = rest.where((F.col("n") <= bucket) | (64 - F.bit_count("fixed") <= FREE_BITS))
        found.append(small.groupBy("key", "fixed").agg(F.collect_list("f").alias("f")).select("f").mapInArrow(_solve, LINK))
        big = rest.where((F.col("n") > bucket) & (64 - F.bit_count("fixed") > FREE_BITS))
        if big.isEmpty():
            break
        # three parts of what is free: two differing bits leave one part equal
        cut = big.select("key", "f", "fixed", F.explode(F.expr(PARTS)).alias("m")).select("f", F.xxhash64("key", "m", F.col("f").bitwiseAND(F.col("m"))).alias("key"), F.col("fixed").bitwiseOR(F.col("m")).alias("fixed"))
        cut = staged(cut, "simhash-cut")
        sizes = staged(cut.groupBy("key", "fixed").agg(F.count("*").alias("n")).where("n >= 2"), "simhash-sizes")
        rest = staged(cut.join(sizes, ["key", "fixed"]), "simhash-buckets")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return staged(out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "simhash-links")


#: Every third (DISTANCE + 1) of the bits not in ``fixed``, from the k-th on, as masks for k from 0 to DISTANCE.
PARTS = f"""transform(sequence(0, {DISTANCE}), k -> aggregate(sequence(0, 63), struct(0 AS i, 0L AS m), (acc, b) -> struct(
    acc.i + 1 - cast(getbit(fixed, b) AS int) AS i,
    if(getbit(fixed, b) = 0 AND acc.i % {DISTANCE + 1} = k, acc.m | shiftleft(1L, b), acc.m) AS m), acc -> acc.m))"""


# --------------------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """(node, label): for each node of the edges (a, b) the smallest node of its component.

    Alternating large-star and small-star contraction: each node's larger neighbours, then its smaller neighbours and itself, are
    tied to the smallest neighbour. Each step keeps the components and at most as many edges; a node with many neighbours is
    met by a join on aggregated minima, not gathered.
    """
    cur = edges
    before = None
    used: list[DataFrame] = []
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = staged(least.select("a", F.least("a", "m").alias("m")), "components-least")
        large = staged(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct(), "components-large")
        # small star: a > b now
        low = staged(large.groupBy("a").agg(F.min("b").alias("m")), "components-low")
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e")).select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a != b").distinct()
        cur = staged(small.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "components")
        unstage(*used, least, large, low)  # with the edges of the loop before
        used = [cur]
        mark = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
    return cur.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(cur.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct()


def _labelled(nodes: DataFrame) -> DataFrame:
    """nodes (distinct fingerprint, and more) with label, the smallest fingerprint of each one's component."""
    label = components(links(nodes))
    named = nodes.join(label, nodes["fingerprint"] == label["node"], "left").drop("node").withColumn("label", F.coalesce("label", "fingerprint"))
    return staged(named, "simhash-named")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint long, component_id) for each row of docs; component_id: the smallest id reachable, itself included.

    Texts without words and nulls have fingerprint zero and link like any other. Null ids are left out of the minima (a component
    of null ids only has a null id). Repeated rows give a row each.
    """
    prints = staged(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), keep=["doc_id"]), "simhash-prints")
    nodes = staged(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    named = _labelled(nodes)
    best = staged(named.groupBy("label").agg(F.min("least").alias("component_id")), "simhash-best")
    whole = staged(named.select("fingerprint", "label").join(best, "label").select("fingerprint", "component_id"), "simhash-components")
    return prints.join(whole, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with the columns of docs: that with the smallest id (null ids last), then the smallest text digest,
    then the smallest hash of the whole row.

    A row is known by its id, a 128-bit digest of its text and that hash, so every component keeps a row whatever the ids, and the
    same one if a task runs again; of rows that are equal in all columns, which are of one component, one stays. Null and empty
    texts are one component. An empty table gives an empty result.
    """
    own, mark, whole = fresh(docs, "kept_id", "kept_digest", "kept_hash")
    digest = F.md5(F.col(text).cast("binary"))  # null for a null
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), digest.alias("digest"), row_hash(docs).alias("hash"))
    prints = with_fingerprint(narrow, keep=["doc_id", "digest", "hash"])
    rows = staged(prints.groupBy("doc_id", "digest", "hash", "fingerprint").agg(F.count("*").alias("n")), "simhash-rows")
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "hash", "n")
    nodes = staged(rows.groupBy("fingerprint").agg(F.min(row).alias("least")), "simhash-nodes")
    best = _labelled(nodes).groupBy("label").agg(F.min("least").alias("least"))
    found = staged(best.select(F.col("least.doc_id").alias(own), F.col("least.digest").alias(mark), F.col("least.hash").alias(whole), F.col("least.n").alias("n")), "simhash-kept")
    same = F.col(doc_id).eqNullSafe(F.col(own)) & digest.eqNullSafe(F.col(mark)) & (row_hash(docs) == F.col(whole))
    kept = docs.join(found.where("n = 1").select(own, mark, whole), same, "left_semi")
    if (again := found.where("n > 1").select(own, mark, whole)).isEmpty():
        return kept
    repeated = docs.join(again, same, "left_semi").withColumn(mark, digest).withColumn(whole, row_hash(docs)).dropDuplicates([doc_id, mark, whole]).drop(mark, whole)
    return kept.unionByName(repeated)
