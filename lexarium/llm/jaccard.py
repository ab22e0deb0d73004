"""Jaccard join of word 5-gram sets with prefix filters under several global token orders.

Two sets link at a Jaccard similarity of 0.8 or more. Under any order of all tokens, linked sets then share a token among the first
``size - ceil(0.8 * size) + 1`` of each, and ``k`` tokens among the first ``k - 1`` more. So the sets that share prefix tokens under
one order fall into components, links never leave one, and what several orders leave together is the intersection:

1. the order of a hash: with its ``k``-prefix a set stays only if ``k`` of those tokens stand in other sets;
2. rarest first, ties by a second hash: sets with too few shared tokens go, prefix sharing gives components;
3. rarest first, ties by a third hash, gives others: a candidate pair is in one component under both.

Equal sets are one node. What is left of each component, its shared tokens, is verified exactly: small components in one task;
of large ones every member meets a few pivots first, and where that does not join all of them, lots meet lots, in tasks of bounded
size that skip what is joined already. Links leave as spanning forests, so no group yields all its pairs.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import LOWER, NOT_SPACE, hot_join, longs, mix, prefix_hash, span_hash, staged, text_blocks, window_hash, word_spans
from .simhash import components

SHINGLE = 5
#: Tokens of all members that one task verifies at once, and pivots of a larger component.
TASK_TOKENS, PIVOTS = 1 << 20, 8
#: Most bits of a map, which is broadcast.
MOST_BITS = 1 << 29
#: Seeds of the orders.
FIRST, SECOND, THIRD = 0x51ED270B, 0x2545F491, 0x9E3779B1


def needed(size):
    """ceil(0.8 * size): the least intersection with a linked set; for ints and arrays."""
    return (4 * size + 4) // 5


def linked(inter, a, b):
    return 100 * inter >= 80 * (a + b - inter)


# --------------------------------------------------------------------------- sets


def shingle_sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For blocks of texts, in order: the ascending distinct shingle hashes of all its texts, one text after the other, and where each ends."""
    for i, j, buf, offs in text_blocks(column):
        low = LOWER[buf]
        start, end, before = word_spans(low, offs, NOT_SPACE)
        words = span_hash(prefix_hash(low), start, end)
        n = np.diff(before)
        doc = np.repeat(np.arange(j - i), n)
        h = window_hash(words, SHINGLE)
        inside = doc[: len(h)] == doc[SHINGLE - 1 :] if len(h) else np.empty(0, bool)
        h, at = h[inside], doc[: len(h)][inside]
        few = np.flatnonzero((n > 0) & (n < SHINGLE))  # the whole sequence
        short = [window_hash(words[before[d] : before[d + 1]], int(n[d]))[0] for d in few.tolist()]
        h, at = np.r_[h, np.array(short, np.uint64)], np.r_[at, few]
        order = np.lexsort((h, at))
        h, at = h[order], at[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (at[1:] != at[:-1])
        yield h[new], np.searchsorted(at[new], np.arange(j - i), side="right")


def nodes_of(tokens: np.ndarray, ends: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set's digest, as two longs; the first names the set."""
    raw, salt = tokens.tobytes(), seed.to_bytes(8, "little")
    digests = b"".join(hashlib.blake2b(raw[8 * s : 8 * e], digest_size=16, salt=salt).digest() for s, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))
    both = np.frombuffer(digests, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _with_node(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, size, node, check) of each row of (doc_id, text)."""
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("size", "node", "check"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = [(np.diff(ends, prepend=0), *nodes_of(tokens, ends, seed)) for tokens, ends in shingle_sets(batch.column(1))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(longs(np.concatenate(c)) for c in zip(*made, strict=True))], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _ordered(tokens: np.ndarray, seed: int) -> np.ndarray:
    """Where each token stands in the order of a seed."""
    return mix(tokens ^ np.uint64(seed))


# --------------------------------------------------------------------------- the first order


def more(size):
    """Tokens by which the first order's prefix is longer, each of which must be shared too."""
    return size // 10


def _first_rows(seed: int):
    """(token, node, n) of the prefixes of a batch's sets. Tokens that several sets of the batch have are counted here: a row with
    n > 0 says that its node has so many of them, and one row with n = -1 lets other batches know of the token. So a token, however
    common, has one row a batch; the others have n = 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toks, owns = [], []
            for tokens, ends in shingle_sets(batch.column(0)):
                node, _ = nodes_of(tokens, ends, seed)
                size = np.diff(ends, prepend=0)
                doc = np.repeat(np.arange(len(ends)), size)
                order = np.lexsort((_ordered(tokens, FIRST), doc))
                rank = np.arange(len(tokens)) - np.repeat(ends - size, size)
                keep = rank < (size - needed(size) + 1 + more(size))[doc]
                toks.append(tokens[order][keep].view(np.int64))
                owns.append(node[doc[keep]])
            if not toks:
                continue
            tok, own = np.concatenate(toks), np.concatenate(owns)
            tok, own, _, first, many = _runs(tok, own, np.zeros(len(tok), np.int64))
            node, n = np.unique(own[many], return_counts=True)
            sent = first | ~many
            out = np.r_[tok[sent], node], np.r_[own[sent], node], np.r_[np.where(many[sent], -1, 0), n]
            yield pa.RecordBatch.from_arrays([longs(c) for c in out], names=["token", "node", "n"])

    return run


def _runs(tok: np.ndarray, own: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (token, node) by token, each with its least n; which are the first of a token, and which have a token of several nodes."""
    order = np.lexsort((n, own, tok))
    tok, own, n = tok[order], own[order], n[order]
    new = np.ones(len(tok), bool)
    new[1:] = (tok[1:] != tok[:-1]) | (own[1:] != own[:-1])
    tok, own, n = tok[new], own[new], n[new]
    first = np.ones(len(tok), bool)
    first[1:] = tok[1:] != tok[:-1]
    sizes = np.diff(np.r_[np.flatnonzero(first), len(tok)])
    return tok, own, n, first, np.repeat(sizes > 1, sizes)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n) from rows sorted by token: how many of a node's tokens stand in other nodes. A token's rows, one a batch at most of
    those that made them, come together."""
    held = [np.empty(0, np.int64)] * 3
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held = [np.r_[h, batch.column(k).to_numpy(zero_copy_only=False)] for k, h in enumerate(held)]
        tok, own, n = held
        upto = len(tok) if batch is None else int(np.searchsorted(tok, tok[-1])) if len(tok) else 0
        held = [h[upto:] for h in held]
        tok, own, n = tok[:upto], own[:upto], n[:upto]
        told = n > 0
        _, o, m, _, many = _runs(tok[~told], own[~told], n[~told])
        o = o[many & (m == 0)]  # the others were counted where their token came from
        node, back = np.unique(np.r_[own[told], o], return_inverse=True)
        total = np.bincount(back, np.r_[n[told], np.ones(len(o), np.int64)]).astype(np.int64)
        if len(node):
            yield pa.RecordBatch.from_arrays([longs(node), longs(total)], names=["node", "n"])


def _texts(seed: int, alive):
    """(node, text) of each text with words whose node may be in the map ``alive``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = [(np.diff(ends, prepend=0), nodes_of(tokens, ends, seed)[0]) for tokens, ends in shingle_sets(batch.column(0))]
            size, node = (np.concatenate(c) for c in zip(*made, strict=True))
            yield pa.RecordBatch.from_arrays([longs(node), batch.column(0)], names=["node", "text"]).filter(pa.array((size > 0) & _has(alive.value, node)))

    return run


TOKEN = "node long, token long"


def _tokens(known=None):
    """(node, token) of (node, text), of the tokens that may be in the map ``known``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, at = batch.column(0).to_numpy(zero_copy_only=False), 0
            for tokens, ends in shingle_sets(batch.column(1)):
                own, token = np.repeat(node[at : at + len(ends)], np.diff(ends, prepend=0)), tokens.view(np.int64)
                at += len(ends)
                keep = slice(None) if known is None else _has(known.value, token)
                yield pa.RecordBatch.from_arrays([longs(own[keep]), longs(token[keep])], names=["node", "token"])

    return run


# --------------------------------------------------------------------------- bit maps


def _bit(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(values.view(np.uint64) ^ np.uint64(FIRST)) & np.uint64(bits - 1)).astype(np.int64)


def bit_map(values: DataFrame, most_bits: int = MOST_BITS) -> tuple[np.ndarray, int]:
    """A map of the bits that the longs of the one column of values hash to, of 16 bits a value but at most ``most_bits``: what it
    doesn't have is not among them. It is made in chunks by the executors; a full one lets all pass."""
    n = values.count()
    bits = min(most_bits, 1 << max(19, (16 * n - 1).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bit(batch.column(0).to_numpy(zero_copy_only=False), bits))
            yield pa.RecordBatch.from_arrays([longs(at >> 19), longs(at)], names=["chunk", "at"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            chunk, at = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for c in np.unique(chunk).tolist():
                np.bitwise_or.at(made.setdefault(c, np.zeros(1 << 16, np.uint8)), (at[chunk == c] & ((1 << 19) - 1)) >> 3, np.left_shift(1, at[chunk == c] & 7).astype(np.uint8))
        if made:
            yield pa.RecordBatch.from_arrays([longs(np.array([*made])), pa.array([x.tobytes() for x in made.values()], pa.binary())], names=["chunk", "map"])

    out = np.zeros(bits >> 3, np.uint8)
    for r in values.mapInArrow(places, "chunk long, at long").repartition("chunk").mapInArrow(chunks, "chunk long, map binary").collect():  # bits >> 3 bytes
        out[r["chunk"] << 16 : (r["chunk"] + 1) << 16] |= np.frombuffer(r["map"], np.uint8)
    return out, bits


def _has(known: tuple[np.ndarray, int], values: np.ndarray) -> np.ndarray:
    at = _bit(values, known[1])
    return (known[0][at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


# --------------------------------------------------------------------------- further orders


def _shared_tokens(texts: DataFrame) -> DataFrame:
    """(node, tokens: array<struct<n, token>>) of texts (node, text): the tokens that several nodes have, with their number."""
    counts = staged(texts.mapInArrow(_tokens(), TOKEN).groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "jaccard-counts")
    known = texts.sparkSession.sparkContext.broadcast(bit_map(counts.select("token")))
    rows = hot_join(texts.mapInArrow(_tokens(known), TOKEN), counts, ["token"], "n")
    return rows.groupBy("node").agg(F.collect_list(F.struct("n", "token")).alias("tokens"))


def _early(tokens: str, seed: int) -> Column:
    """Of a set's shared tokens those in its prefix, rarest first, ties by a hash; have - need + 1 of them, as its other tokens come first."""
    keyed = F.array_sort(F.transform(tokens, lambda t: F.struct(t["n"].alias("n"), F.xxhash64(t["token"], F.lit(seed)).alias("h"), t["token"].alias("token"))))
    return F.transform(F.slice(keyed, F.lit(1), F.size(tokens) - F.col("need") + 1), lambda t: t["token"])


def _labels(kept: DataFrame, seed: int) -> DataFrame:
    """(node, label): the components of the sets that share prefix tokens in the order of a seed; sets without a partner go."""
    entries = kept.select("node", F.explode(_early("tokens", seed)).alias("token"))
    least = staged(entries.groupBy("token").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1"), "jaccard-least")
    edges = hot_join(entries, least, ["token"], "n").where("node != least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    return components(staged(edges, "jaccard-edges"))


def candidates(texts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(group, node, size, tokens) of texts (node, text), each set once: its shared tokens, and its component under both orders, for the
    sets that have a partner under both. sizes: (node, size)."""
    need = F.floor((4 * F.col("size") + 4) / 5).cast("int").alias("need")
    kept = _shared_tokens(texts).join(sizes, "node").select("node", "size", "tokens", need).where(F.size("tokens") >= F.col("need"))
    kept = staged(kept, "jaccard-kept")
    second, third = _labels(kept, SECOND), _labels(kept, THIRD)
    both = second.join(third.withColumnRenamed("label", "other"), "node").select("node", F.xxhash64("label", "other").alias("group"))
    return staged(kept.join(both, "node").select("group", "node", "size", F.col("tokens.token").alias("tokens")), "jaccard-candidates")


# --------------------------------------------------------------------------- verification

LINK = "a long, b long"
MEMBER = "struct<node: bigint, size: bigint, label: bigint, tokens: array<bigint>>"


def forest(size: np.ndarray, label: np.ndarray, tokens: list[np.ndarray], apart: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of members that span the components of all links between different labels (``apart``: and different sides)."""
    n = len(size)
    flat, owner = np.concatenate(tokens), np.repeat(np.arange(n), [len(t) for t in tokens])
    _, flat, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = count > max(16, n // 16)  # few: these are a dense matrix, the others lists of owners
    column = np.cumsum(common) - 1
    dense = np.zeros((n, int(common.sum())), np.float32)
    is_common = common[flat]
    dense[owner[is_common], column[flat[is_common]]] = 1
    rest = (count > 1) & ~common
    held = rest[flat]
    tok, own = flat[held], owner[held]
    order = np.argsort(tok, kind="stable")
    by_tok, start = own[order], np.searchsorted(tok[order], np.arange(len(count) + 1))
    mine = np.searchsorted(own, np.arange(n + 1))
    parent = np.unique(label, return_inverse=True)[1].astype(np.int64)
    root = np.arange(parent.max() + 1 if n else 0)  # of each label's number

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    out = []
    for k in range(0, n, 256):
        inter = (dense[k : k + 256] @ dense.T).astype(np.int64)
        for i in range(k, min(n, k + 256)):
            row = inter[i - k]
            if (t := tok[mine[i] : mine[i + 1]]).size:
                row = row + np.bincount(np.concatenate([by_tok[start[x] : start[x + 1]] for x in t.tolist()]), minlength=n)
            good = linked(row, size[i], size) & (parent != parent[i])
            good[: i + 1] = False
            if apart is not None:
                good &= apart != apart[i]
            for j in np.flatnonzero(good).tolist():
                a, b = find(int(parent[i])), find(int(parent[j]))
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((i, j))
    return out


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of members (array, and for lots the side of each) to links."""
    for batch in batches:
        a, b = [], []
        for k in range(batch.num_rows):
            members = batch.column(0).slice(k, 1).flatten()
            node, size, label = (members.field(c).to_numpy(zero_copy_only=False) for c in (0, 1, 2))
            lists = members.field(3)
            ends, flat = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy(zero_copy_only=False)
            side = batch.column(1).slice(k, 1).flatten().to_numpy(zero_copy_only=False) if batch.num_columns > 1 and batch.column(1)[k].is_valid else None
            for i, j in forest(size, label, np.split(flat, ends[:-1]), side):
                a.append(node[i])
                b.append(node[j])
        if a:
            yield pa.RecordBatch.from_arrays([longs(np.array(a)), longs(np.array(b))], names=["a", "b"])


def _pivot_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, size, tokens, pivots) to the links with pivots."""
    for batch in batches:
        a, b = [], []
        for node, size, tokens, pivots in zip(*(batch.column(k) for k in range(4)), strict=True):
            own = tokens.values.to_numpy(zero_copy_only=False)
            for p in pivots.as_py():
                inter = np.intersect1d(own, np.array(p["tokens"], np.int64), assume_unique=True).size
                if p["node"] != node.as_py() and linked(inter, size.as_py(), p["size"]):
                    a.append(p["node"])
                    b.append(node.as_py())
        if a:
            yield pa.RecordBatch.from_arrays([longs(np.array(a)), longs(np.array(b))], names=["a", "b"])


def verify(sets: DataFrame, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """Links (a, b) that span the components of all links inside the groups of sets (group, node, size, tokens), which are staged."""
    rows = sets.withColumn("label", F.col("node"))
    member = F.struct("node", "size", "label", "tokens").alias("m")
    weight = staged(rows.groupBy("group").agg(F.count("*").alias("n"), F.sum(F.size("tokens") + 64).alias("weight")).where("n > 1"), "jaccard-groups")
    small = hot_join(rows, weight.where(F.col("weight") <= task_tokens), ["group"], "n")
    found = small.groupBy("group").agg(F.collect_list(member).alias("m")).select("m").mapInArrow(_solve, LINK)
    large = weight.where(F.col("weight") > task_tokens)
    if large.isEmpty():
        return found
    # every member of a large group meets a few pivots
    theirs = staged(hot_join(rows, large, ["group"], "n"), "jaccard-large")
    pivots = _pivots(theirs).join(large, "group")
    met = hot_join(theirs.drop("n", "weight"), pivots, ["group"], "n").select("node", "size", "tokens", "pivots").mapInArrow(_pivot_links, LINK)
    met = staged(met, "jaccard-met")
    label = components(met).withColumnRenamed("label", "now")
    theirs = theirs.join(label, "node", "left").withColumn("label", F.coalesce("now", "label")).drop("now")
    theirs = staged(theirs, "jaccard-labelled")
    left = theirs.groupBy("group").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("group")
    # lots of half a task's tokens meet each other and themselves
    lots = F.ceil(2 * F.col("weight") / task_tokens)
    dealt = theirs.join(left, "group", "left_semi").withColumn("lots", lots).withColumn("lot", F.pmod(F.xxhash64("node"), F.col("lots")))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
    keyed = pairs.select("group", F.least("lot", "other").alias("i"), F.greatest("lot", "other").alias("j"), member, F.col("lot").alias("lot"))
    side = F.when(F.col("i") != F.col("j"), F.col("s")).alias("s")
    whole = keyed.groupBy("group", "i", "j").agg(F.collect_list(F.struct("m", "lot")).alias("x")).select("i", "j", F.transform("x", lambda v: v["m"]).alias("m"), F.transform("x", lambda v: v["lot"]).alias("s"))
    return found.unionByName(met).unionByName(whole.select("m", side).mapInArrow(_solve, LINK))


def _pivots(members: DataFrame) -> DataFrame:
    """(group, pivots): the members of least hash of each group, each partition's own first, so no group comes together."""
    rank = F.xxhash64("node", F.lit(7))
    row = F.struct(rank.alias("r"), "node", "size", "tokens")
    part = members.withColumn("part", F.spark_partition_id())
    some = part.withColumn("k", F.row_number().over(Window.partitionBy("group", "part").orderBy(rank, "node"))).where(F.col("k") <= PIVOTS)
    best = some.groupBy("group").agg(F.slice(F.array_sort(F.collect_list(row)), 1, PIVOTS).alias("p"))
    return best.select("group", F.transform("p", lambda p: F.struct(p["node"].alias("node"), p["size"].alias("size"), p["tokens"].alias("tokens"))).alias("pivots"))


# --------------------------------------------------------------------------- the join


def links(docs: DataFrame, sets: DataFrame, seed: int, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """Links (a, b) between different sets of docs (text) whose components are those of all links; sets: (node, size), distinct."""
    spark = docs.sparkSession
    rows = docs.select("text").mapInArrow(_first_rows(seed), "token long, node long, n long")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    met = rows.repartition(parts, "token").sortWithinPartitions("token").mapInArrow(_met, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    alive = staged(met.join(sets, "node").where(F.col("n") > F.floor(F.col("size") / 10)).select("node"), "jaccard-alive")  # more(size) + 1
    known = spark.sparkContext.broadcast(bit_map(alive.select("node")))
    texts = docs.select("text").mapInArrow(_texts(seed, known), "node long, text string").dropDuplicates(["node"]).join(alive, "node", "left_semi")
    return verify(candidates(staged(texts, "jaccard-texts"), sets), task_tokens)


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", task_tokens: int = TASK_TOKENS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs; component_id: the smallest id reachable by links, itself included.

    Null and empty texts, and those without words, have no shingles, link with nothing and keep their own id. Rows that repeat a text
    or a set of shingles are one node and give a row each; null ids are left out of the minima (a component of null ids only has a
    null id). A text of fewer than five words is one shingle. Very long texts are like any others. Shingles are known by 64-bit
    hashes, sets by 128 bits of a digest. An empty table gives an empty result; other columns play no part.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    for seed in itertools.count(1):  # until no two sets have the same name; once, as good as always
        sets = staged(_with_node(own, seed), "jaccard-sets")
        nodes = staged(sets.where("size > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.max("size").alias("size"), F.min("check").alias("x"), F.max("check").alias("y")), "jaccard-nodes")
        if nodes.where("x != y").isEmpty():
            break
    found = staged(links(own, nodes.select("node", "size"), seed, task_tokens).distinct(), "jaccard-links")
    label = components(found)
    named = staged(nodes.select("node", "least").join(label, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label")), "jaccard-named")
    best = named.groupBy("label").agg(F.min("least").alias("component_id"))
    whole = staged(named.join(best, "label").select("node", "component_id"), "jaccard-components")
    n = F.col("size").alias("n_shingles")
    return sets.where("size > 0").join(whole, "node").select("doc_id", n, "component_id").unionByName(sets.where("size = 0").select("doc_id", n, F.col("doc_id").alias("component_id")))
