"""Alignment of two tokenizers over a corpus: groups between common byte ends, linked token pairs and their corpus-wide counts.

Each text is encoded once, by a byte-level BPE (A) and a sentence-piece BPE with byte fallback (B). Where tokens of both end at the
same byte, the two are linked and a group closes. Links are kept as ids in a staged table. An id pair is one packed int64,
``b << 32 | a``: each partition counts its keys by ``np.unique``, the partial counts are range-partitioned and sorted by key, and
runs of equal keys are summed as they stream by. Each range is written as one sorted shard, an Arrow file in the shared folder,
which the tasks that look counts up map into memory and search by ``np.searchsorted``.

What leaves the executors for the driver is one row a shard (its name, its first and last key) and the highest count of each id of
B in it: no more rows than ids of B and shards together.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, longs, scratch, staged, text_blocks

BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Most bytes of a vocabulary file, which is broadcast.
VOCABULARY_BYTES = 64 << 20
#: Partial counts of one shard, and distinct pairs that a task counts before it passes them on.
SHARD_ROWS, HELD = 1 << 20, 1 << 20
#: Bytes of text that are encoded at a time: a token takes some tens of bytes then.
BLOCK = 1 << 18
#: Code points of a text that is encoded by ranks.
PLAIN = 1 << 16
#: Links that a task counts or looks up at a time.
LOOKED_UP = 1 << 19
DIGITS = 10

LINKS = T.StructType(
    [
        *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")),
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("a", T.ArrayType(T.IntegerType())),
        T.StructField("b", T.ArrayType(T.IntegerType())),
    ]
)
SHARD = "path string, first long, last long, n long, b array<int>, top array<long>"


# --------------------------------------------------------------------------- vocabularies


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def bytes_of_a(vocabulary: bytes) -> list[bytes]:
    """The bytes of each id of a byte-level BPE; special tokens, which are never encoded to, have none."""
    of, vocab = _byte_alphabet(), json.loads(vocabulary)["model"]["vocab"]
    out = [b""] * (max(vocab.values()) + 1)
    for token, k in vocab.items():
        out[k] = bytes(of[c] for c in token) if all(c in of for c in token) else b""
    return out


def bytes_of_b(model) -> list[bytes]:
    """The bytes of each piece: U+2581 is a space, <0xHH> a byte; control pieces have none."""
    silent = lambda k: model.is_control(k) or model.is_unknown(k)
    return [b"" if silent(k) else bytes([int(model.id_to_piece(k)[3:5], 16)]) if model.is_byte(k) else model.id_to_piece(k).replace("\u2581", " ").encode() for k in range(model.get_piece_size())]


#: Fixed value: how a byte-level BPE cuts a text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranked(vocabulary: bytes, of: list[bytes]):
    """The same byte-level BPE as ranks of byte strings, which encodes four times as fast; None for a file whose merges aren't in order of their ids."""
    import tiktoken

    own = json.loads(vocabulary)
    model, cut = own["model"], own["pre_tokenizer"] or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"][x + y] for x, y in pairs]
    odd = own["normalizer"] or any(model.get(c) for c in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if odd or cut.get("type") != "ByteLevel" or not cut.get("use_regex") or cut.get("add_prefix_space") or any(x >= y for x, y in zip(ids, ids[1:], strict=False)):
        return None
    special = {t["id"] for t in own["added_tokens"]}
    return tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks={x: k for k, x in enumerate(of) if x and k not in special}, special_tokens={})


def _plain(t: str) -> bool:
    """Whether both ways must agree on a text: of characters whose classes no version of Unicode has changed, and too short for a limit of the regular expressions."""
    if len(t) > PLAIN:
        return False
    try:
        t.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@functools.lru_cache(maxsize=1)
def _models(a: bytes, b: bytes):
    """Both encoders and the bytes of their ids; made once in a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_str(a.decode()), SentencePieceProcessor(model_proto=b)
    one.encode_special_tokens = True  # their strings are plain text
    of = bytes_of_a(a)
    return one, two, of, bytes_of_b(two), ranked(a, of)


def vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(VOCABULARY_BYTES + 1)
    if len(raw) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return raw


# --------------------------------------------------------------------------- groups and links


def _decimal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to n-1, from the left, and how many there are."""
    text = np.array([str(k).ljust(DIGITS) for k in range(n)], f"S{DIGITS}")
    return text.view(np.uint8).reshape(n, DIGITS), np.char.str_len(np.char.rstrip(text)).astype(np.int64)


def _counts(ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the ascending ends each text has, whose own ends are ``at``."""
    return np.diff(np.searchsorted(ends, at, side="right"), prepend=0)


class Aligner:
    """Groups and links of blocks of texts."""

    def __init__(self, a: bytes, b: bytes):
        self.one, self.two, self.bytes_a, self.bytes_b, self.ranked = _models(a, b)
        self.size_a, self.size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.digits, self.width = _decimal(max(len(self.bytes_a), len(self.bytes_b)))

    def encoded(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], list[int]]:
        """Ids by A and B, and the length in bytes, of each text; none where the ids don't give the text back."""
        a = self.by_a([" " + t for t in texts])
        b = self.two.encode(texts, num_threads=1)
        sizes = []
        for k, t in enumerate(texts):
            want = b" " + t.encode()
            if t and b"".join(map(self.bytes_a.__getitem__, a[k])) == want == b"".join(map(self.bytes_b.__getitem__, b[k])):
                sizes.append(len(want))
            else:
                a[k], b[k] = [], []
                sizes.append(0)
        return a, b, sizes

    def by_a(self, texts: list[str]) -> list[list[int]]:
        """Ids by A: of plain texts by its ranks, of others by its merges."""
        quick = [self.ranked is not None and _plain(t) for t in texts]
        rest = iter(self.one.encode_batch_fast([t for t, q in zip(texts, quick, strict=True) if not q], add_special_tokens=False))
        return [self.ranked.encode_ordinary(t) if q else next(rest).ids for t, q in zip(texts, quick, strict=True)]

    def block(self, texts: list[str]) -> dict[str, list]:
        """For each text its counts, the digest of its groups, and the ids of its links."""
        lists_a, lists_b, sizes = self.encoded(texts)
        a, b = (np.fromiter((k for x in lists for k in x), np.int64, sum(map(len, lists))) for lists in (lists_a, lists_b))
        end_a, end_b, at = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), np.cumsum(sizes)
        total = int(at[-1]) if len(at) else 0
        mark_a, mark_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        mark_a[end_a], mark_b[end_b] = True, True
        last_a, last_b = mark_b[end_a], mark_a[end_b]  # the tokens that close a group
        n_a, n_b, n_links = _counts(end_a, at), _counts(end_b, at), _counts(end_a[last_a], at)
        text, cut = self._groups(a, b, last_a, last_b, np.cumsum(n_a + n_b))
        digests = [hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else "" for s, e in zip([0, *cut[:-1]], cut, strict=True)]
        return {"n_a": n_a, "n_b": n_b, "n_links": n_links, "digests": digests, "a": a[last_a], "b": b[last_b]}

    def _groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, ends: np.ndarray) -> tuple[memoryview, list[int]]:
        """The groups of all texts as bytes, a separator after each id, and where each text's end; ends: of ids of both."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b = np.r_[0, np.flatnonzero(last_b) + 1]  # ids of B in earlier groups
        upto_a = np.flatnonzero(last_a) + 1
        ids, sep = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
        at_a, at_b = np.arange(len(a)) + before_b[group_a], np.arange(len(b)) + upto_a[group_b]
        ids[at_a], ids[at_b] = a, b
        sep[at_a], sep[at_b] = np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))
        width = self.width[ids]
        chars = np.empty((len(ids), DIGITS + 1), np.uint8)
        chars[:, :-1] = self.digits[ids]
        chars[np.arange(len(ids)), width] = sep
        upto = np.r_[0, np.cumsum(width + 1)]
        return memoryview(chars[np.arange(DIGITS + 1) <= width[:, None]].tobytes()), upto[ends].tolist()


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values.astype(np.int32)))


def with_links(docs: DataFrame, text: str = "text", keep: list[str] | None = None, a: str = BYTE_BPE, b: str = PIECE_BPE) -> DataFrame:
    """docs with n_a, n_b, n_groups, n_links, groups_sha256 and the linked ids, arrays a and b. Columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary(a), vocabulary(b)))

    def align(column: pa.Array) -> dict[str, pa.Array]:
        own = Aligner(*shared.value)
        parts = [own.block(column.slice(i, j - i).fill_null("").to_pylist()) for i, j, _, _ in text_blocks(column)]
        joined = {c: np.concatenate([p[c] for p in parts]) for c in ("n_a", "n_b", "n_links", "a", "b")}
        n = joined["n_links"]
        digests = pa.array([d for p in parts for d in p["digests"]], pa.string())
        return {"n_a": longs(joined["n_a"]), "n_b": longs(joined["n_b"]), "n_groups": longs(n), "n_links": longs(n), "groups_sha256": digests, "a": _lists(joined["a"], n), "b": _lists(joined["b"], n)}

    return attach(docs, text, align, LINKS, keep, BLOCK)


# --------------------------------------------------------------------------- counts of pairs


def keys_of(batch: pa.RecordBatch, a: str = "a", b: str = "b") -> np.ndarray:
    """The packed keys of all links of a batch."""
    flat = lambda c: batch.column(batch.schema.get_field_index(c)).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat(b) << 32 | flat(a)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches, about LOOKED_UP links at a time."""
    for batch in batches:
        ends = np.cumsum(batch.column(batch.schema.get_field_index("a")).value_lengths().to_numpy(zero_copy_only=False))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + LOOKED_UP, side="right")))
            yield batch.slice(i, j - i)
            i = j


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal keys, which are sorted, as one with the sum."""
    if not len(keys):
        return keys, counts
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts, starts)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n) of a partition's links, each key once while no more than HELD are held."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in _parts(batches):
        k, n = np.unique(keys_of(batch), return_counts=True)
        keys, counts = np.r_[keys, k], np.r_[counts, n]
        order = np.argsort(keys, kind="stable")
        keys, counts = _summed(keys[order], counts[order])
        if len(keys) > HELD:
            yield pa.RecordBatch.from_arrays([longs(keys), longs(counts)], names=["key", "n"])
            keys, counts = keys[:0], counts[:0]
    if len(keys):
        yield pa.RecordBatch.from_arrays([longs(keys), longs(counts)], names=["key", "n"])


def filesystem(uri: str):
    """The file system of a folder of Spark's, and the folder's path in it."""
    from pyarrow.fs import FileSystem

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted (key, n) rows, equal keys in one partition, to one shard a partition; an attempt that is lost leaves a file that nothing names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        carry: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.int64), np.empty(0, np.int64))
        for batch in batches:
            k, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            k, n = _summed(np.r_[carry[0], k], np.r_[carry[1], n])
            keys.append(k[:-1])
            counts.append(n[:-1])
            carry = k[-1:], n[-1:]  # may go on in the next batch
        k, n = np.concatenate([*keys, carry[0]]), np.concatenate([*counts, carry[1]])
        if not len(k):
            return
        fs, at = filesystem(folder)
        name = f"{uuid.uuid4().hex}.arrow"
        fs.create_dir(at, recursive=True)
        table = pa.table({"key": longs(k), "n": longs(n)}).combine_chunks()
        with fs.open_output_stream(f"{at}/{name}") as f, pa.ipc.new_file(f, table.schema) as out:
            out.write_table(table)
        ids = (k >> 32).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        one = lambda x, kind: pa.array([x], kind)
        made = [one(name, pa.string()), one(int(k[0]), pa.int64()), one(int(k[-1]), pa.int64()), one(len(k), pa.int64()), one(ids[starts].tolist(), pa.list_(pa.int32())), one(np.maximum.reduceat(n, starts).tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(made, names=["path", "first", "last", "n", "b", "top"])

    return run


class Counts:
    """Corpus-wide counts of pairs in sorted shards, and the highest count of each id of B."""

    def __init__(self, folder: str, shards: list, top: np.ndarray):
        self.folder, self.shards, self.top = folder, shards, top  # shards: (name, first key, last key), by first key

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The counts of ascending keys; zero for one that the corpus doesn't have."""
        out = np.zeros(len(keys), np.int64)
        for name, first, last in self.shards:
            i, j = np.searchsorted(keys, first), np.searchsorted(keys, last, side="right")
            if i < j:
                k, n = _shard(self.folder, name)
                at = np.minimum(np.searchsorted(k, keys[i:j]), len(k) - 1)
                out[i:j] = np.where(k[at] == keys[i:j], n[at], 0)
        return out


@functools.lru_cache(maxsize=64)
def _shard(folder: str, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of a shard, mapped where the folder is mounted, else read."""
    fs, at = filesystem(folder)
    local = fs.type_name == "local"
    source = pa.memory_map(f"{at}/{name}") if local else fs.open_input_file(f"{at}/{name}")
    table = pa.ipc.open_file(source).read_all().combine_chunks()
    return tuple(table[c].chunk(0).to_numpy(zero_copy_only=True) for c in ("key", "n"))


def count_pairs(links: DataFrame, shard_rows: int = SHARD_ROWS) -> Counts:
    """The counts of all id pairs of links (arrays a, b)."""
    spark = links.sparkSession
    partial = staged(links.select("a", "b").mapInArrow(_partial, "key long, n long"), "align-partial")
    rows = partial.count()
    folder = scratch(spark, "align-shards")
    sorted_ = partial.repartitionByRange(max(1, -(-rows // shard_rows)), "key").sortWithinPartitions("key")
    made = staged(sorted_.mapInArrow(_writer(folder), SHARD), "align-index").orderBy("first").collect()  # a row a shard
    top = np.zeros(max((r["b"][-1] for r in made), default=-1) + 1, np.int64)
    for r in made:
        top[r["b"]] = np.maximum(top[r["b"]], r["top"])
    return Counts(folder, [(r["path"], r["first"], r["last"]) for r in made], top)


def with_counts(links: DataFrame, counts: Counts, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of links with n_best (links whose pair is their B id's most frequent, ties included) and count_sum."""
    new = T.StructType([T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    schema = T.StructType([*(links.schema[c] for c in keep), *new])
    shared = links.sparkSession.sparkContext.broadcast((counts.folder, counts.shards, counts.top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Counts(*shared.value)
        for batch in _parts(batches):
            keys, back = np.unique(keys_of(batch), return_inverse=True)
            n = own.of(keys)
            best = (n == own.top[keys >> 32])[back] if len(keys) else np.empty(0, bool)
            ends = np.cumsum(batch.column(batch.schema.get_field_index("a")).value_lengths().to_numpy(zero_copy_only=False))
            per_doc = lambda x: longs(np.diff(np.r_[0, np.cumsum(x)][ends], prepend=0))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), per_doc(best.astype(np.int64)), per_doc(n[back])], names=schema.names)

    return links.select(*keep, "a", "b").mapInArrow(run, schema)


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str = BYTE_BPE, b: str = PIECE_BPE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) for each row of docs.

    Null and empty texts, and those whose joined token bytes aren't a space and the text (such as texts with U+2581), have no tokens:
    zeros, an empty digest, and no part in the counts. Repeated rows count each; ids may be null or repeat. An id pair tied for the
    highest count of its B id is best. An empty table gives an empty result; other columns play no part. A text is encoded whole by
    one task, in the memory that its tokens need.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    links = staged(with_links(own, keep=["doc_id"], a=a, b=b), "align-links")
    return with_counts(links, count_pairs(links, shard_rows), ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
