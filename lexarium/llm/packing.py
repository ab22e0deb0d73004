"""Token ids packed into rows of one length: best-fit decreasing with a segment tree over free capacities.

Texts become ids of a given byte-level BPE vocabulary. A text of more than ``length`` ids is cut into pieces that, put together,
are its ids again. The pieces of a block of texts (about ``block_tokens`` ids, never across partitions, so nothing is shuffled) go,
longest first, each to the fullest row that still has room; a segment tree over the capacities finds it in logarithmic time. A row
holds its ids, the cumulative lengths of its segments, and positions that restart at zero with each segment.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH, PAD = 2048, 50256
BLOCK_TOKENS = 1 << 21
#: Most bytes of a vocabulary file, which is broadcast.
VOCABULARY_BYTES = 64 << 20



def packed_type(doc_id: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("doc_ids", T.ArrayType(doc_id)),
            T.StructField("starts", T.ArrayType(T.IntegerType())),
            T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
            T.StructField("input_ids", T.BinaryType()),
            T.StructField("position_ids", T.BinaryType()),
        ]
    )


class Capacities:
    """The open rows by free capacity; ``take(size)`` gives one of least capacity that has room."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.some = [0] * (2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(self.base)]

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        k = capacity + self.base
        while k and not self.some[k]:
            self.some[k] = 1
            k >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        some, k = self.some, size + self.base
        if not some[k]:
            while k > 1 and (k & 1 or not some[k + 1]):  # up to the first subtree to the right
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.base:
                k = 2 * k if some[2 * k] else 2 * k + 1
        capacity = k - self.base
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            some[k] = 0
            k >>= 1
            while k and not (some[2 * k] or some[2 * k + 1]):
                some[k] = 0
                k >>= 1
        return capacity, row


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """The pieces of each row, by best-fit decreasing; a piece is at most ``length`` long."""
    rows: list[list[int]] = []
    open_rows = Capacities(length)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        found = open_rows.take(sizes[k])
        if found:
            free, row = found
        else:
            free, row = length, len(rows)
            rows.append([])
        rows[row].append(k)
        if free > sizes[k]:
            open_rows.put(free - sizes[k], row)
    return rows


def encoder(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _rows(block: list[tuple], length: int, pad: int, kind: np.dtype, schema: T.StructType) -> pa.RecordBatch:
    pieces = [(doc, at, ids[at : at + length]) for doc, ids in block for at in range(0, len(ids), length)]
    columns: list[list] = [[] for _ in schema]
    for row in best_fit([len(p[2]) for p in pieces], length):
        own = [pieces[k] for k in row]
        sizes = [len(p[2]) for p in own]
        n = sum(sizes)
        ids = np.full(length, pad, kind)
        ids[:n] = np.concatenate([p[2] for p in own])
        positions = np.zeros(length, kind)
        positions[:n] = np.concatenate([np.arange(s) for s in sizes])
        for column, v in zip(columns, (n, [p[0] for p in own], [p[1] for p in own], np.concatenate(([0], np.cumsum(sizes))).tolist(), ids.tobytes(), positions.tobytes()), strict=True):
            column.append(v)
    return pa.RecordBatch.from_arrays([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema, strict=True)], names=schema.names)


def id_type(vocabulary_size: int, length: int) -> np.dtype:
    """Little-endian, of 2 bytes if ids and positions fit, else of 4."""
    return np.dtype("<u2" if max(vocabulary_size, length) < 1 << 16 else "<u4")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, length: int = LENGTH, pad: int = PAD, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Packed rows: n_tokens, doc_ids and starts (each segment's document and first id in it), cu_seqlens, input_ids and position_ids.

    The ids of a document, segments in order of their starts, are exactly those of its whole text. Null and empty texts have no
    ids and no segments; a very long text is cut like any other. doc_ids has the rows' own ids, of whatever type, null or not; rows
    that repeat an id have segments each. Other columns play no part; an empty table gives no rows. input_ids and position_ids are little-endian integers (``id_type``), padded with ``pad`` and zero to ``length``.
    """
    with open(vocabulary, "rb") as f:
        raw = f.read(VOCABULARY_BYTES + 1)
    if len(raw) > VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} is larger than {VOCABULARY_BYTES} bytes")
    kind = id_type(max(pad, raw.count(b"\n")), length)
    schema = packed_type(docs.schema[doc_id].dataType)
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode_ordinary
        block, total = [], 0
        for batch in batches:
            for doc, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if ids := encode(own.as_py() or ""):
                    block.append((doc, np.array(ids, kind)))
                    total += len(ids)
                if total >= block_tokens:
                    yield _rows(block, length, pad, kind, schema)
                    block, total = [], 0
        if block:
            yield _rows(block, length, pad, kind, schema)

    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)
