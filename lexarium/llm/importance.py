"""Importance resampling towards a target distribution, by hashed word n-grams.

Each partition runs DuckDB on blocks of its texts: SQL takes their words, a registered function gives the zlib CRC of each run of one to
three, made from the CRCs of its words, and the buckets of these are counted by text. The counts are spilled to Parquet in the shared
folder, so every text is read once. Spark merges them into the bucket counts of the corpus and of the target, whose ratio gives each
bucket its gain, and scores the texts from the spilled counts. The highest scores, noise added, are drawn without replacement: a range
partition in that order, with the sizes of its parts, numbers them without gathering any rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach, longs, staged, text_blocks

BUCKETS, LEAST_WORDS, SHARE, SEED = 10_000, 20, (5, 100), 42
#: DuckDB gets texts in blocks of about so many bytes, and at most so much memory a task.
BLOCK, MEMORY = 1 << 19, "1GB"

#: ``texts`` (row, text) to (row, bucket, n).
SQL = r"""
WITH words AS (SELECT row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
     features AS (SELECT row, unnest(run_crcs(w)) % {buckets} AS bucket FROM words)
SELECT row, bucket, count(*) AS n FROM features GROUP BY ALL ORDER BY row, bucket
"""

#: buckets and counts are packed: a text's in two bytes each (four beyond 65536 buckets) and one byte each, a count above 255 as several.
COUNTED = T.StructType([T.StructField("n_features", T.LongType()), T.StructField("buckets", T.BinaryType()), T.StructField("counts", T.BinaryType())])


#: Words of more bytes get their CRC from zlib, one by one.
LONG = 64
#: What a zero byte makes of a CRC whose last byte is the index, but for the bytes before.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1)


def _zeros(tables: np.ndarray, at: np.ndarray | int, crc: np.ndarray) -> np.ndarray:
    """crc after the zero bytes whose four tables, one for each byte of a CRC, begin at ``at``."""
    return tables[at + (crc & 255)] ^ tables[at + 256 + (crc >> 8 & 255)] ^ tables[at + 512 + (crc >> 16 & 255)] ^ tables[at + 768 + (crc >> 24)]


def _zero_tables() -> list[np.ndarray]:
    """Tables for 0 to 63 zero bytes, 0 to 63 times 64 of them, and so on to lengths of 36 bits."""
    same = np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    once, out = _CRC[same & 255] ^ same >> 8, []
    for _ in range(6):
        made = [same]
        for _ in range(64):
            made.append(_zeros(once, 0, made[-1]))
        once = made.pop()
        out.append(np.concatenate(made))
    return out


_ZEROS = _zero_tables()


def followed(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What the CRCs add to that of a string in which n bytes come after theirs: xor with the CRC of these gives that of both."""
    out = _zeros(_ZEROS[0], (n & 63) << 10, crc)
    for k in range(1, len(_ZEROS)):
        far = np.flatnonzero(n >> 6 * k)
        if not len(far):
            break
        out[far] = _zeros(_ZEROS[k], (n[far] >> 6 * k & 63) << 10, out[far])
    return out


def _word_crcs(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRC-32 of each of these spans of bytes, in steps of one byte of all spans that have it."""
    out, order = np.empty(len(start), np.uint32), np.argsort(-np.minimum(size, LONG + 1).astype(np.int16), kind="stable")
    long = np.count_nonzero(size > LONG)
    for k in order[:long].tolist():
        out[k] = zlib.crc32(buf[start[k] : start[k] + size[k]])
    order = order[long:]
    at, less = start[order], -size[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k, n in enumerate(np.searchsorted(less, -np.arange(-less[0] if len(less) else 0)).tolist()):
        crc[:n] = _CRC[(crc[:n] ^ buf[at[:n] + k]) & 255] ^ crc[:n] >> 8
    out[order] = ~crc
    return out


def run_crcs(column: pa.ChunkedArray | pa.Array) -> pa.ChunkedArray:
    """For each list of words the unsigned CRC-32 of the UTF-8 bytes of its runs of 1 to 3 words, joined by a space."""
    out = []
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        lists, words = part.offsets.to_numpy().astype(np.int64), part.values.cast(pa.large_binary())
        _, where, data = words.buffers()
        offs = np.frombuffer(where, np.int64)[words.offset + lists[0] : words.offset + lists[-1] + 1] if len(words) else np.zeros(1, np.int64)
        buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        size, n = np.diff(offs), np.diff(lists)
        crc = _word_crcs(buf, offs[:-1], size)
        spaced = followed(np.full(len(crc), zlib.crc32(b" "), np.uint32), size) ^ crc  # of a space and the word
        made = np.empty((len(crc), 3), np.uint32)
        made[:, 0] = crc
        for k in (1, 2):  # runs beyond the list's end are made too, and left out below
            crc = followed(crc[: max(0, len(size) - k)], size[k:] + 1) ^ spaced[k:]
            made[: len(crc), k] = crc
        rest = np.repeat(lists[1:] - lists[0], n) - np.arange(len(size))
        ends = np.cumsum(n + np.maximum(0, n - 1) + np.maximum(0, n - 2))
        out.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(made[rest[:, None] > np.arange(3)])))
    return pa.chunked_array(out, pa.list_(pa.uint32()))


def connect():
    """An in-memory database with the function run_crcs, on one thread: the cores are Spark's."""
    import duckdb

    db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
    db.create_function("run_crcs", run_crcs, ["VARCHAR[]"], "UINTEGER[]", type="arrow", side_effects=False)
    return db


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of so many values a row."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _unpacked(buckets: pa.Array, counts: pa.Array, kind: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, buckets, counts, ends) of rows i to j-1, some hundred thousand counts at a time."""
    for i, j, n, ends in text_blocks(counts, BLOCK):
        yield i, j, next(text_blocks(buckets.slice(i, j - i), 1 << 62))[2].view(kind), n, ends


def with_features(docs: DataFrame, text: str = "text", keep: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """docs with n_features, buckets (ascending) and counts, packed: how many runs of 1 to 3 words fall into each bucket."""

    def count(column: pa.Array) -> dict[str, pa.Array]:
        db, total, at, counts, ends = connect(), [], [], [], [np.zeros(1, np.int64)]
        for i, j, _, _ in text_blocks(column, BLOCK):
            texts = pa.table({"row": longs(np.arange(j - i)), "text": column.slice(i, j - i).fill_null("")})
            db.register("texts", texts)
            made = db.execute(SQL.format(buckets=buckets)).fetchnumpy()
            db.unregister("texts")
            n, upto = made["n"], np.searchsorted(made["row"], np.arange(j - i), side="right")
            total.append(np.diff(np.r_[0, np.cumsum(n)][upto], prepend=0))
            times = (n + 254) // 255
            last = np.cumsum(times)
            small = np.full(last[-1] if len(last) else 0, 255, np.uint8)
            small[last - 1] = n - 255 * (times - 1)
            at.append(np.repeat(made["bucket"].astype(_kind(buckets)), times))
            counts.append(small)
            ends.append(ends[-1][-1] + np.r_[0, last][upto])
        db.close()
        ends = np.concatenate(ends)
        return {"n_features": longs(np.concatenate(total)), "buckets": _packed(np.concatenate(at), ends), "counts": _packed(np.concatenate(counts), ends)}

    return attach(docs, text, count, COUNTED, keep, 8 * BLOCK)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The count of each bucket over all rows; there are ``buckets`` of them, whatever the rows."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, at, n, _ in _unpacked(batch.column(0), batch.column(1), _kind(buckets)):
                total += np.bincount(at, n, minlength=buckets).astype(np.int64)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([longs(at), longs(total[at])], names=["bucket", "n"])

    out = [0] * buckets
    for r in features.select("buckets", "counts").mapInArrow(merged, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """What each bucket adds to a score: floor(1000 * ln of the ratio of its smoothed shares), target over corpus."""
    s, t = float(sum(corpus) + len(corpus)), float(sum(target) + len(target))
    return [math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t))) for a, b in zip(corpus, target, strict=True)]


def noise(doc_id, seed: int = SEED) -> int:
    """Gumbel noise of an id in whole thousandths, from a seeded hash; a null id is an empty string."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score) from spilled counts."""
    schema = T.StructType([features.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("n_features", "weight", "score"))])
    values = np.array(gain, np.int64)  # one a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.zeros(batch.num_rows, np.int64)
            for i, j, at, n, ends in _unpacked(batch.column(2), batch.column(3), _kind(len(values))):
                weight[i:j] = np.diff(np.r_[0, np.cumsum(values[at] * n)][ends])
            extra = np.array([noise(d, seed) for d in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), longs(weight), longs(weight + extra)], names=schema.names)

    return features.select("doc_id", "n_features", "buckets", "counts").mapInArrow(run, schema)


def features_of(words: int) -> int:
    """How many runs of 1 to 3 words so many words have; the inverse orders texts as their words do."""
    return words + max(0, words - 1) + max(0, words - 2)


def drawn(scores: DataFrame, least_words: int = LEAST_WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """scores with rank: 1, 2, 3... by score, ties to the smaller id (null ids last), for the share of all rows with enough words; else null.

    Rows go to ranges of that order; a row's number is its place in its range and the sizes of the ranges before, one number each.
    """
    fits = scores["n_features"] >= features_of(least_words)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    # a row's id is the number of its range, and below it its place there
    dealt = scores.where(fits).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dealt = staged(dealt, "importance-ranges").withColumn("range", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = dict(dealt.groupBy("range").count().collect())  # a row a range
    most = share[0] * sum(sizes.values()) // share[1]
    starts, before = [], 0
    for k in sorted(sizes):
        starts.append((k, before))
        before += sizes[k]
    first = scores.sparkSession.createDataFrame(starts, "range long, start long")
    rank = F.col("start") + F.col("place") + 1
    ranked = dealt.join(F.broadcast(first), "range").select("doc_id", "n_features", "weight", "score", F.when(rank <= most, rank).alias("rank"))
    return ranked.unionByName(scores.where(~fits).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS, least_words: int = LEAST_WORDS, share: tuple[int, int] = SHARE, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for each row of docs.

    Null and empty texts, and those without words, have no features: weight zero, no rank. Repeated rows count and are drawn each;
    rows of one id have the same noise; of rows equal in id and score those with fewer features, then of lower weight, come first. An
    empty target or corpus has smoothed shares like any other; an empty table gives an empty result. Other columns play no part. A
    text's features are made in one task, in DuckDB's bounded memory.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    spilled = staged(with_features(own, keep=["doc_id"], buckets=buckets), "importance-features")
    theirs = staged(with_features(target.select(F.col(f"`{target_text}`").alias("text")), keep=[], buckets=buckets), "importance-target")
    gain = gains(bucket_counts(spilled, buckets), bucket_counts(theirs, buckets))
    return drawn(staged(scored(spilled, gain, seed), "importance-scores"), least_words, share)
