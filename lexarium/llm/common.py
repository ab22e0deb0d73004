"""What the operators share: staged tables, Arrow row functions, and vectorised words and hashes over UTF-8 bytes."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text is tokenised in blocks of about so many bytes (whole texts; a longer text is a block of its own).
BLOCK_BYTES = 1 << 20

_staged: list[str] = []


# --------------------------------------------------------------------------- staged tables


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where it is unset, a temporary folder in local mode, else one in the warehouse."""
    if at := spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        return at.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        return f"file://{tempfile.gettempdir()}/lexarium-staged"
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_lexarium_staged"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of that name in the shared one, deleted with the staged tables."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _staged:
        atexit.register(clear_staged)
    _staged.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts the lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def unstage(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing will read again."""
    for df in tables:
        if (path := getattr(df, "staged_path", None)) in _staged:
            _staged.remove(path)
            _delete(df.sparkSession, path)


def clear_staged() -> None:
    """Deletes the staged tables of this process; runs at its end too."""
    spark = SparkSession.getActiveSession()
    while _staged:
        path = _staged.pop()
        if spark is None:
            continue
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session is gone; the folder goes with the application
            return


def hot_join(big: DataFrame, small: DataFrame, on: list[str], count: str, how: str = "inner", parts: int = 2048) -> DataFrame:
    """big joined with small, which is staged, unique on ``on``, and has in ``count`` how many rows of big have each key, at least.

    Keys with more than 1 / parts of all these rows, of which there can't be more than parts, are broadcast with a number of lots;
    their rows are dealt over the lots, and their row of small is in each. So no task gets a hot key whole.
    """
    total, most = small.agg(F.sum(count), F.max(count)).first()
    limit = max(1 << 13, -(-(total or 0) // parts))
    if (most or 0) <= limit:
        return big.join(small, on, how)
    lots, lot = fresh(big, "lots", "lot")
    hot = F.broadcast(small.where(F.col(count) > limit).select(*on, F.ceil(F.col(count) / limit).cast("long").alias(lots)))
    dealt = big.join(hot, on, "left").withColumn(lot, F.when(F.col(lots).isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.monotonically_increasing_id(), F.col(lots)))).drop(lots)
    copies = small.join(hot, on, "left").withColumn(lot, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(lots), F.lit(1).cast("long")) - 1))).drop(lots)
    return dealt.join(copies, [*on, lot], how).drop(lot)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores before it until no column of df has it."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row but maps, which have no hash."""
    return F.xxhash64(*(F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()))


# --------------------------------------------------------------------------- row functions


def attach(df: DataFrame, of: str, fn: Callable[[pa.Array], dict[str, pa.Array]], new: T.StructType, keep: list[str] | None = None, block: int | None = None) -> DataFrame:
    """The columns ``keep`` of df (None: all) and those that ``fn`` makes, row for row, from Arrow batches of the column ``of``, which
    holds texts of about ``block`` bytes a batch if that is given.

    A column of df with the name of a new one is replaced.
    """
    names = {f.name.lower() for f in new}
    stay = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    need = [*dict.fromkeys([*stay, of])]
    schema = T.StructType([*(T.StructField(df.schema[c].name, df.schema[c].dataType) for c in stay), *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = batch.column(need.index(of))
                for part in [batch] if block is None else (batch.slice(i, j - i) for i, j, _, _ in text_blocks(at, block)):
                    made = fn(part.column(need.index(of)))
                    yield pa.RecordBatch.from_arrays([*(part.column(need.index(c)) for c in stay), *(made[f.name] for f in new)], names=[*stay, *(f.name for f in new)])

    return df.select(*(F.col(f"`{c}`") for c in need)).mapInArrow(run, schema)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, bytes, offsets) of rows i to j-1, about ``limit`` bytes at a time; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, where, data = column.buffers()
    offs = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1))
        yield i, j, buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


# --------------------------------------------------------------------------- words and hashes

_ALL = np.arange(256)
#: Word bytes of ``[^\x20\x09-\x0D]+``; all bytes of a code point above 0x7F are word bytes.
NOT_SPACE = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)
#: A-Z to a-z, other bytes as they are.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 0x20, _ALL).astype(np.uint8)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        p = np.full(n, base, np.uint64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        if n > 4 * BLOCK_BYTES:  # not kept for one very long text
            return p
        _powers[base] = p
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which each bit depends on all."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    acc = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * _power(_BASE, len(buf) + 1)[:-1], out=acc[1:])
    return acc


def span_hash(acc: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, equal for equal bytes wherever they lie; acc: the text's prefix_hash."""
    h = (acc[end] - acc[start]) * _power(_INVERSE, len(acc))[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and for each of its texts (and the end) the number of words before it."""
    m = is_word[buf]
    first, last = m.copy(), m.copy()
    if len(m):
        first[1:] &= ~m[:-1]
        last[:-1] &= ~m[1:]
        cut = offs[1:-1]
        cut = cut[(cut > 0) & (cut < len(m))]
        first[cut] = m[cut]
        last[cut - 1] = m[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offs)


_WEIGHTS = np.random.default_rng(77003).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def window_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n consecutive word hashes."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h += words[k : k + m] * _WEIGHTS[k % 64]
        if k % 8 == 7:
            h ^= h >> np.uint64(29)
            h *= np.uint64(_BASE)
    return mix(h)


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).astype(np.int64, copy=False))
