"""Sharding by a two-pass external shuffle.

Pass one scatters every record, by seeded hashes, to a shard and to one of the shard's buckets; the number of buckets follows from
the table's bytes, so a bucket fits in a task's memory. Pass two puts a bucket's records in a canonical order, permutes them by
Fisher-Yates with a generator seeded by the bucket, and gives them their slots. Both passes depend on the records and the seed
alone, so a recomputed task gives the same rows.

Law ``key``: the id and the number of shards decide. The shard is the one of greatest seeded hash of (shard, id), so one more shard
takes records only into itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import fresh, row_hash, staged

SHARDS, SEED = 40, 17
#: Bytes of records in a bucket, on average.
BUCKET_BYTES = 8 << 20
#: Bytes of a record besides its text.
OVERHEAD = 16


def record_bytes(text: str) -> Column:
    """UTF-8 bytes of the text (null: none) and the overhead."""
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + OVERHEAD).cast("long")


def shard_of(doc_id: str, shards: int, seed: int = SEED) -> Column:
    """The shard of greatest seeded hash; of ties the last. Records with a null id share a shard."""
    return F.expr(f"array_max(transform(sequence(0, {shards - 1}), s -> struct(xxhash64({seed}L, s, `{doc_id}`) AS h, s AS s))).s")


def permutation(n: int, *seed: int) -> np.ndarray:
    """Fisher-Yates over 0..n-1."""
    order = list(range(n))
    draws = np.random.default_rng([abs(s) for s in seed]).random(n)
    picks = (draws * np.arange(1, n + 1)).astype(np.int64).tolist()
    for k in range(n - 1, 0, -1):
        j = picks[k]
        order[k], order[j] = order[j], order[k]
    return np.array(order, np.int64)


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """docs with shard int, slot long (gapless from 0 in each shard) and bucket int.

    Columns of docs with these names are replaced. Rows that repeat an id, or have a null one, share its shard but not its bucket:
    that follows from a hash of the whole row. Rows that are equal in all columns, id and all, share a bucket and are
    interchangeable. Null and empty texts are records of the overhead alone; a very long text is a record like any other, so its
    bucket is as large. An empty table gives an empty result.
    """
    stay = [c for c in docs.columns if c.lower() not in ("shard", "slot", "bucket")]
    total = docs.agg(F.sum(record_bytes(text))).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    kinds = {f.name: f.dataType for f in docs.schema}
    key, tie = fresh(docs, "bucket_key", "record_hash")
    place = (shard_of(doc_id, shards, seed) * F.lit(buckets) + F.pmod(F.xxhash64(F.lit(seed + 1), F.col(f"`{doc_id}`"), row_hash(docs)), F.lit(buckets))).cast("long")
    scattered = docs.select(*(F.col(f"`{c}`") for c in stay), place.alias(key), row_hash(docs).alias(tie))
    counts = docs.select(place.alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy(F.expr(f"key div {buckets}")).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(counts.select("key", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start")), "shard-starts")
    schema = T.StructType([*(T.StructField(c, kinds[c]) for c in stay), T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType()), T.StructField("bucket", T.IntegerType())])

    def permute(records: pa.Table, start: pa.Table) -> pa.Table:
        at = records.column(key)[0].as_py()
        ids = records.column(doc_id)
        order = [("id", "ascending"), ("tie", "ascending")]
        by = pc.sort_indices(pa.table({"id": ids, "tie": records.column(tie)}), sort_keys=order)
        n = len(by)
        rows = records.take(pc.take(by, pa.array(permutation(n, seed, at))))
        own = {"shard": pa.array(np.full(n, at // buckets, np.int32)), "slot": pa.array(start.column("start")[0].as_py() + np.arange(n)), "bucket": pa.array(np.full(n, at % buckets, np.int32))}
        return pa.table({**{c: rows.column(c) for c in stay}, **own})

    return scattered.groupBy(key).cogroup(starts.groupBy("key")).applyInArrow(permute, schema)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Shard folders of Parquet files; a file's rows are in slot order, bucket by bucket."""
    sharded.write.partitionBy("shard").parquet(path)
