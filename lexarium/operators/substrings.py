"""Substring joins: which of many strings stand in which texts, by an automaton over the strings.

The strings, a side of any size, are taken in blocks of measured bytes. A block is one Aho-Corasick automaton, made once in a Python
worker, and every text is scanned by it once, whatever the number of strings; nothing is joined or multiplied, and no string is in a
plan. Blocks bound a worker's memory: an automaton takes some tens of bytes for each of its characters.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most UTF-8 bytes of the strings of one automaton.
BLOCK_BYTES = 4 << 20


@functools.lru_cache(maxsize=2)
def automaton(strings: tuple[str, ...]):
    import ahocorasick

    own = ahocorasick.Automaton()
    for k, s in enumerate(strings):
        own.add_word(s, k)
    own.make_automaton()
    return own


def blocks(items: DataFrame, item: str = "item", block_bytes: int = BLOCK_BYTES, rank: str | None = None) -> Iterator[list[str]]:
    """The distinct non-empty strings of a column in blocks of about so many bytes, one block at a time, each by rank and string; a longer string is one alone."""
    own = items.where(F.col(item) != "").groupBy(F.col(item).alias("item")).agg(F.min(F.col(rank) if rank else F.lit(0)).alias("rank"))
    total = own.agg(F.sum(F.octet_length("item") + 16)).first()[0] or 0
    parts = -(-total // block_bytes)
    for k in range(parts):
        mine = own.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == k).collect()  # about block_bytes
        if mine:
            yield [r["item"] for r in sorted(mine, key=lambda r: (r["rank"], r["item"]))]


def standing(spark, text: Column, strings: list[str], least: bool = False) -> Column:
    """array<int>: the places in ``strings`` of those that stand in the text, ascending (``least``: the first of them alone)."""
    shared = spark.sparkContext.broadcast(tuple(strings))

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        own = automaton(shared.value)
        out = []
        for t in texts.to_pylist():
            found = {k for _, k in own.iter(t)} if t else set()
            out.append([min(found)] if least and found else sorted(found))
        return pa.array(out, pa.list_(pa.int32()))

    return run(text)


def contained(items: DataFrame, docs: DataFrame, item_id: str, item: str, doc_id: str, text: str, prepare=lambda c: c, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, doc_id) for each item that stands in a document, both prepared (as by squeezing white space); an empty item stands nowhere.

    Documents are read once a block of items. Null texts have nothing in them; repeated rows of either side give rows each.
    """
    spark = items.sparkSession
    own = items.select(F.col(item_id).alias("item_id"), prepare(F.coalesce(F.col(item), F.lit(""))).alias("item"))
    whole = docs.select(F.col(doc_id).alias("doc_id"), prepare(F.col(text)).alias("text"))
    out = None
    for strings in blocks(own, "item", block_bytes):
        hits = whole.select("doc_id", F.explode(standing(spark, F.col("text"), strings)).alias("place"))
        named = spark.createDataFrame([*enumerate(strings)], "place int, item string")  # a block
        found = hits.join(F.broadcast(named).join(own, "item").select("place", "item_id"), "place").select("item_id", "doc_id")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], T.StructType([own.schema["item_id"], whole.schema["doc_id"]])) if out is None else out


def first_match(rows: DataFrame, patterns: DataFrame, value: str, pattern: str = "pattern", rank: str = "ord", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """rows with the columns of the first pattern, by rank, that the value contains in upper case; nulls where none does.

    Patterns of any number, in blocks: each gives a row its best pattern's rank, and the least of these ranks is joined to its fields.
    Of patterns of one rank that with the lesser string is taken; null patterns and empty ones match nothing; a null value has none.
    """
    spark = rows.sparkSession
    fields = [c for c in patterns.columns if c not in (pattern, rank)]
    known = patterns.where(F.col(pattern) != "").groupBy(F.col(pattern).alias("item")).agg(F.min(F.struct(F.col(rank).alias("rank"), *fields)).alias("p")).select("item", "p", F.col("p.rank").alias("rank"))
    best, names = rows, []
    for n, strings in enumerate(blocks(known, "item", block_bytes, "rank")):
        hit = F.struct("rank", "item", *(F.col(f"p.{c}").alias(c) for c in fields)).alias(f"hit_{n}_")
        named = spark.createDataFrame([*enumerate(strings)], "place_ int, item string").join(known, "item").select("place_", hit)  # a block
        best = best.withColumn("place_", F.get(standing(spark, F.upper(F.col(value)), strings, least=True), F.lit(0))).join(F.broadcast(named), "place_", "left").drop("place_")
        names.append(f"hit_{n}_")
    if not names:
        return rows.select("*", *(F.lit(None).cast(patterns.schema[c].dataType).alias(c) for c in fields))
    hit = F.least(*names) if len(names) > 1 else F.col(names[0])
    return best.withColumn("hit_", hit).select(*(F.col(f"`{c}`") for c in rows.columns), *(F.col(f"hit_.{c}").alias(c) for c in fields))
