"""A search index that takes and loses pages without being rebuilt, for ``search``'s BM25.

Tables of one snapshot folder (``sources.snapshots``), each a list of parts:

* ``<name>.docs``: a part is a segment; rows (key, length, terms, block, segment). A segment's pages are numbered in order of their
  lengths, 256 to a block.
* ``<name>.postings``: the same by term: rows (bucket, term, segment, block, n, max_tf, min_length, pages), a row a term and block, in
  folders by the term's bucket and in order of terms and blocks inside.
* ``<name>.df``: signed document counts by term; their sums are the frequencies of the live pages, as the sums of the parts' tags are
  the number and length of these.
* ``<name>.gone``: tombstones: key is gone from the segments below ``below``.

Segments never change. ``add`` writes one (a page whose key is there already replaces it), ``remove`` writes tombstones, ``merge``
puts the segments of a size tier into one and leaves tombstones behind that no segment needs any more. ``search`` takes an upper
bound for each block from max_tf and min_length, scores the best blocks for a threshold, then the blocks that can pass it: the score
grows with tf and falls with length, so no page that belongs to the best k is missed, whatever was added or removed since.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import snapshots
from . import search as bm25

BUCKETS = 64
BLOCK_BITS = 8
#: As many segments of a tier are merged; tiers are powers of it.
FANOUT = 8
#: Up to so many chosen blocks are named in the scan's filter; more are joined only.
NAMED = 1000

_TERMS = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]))


@F.pandas_udf(_TERMS)
def _counted(words: pd.Series) -> pd.Series:
    return words.map(lambda ws: [{"term": t, "tf": n} for t, n in sorted(Counter(ws).items())])


def _bucket(term: Column) -> Column:
    return F.pmod(F.crc32(term.cast("binary")), F.lit(BUCKETS)).cast("int")


def _parts(snap: snapshots.Snapshot, name: str, table: str) -> tuple[dict, ...]:
    return snap.parts(f"{name}.{table}")


def _table(spark: SparkSession, snap: snapshots.Snapshot, name: str, table: str) -> DataFrame:
    return snap.table(spark, f"{name}.{table}")


def _live(rows: DataFrame, spark: SparkSession, snap: snapshots.Snapshot, name: str) -> DataFrame:
    """rows (key, segment, ...) without those that a tombstone covers."""
    if not _parts(snap, name, "gone"):
        return rows
    gone = _table(spark, snap, name, "gone").groupBy("key").agg(F.max("below").alias("below_"))
    return rows.join(gone.select(F.col("key").alias("key_"), "below_"), (F.col("key") == F.col("key_")) & (F.col("segment") < F.col("below_")), "left_anti")


def _write_docs(rows: DataFrame, root: str, name: str, segment: int) -> tuple[dict, DataFrame]:
    """(key, length, terms) as a segment, numbered in order of length; and the segment as written, so that numbers are what readers see."""
    ordered = rows.repartitionByRange("length", "key").sortWithinPartitions("length", "key")
    blocks = ordered.select("key", "length", "terms", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("block"), F.lit(segment).cast("long").alias("segment"))
    part = snapshots.write_part(blocks, root, f"{name}.docs", segment=segment)
    return part, snapshots.read_parts(rows.sparkSession, root, blocks.schema.json(), (part,))


def _postings(docs: DataFrame) -> DataFrame:
    each = docs.select("key", "length", "segment", "block", F.explode("terms").alias("t"))
    page = F.struct("key", F.col("t.tf").alias("tf"), "length")
    rows = each.groupBy(F.col("t.term").alias("term"), "segment", "block").agg(
        F.count("*").alias("n"), F.max("t.tf").alias("max_tf"), F.min("length").alias("min_length"), F.array_sort(F.collect_list(page)).alias("pages")
    )  # a block has at most 256 pages
    rows = rows.withColumn("bucket", _bucket(F.col("term")))
    return rows.repartitionByRange("bucket", "term", "block").sortWithinPartitions("bucket", "term", "block")


def _write_postings(docs: DataFrame, root: str, name: str, segment: int) -> tuple[dict, str]:
    rows = _postings(docs)
    return snapshots.write_part(rows, root, f"{name}.postings", ("bucket",), {"parquet.page.size": str(1 << 16)}, segment=segment), rows.schema.json()


def _change(spark: SparkSession, root: str, name: str, added: DataFrame | None, keys: DataFrame) -> snapshots.Snapshot:
    """Adds (key, length, terms) and takes the pages of keys out of the segments that are there, in one version."""
    base = snapshots.latest(spark, root)
    root, segment = base.root, base.version + 1
    tables = {t: list(_parts(base, name, t)) for t in ("docs", "postings", "df", "gone")}
    schema = {t: base.tables[f"{name}.{t}"].schema for t in tables if f"{name}.{t}" in base.tables}
    counts = []
    pages = length = 0
    if added is not None:
        part, docs = _write_docs(added, root, name, segment)
        if part["rows"]:
            postings, schema["postings"] = _write_postings(docs, root, name, segment)
            schema["docs"] = docs.schema.json()
            tables["docs"].append(part)
            tables["postings"].append(postings)
            pages, length = part["rows"], docs.agg(F.sum("length")).first()[0]
            counts.append(docs.select(F.explode("terms.term").alias("term"), F.lit(1).alias("by")))
            keys = docs.select("key")
    if _parts(base, name, "docs"):
        own = _live(_table(spark, base, name, "docs"), spark, base, name).join(keys.dropDuplicates(["key"]), "key", "left_semi")
        own = own.select("key", F.lit(segment).cast("long").alias("below"), "length", "terms")
        part = snapshots.write_part(own, root, f"{name}.gone", below=segment)
        if part["rows"]:
            schema["gone"] = own.schema.json()
            tables["gone"].append(part)
            gone = snapshots.read_parts(spark, root, schema["gone"], (part,))
            pages, length = pages - part["rows"], length - gone.agg(F.sum("length")).first()[0]
            counts.append(gone.select(F.explode("terms.term").alias("term"), F.lit(-1).alias("by")))
    if not counts:
        return base
    df = counts[0] if len(counts) == 1 else counts[0].union(counts[1])
    tables["df"].append(_write_df(df, root, name, schema, pages=pages, length=length))
    return snapshots.commit(spark, base, {f"{name}.{t}": snapshots.Table(schema[t], tuple(p)) for t, p in tables.items() if p})


def _write_df(counts: DataFrame, root: str, name: str, schema: dict, **tags: object) -> dict:
    df = counts.groupBy("term").agg(F.sum("by").cast("long").alias("by")).where("by != 0").withColumn("bucket", _bucket(F.col("term")))
    df = df.repartition("bucket").sortWithinPartitions("bucket", "term")
    schema["df"] = df.schema.json()
    return snapshots.write_part(df, root, f"{name}.df", ("bucket",), **tags)


def add(docs: DataFrame, root: str, name: str, key: str, body: str = "text", stop: frozenset[str] = bm25.STOP, stems: bool = True) -> snapshots.Snapshot:
    """Adds pages; one whose key is in the index replaces what is there. Null keys are skipped, of rows with one key the least text stays."""
    one = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(F.coalesce(F.col(body), F.lit(""))).alias("body"))
    words = one.select("key", bm25.terms(F.col("body"), stop, stems).alias("words"))
    rows = words.select("key", F.size("words").cast("long").alias("length"), _counted("words").alias("terms"))
    return _change(docs.sparkSession, root, name, rows, one.select("key"))


def remove(keys: DataFrame, root: str, name: str, key: str) -> snapshots.Snapshot:
    """Takes pages out; keys that aren't in the index do nothing."""
    return _change(keys.sparkSession, root, name, None, keys.select(F.col(key).alias("key")))


def merge(spark: SparkSession, root: str, name: str, fanout: int = FANOUT) -> snapshots.Snapshot:
    """Merges the smallest tier that has ``fanout`` segments or more, and the frequencies if they have as many parts; else nothing.

    A page is rewritten once a tier, so adding N pages in small lots writes N log N of them in all. Pages, frequencies and so scores
    stay. Call it after ``add``; it returns the newest version.
    """
    base = snapshots.latest(spark, root)
    tier = lambda p: int(math.log(max(p["rows"], 1), fanout) + 1e-9)
    docs = _parts(base, name, "docs")
    full = [t for t, n in sorted(Counter(map(tier, docs)).items()) if n >= fanout]
    new: dict[str, snapshots.Table] = {}
    table = lambda t: base.tables[f"{name}.{t}"]
    if full:
        old = [p for p in docs if tier(p) == full[0]]
        numbers = {p["tags"]["segment"] for p in old}
        rest = lambda t: [p for p in _parts(base, name, t) if p["tags"]["segment"] not in numbers]
        rows = _live(base.table(spark, f"{name}.docs", tuple(old)), spark, base, name).select("key", "length", "terms")
        part, made = _write_docs(rows, base.root, name, base.version + 1)
        kept, postings = rest("docs"), rest("postings")
        if part["rows"]:
            kept.append(part)
            postings.append(_write_postings(made, base.root, name, base.version + 1)[0])
        least = min((p["tags"]["segment"] for p in kept), default=base.version + 1)
        new["docs"] = snapshots.Table(table("docs").schema, tuple(kept))
        new["postings"] = snapshots.Table(table("postings").schema, tuple(postings))
        if _parts(base, name, "gone"):
            new["gone"] = snapshots.Table(table("gone").schema, tuple(p for p in _parts(base, name, "gone") if p["tags"]["below"] > least))
    if len(_parts(base, name, "df")) >= fanout:
        schema: dict[str, str] = {}
        pages, length = totals(base, name)
        part = _write_df(_table(spark, base, name, "df"), base.root, name, schema, pages=pages, length=length)
        new["df"] = snapshots.Table(schema["df"], (part,))
    return snapshots.commit(spark, base, {f"{name}.{t}": v for t, v in new.items()}) if new else base


def totals(snap: snapshots.Snapshot, name: str) -> tuple[int, int]:
    """The number of live pages and of their terms, from the manifest alone."""
    parts = _parts(snap, name, "df")
    return sum(p["tags"]["pages"] for p in parts), sum(p["tags"]["length"] for p in parts)


def _of_terms(rows: DataFrame, terms: list[str]) -> DataFrame:
    """Of a table in folders by bucket, the rows of some terms: other folders aren't listed for reading, other terms' row groups are passed over."""
    return rows.where(F.col("bucket").isin(*sorted({zlib.crc32(t.encode()) % BUCKETS for t in terms}))).where(F.col("term").isin(*terms))


@dataclass(frozen=True)
class Found:
    """A search: its rows (key, score), best first; the blocks that hold one of its terms, and how many of them had to be scored."""

    rows: DataFrame
    blocks: int
    scored: int


def search(spark: SparkSession, snap: snapshots.Snapshot, name: str, query: list[str], k: int = 10, first: int = 8, stop: frozenset[str] = bm25.STOP, stems: bool = True, k1: float = bm25.K1, b: float = bm25.B) -> Found:
    """The k best pages by the words of a query, ties by key; ``first`` blocks are scored for the threshold.

    Only a row a query term, ``first`` blocks' names, k scores, two counts and at most ``NAMED`` block names come to the driver.
    """
    wanted = bm25.query_terms(query, stop, stems)
    n, length = totals(snap, name)
    key_type = next((f.dataType for f in _table(spark, snap, name, "docs").schema if f.name == "key"), T.StringType()) if _parts(snap, name, "docs") else T.StringType()
    none = spark.createDataFrame([], T.StructType([T.StructField("key", key_type), T.StructField("score", T.DoubleType())]))
    if not wanted or n <= 0 or not length:
        return Found(none, 0, 0)
    df = {r["term"]: r["df"] for r in _of_terms(_table(spark, snap, name, "df"), wanted).groupBy("term").agg(F.sum("by").alias("df")).where("df > 0").collect()}
    if not df:
        return Found(none, 0, 0)
    known = sorted(df)
    idf = F.element_at(F.create_map(*(F.lit(x) for t in known for x in (t, math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))))), F.col("term"))
    gain = lambda tf, size: tf * (k1 + 1) / (tf + k1 * (1 - b + b * size / F.lit(length / n)))
    rows = _of_terms(_table(spark, snap, name, "postings"), known)
    bounds = rows.groupBy("segment", "block").agg(F.sum(idf * gain(F.col("max_tf"), F.col("min_length"))).alias("bound"))

    def scores(own: DataFrame) -> DataFrame:
        each = own.select("term", "segment", F.explode("pages").alias("p")).select("term", "segment", "p.*")
        return _live(each, spark, snap, name).groupBy("key").agg(F.sum(idf * gain(F.col("tf"), F.col("length"))).alias("score"))

    def named(blocks: list) -> Column:
        by: dict[int, list[int]] = {}
        for r in blocks:
            by.setdefault(r["segment"], []).append(r["block"])
        out = F.lit(False)
        for s, own in sorted(by.items()):
            out = out | ((F.col("segment") == s) & F.col("block").isin(*own))
        return F.col("block").isin(*sorted({x for own in by.values() for x in own})) & out

    head = bounds.orderBy(F.col("bound").desc(), "segment", "block").limit(first).collect()
    best = [r["score"] for r in scores(rows.where(named(head))).orderBy(F.col("score").desc()).limit(k).collect()]
    least = best[-1] * (1 - 1e-9) if len(best) == k else 0.0
    can = F.col("bound") >= least
    blocks, scored = bounds.agg(F.count("*"), F.count_if(can)).first()
    chosen = bounds.where(can).select("segment", "block")
    own = rows.where(named(chosen.collect())) if scored <= NAMED else rows.join(chosen, ["segment", "block"], "left_semi")
    return Found(scores(own).orderBy(F.col("score").desc(), F.col("key").asc()).limit(k), blocks, scored)
