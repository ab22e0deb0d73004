"""A training corpus from ``documents``: toxic documents go, one of each group of near duplicates stays, contaminated documents go,
sources are mixed, and what is left is sharded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the next one's docs; all but
the last return the columns of docs. The mixing stage repeats documents of small sources, each at most ``mixing.MAX_REPEATS``
times, and drops none.

No stage fails on nulls in any column, empty or very long texts, repeated rows or columns named like what it makes; each says what
becomes of them. Every stage gives an empty table for an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexarium.llm import decontaminate, mixing, shard, simhash, toxicity
from lexarium.llm.common import fresh, staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score, by a model of ``labels``, is under the threshold.

    A null or empty text has the score of no features, under the threshold wherever most labels are 0; equal texts go or stay
    together; a null id has no label to learn from and is scored like any other. Without labels all scores are a half, and all go.
    """
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row: that with the smallest id (null ids last), then the smallest digest of the text and
    hash of the row. Null and empty texts are one group; rows that are equal in all columns leave one."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which less than a twentieth is benchmark text. Null and empty texts have none and stay; each row is judged for
    itself, whatever its id; with an empty benchmark all stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources asks for. A null source is a source; null and empty texts pass once if their whole
    source has no words, else with their source; rows that repeat id and text are chosen together."""
    own = dict(zip(("n_tokens", "epoch", "mix_key"), fresh(docs, "n_tokens", "epoch", "mix_key"), strict=True))
    return mixing.mix(docs, **own).select(*(F.col(f"`{c}`") for c in docs.columns))


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard, slot and bucket, which replace columns of these names. The id decides the shard, so rows that repeat
    an id, and rows with a null one, share it; null texts are records like any other."""
    return shard.shard(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard_documents),
]

#: SQL cannot express the first two stages (a trained model; XXH64): the tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
