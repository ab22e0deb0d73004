"""Mixing sources to target weights, by DataFrame and SQL operations only.

A source's weight is its token share to a power (the inverse temperature), normalised. The power is bisected on [0, 1]: either to
the least one at which no source repeats more than ``max_repeats`` times, or to the one at which the weights have ``entropy``
(nats). Each source's budget, its weight's part of the total, is realised as whole passes over the source and a part of one more:
the documents whose seeded hash is at most the source's cut, where the cut is found on per-block token sums and then inside one
block.

The mix is a sequence of blocks (``in_blocks``). Each block has an integer budget of every source, its rows' part of the block within
one row, and is a permutation by a seeded hash. A source's rows are dealt over the blocks in the order of another hash, each source
from where the one before it ended, so that blocks are of one size, within one row; the stride from block to block is near the golden
ratio, so that a source of fewer rows than blocks is spread evenly over them.

``budget`` None: the least budget that passes every source at least once, so mixing repeats documents but drops none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh, staged

SEED = "mix-1"
MAX_REPEATS = 2.0
#: Most documents of a block.
BLOCK_DOCS = 4096
#: Bisection levels: so many jobs, each of so many levels at once.
JOBS, LEVELS = 5, 5


def tokens(text: str) -> Column:
    """Words of the text; a null has none."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def digest(text: str) -> Column:
    """32 hex digits of the text; those of the empty text for a null."""
    return F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"))


def order_key(purpose: str, seed: str, epoch: str, doc_id: str, digest: str) -> Column:
    """32 hex digits, uniform and independent for each purpose and epoch, of id and text: rows that share an id are spread too."""
    return F.expr(f"md5(concat('{seed}|{purpose}|', cast({epoch} AS string), '|', coalesce(cast({doc_id} AS string), ''), '|', {digest}))")


def _digits(n: Column) -> Column:
    """Hex digits of a block's number: the least for which so many documents fill blocks of at most BLOCK_DOCS."""
    out = F.lit(7)
    for k in range(6, -1, -1):
        out = F.when(n <= BLOCK_DOCS * 16**k, F.lit(k)).otherwise(out)
    return out


def exponent(sources: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, budget: int | None = None) -> float:
    """The bisected power, from (source, n_tokens) rows; sources without tokens play no part. One row a level comes to the driver.

    With max_repeats the upper end, which keeps the limit; at 1, the shares as they are, if no power does. With entropy the middle
    of the last interval.
    """
    logs = sources.where("n_tokens > 0").select(F.log("n_tokens").alias("l"))
    total = logs.agg(F.max("l").alias("m")).first()["m"]
    if total is None:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(JOBS):
        steps = 1 << LEVELS
        at = [low + (high - low) * k / steps for k in range(1, steps)]
        grid = logs.select("l", F.explode(F.array(*map(F.lit, at))).alias("a"))
        e = F.exp(F.col("a") * (F.col("l") - total))
        rows = grid.groupBy("a").agg(F.sum(e).alias("z"), F.sum(e * F.col("a") * (F.col("l") - total)).alias("x"), F.max((F.col("a") - 1) * (F.col("l") - total)).alias("most"), F.min((F.col("a") - 1) * (F.col("l") - total)).alias("least"))
        if entropy is not None:
            too_flat = {r["a"] for r in rows.select("a", (F.log("z") - F.col("x") / F.col("z") > entropy).alias("p")).where("p").collect()}
        elif budget is None:
            too_flat = {r["a"] for r in rows.where(F.exp(F.col("most") - F.col("least")) > max_repeats).collect()}
        else:
            too_flat = {r["a"] for r in rows.where(F.lit(float(budget)) * F.exp(F.col("most") - total) / F.col("z") > max_repeats).collect()}
        k, size = 0, steps
        while size > 1:  # the bisection's own path over the grid
            size //= 2
            k += size if at[k + size - 1] in too_flat else 0
        low, high = low + (high - low) * k / steps, low + (high - low) * (k + 1) / steps
    return high if entropy is None else (low + high) / 2


def plan(counted: DataFrame, seed: str = SEED, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """For each source of counted (doc_id, source, n_tokens, digest): weight, whole passes and the cut of the last, partial one."""
    sources = staged(counted.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs")), "mixing-sources")
    power = exponent(sources, max_repeats, entropy, budget)
    top, z = sources.where("n_tokens > 0").agg(F.max("n_tokens"), F.sum(F.pow(F.col("n_tokens").cast("double"), F.lit(power)))).first()
    if top is None:
        top, z = 1, 1.0
    share = F.pow(F.col("n_tokens").cast("double"), F.lit(power)) / z
    if budget is None:  # the largest source passes once
        wanted = F.floor(F.col("n_tokens") * F.pow(F.lit(float(top)) / F.col("n_tokens"), F.lit(1 - power)))
    else:
        wanted = F.floor(F.lit(float(budget)) * share)
    some = F.col("n_tokens") > 0
    out = sources.select("source", "n_docs", F.when(some, share).otherwise(F.lit(0.0)).alias("weight"), F.when(some, wanted).otherwise(F.lit(0)).cast("long").alias("wanted"), F.col("n_tokens").alias("size"))
    out = staged(out.select("source", "weight", F.when(some_size(), F.expr("wanted div size")).otherwise(F.lit(1)).alias("passes"), F.when(some_size(), F.col("wanted") % F.col("size")).otherwise(F.lit(0)).alias("rest"), _digits(F.col("n_docs")).alias("digits")), "mixing-plan")
    # tokens by block of the partial pass, then inside the block where the budget ends
    own = out.withColumnRenamed("source", "own")
    last = counted.join(own, F.col("source").eqNullSafe(F.col("own"))).where("rest > 0").select("own", "n_tokens", "rest", order_key("pick", seed, "passes", "doc_id", "digest").alias("h"), "digits")
    last = last.withColumn("block", F.substring("h", F.lit(1), F.col("digits")))
    sums = last.groupBy("own", "block").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("own").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    ends = staged(sums.withColumn("upto", F.sum("n").over(upto)).where("upto >= rest AND upto - n < rest").select("own", "block", (F.col("rest") - F.col("upto") + F.col("n")).alias("left")), "mixing-ends")
    inside = last.select("own", "block", "n_tokens", "h").join(ends.withColumnsRenamed({"own": "o", "block": "b"}), F.col("own").eqNullSafe(F.col("o")) & (F.col("block") == F.col("b")))
    before = Window.partitionBy("own").orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = inside.withColumn("upto", F.sum("n_tokens").over(before)).where(F.col("upto") >= F.col("left")).groupBy("own").agg(F.min("h").alias("cut"))
    return staged(out.join(cuts, F.col("source").eqNullSafe(F.col("own")), "left").select("source", "weight", "passes", F.coalesce("cut", F.lit("")).alias("cut")), "mixing-cuts")


def some_size() -> Column:
    return F.col("size") > 0


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, budget: int | None = None, n_tokens: str = "n_tokens", epoch: str = "epoch", mix_key: str = "mix_key") -> DataFrame:
    """docs, each row as often as its source's budget says, with epoch int, n_tokens long and mix_key string: the mix is the order by mix_key.

    A null source is a source; sources without tokens, as of null and empty texts, pass once; rows that repeat id and text are
    chosen together, others of one id, or of a null one, each for itself; an empty table gives none. The names of the new columns are parameters; columns of docs that have them are replaced.
    """
    stay = [c for c in docs.columns if c.lower() not in (epoch.lower(), mix_key.lower(), n_tokens.lower())]
    counted = staged(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), tokens(text).alias("n_tokens"), digest(text).alias("digest")), "mixing-counts")
    per_source = plan(counted, seed, max_repeats, entropy, budget)
    k1, k2, k3, k4, k5 = fresh(docs, "plan_source", "plan_passes", "plan_cut", "plan_times", "text_digest")
    per_source = per_source.select(F.col("source").alias(k1), F.col("passes").cast("int").alias(k2), F.col("cut").alias(k3))
    rows = docs.withColumn(k5, digest(text)).join(per_source, F.col(f"`{source}`").eqNullSafe(F.col(k1)))
    times = F.col(k2) + F.when(order_key("pick", seed, f"`{k2}`", f"`{doc_id}`", f"`{k5}`") <= F.col(k3), 1).otherwise(0)
    rows = rows.withColumn(k4, times).where(F.col(k4) > 0)
    rows = rows.select(*(F.col(f"`{c}`") for c in stay), tokens(text).alias(n_tokens), F.col(k5), F.explode(F.sequence(F.lit(0), F.col(k4) - 1)).alias(epoch))
    return rows.withColumn(mix_key, order_key("mix", seed, f"`{epoch}`", f"`{doc_id}`", f"`{k5}`")).drop(k5)


def stride(blocks: int) -> int:
    """The greatest number up to 0.618 of the blocks that has no factor in common with them."""
    return next((k for k in range(blocks * 618 // 1000, 0, -1) if math.gcd(k, blocks) == 1), 1)


def in_blocks(mixed: DataFrame, doc_id: str = "doc_id", block_docs: int = BLOCK_DOCS, source: str = "source", mix_key: str = "mix_key", block: str = "block", slot: str = "slot") -> DataFrame:
    """mixed with block int and slot int, the place in the block: blocks of at most block_docs rows, with each source's rows spread over
    them within one row.

    mixed is read three times, so stage it. A null source is a source. Rows that agree in key, id and source are alike; columns that
    have the new names are replaced; an empty table gives none. A source's rows are ranked inside pieces of about block_docs rows by
    the sums of the pieces before, so no task gets a whole source.
    """
    mixed = mixed.select(*(F.col(f"`{c}`") for c in mixed.columns if c.lower() not in (block.lower(), slot.lower())))
    n = mixed.count()
    blocks = max(1, -(-n // block_docs))
    digits = next(k for k in range(8) if n <= block_docs * 16**k or k == 7)
    piece, own, cut, start, rank = fresh(mixed, "piece", "own", "cut", "start", "rank")
    rows = mixed.withColumn(piece, F.substring(F.col(f"`{mix_key}`"), 1, digits))
    sizes = staged(rows.groupBy(F.col(f"`{source}`").alias(own), F.col(piece).alias(cut)).agg(F.count("*").alias("n")), "mixing-pieces")
    whole = sizes.groupBy(F.col(own).alias("source")).agg(F.sum("n").alias("n"))
    # one row a source
    whole = whole.select("source", (F.sum("n").over(Window.orderBy("source").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("first"))
    upto = F.sum("n").over(Window.partitionBy(own).orderBy(cut).rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    sizes = sizes.withColumn("upto", upto).join(whole, F.col(own).eqNullSafe(F.col("source"))).select(own, cut, (F.col("first") + F.col("upto")).alias(start))
    order = [F.col(f"`{c}`") for c in (mix_key, doc_id)]
    rows = rows.withColumn(rank, F.row_number().over(Window.partitionBy(f"`{source}`", piece).orderBy(*order)) - 1)
    rows = rows.join(sizes, F.col(f"`{source}`").eqNullSafe(F.col(own)) & (F.col(piece) == F.col(cut)))
    rows = rows.withColumn(block, ((F.col(start) + F.col(rank)) % blocks * stride(blocks) % blocks).cast("int"))
    place = F.row_number().over(Window.partitionBy(f"`{block}`").orderBy(*order, F.col(f"`{source}`"))) - 1
    return rows.withColumn(slot, place).select(*(F.col(f"`{c}`") for c in mixed.columns), F.col(f"`{block}`"), F.col(f"`{slot}`"))
