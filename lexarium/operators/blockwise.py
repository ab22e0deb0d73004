"""Running values over keys of any size: a key's rows are dealt to blocks by their order, so no key is one task.

The blocks of a key are cut at quantiles of its order column, from a mergeable sketch, as many as its rows ask for: a key of few rows
is one block, one with all rows is cut into all of them, and a value far from the others moves no cut. A window runs inside each
block; what the blocks before a block add up to comes from one row a block, and is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = "block_"
#: Blocks in all, about; and rows that a block has at least.
PARTS, LEAST = 256, 1024


def _number(rows: DataFrame, order: str) -> Column:
    """The order column, a number or time, as a double."""
    c = F.col(order)
    return c.cast("timestamp").cast("double") if rows.schema[order].dataType.typeName().startswith("timestamp") else c.cast("double")


def cuts(rows: DataFrame, by: list[str], order: str, parts: int = PARTS, least: int = LEAST) -> list[tuple]:
    """(key columns, ascending cuts) of each key with more than a block of rows: the values at which its blocks after the first begin.

    There are fewer such keys than ``parts``, and about as many cuts, so they come to the driver.
    """
    at = _number(rows, order)
    total = rows.count()
    size = max(least, -(-total // parts))
    sketch = F.percentile_approx(at, [k / parts for k in range(1, parts)], F.lit(100 * parts))
    large = rows.groupBy(*by).agg(F.count(at).alias("n_")).where(F.col("n_") > size)
    if not (names := large.collect()):
        return []
    same = F.lit(True)
    big = rows.sparkSession.createDataFrame(names, large.schema)
    for c in by:
        same = same & rows[c].eqNullSafe(big[c])
    found = rows.join(F.broadcast(big), same, "left_semi").groupBy(*by).agg(F.count(at).alias("n_"), sketch.alias("cuts_")).collect()
    out = []
    for r in found:
        blocks = -(-r["n_"] // size)
        wanted = [r["cuts_"][max(0, min(parts - 2, round(parts * k / blocks) - 1))] for k in range(1, blocks)]
        out.append((*(r[c] for c in by), sorted(set(wanted))))
    return out


def with_block(rows: DataFrame, by: list[str], order: str, parts: int = PARTS, least: int = LEAST) -> DataFrame:
    """rows with the number of their block: how many of the key's cuts their order value has reached. Nulls come first; equal values share a block."""
    own = cuts(rows, by, order, parts, least)
    if not own:
        return rows.withColumn(BLOCK, F.when(F.col(order).isNull(), -1).otherwise(0))
    kinds = ", ".join(f"{c}_own {rows.schema[c].dataType.simpleString()}" for c in by)
    table = rows.sparkSession.createDataFrame(own, f"{kinds}, cuts_ array<double>")
    same = F.lit(True)
    for c in by:
        same = same & rows[c].eqNullSafe(table[f"{c}_own"])
    at = _number(rows, order)
    # of every 16th cut, then of the 16 after it
    heads = F.size(F.filter(F.transform(F.sequence(F.lit(0), F.floor((F.size("cuts_") - 1) / 16).cast("int")), lambda k: F.get("cuts_", k * 16)), lambda c: c <= at))
    reached = F.when(heads == 0, 0).otherwise((heads - 1) * 16 + F.size(F.filter(F.slice("cuts_", (heads - 1) * 16 + 1, F.lit(16)), lambda c: c <= at)))
    block = F.when(at.isNull(), -1).when(F.col("cuts_").isNull(), 0).otherwise(reached)
    return rows.join(F.broadcast(table), same, "left").select(*(rows[c] for c in rows.columns), block.cast("int").alias(BLOCK))


_KINDS = {"sum": F.sum, "max": F.max}


def _before(totals: DataFrame, by: list[str], **values: tuple[str, str]) -> DataFrame:
    """One row a key and block: the values of the blocks before it; a key has no more rows than there are blocks."""
    w = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*by, BLOCK, *(_KINDS[kind](c).over(w).alias(f"{name}_before") for name, (kind, c) in values.items()))


def running(rows: DataFrame, by: list[str], order: list[str], **values: tuple[str, Column]) -> DataFrame:
    """rows, which have a block, with the running value of each name: ("sum" or "max", expression), over the key's rows so far."""
    w = Window.partitionBy(*by, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy(*by, BLOCK).agg(*(_KINDS[kind](e).alias(name) for name, (kind, e) in values.items()))
    before = _before(totals, by, **{name: (kind, name) for name, (kind, _) in values.items()})
    own = rows.select("*", *(_KINDS[kind](e).over(w).alias(name) for name, (kind, e) in values.items()))
    joined = _join(own, before, by)
    both = {name: F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"{name}_before"), F.lit(0)) if kind == "sum" else F.greatest(name, f"{name}_before") for name, (kind, _) in values.items()}
    return joined.select(*rows.columns, *(e.alias(name) for name, e in both.items()))


def previous(rows: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
    """rows, which have a block, with the order value of the key's row before; null for the first."""
    ends = _before(rows.groupBy(*by, BLOCK).agg(F.max(order).alias("end_")), by, end_=("max", "end_"))
    own = rows.withColumn(name, F.lag(order).over(Window.partitionBy(*by, BLOCK).orderBy(order)))
    return _join(own, ends, by).select(*rows.columns, F.coalesce(name, "end__before").alias(name))


def _join(rows: DataFrame, before: DataFrame, by: list[str]) -> DataFrame:
    names = {c: f"{c}_own" for c in (*by, BLOCK)}
    small = before.withColumnsRenamed(names)
    same = F.col(BLOCK) == F.col(names[BLOCK])
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(names[c]))
    return rows.join(small, same, "left").drop(*names.values())


def lagged(rows: DataFrame, by: list[str], order: list[str], value: str, n: int, name: str) -> DataFrame:
    """rows, which have a block, with the value of the key's row n before, met by its number; null for the first n."""
    numbered = running(rows, by, order, number_=("sum", F.lit(1)))
    earlier = numbered.select(*(F.col(c).alias(f"{c}_own") for c in by), (F.col("number_") + n).alias("number_own"), F.col(value).alias(name))
    same = F.col("number_") == F.col("number_own")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_own"))
    return numbered.join(earlier, same, "left").select(*rows.columns, name)
