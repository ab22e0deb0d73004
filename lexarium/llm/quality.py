"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Counts of each text come from one vectorised pass over its bytes. Each rule is a rate in thousandths. Its quantile sketch is a
log-linear histogram of integers (``BITS`` leading bits are kept, so a value is known within one part in ``1 << (BITS - 1)``):
adding two sketches adds their counts, so partial sketches of a group merge in any order to the same result. A (language, source)
group sets its own fences; a group of fewer than ``MIN_GROUP`` texts takes those of its language, and a small language those of the
whole, each merged from the same sketches.

No fence has a fixed part. It is a quantile of the group moved out by ``FENCE`` times its distance to a lower quantile. Word length
and symbols take the median and the lower quartile, which junk in up to half of a group doesn't reach; so does the low fence of word
length. Repeated lines and windows are rare and uneven in good texts, so they take the 99th part and the median, and no group's
fence is above its language's. A text is beyond a fence if its count is, by more than ``NOISE`` deviations of a count of that mean:
a short text needs more to be beyond than a long one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NOT_SPACE, attach, fresh, longs, mix, prefix_hash, span_hash, staged, text_blocks, window_hash, word_spans

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
COUNTS_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

#: Leading bits of a value that a sketch keeps.
BITS = 7
MIN_GROUP = 200
FENCE, NOISE = 3, 4
#: Rule: numerator, denominator, the quantile and the lower one in hundredths, and whether low values fail too.
RULES = {
    "word_length": ("word_chars", "n_words", 50, 25, True),
    "symbols": ("n_symbols", "n_words", 50, 25, False),
    "dup_lines": ("n_dup_lines", "n_lines", 99, 50, False),
    "repeats": ("n_repeat_words", "n_words", 99, 50, False),
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: Odd, so that texts keep their own keys.
_LINE, _GRAM = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD1B54A32D192ED03)


def counts(column: pa.Array) -> dict[str, pa.Array]:
    """The COUNTS of each text; a null is empty. Lines are counted if they have a word."""
    out: dict[str, list] = {c: [] for c in COUNTS}
    for _, _, buf, offs in text_blocks(column):
        start, end, first = word_spans(buf, offs, NOT_SPACE)
        per_text = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[offs])
        n = len(offs) - 1
        acc = prefix_hash(buf)
        out["n_words"].append(np.diff(first))
        out["word_chars"].append(per_text(NOT_SPACE[buf] & ((buf & 0xC0) != 0x80)))
        out["n_symbols"].append(per_text(_SYMBOL[buf]))
        lines = _lines(buf, offs)
        worded = np.searchsorted(start, lines[0]) < np.searchsorted(start, lines[1])
        a, b = lines[0][worded], lines[1][worded]
        text = np.searchsorted(offs, a, side="right") - 1
        out["n_lines"].append(np.bincount(text, minlength=n))
        out["n_dup_lines"].append(np.bincount(text[_later(span_hash(acc, a, b), text, _LINE)], minlength=n))
        out["n_repeat_words"].append(_repeat_words(span_hash(acc, start, end), first, n))
    return {c: longs(np.concatenate(v)) if v else longs(np.empty(0, np.int64)) for c, v in out.items()}


def _lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the non-empty lines of all texts."""
    cut = np.flatnonzero(buf == 0x0A)
    start = np.sort(np.concatenate((offs[:-1], cut + 1)))
    end = np.sort(np.concatenate((offs[1:], cut)))
    return start[start < end], end[start < end]


def _keyed(h: np.ndarray, text: np.ndarray, salt: np.uint64) -> np.ndarray:
    return mix(h + (text.astype(np.uint64) + np.uint64(1)) * salt)


def _later(h: np.ndarray, text: np.ndarray, salt: np.uint64) -> np.ndarray:
    """The items that equal another one of their text, without one of each kind."""
    key = _keyed(h, text, salt)
    order = np.argsort(key)
    return order[1:][key[order[1:]] == key[order[:-1]]]


def _repeat_words(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """For each text the words in 3-word windows that it has twice or more."""
    at = np.arange(max(0, len(words) - 2))
    text = np.repeat(np.arange(n), np.diff(first))
    at = at[text[:-2] == text[2:]] if len(at) else at
    if not len(at):
        return np.zeros(n, np.int64)
    key = _keyed(window_hash(words, 3)[at], text[at], _GRAM)
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[at[again] + k] = True
    return np.bincount(text[hit], minlength=n)


def with_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    return attach(docs, text, counts, COUNTS_TYPE, keep)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rate(rule: str) -> Column:
    """The rule's rate in whole thousandths; zero where the denominator is."""
    above, below, *_ = RULES[rule]
    return F.expr(f"if({below} = 0, 0L, 1000 * {above} div {below})")


def _bucket(x: str) -> str:
    """The least value of x's cell in a sketch."""
    shift = f"greatest(0, length(bin({x})) - {BITS})"
    return f"shiftleft(shiftright({x}, {shift}), {shift})"


def sketches(counted: DataFrame, lang: str, source: str) -> DataFrame:
    """(lang, source, rule, value, n): the sketch of each group and rule, over texts with a word."""
    rates = F.array(*(F.struct(F.lit(r).alias("rule"), rate(r).alias("x")) for r in RULES))
    each = counted.where("n_words > 0").select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(rates).alias("r")).select("lang", "source", "r.rule", F.expr(_bucket("r.x")).alias("value"))
    return each.groupBy("lang", "source", "rule", "value").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """For each of keys and rule: the number of texts, and the fences low and high of the merged sketches, in thousandths."""
    merged = sketch.groupBy(*keys, "rule", "value").agg(F.sum("n").alias("n"))
    cells = merged.groupBy(*keys, "rule").agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias("cells"), F.sum("n").alias("total"))  # at most 64 * 2**6 cells
    at = lambda share: F.expr(f"aggregate(cells, struct(0L AS seen, cast(NULL AS bigint) AS at), (acc, c) -> struct(acc.seen + c.n AS seen, coalesce(acc.at, if((acc.seen + c.n) * 100 >= total * {share}, c.value, NULL)) AS at), acc -> acc.at)")
    pick = lambda k: F.coalesce(*(F.when(F.col("rule") == r, at(v[k])) for r, v in RULES.items()))
    known = cells.select(*keys, "rule", "total", pick(2).alias("most"), pick(3).alias("base"), at(50).alias("middle"), at(25).alias("lower"))
    # rates are whole thousandths, so the true one is less than one more
    return known.select(*keys, "rule", "total", (F.col("middle") - FENCE * (F.col("middle") - F.col("lower"))).alias("low"), (F.col("most") + FENCE * (F.col("most") - F.col("base")) + 1).alias("high"))


def fences(counted: DataFrame, lang: str = "lang", source: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source) with low_<rule> and high_<rule>, in thousandths."""
    sketch = staged(sketches(counted, lang, source), "quality-sketches")
    # a rule's name is a key at every level; the whole has none else
    fine, mid, whole = quantiles(sketch, ["lang", "source"]), quantiles(sketch, ["lang"]), quantiles(sketch, [])
    fine, mid, whole = (x.select(*keys, "rule", *(F.col(c).alias(f"{c}_{k}") for c in ("total", "low", "high"))) for x, keys, k in ((fine, ["lang", "source"], 0), (mid, ["lang"], 1), (whole, [], 2)))
    mid = mid.withColumnsRenamed({"lang": "lang_1", "rule": "rule_1"})
    both = fine.join(mid, F.col("lang").eqNullSafe(F.col("lang_1")) & (F.col("rule") == F.col("rule_1"))).drop("lang_1", "rule_1").join(whole, "rule")
    wide = lambda c: F.when(F.col("total_1") >= min_group, F.col(f"{c}_1")).otherwise(F.col(f"{c}_2"))
    own = lambda c: F.when(F.col("total_0") >= min_group, F.col(f"{c}_0")).otherwise(wide(c))
    tails = [r for r, v in RULES.items() if v[2] > 50]
    both = both.select("lang", "source", "rule", own("low").alias("low"), F.when(F.col("rule").isin(tails), F.least(own("high"), wide("high"))).otherwise(own("high")).alias("high"))
    return both.groupBy("lang", "source").agg(*(F.max(F.when(F.col("rule") == r, F.col(c))).alias(f"{c}_{r}") for r in RULES for c in ("low", "high")))


def beyond(rule: str) -> Column:
    """Whether the rule's count is above its high fence or, where low values fail, below its low one, by more than noise."""
    count, per, _, _, low = RULES[rule]
    mean = lambda side: F.greatest(F.lit(0.0), (F.col(f"{side}_{rule}") * F.col(per)).cast("double") / F.lit(1000.0))
    far = lambda side: (F.col(count) - mean(side)) * (F.col(count) - mean(side)) > NOISE * NOISE * (mean(side) + 1.0)
    out = (F.col(count) > mean("high")) & far("high")
    if low:
        out = out | (F.col(count) < mean("low")) & far("low")
    return F.coalesce(out, F.lit(False))


def _with_fences(counted: DataFrame, limits: DataFrame, lang: str, source: str) -> DataFrame:
    k1, k2 = fresh(counted, "fence_lang", "fence_source")
    limits = limits.withColumnsRenamed({"lang": k1, "source": k2})
    return counted.join(limits, F.col(lang).eqNullSafe(F.col(k1)) & F.col(source).eqNullSafe(F.col(k2)), "left")


def judge(counted: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """counted with base_failed and kept: neither base_failed nor beyond a fence of its group."""
    bad = F.lit(False)
    for r in RULES:
        bad = bad | beyond(r)
    return _with_fences(counted, limits, lang, source).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~bad).select(*(F.col(f"`{c}`") for c in counted.columns), "base_failed", "kept")


def rejections(counted: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """For each (lang, source): its texts, those that fail the base rules, and those that each adaptive rule rejects besides."""
    each = _with_fences(counted, limits, lang, source)
    return each.groupBy(lang, source).agg(F.count("*").alias("n_texts"), F.count_if(base_failed()).alias("base_failed"), *(F.count_if(~base_failed() & beyond(r)).alias(r) for r in RULES))


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", **how) -> DataFrame:
    """(doc_id, lang, source, the COUNTS, base_failed, kept) for each row of docs.

    Null and empty texts have no words and fail the base rules; a null language or source is a group of its own; repeated rows are
    judged alike; an empty table gives none. Other columns of docs play no part.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    counted = staged(with_counts(narrow, keep=["doc_id", "lang", "source"]), "quality-counts")
    return judge(counted, staged(fences(counted, **how), "quality-fences"))
