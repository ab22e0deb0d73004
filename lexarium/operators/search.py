"""Ranked full-text search: Okapi BM25 over an index of postings.

The index is two tables, postings (term, doc, tf, length) and one row of totals, written once (``write_index``), in order of terms,
and read by every query; a query reads the postings of its terms only, so its cost follows these, and its result is a top-k.

Terms are lower-case runs of a-z after accents are stripped, without stop words, and cut to their stems by Porter's rules.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

K1, B = 1.2, 0.75

#: English words that carry no topic; a parameter wherever it is used.
STOP = frozenset(
    "a about above after again all also am an and any are as at be because been before being below between both but by can could did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its itself "
    "just me more most my no nor not now of off on once only or other our ours out over own same she should so some such than that the their theirs them then there these they this those through to too under until up very was we were what when where which while who whom why will with would you your yours".split()
)


def _unaccented() -> tuple[str, str]:
    """Latin letters with marks, and the letters without."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x250)]
    own = [(a, b) for a, b in pairs if a != b and b.isascii() and b.isalpha()]
    return "".join(a for a, _ in own), "".join(b for _, b in own)


_MARKED, _PLAIN = _unaccented()
_VOWELS = frozenset("aeiou")


def _shape(w: str) -> str:
    """v or c for each letter; y is a vowel after a consonant."""
    out = ""
    for ch in w:
        out += "v" if ch in _VOWELS or ch == "y" and out.endswith("c") else "c"
    return out


def _measure(w: str) -> int:
    """How often vowels are followed by consonants."""
    return _shape(w).count("vc")


def _short(w: str) -> bool:
    return len(w) > 2 and _shape(w)[-3:] == "cvc" and w[-1] not in "wxy"


def _swap(w: str, rules: list[tuple[str, str]], least: int) -> str:
    """The longest suffix that w has, replaced if what is before it has more than ``least`` measures."""
    for end, to in rules:
        if w.endswith(end):
            stem = w[: len(w) - len(end)]
            return stem + to if _measure(stem) > least and (end != "ion" or stem.endswith(("s", "t"))) else w
    return w


def _rules(text: str) -> list[tuple[str, str]]:
    """Pairs "suffix>replacement", longest suffix first."""
    return sorted(((a, b) for a, _, b in (x.partition(">") for x in text.split())), key=lambda r: -len(r[0]))


# The suffixes of Porter's second, third and fourth steps.
_SECOND = _rules("ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive biliti>ble logi>log")
_THIRD = _rules("icate>ic ative> alize>al iciti>ic ical>ic ful> ness>")
_FOURTH = _rules("al> ance> ence> er> ic> able> ible> ant> ement> ment> ent> ion> ou> ism> ate> iti> ous> ive> ize>")


@lru_cache(maxsize=1 << 16)
def stem(w: str) -> str:
    """The stem of a lower-case word by Porter's algorithm."""
    if len(w) < 3:
        return w
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) else w
    else:
        for end in ("ed", "ing"):
            if w.endswith(end) and "v" in _shape(w[: -len(end)]):
                w = w[: -len(end)]
                if w.endswith(("at", "bl", "iz")) or _measure(w) == 1 and _short(w):
                    w += "e"
                elif len(w) > 1 and w[-1] == w[-2] and _shape(w)[-1] == "c" and w[-1] not in "lsz":
                    w = w[:-1]
                break
    if w.endswith("y") and "v" in _shape(w[:-1]):
        w = w[:-1] + "i"
    w = _swap(_swap(_swap(w, _SECOND, 0), _THIRD, 0), _FOURTH, 1)
    if w.endswith("e") and (_measure(w[:-1]) > 1 or _measure(w[:-1]) == 1 and not _short(w[:-1])):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w) > 1 else w


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stems(words: pd.Series) -> pd.Series:
    return words.map(lambda ws: [stem(w) for w in ws])


def terms(body: Column, stop: frozenset[str] = STOP, stems: bool = True) -> Column:
    """The terms of a text, in order, repeats included; none for a null."""
    words = F.split(F.lower(F.translate(F.coalesce(body, F.lit("")), _MARKED, _PLAIN)), "[^a-z]+")
    words = F.filter(words, lambda t: (t != "") & ~t.isin(*sorted(stop))) if stop else F.filter(words, lambda t: t != "")
    return _stems(words) if stems else words


def query_terms(words: list[str], stop: frozenset[str] = STOP, stems: bool = True) -> list[str]:
    """The same of the words of a query, each once."""
    table = str.maketrans(_MARKED, _PLAIN)
    own = {w.translate(table).lower() for w in words} - stop
    return sorted({stem(w) for w in own} if stems else own)


def postings(docs: DataFrame, key: str, body: str = "text", only: list[str] | None = None, stop: frozenset[str] = STOP, stems: bool = True) -> DataFrame:
    """(term, key, tf, length), of all terms or of some. A text is cut once, not once a term."""
    cut = docs.select(key, terms(F.col(body), stop, stems).alias("own_"))
    some = F.col("own_") if only is None else F.filter("own_", lambda t: t.isin(only))
    rows = cut.select(key, F.explode(F.arrays_zip(some.alias("term"), F.array_repeat(F.size("own_").cast("long"), F.size(some)).alias("length"))).alias("p"))
    return rows.groupBy("p.term", key).agg(F.count("*").alias("tf"), F.first("p.length").alias("length"))


def write_index(docs: DataFrame, key: str, name: str, body: str = "text", stop: frozenset[str] = STOP, stems: bool = True) -> None:
    """Tables ``<name>_postings``, in order of terms so that a query's terms prune files and row groups, and ``<name>_totals``."""
    postings(docs, key, body, None, stop, stems).repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").saveAsTable(f"{name}_postings")
    totals(docs, body, stop, stems).write.mode("overwrite").saveAsTable(f"{name}_totals")


def read_index(spark: SparkSession, name: str) -> tuple[DataFrame, DataFrame]:
    return spark.table(f"{name}_postings"), spark.table(f"{name}_totals")


def totals(docs: DataFrame, body: str = "text", stop: frozenset[str] = STOP, stems: bool = True) -> DataFrame:  # stems don't change the number of terms
    """One row: documents and their mean length."""
    return docs.select(F.size(terms(F.col(body), stop, False)).alias("n_")).agg(F.count("*").alias("n_docs"), F.avg("n_").alias("mean_length"))


def search(index: DataFrame, total: DataFrame, query: list[str], key: str, k: int = 10, k1: float = K1, b: float = B) -> DataFrame:
    """(key, score) of the k best documents with one of the query's terms (``query_terms``), best first, ties by key."""
    wanted = sorted(set(query))
    own = index.where(F.col("term").isin(wanted))
    df = own.groupBy("term").agg(F.count("*").alias("df"))  # a row a query term
    n, mean = F.col("n_docs"), F.col("mean_length")
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    gain = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / mean))
    scored = own.join(F.broadcast(df), "term").join(F.broadcast(total)).groupBy(key).agg(F.sum(idf * gain).alias("score"))
    return scored.orderBy(F.col("score").desc(), F.col(key).asc()).limit(k)


def scored_pages(docs: DataFrame, query: list[str], key: str, body: str = "text", k: int = 10, stop: frozenset[str] = STOP, stems: bool = True) -> DataFrame:
    """Search without a stored index."""
    wanted = query_terms(query, stop, stems)
    return search(postings(docs, key, body, wanted, stop, stems), totals(docs, body, stop, stems), wanted, key, k)


def hits_with_documents(hits: DataFrame, pages: DataFrame, docs: DataFrame, page_key: str, doc_key: str) -> DataFrame:
    """Hits with the columns of their pages and, of these, of their documents; few hits meet large tables, so they are broadcast."""
    own = pages.join(F.broadcast(hits), page_key)
    return docs.join(F.broadcast(own.select(doc_key, page_key, "score")), doc_key)


def snippet(body: Column, needle: str, around: int = 200) -> Column:
    """The first occurrence of needle, in any case, with up to ``around`` code points on each side; null if there is none."""
    at = F.locate(needle.lower(), F.lower(body))
    return F.when(at > 0, F.substring(body, F.greatest(at - around, F.lit(1)), F.least(at - 1, F.lit(around)) + len(needle) + around))


def highlight(body: Column, needle: str) -> Column:
    """HTML-escaped text in which the needle, with any white space between its words, is marked."""
    import html
    import re

    out = body
    for raw, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(ref))
    regex = r"\s+".join(re.escape(html.escape(w)) for w in needle.split())
    return F.regexp_replace(out, f"(?iuU)({regex})", "<mark>$1</mark>") if regex else out


def filtered(rows: DataFrame, **conditions: object) -> DataFrame:
    """The rows that meet all conditions that are given: equality, membership for lists; None asks for nothing."""
    for column, value in conditions.items():
        if value is not None:
            rows = rows.where(F.col(column).isin(*value) if isinstance(value, (list, tuple, set)) else F.col(column) == F.lit(value))
    return rows


def browse(rows: DataFrame, needle: str | None, body: str, k: int = 50, order: str = "publication_date", **conditions: object) -> DataFrame:
    """Up to k rows that meet the conditions and contain the needle in any case, latest first, with a snippet."""
    own = filtered(rows, **conditions)
    if needle:
        own = own.where(F.contains(F.lower(F.col(body)), F.lit(needle.lower()))).withColumn("snippet", snippet(F.col(body), needle))
    return own.orderBy(F.col(order).desc_nulls_last()).limit(k)
