"""Column functions over text with the semantics of Python's ``re`` and ``str``: on the JVM where its expressions have them in linear time.

Offsets count code points from zero. Patterns are given in the common dialect of Java and Python (no look-around, no
back-references, no empty matches) and get the flags under which Java agrees with Python on Unicode classes and line ends.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scan

#: Pages are looked up by every so many starts, then among these.
PAGES = 64


def pattern(p: str, ignore_case: bool = True, multiline: bool = False, dotall: bool = False) -> str:
    """p with flags: Unicode classes and case folding, and only \\n ends a line."""
    return f"(?{'i' * ignore_case}uUd{'m' * multiline}{'s' * dotall}){p}"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "")


def squeeze(c: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


_JAVA = re.compile(r"\(\?(i?)uUd(m?)(s?)\)")


def flagged(regex: str) -> tuple[str, int]:
    """A pattern that ``pattern`` has given flags, as Python's, and re's flags."""
    if not (own := _JAVA.match(regex)):
        return regex, 0
    return regex[own.end() :], re.IGNORECASE * bool(own[1]) | re.MULTILINE * bool(own[2]) | re.DOTALL * bool(own[3])


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def sums_before(sizes: pa.Array) -> pa.Array:
    """For each of an array of ints the sum of those before it."""
    ends = np.r_[0, np.cumsum(sizes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
    flat = sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.cumsum(flat) - flat
    first = np.repeat(np.r_[before, 0][ends[:-1]], np.diff(ends))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array((before - first).astype(np.int32)))


def find_all(text: Column, regex: str) -> Column:
    """array<struct<start int, text string>> of the matches in order, in time linear in the text and its matches."""
    return F.transform(scan.found(text, (flagged(regex),)), lambda m: F.struct(m["start"].alias("start"), m["text"].alias("text")))


def page_starts(pages: Column) -> Column:
    """Start of each page in the pages joined by blank lines."""
    return sums_before(F.transform(pages, lambda p: F.length(p) + 2))


def page_of(offset: Column, starts: Column) -> Column:
    """The 0-based page of an offset; what separates two pages belongs to the first."""
    before = lambda xs: F.size(F.filter(xs, lambda s: s <= offset))
    heads = F.transform(F.sequence(F.lit(0), F.ceil(F.size(starts) / PAGES).cast("int") - 1), lambda k: F.get(starts, k * PAGES))
    lot = F.greatest(before(heads) - 1, F.lit(0)) * PAGES
    return lot + before(F.slice(starts, lot + 1, F.lit(PAGES))) - 1


def before(text: Column, start: Column, n: int) -> Column:
    """Up to n code points before start."""
    return F.substring(text, F.greatest(start - n, F.lit(0)) + 1, F.least(start, F.lit(n)))


def after(text: Column, end: Column, n: int) -> Column:
    return F.substring(text, end + 1, F.lit(n))


def any_match(text: Column, regexes: list[str], **flags: bool) -> Column:
    """Whether one matches; the patterns are literals, each compiled once in a task."""
    out = F.lit(False)
    for p in regexes:
        out = out | text.rlike(pattern(p, **flags))
    return out


@F.arrow_udf(T.StringType())
def title_case(c: pa.Array) -> pa.Array:
    """Each letter after a non-letter in upper case, the others in lower case."""
    return pa.array([None if x is None else x.title() for x in c.to_pylist()], pa.string())


# --------------------------------------------------------------------------- markdown and reflow

# What is rewritten, in this order (pattern, replacement).
MARKDOWN = [
    (r"<!--\s*image\s*-->", ""),
    (r"(?m)^#{1,6}\s+", ""),
    (r"\*{3}(.+?)\*{3}", "$1"),
    (r"\*{2}(.+?)\*{2}", "$1"),
    (r"\*(.+?)\*", "$1"),
    (r"`([^`]+)`", "$1"),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (r"(?m)^\s*[-*+]\s+", ""),
    (r"(?m)^\s*\d+\.\s+", ""),
    (r"(?m)^\|[-:\s|]+\|$", ""),
]


def strip_markdown(c: Column) -> Column:
    """Markdown as plain text: marks of headings, emphasis, code, links and lists go; table rows become their cells, joined by spaces."""
    for p, to in MARKDOWN:
        c = F.regexp_replace(c, f"(?Ud){p}", to)
    cells = lambda row: F.array_join(F.filter(F.transform(F.split(row, r"\|"), strip), lambda x: x != ""), " ")
    c = F.array_join(F.transform(F.split(c, "\n"), lambda x: F.when(x.rlike(r"^\|.+\|$"), cells(x)).otherwise(x)), "\n")
    return F.regexp_replace(F.regexp_replace(c, "(?md)^[-*]{3,}$", ""), r"\n{3,}", "\n\n")


#: A paragraph goes on if it is shorter than SHORT, doesn't end a sentence, and the next line starts in lower case or it is under TINY.
SHORT, TINY = 60, 15


def reflow(c: Column) -> Column:
    """Hard-wrapped lines as paragraphs: hyphens at line ends go, short lines take the next, blank lines part paragraphs."""
    lines = F.transform(F.split(F.replace(c, F.lit("-\n"), F.lit("")), "\n"), strip)
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    closed = lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))

    def step(acc, x):
        goes_on = (acc["open"] != "") & (F.length(acc["open"]) < SHORT) & ~acc["open"].rlike(r"[.:;?!]$") & (x.rlike(r"(?U)^\p{Lower}") | (F.length(acc["open"]) < TINY))
        return (
            F.when(x == "", F.struct(F.concat(closed(acc), F.array(F.lit(""))).alias("done"), F.lit("").alias("open")))
            .when(goes_on, F.struct(acc["done"].alias("done"), F.concat(acc["open"], F.lit(" "), x).alias("open")))
            .otherwise(F.struct(closed(acc).alias("done"), x.alias("open")))
        )

    return F.array_join(F.aggregate(lines, state, step, closed), "\n")


# --------------------------------------------------------------------------- dates, numbers, names

MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def free_date(c: Column) -> Column:
    """ISO, "Month d, yyyy" or "d Month yyyy" (ordinals allowed, any case) as a date; anything else is null."""
    t = F.lower(squeeze(F.regexp_replace(c, r"(?i)\b(\d{1,2})(st|nd|rd|th)\b", "$1")))
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(t, r"([a-z]{3,})", 1))
    day = F.coalesce(F.nullif(F.regexp_extract(t, r"^[a-z]+\.? (\d{1,2}),? \d{4}$", 1), F.lit("")), F.nullif(F.regexp_extract(t, r"^(\d{1,2}) [a-z]+\.?,? \d{4}$", 1), F.lit("")))
    year = F.nullif(F.regexp_extract(t, r"(\d{4})$", 1), F.lit(""))
    spelt = F.when(day.isNotNull() & (month > 0), F.try_to_timestamp(F.format_string("%s-%02d-%02d", year, month, day.cast("int")), F.lit("yyyy-MM-dd")).cast("date"))
    return F.coalesce(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(t, F.lit("yyyy-MM-dd")).cast("date")), spelt)


def estimated_tokens(c: Column) -> Column:
    """A quarter of the code points."""
    return F.floor(F.length(c) / 4).cast("long")


def slug(c: Column) -> Column:
    """Lower case, hyphens for spaces, without parentheses and commas."""
    return F.regexp_replace(F.replace(F.lower(c), F.lit(" "), F.lit("-")), "[(),]", "")


def issuer_of(title: Column) -> Column:
    """What stands before " - " in a title, else the title."""
    return strip(F.when(F.contains(title, F.lit(" - ")), F.substring_index(title, " - ", 1)).otherwise(title))
