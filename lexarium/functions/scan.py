"""Many patterns over a text in one scan.

An automaton over the literals that the matches of each pattern must have tells, in one pass, which patterns can match a text at all;
only these are run, by Python's ``re``, whose semantics the registries have. Compiled patterns and automata are made once in a Python
worker; texts reach them in Arrow batches. A search is linear in the text and its matches.

The literals of a pattern come from its parse: a sequence needs each of its parts, so the part with the longest shortest literal
stands for it; a branch needs one literal of each of its sides; what may be absent needs nothing. A pattern without literals is run
on every text.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from re import _constants as op
from re import _parser as parser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Each pattern as (regular expression, flags of re).
Patterns = tuple[tuple[str, int], ...]

FOUND = "array<struct<p:int,start:int,text:string>>"
#: Characters outside ASCII that match an ASCII letter when case is ignored.
FOLDS = str.maketrans({"İ": "i", "ı": "i", "ſ": "s", "K": "k"})


# --------------------------------------------------------------------------- mandatory literals


def literals(regex: str, flags: int = 0) -> frozenset[str]:
    """Strings in lower case of which every match has one, its letters' case aside; empty if there are none."""
    return _of_sequence(parser.parse(regex, flags)) or frozenset()


def _better(a: frozenset[str] | None, b: frozenset[str] | None) -> frozenset[str] | None:
    """The set that leaves fewer texts: that whose shortest string is longer, of equals the smaller."""
    if not a or not b:
        return a or b
    return max(a, b, key=lambda s: (min(map(len, s)), -len(s)))


def _of_sequence(parts) -> frozenset[str] | None:
    best, run = None, ""
    for kind, value in parts:
        if kind is op.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        if kind is op.AT:  # takes no character
            continue
        best, run = _better(best, frozenset([run]) if run else None), ""
        if kind is op.SUBPATTERN:
            best = _better(best, _of_sequence(value[3]))
        elif kind is op.BRANCH:
            sides = [_of_sequence(s) for s in value[1]]
            best = _better(best, frozenset().union(*sides) if all(sides) else None)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0] >= 1:
            best = _better(best, _of_sequence(value[2]))
    return _better(best, frozenset([run]) if run else None)


class Scanner:
    """The patterns of one registry, compiled, and the automaton of their literals."""

    def __init__(self, patterns: Patterns):
        import ahocorasick

        self.compiled = [re.compile(p, f) for p, f in patterns]
        self.always: list[int] = []
        owners: dict[str, set[int]] = {}
        for k, (p, f) in enumerate(patterns):
            own = literals(p, f)
            if not own:
                self.always.append(k)
            for s in own:
                owners.setdefault(s, set()).add(k)
        self.automaton = ahocorasick.Automaton() if owners else None
        for s, own in owners.items():
            self.automaton.add_word(s, own)
        if owners:
            self.automaton.make_automaton()

    def candidates(self, text: str) -> list[int]:
        """The patterns, in order, that can match the text."""
        out = set(self.always)
        if self.automaton is not None:
            for _, own in self.automaton.iter((text if text.isascii() else text.translate(FOLDS)).lower()):
                out |= own
        return sorted(out)

    def matches(self, text: str) -> Iterator[tuple[int, int, str]]:
        """(pattern, start, text) of every match, pattern by pattern, each in order."""
        for k in self.candidates(text):
            for m in self.compiled[k].finditer(text):
                yield k, m.start(), m[0]

    def first(self, text: str) -> Iterator[tuple[int, int, str]]:
        """The first match of each pattern that has one."""
        for k in self.candidates(text):
            if m := self.compiled[k].search(text):
                yield k, m.start(), m[0]


@functools.lru_cache(maxsize=32)
def scanner(patterns: Patterns) -> Scanner:
    return Scanner(patterns)


# --------------------------------------------------------------------------- columns


def compiled(regex: str, ignore_case: bool = True, multiline: bool = False, dotall: bool = False) -> tuple[str, int]:
    """A pattern with its flags."""
    return regex, re.IGNORECASE * ignore_case | re.MULTILINE * multiline | re.DOTALL * dotall


def found(text: Column, patterns: Patterns, first: bool = False) -> Column:
    """array<struct<p, start, text>>: the matches of all patterns (``first``: the first of each), by the pattern's number in order; p and
    start count from zero, in code points. A null text has none."""

    @F.arrow_udf(FOUND)
    def run(texts: pa.Array) -> pa.Array:
        own = scanner(patterns)
        search = own.first if first else own.matches
        ends, numbers, starts, matched = [0], [], [], []
        for t in texts.to_pylist():
            for k, at, m in search(t) if t else ():
                numbers.append(k)
                starts.append(at)
                matched.append(m)
            ends.append(len(numbers))
        row = pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), pa.array(starts, pa.int32()), pa.array(matched, pa.string())], ["p", "start", "text"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), row)

    return run(text) if patterns else F.array().cast(FOUND)


def present(text: Column, patterns: Patterns) -> Column:
    """array<int>: the numbers of the patterns that match, ascending; none for a null text."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        own = scanner(patterns)
        return pa.array([[k for k in own.candidates(t) if own.compiled[k].search(t)] if t is not None else [] for t in texts.to_pylist()], pa.list_(pa.int32()))

    return run(text) if patterns else F.array().cast("array<int>")


def chosen(numbers: Column, names: list[str]) -> Column:
    """The distinct names, in the order of ``names``, of pattern numbers; names has one for each pattern."""
    groups: dict[str, list[int]] = {}
    for k, name in enumerate(names):
        groups.setdefault(name, []).append(k)
    if not groups:
        return F.array().cast("array<string>")
    return F.filter(F.array(*(F.when(F.arrays_overlap(numbers, F.array(*map(F.lit, own))), F.lit(name)) for name, own in groups.items())), lambda c: c.isNotNull())
