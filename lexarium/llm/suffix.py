"""Exact substring deduplication: suffix grouping in linear time, over the parts of a corpus that can repeat.

A byte is a repeat if a string of ``LENGTH`` bytes that covers it starts anywhere else too. Steps:

1. Equal texts (SHA-256) are one text with a multiplicity.
2. Anchors. Each window of LENGTH bytes is named by its minimiser, the ``GRAM``-gram of least hash (leftmost of ties). Equal
   windows have equal anchors at equal places, so only windows under an anchor seen twice can repeat. A run of windows with one
   anchor is a context. Anchors are counted in a pre-aggregated group-by; contexts under an anchor seen once are final: no repeat.
3. The distinct contexts of each anchor (a 128-bit digest tells them apart) go through suffix sorting: one that occurs in several
   texts enters with the bytes of two of its occurrences, one of a text that is there several times with that multiplicity. The
   suffixes of a task's contexts are grouped by their Lyndon prefixes, groups being processed in descending order with
   previous-smaller pointers, and then each group's order is emitted in one pass, without renaming (``suffix_order``). Windows
   that neighbours in that order have in common, byte for byte, are repeats; nothing else is. Symbols are phrases: what stands
   between cuts that the letters before a word set (a prefix-free code, so the order is the bytes' own). Groups with longer
   phrases than ``MOST`` take words, and with longer words bytes.
4. An anchor with more than ``GROUP`` distinct contexts is split before it is sorted: its windows are dealt by their distance from
   the anchor, in steps of ``WIDTHS``, and by the bytes that all windows of one step share. Equal windows stay together, and a
   group at the last step has one string. What a group finds out about a piece holds for all contexts that have it.
5. The repeats of a distinct context are those of all its occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import NOT_SPACE, fresh, hot_join, longs, mix, prefix_hash, span_hash, staged, text_blocks

LENGTH, GRAM = 200, 64
#: Distinct contexts of a group that are sorted together: about 80 kB of text.
GROUP = 256
#: Steps of distances by which a larger group is split, and split again.
WIDTHS = (16, 4, 1)
#: Bytes of contexts sorted at a time, if no group is larger.
SORT_BYTES = 1 << 19
#: Longest phrase or word that is a symbol; bytes before a cut that set it; one cut in so many words.
MOST, LOOK, CUT = 120, 4, 3
BLOCK = 1 << 18


# --------------------------------------------------------------------------- suffix order


def suffix_order(s: np.ndarray) -> np.ndarray:
    """The suffix array of s, whose last symbol is its unique least one.

    First the suffixes are grouped by their Lyndon prefixes: groups start as one a symbol and are processed in descending order;
    each suffix of a group points to the nearest one before it in a lower group, and those pointed to leave their groups, by the
    number of pointers they got, for new groups just above. Then the order is emitted from the least suffix on: the suffix before
    each emitted one, and what its pointers chain to, take the next free places of their groups.
    """
    n = len(s)
    by = np.argsort(s, kind="stable")
    head = np.ones(n, bool)
    head[1:] = s[by][1:] != s[by][:-1]
    starts = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    group_of, place_of = np.empty(n, np.int64), np.empty(n, np.int64)
    group_of[by], place_of[by] = starts, np.arange(n)
    sa, group, place = by.tolist(), group_of.tolist(), place_of.tolist()
    size = np.bincount(starts, minlength=n).tolist()
    before = [-1] * n
    end = n
    while end > 0:
        g = group[sa[end - 1]]
        if end - g == 1:
            i = sa[g]
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = before[p]
            before[i] = p
            if p >= 0:
                old = group[p]
                k = size[old] - 1
                if k:
                    top = old + k
                    if sa[top] != p:
                        q, at = sa[top], place[p]
                        sa[at], place[q] = q, at
                        sa[top], place[p] = p, top
                    size[old] = k
                    size[top] = 1
                    group[p] = top
            end = g
            continue
        got: dict[int, int] = {}
        for i in sorted(sa[g:end]):
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = before[p]
            before[i] = p
            if p >= 0:
                got[p] = got.get(p, 0) + 1
        end = g
        if not got:
            continue
        levels: dict[int, dict[int, list[int]]] = {}
        for p, k in got.items():
            levels.setdefault(k, {}).setdefault(group[p], []).append(p)
        for k in sorted(levels, reverse=True):
            for old, own in levels[k].items():
                m, k_old = len(own), size[old]
                if m == k_old:
                    continue
                top = old + k_old
                for p in own:
                    top -= 1
                    if sa[top] != p:
                        q, at = sa[top], place[p]
                        sa[at], place[q] = q, at
                        sa[top], place[p] = p, top
                for p in own:
                    group[p] = top
                size[old] = k_old - m
                size[top] = m
    free = list(range(n))
    out = [0] * n
    out[0] = n - 1
    group[n - 1] = -1
    for i in range(n):
        p = out[i] - 1
        while p >= 0:
            g = group[p]
            if g < 0:
                break
            out[free[g]] = p
            free[g] += 1
            group[p] = -1
            p = before[p]
    return np.array(out, np.int64)


# --------------------------------------------------------------------------- repeats among contexts

PHRASES, WORDS, BYTES = 0, 1, 2


def _cuts(buf: np.ndarray, offs: np.ndarray, symbols: int) -> tuple[np.ndarray, int]:
    """Starts of the symbols inside contexts, and the bytes before a start that it depends on, all of its context."""
    look = LOOK if symbols == PHRASES else 1
    if symbols == BYTES:
        cut = np.ones(len(buf), bool)
    else:
        space = ~NOT_SPACE[buf]
        cut = np.zeros(len(buf), bool)
        cut[1:] = space[:-1]
    if symbols == PHRASES:
        # the last three letters of the word before, none of them beyond its start
        own = np.where(space, 0, buf).astype(np.uint64)
        key = np.zeros(len(buf), np.uint64)
        some = np.ones(len(buf), bool)
        for k in (2, 3, 4):
            before = np.zeros(len(buf), np.uint64)
            before[k:] = own[:-k]
            some &= before > 0
            key = key << np.uint64(8) | np.where(some, before, 0)
        cut &= mix(key) % np.uint64(CUT) == 0
    for k in range(look):
        cut[offs[:-1] + k] = False
    return np.flatnonzero(cut), look


def _longest(buf: np.ndarray, offs: np.ndarray, symbols: int) -> np.ndarray:
    """For each context the bytes of its longest symbol."""
    start, _ = _cuts(buf, offs, symbols)
    at = np.union1d(offs, start)
    return np.maximum.reduceat(np.diff(at), np.searchsorted(at, offs[:-1]))


def repeats(buf: np.ndarray, offs: np.ndarray, weight: np.ndarray, length: int = LENGTH, symbols: int = PHRASES) -> np.ndarray:
    """For each byte of the contexts (back to back in buf) whether the window of ``length`` bytes that starts there, inside its context, occurs twice or more; weight: how often each context counts."""
    out = np.zeros(len(buf), bool)
    start, look = _cuts(buf, offs, symbols)
    if not len(start):
        return out
    context = np.searchsorted(offs, start, side="right") - 1
    first = np.ones(len(start), bool)
    first[1:] = context[1:] != context[:-1]
    last = np.append(first[1:], True)
    stop = offs[context + 1]
    end = np.where(last, stop, np.append(start[1:], 0))
    before = np.where(first, start - offs[context], start - np.append(0, start[:-1]) + look - 1)
    # ranks of the symbols in the order of their bytes; a context's last symbol is followed by a separator, the least of all
    if symbols == BYTES:
        rank = buf[start].astype(np.int64)
    else:
        raw, seen = buf.tobytes(), {}
        kind = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start.tolist(), end.tolist(), strict=True)])
        by = np.empty(len(seen), np.int64)
        by[[seen[x] for x in sorted(seen)]] = np.arange(len(seen))
        rank = by[kind]
    where = np.arange(len(start)) + np.concatenate(([0], np.cumsum(last)[:-1]))
    text = np.full(len(start) + int(last.sum()) + 1, 1, np.int64)
    text[where] = rank + 2
    text[-1] = 0
    back = np.full(len(text), -1, np.int64)
    back[where] = np.arange(len(start))
    order = back[suffix_order(text)]
    order = order[order >= 0]
    acc = prefix_hash(buf)
    at, room = start[order], (stop - start)[order]
    least = max(1, length - int(before.max()))
    common = _common(buf, acc, at, room, length, least)
    # a window's first symbol is the first whose start its own bytes tell, d bytes on; the window repeats if that symbol's interval
    # at length - d has another with the same d bytes before, or counts twice itself
    near = np.concatenate(([False], common >= least, [False]))
    heavy = weight[context[order]]
    live = np.flatnonzero(near[1:] | near[:-1] | (heavy > 1))
    for d in range(look, int(before.max()) + 1):
        some = live[(before[order[live]] >= d) & (room[live] >= length - d)]
        if not len(some):
            continue
        interval = np.cumsum(np.concatenate(([0], common < length - d)))[some]
        _again(buf, acc, at[some] - d, d, interval, heavy[some], out)
    return out


def _again(buf: np.ndarray, acc: np.ndarray, p: np.ndarray, d: int, interval: np.ndarray, weight: np.ndarray, out: np.ndarray) -> None:
    """Marks in out those p that count twice or more among those with their interval and the d bytes from p."""
    key = mix(span_hash(acc, p, p + d) + interval.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    by = np.argsort(key, kind="stable")
    head = np.concatenate(([True], key[by][1:] != key[by][:-1]))
    run = np.cumsum(head) - 1
    twice = np.bincount(run, weights=weight[by])[run] > 1
    found = by[twice]
    one = by[np.flatnonzero(head)][run][twice]  # the first of each one's run
    grid = np.arange(d)
    for k in range(0, len(found), 8192):
        a, b = found[k : k + 8192], one[k : k + 8192]
        if (interval[a] != interval[b]).any() or (buf[p[a][:, None] + grid] != buf[p[b][:, None] + grid]).any():
            break
    else:
        out[p[found]] = True
        return
    # two strings have one hash: by the bytes themselves
    count: dict[tuple[int, bytes], int] = {}
    own = [(i, buf[x : x + d].tobytes()) for i, x in zip(interval.tolist(), p.tolist(), strict=True)]
    for x, w in zip(own, weight.tolist(), strict=True):
        count[x] = count.get(x, 0) + w
    out[p[[count[x] > 1 for x in own]]] = True


def _common(buf: np.ndarray, acc: np.ndarray, at: np.ndarray, room: np.ndarray, length: int, least: int) -> np.ndarray:
    """Common bytes, up to length, of neighbours in the order; only counts of least or more are exact."""
    out = np.zeros(max(0, len(at) - 1), np.int64)
    short = np.minimum(room[1:], room[:-1])
    some = np.flatnonzero(short >= least)
    same = some[span_hash(acc, at[some], at[some] + least) == span_hash(acc, at[some + 1], at[some + 1] + least)]
    padded = np.concatenate((buf, np.zeros(length, np.uint8)))
    grid = np.arange(length)
    for k in range(0, len(same), 4096):
        part = same[k : k + 4096]
        diff = padded[at[part][:, None] + grid] != padded[at[part + 1][:, None] + grid]
        found = np.where(diff.any(axis=1), diff.argmax(axis=1), length)
        out[part] = np.minimum(found, short[part])
    return out


def spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


# --------------------------------------------------------------------------- anchors


def contexts(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, anchor, place of the anchor, first window, windows) for each context of a block of texts; places are in the block."""
    n = len(buf)
    if n < length:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty
    acc = prefix_hash(buf)
    at = np.arange(n - gram + 1)
    h = span_hash(acc, at, at + gram)
    least = (h & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width, size = length - gram + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if rest := width - size:
        least = np.minimum(least[:-rest], least[rest:])
    where = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(n - length + 2, np.int8)
    long = np.flatnonzero(np.diff(offs) >= length)
    np.add.at(inside, offs[long], 1)
    np.add.at(inside, offs[long + 1] - length + 1, -1)
    ok = np.cumsum(inside[:-1], dtype=np.int8) > 0
    first = ok.copy()
    first[1:] &= ~ok[:-1] | (where[1:] != where[:-1])
    first[offs[long]] = True
    lo = np.flatnonzero(first)
    text = np.searchsorted(offs, lo, side="right") - 1
    stop = np.append(lo[1:], n)
    count = np.minimum(stop, offs[text + 1] - length + 1) - lo
    return text, h[where[lo]].view(np.int64), where[lo], lo, count


def _digests(parts: list[bytes], seed: int = 0) -> np.ndarray:
    """128-bit digests as two columns of longs."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(x, seed) for x in parts]), np.int64).reshape(-1, 2)


def _anchors(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, w) for each context of texts (row, w, text); w: how often its text is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = batch.column(0).to_numpy()
            for i, _, buf, offs in text_blocks(batch.column(1), BLOCK):
                text, anchor, *_ = contexts(buf, offs, length)
                if len(text):
                    yield pa.RecordBatch.from_arrays([longs(anchor), longs(w[i + text])], names=["anchor", "w"])

    return texts.select("w", "text").mapInArrow(run, "anchor long, w long")


CONTEXTS = "anchor long, row long, copied boolean, lo int, n int, c1 long, c2 long"


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, w = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, _, buf, offs in text_blocks(batch.column(2), BLOCK):
                text, anchor, _, lo, n = contexts(buf, offs, length)
                if len(text):
                    raw = buf.tobytes()
                    c = _digests([raw[a:b] for a, b in zip(lo.tolist(), (lo + n + length - 1).tolist(), strict=True)])
                    columns = [longs(anchor), longs(rows[i + text]), pa.array(w[i + text] > 1), pa.array((lo - offs[text]).astype(np.int32)), pa.array(n.astype(np.int32)), longs(c[:, 0]), longs(c[:, 1])]
                    yield pa.RecordBatch.from_arrays(columns, names=["anchor", "row", "copied", "lo", "n", "c1", "c2"])

    return texts.select("row", "w", "text").mapInArrow(run, CONTEXTS)


# --------------------------------------------------------------------------- groups

#: A string of a group (g1, g2), its digest (c1, c2), the number of places that have it, and its weight in the group.
STRINGS = "g1 long, g2 long, c1 long, c2 long, k long, weight int, many boolean, bytes binary"
RUNS = "g1 long, g2 long, c1 long, c2 long, k long, lo int, n int"
PIECES = "o1 long, o2 long, o3 long, o4 long, ok long, off int, g1 long, g2 long, c1 long, c2 long, weight int, bytes binary"
KEY = ["g1", "g2", "c1", "c2"]


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, needed: [(anchor, c1, c2, k, weight, many, lo, size)]) to STRINGS, a row of texts at a time."""
    kinds = (*[pa.int64()] * 5, pa.int32(), pa.bool_(), pa.binary())
    names = [*KEY, "k", "weight", "many", "bytes"]
    for batch in batches:
        texts = batch.column(0).cast(pa.large_binary())
        for k, needed in enumerate(batch.column(1)):
            raw = texts[k].as_py()
            needed = needed.values
            for i in range(0, len(needed), 1 << 14):
                part = needed.slice(i, 1 << 14).flatten()
                lo, size = part[6].to_pylist(), part[7].to_pylist()
                own = [part[0], pa.array(np.zeros(len(lo), np.int64)), *part[1:6], [raw[a : a + b] for a, b in zip(lo, size, strict=True)]]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(own, kinds, strict=True)], names=names)


def _sorted_repeats(length: int, sort_bytes: int):
    names = [*KEY, "k", "lo", "n"]

    def solve(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        """held: (g1, g2, c1, c2, k, weight, bytes), whole groups. Groups with long symbols take finer ones."""
        for symbols in (PHRASES, WORDS, BYTES):
            if not held:
                return
            buf = np.frombuffer(b"".join([r[6] for r in held]), np.uint8)
            offs = np.concatenate(([0], np.cumsum([len(r[6]) for r in held])))
            own, held_back = held, []
            if symbols != BYTES and (long := _longest(buf, offs, symbols) > MOST).any():
                groups = {held[k][:2] for k in np.flatnonzero(long).tolist()}
                own, held_back = [r for r in held if r[:2] not in groups], [r for r in held if r[:2] in groups]
                buf = np.frombuffer(b"".join([r[6] for r in own]), np.uint8)
                offs = np.concatenate(([0], np.cumsum([len(r[6]) for r in own])))
            held = held_back
            if not own:
                continue
            a, b = spans(repeats(buf, offs, np.array([r[5] for r in own]), length, symbols))
            if not len(a):
                continue
            k = np.searchsorted(offs, a, side="right") - 1
            keys = np.array([r[:5] for r in own], np.int64)[k]
            yield pa.RecordBatch.from_arrays([*(longs(keys[:, c]) for c in range(5)), pa.array((a - offs[k]).astype(np.int32)), pa.array((b - a).astype(np.int32))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if total >= sort_bytes and row[:2] != last:
                    yield from solve(held)
                    held, total = [], 0
                held.append(row)
                total += len(row[6])
                last = row[:2]
        yield from solve(held)

    return run


def _pieces(length: int, width: int):
    """Strings to their pieces: the windows whose distances from the anchor are of one step, under the bytes that they all share."""
    names = ["o1", "o2", "o3", "o4", "ok", "off", *KEY, "weight", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for *key, weight, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = int(contexts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), length)[2][0])
                n = len(raw) - length + 1
                j = 0
                while j < n:
                    step = (at - j) // width
                    stop = min(n, at - step * width + 1)
                    core = raw[at - step * width : at - (step + 1) * width + 1 + length]
                    piece = raw[j : stop - 1 + length]
                    g, c = _digests([core], step * 256 + width)[0].tolist(), _digests([piece])[0].tolist()
                    for column, v in zip(out, (*key, j, *g, *c, weight, piece), strict=True):
                        column.append(v)
                    j = stop
            kinds = (*[pa.int64()] * 5, pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    return run


def _runs(strings: DataFrame, length: int, group: int, sort_bytes: int, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """The windows of STRINGS that repeat in their groups, as RUNS; groups marked many are split by the first of widths."""
    own = strings.where(~F.col("many")).select(*KEY, "k", "weight", "bytes").repartition("g1", "g2").sortWithinPartitions("g1", "g2", "c1", "c2")
    runs = own.mapInArrow(_sorted_repeats(length, sort_bytes), RUNS)
    many = strings.where("many").select(*KEY, "k", "weight", "bytes")
    if not widths or many.isEmpty():
        return runs
    places = staged(many.mapInArrow(_pieces(length, widths[0]), PIECES), "suffix-pieces")
    one = F.struct("o1", "o2", "o3", "o4", "off", "bytes")
    distinct = staged(places.groupBy(*KEY).agg(F.count("*").alias("k"), F.sum("weight").alias("w"), F.min(one).alias("one"), F.max(one).alias("two")), "suffix-distinct")
    groups = staged(distinct.groupBy("g1", "g2").agg(F.count("*").alias("size"), F.sum("w").alias("total")).where("total >= 2"), "suffix-groups")
    each = hot_join(distinct, groups, ["g1", "g2"], "size")
    entries = F.when(F.col("k") > 1, F.array(F.struct(F.lit(1).alias("w"), F.col("one.bytes").alias("b")), F.struct(F.lit(1).alias("w"), F.col("two.bytes").alias("b")))).otherwise(F.array(F.struct(F.col("w").cast("int").alias("w"), F.col("one.bytes").alias("b"))))
    finer = widths[1:]
    each = staged(each.select(*KEY, "k", F.explode(entries).alias("e"), ((F.col("size") > group) if finer else F.lit(False)).alias("many")).select(*KEY, "k", F.col("e.w").alias("weight"), "many", F.col("e.b").alias("bytes")), "suffix-strings")
    found = staged(_collected(_runs(each, length, group, sort_bytes, finer)), "suffix-found")
    back = hot_join(places.drop("bytes", "weight"), found, KEY, "k").select(F.col("o1").alias("g1"), F.col("o2").alias("g2"), F.col("o3").alias("c1"), F.col("o4").alias("c2"), F.col("ok").alias("k"), "off", F.explode("runs").alias("r"))
    return runs.unionByName(back.select(*KEY, "k", (F.col("off") + F.col("r.lo")).alias("lo"), F.col("r.n").alias("n")))


def _collected(runs: DataFrame) -> DataFrame:
    """The runs of each string: no more than its windows."""
    return runs.groupBy(*KEY).agg(F.first("k").alias("k"), F.collect_set(F.struct("lo", "n")).alias("runs"))


# --------------------------------------------------------------------------- the operator


def repeat_runs(docs: DataFrame, text: str = "text", length: int = LENGTH, group: int = GROUP, sort_bytes: int = SORT_BYTES) -> tuple[DataFrame, DataFrame]:
    """(texts, runs): the distinct texts (row, sha, w: how often, n_bytes, text), and the window starts that repeat, as (row, runs: [(lo, n)])."""
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    whole = docs.select(F.sha2(raw.cast("binary"), 256).alias("sha"), raw.alias("text"))
    texts = staged(whole.groupBy("sha").agg(F.count("*").alias("w"), F.first("text").alias("text")).select(F.monotonically_increasing_id().alias("row"), "sha", "w", F.octet_length("text").cast("long").alias("n_bytes"), "text"), "suffix-texts")
    long = texts.where(F.col("n_bytes") >= length)
    anchors = staged(_anchors(long, length).groupBy("anchor").agg(F.count("*").alias("k"), F.sum("w").alias("w")).where("w >= 2").select("anchor", "k"), "suffix-anchors")
    places = staged(hot_join(_contexts(long, length), anchors, ["anchor"], "k").drop("k"), "suffix-contexts")
    # each distinct context, with its first and its last place
    place = F.struct("row", "lo", "n")
    distinct = staged(places.groupBy("anchor", "c1", "c2").agg(F.count("*").alias("k"), F.max("copied").alias("copied"), F.min(place).alias("one"), F.max(place).alias("two")), "suffix-distinct")
    large = staged(distinct.groupBy("anchor").agg(F.count("*").alias("size")).where(F.col("size") > group), "suffix-groups")
    each = hot_join(distinct, large, ["anchor"], "size", "left")
    weight = F.when((F.col("k") == 1) & F.col("copied"), 2).otherwise(1)
    entries = F.when(F.col("k") > 1, F.array("one", "two")).otherwise(F.array("one"))
    need = each.select("anchor", "c1", "c2", "k", weight.alias("weight"), F.col("size").isNotNull().alias("many"), F.explode(entries).alias("e"))
    need = need.select(F.col("e.row").alias("row"), F.struct("anchor", "c1", "c2", "k", "weight", "many", F.col("e.lo").alias("lo"), (F.col("e.n") + length - 1).alias("size")).alias("r"))
    per_text = need.groupBy("row").agg(F.collect_list("r").alias("needed"))  # no more than the contexts of one text
    strings = staged(texts.select("row", "text").join(per_text, "row").select("text", "needed").mapInArrow(_cut_contexts, STRINGS), "suffix-strings")
    found = staged(_collected(_runs(strings, length, group, sort_bytes)).withColumnRenamed("g1", "anchor"), "suffix-found")
    hits = hot_join(places.select("anchor", "c1", "c2", "row", "lo"), found.select("anchor", "c1", "c2", "k", "runs"), ["anchor", "c1", "c2"], "k")
    hits = hits.select("row", F.transform("runs", lambda r: F.struct((F.col("lo") + r["lo"]).alias("lo"), r["n"].alias("n"))).alias("r"))
    return texts, hits.groupBy("row").agg(F.flatten(F.collect_list("r")).alias("runs"))  # no more than the windows of one text


REMOVED = T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType()), T.StructField("kept_sha256", T.StringType())])


def _removed(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte spans covered by windows that start in the runs (lo, n)."""
    out: list[list[int]] = []
    for lo, n in sorted(starts):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], lo + n - 1 + length)
        else:
            out.append([lo, lo + n - 1 + length])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, with_bytes: bool = True, **how) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with_bytes the kept bytes) for each row of docs.

    The id is the row's own, of whatever kind, null or repeated. Null and empty texts have no bytes and lose none; texts shorter
    than ``length`` lose none; a very long text is a row like any other. Rows that repeat a text repeat each other. An empty table
    gives an empty result. Other columns of docs play no part. The kept bytes of rows that lose none are null: the text stands as
    it is.
    """
    texts, runs = repeat_runs(docs, text, length, **how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column(3).cast(pa.large_binary())
            out: list[list] = [[], [], [], []]
            for k, found in enumerate(batch.column(4)):
                raw = raws[k].as_py()
                own = found.values.flatten()
                gone = _removed(list(zip(own[0].to_pylist(), own[1].to_pylist(), strict=True)), length)
                parts, last = [], 0
                for a, b in gone:
                    parts.append(raw[last:a])
                    last = b
                kept = b"".join([*parts, raw[last:]])
                for col, v in zip(out, (sum(b - a for a, b in gone), len(gone), kept if with_bytes else None, hashlib.sha256(kept).hexdigest()), strict=True):
                    col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))], names=["sha", "w", "n_bytes", *REMOVED.names])

    schema = T.StructType([T.StructField("sha", T.StringType()), T.StructField("w", T.LongType()), T.StructField("n_bytes", T.LongType()), *REMOVED])
    changed = staged(texts.join(runs, "row").select("sha", "w", "n_bytes", "text", "runs").mapInArrow(run, schema), "suffix-changed")
    (key,) = fresh(docs.select(doc_id), "sha")
    own = docs.select(F.col(f"`{doc_id}`"), F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"), 256).alias(key), F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("own_bytes"))
    out = hot_join(own, changed.withColumnRenamed("sha", key), [key], "w", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return out.select(F.col(f"`{doc_id}`"), F.col("own_bytes").alias("n_bytes"), zero("n_removed"), zero("n_spans"), *(["kept"] if with_bytes else []), F.coalesce("kept_sha256", key).alias("kept_sha256"))
