"""Scans with many patterns or strings, against each of them alone; and blocks of skewed orders."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lexarium.functions import registry, scan, text
from lexarium.operators import blockwise, substrings
from lexarium.plans import records
from lexarium.streaming import events


def every_pattern():
    own = [(p["pattern"], re.I) for p in [*registry.patterns(), *registry.page_patterns()]]
    own += [(p, re.I) for groups in registry.cues().values() for ps in groups.values() for p in ps]
    own += [(p, re.I | re.M) for ps in registry.negatives().values() for p in ps]
    return tuple(own + [(p, re.I) for parts in registry.components().values() for ps in parts.values() for p in ps])


@pytest.mark.parametrize(("regex", "want"), [
    (r"pari\s+passu", {"passu"}), (r"(?:abc|de)\s*x+", {"abc", "de"}), (r"(?:abc|d?)y", {"y"}), (r"a?b*", set()), (r"\d+%", {"%"}), (r"gross[\s-]?up", {"gross"}),
    (r"(foo(bar)?){2,}", {"foo"}), (r"(foo)?x", {"x"}), (r"^Rule\b", {"rule"}), (r"[ab]c", {"c"}), (r"é\s", set()), (r"bonds?holders", {"holders"}),
])
def test_literals(regex, want):
    assert scan.literals(regex, re.I) == want


def test_scanner_is_every_pattern_alone():
    """No match is lost to the automaton, whatever its case or the letters that fold into ASCII."""
    own = every_pattern()
    scanner = scan.Scanner(own)
    assert len(scanner.always) < len(own) / 10
    rng = random.Random(4)
    bits = [w for s in records.SENTENCES + records.HEADINGS for w in s.split()] + ["ſubject", "K", "bankıng", "İssuer", "\n", "\n\n", "12%", "é"]
    for _ in range(150):
        t = "".join(rng.choice([w, w.upper(), w.replace("s", "ſ").replace("k", "K")]) + rng.choice([" ", "  ", "\n", "-"]) for w in (rng.choice(bits) for _ in range(rng.randint(0, 60))))
        t += rng.choice(records.SENTENCES)
        assert [*scanner.matches(t)] == [(k, m.start(), m[0]) for k, (p, f) in enumerate(own) for m in re.finditer(p, t, f)]


def test_columns_of_scans(spark):
    own = (scan.compiled("on"), scan.compiled("^t", multiline=True), scan.compiled("zzz"))
    df = spark.createDataFrame([(0, None), (1, ""), (2, "One on\nThe"), (3, "x")], "k int, t string")
    got = df.select("k", scan.found(F.col("t"), own).alias("f"), scan.found(F.col("t"), own, first=True).alias("one"), scan.present(F.col("t"), own).alias("n"))
    rows = {r["k"]: ([tuple(m) for m in r["f"]], [tuple(m) for m in r["one"]], r["n"]) for r in got.collect()}
    assert rows[0] == rows[1] == rows[3] == ([], [], [])
    assert rows[2] == ([(0, 0, "On"), (0, 4, "on"), (1, 7, "T")], [(0, 0, "On"), (1, 7, "T")], [0, 1])
    named = df.where("k = 2").select(scan.chosen(F.array(F.lit(2), F.lit(0)), ["b", "a", "b"]).alias("c"))
    assert named.first()["c"] == ["b"]
    assert df.select(scan.found(F.col("t"), ()).alias("f")).first()["f"] == []


def test_find_all_is_linear(spark):
    """20,000 matches in one text take a time that ten times as many as 2,000 may take."""

    def took(n):
        df = spark.createDataFrame([("a of the b " * n,)], "t string").select(F.size(text.find_all(F.col("t"), text.pattern(r"of\s+the"))).alias("n"))
        df.first()
        began = time.perf_counter()
        assert df.first()["n"] == n
        return time.perf_counter() - began

    assert took(20_000) < 10 * took(2_000) + 1


def test_title_case_and_sums_are_linear(spark):
    df = spark.createDataFrame([("it's A " * 30_000, [3] * 50_000)], "t string, n array<int>")
    began = time.perf_counter()
    r = df.select(text.title_case("t").alias("t"), text.sums_before("n").alias("s")).first()
    assert r["t"] == ("it's A " * 30_000).title() and r["s"] == [3 * k for k in range(50_000)] and time.perf_counter() - began < 10


# ------------------------------------------------------------------ substrings


@pytest.mark.parametrize("block", [600, 1 << 20])
def test_contained_is_brute_force(spark, block):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abé漢", k=rng.randint(1, 3)))
    docs = [(k, " ".join(word() for _ in range(rng.randint(0, 80)))) for k in range(60)] + [(60, None), (61, "")]
    items = [(k, " ".join(word() for _ in range(rng.randint(0, 3)))) for k in range(150)] + [(200, None), (201, docs[3][1]), (202, "a"), (203, "a")]
    got = substrings.contained(spark.createDataFrame(items, "i int, s string"), spark.createDataFrame(docs, "d int, t string"), "i", "s", "d", "t", block_bytes=block).collect()
    want = [(i, d) for i, s in items for d, t in docs if s and t and s in t]
    assert sorted(map(tuple, got)) == sorted(want)


def test_contained_of_nothing(spark):
    none, some = spark.createDataFrame([], "i string, s string"), spark.createDataFrame([(1, "x")], "d long, t string")
    out = substrings.contained(none, some, "i", "s", "d", "t")
    assert out.collect() == [] and out.dtypes == [("item_id", "string"), ("doc_id", "bigint")]


def test_a_hundred_thousand_strings(spark, sf_dir):
    """Whole documents against 100,000 strings, in blocks, in a time that does not hang on their number."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    rng = random.Random(1)
    made = [t[a : a + rng.randint(20, 60)] for t in rng.choices([*whole.values()], k=1000) if len(t) > 100 for a in [rng.randrange(len(t) - 80)]]
    items = [*enumerate(made + [f"{rng.random()} is in no text" for _ in range(100_000 - len(made))])]
    df = spark.createDataFrame(items, "i int, s string")
    began = time.perf_counter()
    got = sorted(map(tuple, substrings.contained(df, docs, "i", "s", "doc_id", "text", block_bytes=2 << 20).collect()))
    assert time.perf_counter() - began < 60
    assert got == sorted((k, d) for k, s in items[: len(made)] for d, t in whole.items() if s in t)


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_first_match_of_many_patterns(spark, block):
    rng = random.Random(2)
    patterns = [(rng.randrange(300), "".join(rng.choices("ABC", k=rng.randint(1, 5))), f"f{k}", k) for k in range(60)] + [(0, "", "none", 0), (1, None, "none", 0)]
    rows = [(k, "".join(rng.choices("abcx", k=rng.randint(0, 9)))) for k in range(80)] + [(90, None)]
    got = substrings.first_match(spark.createDataFrame(rows, "k int, v string"), spark.createDataFrame(patterns, "ord int, pattern string, field string, n int"), "v", block_bytes=block)
    want = {}
    for k, v in rows:
        hits = sorted((o, p, f, n) for o, p, f, n in patterns if p and v and p in v.upper())
        want[k] = hits[0][2:] if hits else (None, None)
    assert {r["k"]: (r["field"], r["n"]) for r in got.collect()} == want and got.columns == ["k", "v", "field", "n"]


# ------------------------------------------------------------------ blocks


def test_no_block_is_large(spark):
    """One key with nearly all rows, and an order column with values far from all others: no block has twice the mean."""
    rows = spark.range(200_000).selectExpr("if(id % 1000 = 0, 'small', 'big') AS k", "if(id = 7, 1000000000000, if(id = 8, -5000000000, id * id)) AS at", "id").repartition(8)
    own = blockwise.with_block(rows, ["k"], "at", parts=64, least=100)
    sizes = {(r["k"], r[blockwise.BLOCK]): r["count"] for r in own.groupBy("k", blockwise.BLOCK).count().collect()}
    big = [n for (k, _), n in sizes.items() if k == "big"]
    assert len(big) >= 60 and max(big) < 2 * 199_800 / len(big) and sum(k == "small" for k, _ in sizes) == 1


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_running_values_over_blocks(spark, parts):
    """Sums, maxima, predecessors and lags over blocks are those of one window, nulls and ties included."""
    from pyspark.sql.window import Window

    rows = spark.range(3000).selectExpr("if(id % 5 = 0, NULL, if(id % 7 = 0, 'a', 'b')) AS k", "if(id % 11 = 0, NULL, if(id = 50, 1e15, pmod(id * 7919, 1000))) AS at", "id", "id % 13 AS v")
    w = Window.partitionBy("k").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = rows.select("id", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"), F.lag("v", 9).over(Window.partitionBy("k").orderBy("at", "id")).alias("l"))
    own = blockwise.with_block(rows, ["k"], "at", parts=parts, least=10)
    got = blockwise.running(own, ["k"], ["at", "id"], s=("sum", F.col("v")), m=("max", F.col("v"))).select("id", "s", "m")
    lags = blockwise.lagged(own, ["k"], ["at", "id"], "v", 9, "l").select("id", "l")
    assert sorted(map(tuple, got.join(lags, "id").collect())) == sorted(map(tuple, want.collect()))


def test_breaker_of_one_hot_key(spark):
    rows = spark.range(40_000).selectExpr("'k' AS key", "if(id = 0, -1000000000000, id) AS at", "id % 1000 > 990 AS failed")
    got = events.breaker_rows(rows, "key", ["at"], "failed", pause=4, abort=9, total=10**9).orderBy("at").collect()
    assert [(r["at"], r["action"]) for r in got] == [(994, "pause"), (998, "pause"), (999, "abort")]
