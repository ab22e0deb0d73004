"""Text functions against Python's re and str, on fixed and random texts."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from lexarium.functions import registry, text


def rows(spark, values, kind="string"):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, t {kind}")


@pytest.mark.parametrize("regex", [r"pari\s+passu", r"\d+%", r"(gross[\s-]?up|tax)", r"a.{0,6}b", r"é|ü", r"[^.]{0,9}lien"])
def test_find_all_is_finditer(spark, regex):
    r = random.Random(regex)
    alphabet = ["pari", "PASSU", " ", "\n", " ", "12%", "gross-up", "Tax", "a", "b", "É", "ü", "lien", ".", "😀", "\r\n", "\u0001", "ſ"]
    values = ["", *("".join(r.choices(alphabet, k=r.randint(0, 60))) for _ in range(80))]
    got = {x["k"]: [(m["start"], m["text"]) for m in x["m"]] for x in rows(spark, values).select("k", text.find_all(F.col("t"), text.pattern(regex)).alias("m")).collect()}
    for k, v in enumerate(values):
        assert got[k] == [(m.start(), m[0]) for m in re.finditer(regex, v, re.IGNORECASE)], v


def test_every_pattern_of_the_registries_compiles(spark):
    own = [p["pattern"] for p in registry.patterns()] + [p for g in registry.cues().values() for ps in g.values() for p in ps] + [p for ps in registry.negatives().values() for p in ps] + [p for g in registry.components().values() for ps in g.values() for p in ps] + [p for p, *_ in registry.forms()]
    assert len(registry.families()) == 17 and len(registry.labels()) == 45 and len(registry.forms()) == 22
    one = spark.range(1)
    assert one.select(*(F.lit("x").rlike(text.pattern(p, multiline=True)).alias(f"c{k}") for k, p in enumerate(own))).count() == 1
    for p in own:
        re.compile(p, re.IGNORECASE | re.MULTILINE)


def test_strip_and_squeeze(spark):
    values = ["", " a ", "\n\t a  b \r\n", "x", "\x0b\x0c"]
    for x in rows(spark, values).select("t", text.strip(F.col("t")).alias("s"), text.squeeze(F.col("t")).alias("q")).collect():
        assert x["s"] == x["t"].strip() and x["q"] == re.sub(r"\s+", " ", x["t"]).strip()


def test_pages(spark):
    pages = ["ab", "", "cde"]
    df = spark.createDataFrame([(pages,)], "p array<string>").select(text.page_starts(F.col("p")).alias("s"))
    assert df.first()["s"] == [0, 4, 6]
    for at, page in ((0, 0), (3, 0), (4, 1), (6, 2), (99, 2)):
        assert df.select(text.page_of(F.lit(at), F.col("s")).alias("p")).first()["p"] == page


def test_title_case(spark):
    values = ["ANNUAL REPORT", "it's o-k high", "", "a1b"]
    assert [x["r"] for x in rows(spark, values).select("k", text.title_case(F.col("t")).alias("r")).orderBy("k").collect()] == [v.title() for v in values]


def test_free_date(spark):
    values = {"2021-02-03": dt.date(2021, 2, 3), "March 5th, 2020": dt.date(2020, 3, 5), "31 June 2020": None, "5 MARCH 2020": dt.date(2020, 3, 5), "x": None}
    got = {x["t"]: x["d"] for x in rows(spark, list(values)).select("t", text.free_date(F.col("t")).alias("d")).collect()}
    assert got == values


def test_slug_and_issuer(spark):
    got = rows(spark, ["Iran (Islamic Rep. of), X - Y - Z"]).select(text.slug(F.col("t")).alias("s"), text.issuer_of(F.col("t")).alias("i")).first()
    assert got["s"] == "iran-islamic-rep.-of-x---y---z" and got["i"] == "Iran (Islamic Rep. of), X"
