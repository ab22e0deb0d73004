"""Candidate sections for clause families: cues in headings and bodies, negative signals, clustering of neighbours, stubs.

All families are judged in one scan of a section (``functions.scan``), whatever their number: it finds the cues of all of them, and only
families with hits become rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import registry, scan, text

LARGE, CLUSTER, STUB = 50_000, 25_000, 100
HITS = "array<struct<family:string,pattern:string,matched_text:string>>"


def _hits(found: Column, groups: list[str], regexes: list[str]) -> Column:
    """Matches as hits, from their patterns' numbers."""
    of = lambda names, m: F.get(F.array(*map(F.lit, names)), m["p"])
    return F.transform(found, lambda m: F.struct(of(groups, m).alias("family"), of(regexes, m).alias("pattern"), m["text"].alias("matched_text"))).cast(HITS) if regexes else F.array().cast(HITS)


def _found(c: Column, regexes: list[str], first: bool = False) -> Column:
    return scan.found(c, tuple(map(scan.compiled, regexes)), first)


def heading_hits(heading: Column, cues: list[str]) -> Column:
    """The first match of each cue that a heading has."""
    return _hits(_found(heading, cues, True), ["heading"] * len(cues), cues)


def body_hits(body: Column, groups: dict[str, list[str]]) -> Column:
    """Every match of every cue but the headings', in registry order."""
    own = [(g, p) for g, ps in groups.items() if g != "heading" for p in ps]
    return _hits(_found(body, [p for _, p in own]), [g for g, _ in own], [p for _, p in own])


def negative_signals(body: Column, negatives: dict[str, list[str]] | None = None) -> Column:
    """The categories of which a pattern matches."""
    own = [(c, p) for c, ps in (registry.negatives() if negatives is None else negatives).items() for p in ps]
    return scan.chosen(scan.present(body, tuple(scan.compiled(p, multiline=True) for _, p in own)), [c for c, _ in own])


def negatives_dominate(negatives: Column, groups: Column, length: Column) -> Column:
    """More negative categories than cue groups, in a text that isn't large."""
    return (length <= LARGE) & (F.size(negatives) > F.size(groups))


def locate(sections: DataFrame, families: list[str] | None = None, cues: dict[str, dict[str, list[str]]] | None = None, negatives: dict[str, list[str]] | None = None, key: str = "storage_key", run_id: str = "") -> DataFrame:
    """Candidates (sections and families): a heading cue, or cues of two or more body groups that negatives don't dominate.

    Unknown families give none. The id is a digest of what names a candidate, so a new run gives the same.
    """
    known = registry.cues() if cues is None else cues
    own = {f: known[f] for f in (sorted(known) if families is None else families) if f in known}
    head = [(f, "heading", p) for f, groups in own.items() for p in groups.get("heading", [])]
    body = [(f, g, p) for f, groups in own.items() for g, ps in groups.items() if g != "heading" for p in ps]
    # one scan of a section finds the cues of all families; only families with hits get rows
    rows = sections.withColumn("h", _found(F.col("heading"), [p for *_, p in head], True)).withColumn("b", _found(F.col("text"), [p for *_, p in body]))
    family = lambda found, cues: F.transform(found, lambda m: F.get(F.array(*(F.lit(f) for f, *_ in cues)), m["p"])) if cues else F.array().cast("array<string>")
    rows = rows.withColumn("families", F.array_sort(F.array_distinct(F.concat(family(F.col("h"), head), family(F.col("b"), body))))).where(F.size("families") > 0)
    rows = rows.withColumn("negative_signals", negative_signals(F.col("text"), negatives))
    of = lambda found, cues: _hits(F.filter(found, lambda m: F.get(F.array(*(F.lit(f) for f, *_ in cues)), m["p"]) == F.col("family")), [g for _, g, _ in cues], [p for *_, p in cues]) if cues else F.array().cast(HITS)
    rows = rows.withColumn("family", F.explode("families"))
    rows = rows.withColumn("j", F.struct(F.col("family").alias("clause_family"), of(F.col("h"), head).alias("in_heading"), of(F.col("b"), body).alias("in_body"))).where((F.size("j.in_heading") > 0) | (F.size("j.in_body") > 1))
    groups = F.array_sort(F.array_distinct(F.transform("j.in_body", lambda h: h["family"])))
    rows = rows.withColumn("groups", groups).withColumn("heading_match", F.size("j.in_heading") > 0)
    rows = rows.where(F.col("heading_match") | (F.size("groups") >= 2) & ~negatives_dominate(F.col("negative_signals"), F.col("groups"), F.length("text")))
    return rows.select(
        F.sha2(F.concat_ws("|", F.lit(run_id), "j.clause_family", "section_id"), 256).alias("candidate_id"),
        F.col("j.clause_family").alias("clause_family"),
        key,
        "section_id",
        "section_index",
        F.col("heading").alias("section_heading"),
        "page_range",
        "heading_match",
        F.when(F.col("heading_match"), F.concat(F.array(F.lit("heading")), "groups")).otherwise(F.col("groups")).alias("cue_families_hit"),
        F.concat("j.in_heading", "j.in_body").alias("cue_hits"),
        "negative_signals",
        F.col("text").alias("section_text"),
        "source_format",
        F.lit(run_id).alias("run_id"),
    )


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("size", T.IntegerType())])))
def _runs(places: pd.Series, lengths: pd.Series, most: pd.Series) -> pd.Series:
    """Of ordered members, by their index and length: the first (from 1) and the number of each cluster."""
    out = []
    for own, sizes, cap in zip(places, lengths, most, strict=True):
        runs: list[list[int]] = []
        total = 0
        for k, (at, n) in enumerate(zip(own, sizes, strict=True)):
            if runs and at == own[k - 1] + 1 and total + n <= cap:
                runs[-1][1] += 1
                total += n
            else:
                runs.append([k + 1, 1])
                total = n
        out.append([{"start": a, "size": n} for a, n in runs])
    return pd.Series(out, dtype=object)


def cluster(candidates: DataFrame, key: str = "storage_key", most: int = CLUSTER, by: tuple[str, ...] = ("clause_family",)) -> DataFrame:
    """Neighbouring candidates of a document as one, while their texts together have at most ``most`` code points.

    A new cluster starts at a gap in section_index or where the cap would be passed, which depends on the cluster so far: indexes
    and lengths of a document's candidates are walked in order, in Arrow batches; texts stay on the JVM. No more than a document's
    sections come together.
    """
    fields = [c for c in candidates.columns if c not in (key, *by)]
    members = F.array_sort(F.collect_list(F.struct("section_index", "section_id", *(F.col(c) for c in fields if c not in ("section_index", "section_id")))))
    folded = candidates.groupBy(key, *by).agg(members.alias("members"))
    runs = _runs(F.transform("members", lambda c: c["section_index"].cast("long")), F.transform("members", lambda c: F.length(c["section_text"])), F.lit(most))
    rows = folded.select(key, *by, "members", F.explode(runs).alias("r")).select(key, *by, F.slice("members", F.col("r.start"), F.col("r.size")).alias("m"))
    all_of = lambda f: F.transform("m", lambda c: c[f])
    merged = {
        "page_range": F.struct(F.array_min(F.transform("m", lambda c: c["page_range"]["start"])).alias("start"), F.array_max(F.transform("m", lambda c: c["page_range"]["end"])).alias("end")),
        "heading_match": F.exists("m", lambda c: c["heading_match"]),
        "cue_families_hit": F.when(F.size("m") == 1, F.element_at("m", 1)["cue_families_hit"]).otherwise(F.array_sort(F.array_distinct(F.flatten(all_of("cue_families_hit"))))),
        "cue_hits": F.flatten(all_of("cue_hits")),
        "negative_signals": F.when(F.size("m") == 1, F.element_at("m", 1)["negative_signals"]).otherwise(F.array_sort(F.array_distinct(F.flatten(all_of("negative_signals"))))),
        "section_text": F.array_join(all_of("section_text"), "\n\n"),
    }
    return rows.select(*((merged[c] if c in merged else F.col(c) if c in (key, *by) else F.element_at("m", 1)[c]).alias(c) for c in candidates.columns), F.size("m").alias("n_sections"))


def drop_stubs(candidates: DataFrame, least: int = STUB) -> DataFrame:
    return candidates.where(F.length(text.strip(F.col("section_text"))) >= least)
