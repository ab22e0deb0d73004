"""Verification of extracted passages against their source: verbatim similarity, completeness, quality flags, the record.

Containment after squeezing white space decides natively. Only passages that aren't contained reach difflib, in Arrow batches.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import registry, scan, text
from . import substrings

VERBATIM, SECTION = 0.95, 0.85


def window_similarity(own: str, source: str, autojunk: bool = True) -> float:
    """The ratio of a passage to the window around its longest match in the source. The steps are those that the values ask for."""
    best = SequenceMatcher(None, own, source, autojunk).find_longest_match(0, len(own), 0, len(source))
    if not best.size:
        return 0.0
    start = max(0, best.b - best.a)
    return SequenceMatcher(None, own, source[start : start + len(own) + len(own) // 20], autojunk).ratio()


def similarity(extracted: Column, source: Column, whole: bool = False, autojunk: bool = True) -> Column:
    """0 for an empty passage, 1 for a contained one, else the window's ratio (``whole``: the whole source's)."""

    @F.pandas_udf("double")
    def rest(a: pd.Series, b: pd.Series) -> pd.Series:
        score = (lambda x, y: SequenceMatcher(None, x, y, autojunk).ratio()) if whole else (lambda x, y: window_similarity(x, y, autojunk))
        return pd.Series([None if x is None or y is None else score(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    a, b = text.squeeze(F.coalesce(extracted, F.lit(""))), text.squeeze(F.coalesce(source, F.lit("")))
    left = (a != "") & ~F.contains(b, a)
    # the function sees nulls where containment has decided
    return F.when(a == "", 0.0).when(F.contains(b, a), 1.0).otherwise(rest(F.when(left, a), F.when(left, b)))


def contained(items: DataFrame, docs: DataFrame, item_id: str, item: str, doc_id: str, text_: str, most_bytes: int = substrings.BLOCK_BYTES) -> DataFrame:
    """(item_id, doc_id) for each item that stands in a document, white space squeezed; empty items stand nowhere.

    Items are automata of at most ``most_bytes`` each; a document is scanned once for each of these, in time linear in its text and
    its hits.
    """
    return substrings.contained(items, docs, item_id, item, doc_id, text_, text.squeeze, most_bytes)


Components = dict[str, dict[str, list[str]]]


def _flat(known: Components) -> list[tuple[str, str, str]]:
    return [(f, c, p) for f, parts in known.items() for c, ps in parts.items() for p in ps]


def component_numbers(body: Column, components: Components | None = None) -> Column:
    """The numbers of the patterns, of all families' components, that a text has: one scan of it."""
    own = _flat(registry.components() if components is None else components)
    return scan.present(F.coalesce(body, F.lit("")), tuple(scan.compiled(p) for *_, p in own))


def completeness_of(numbers: Column, family: str, components: Components | None = None) -> Column:
    """map<component, found> of a family from the numbers of the patterns that match."""
    known = registry.components() if components is None else components
    if not known.get(family):
        return F.create_map().cast("map<string,boolean>")
    own = _flat(known)
    at = lambda c: F.array(*(F.lit(k) for k, (f, d, _) in enumerate(own) if (f, d) == (family, c)))
    return F.create_map(*(x for c in known[family] for x in (F.lit(c), F.arrays_overlap(numbers, at(c)))))


def completeness(body: Column, family: str, components: Components | None = None) -> Column:
    """map<component, found>; empty for an unknown family."""
    known = registry.components() if components is None else components
    own = {family: known[family]} if known.get(family) else {}
    return completeness_of(component_numbers(body, own), family, own)


def completeness_by(family: Column, numbers: Column, components: Components | None = None) -> Column:
    """The same with the family in a column, from the numbers of the patterns that match."""
    known = registry.components() if components is None else components
    out = F.create_map().cast("map<string,boolean>")
    for f in known:
        out = F.when(family == f, completeness_of(numbers, f, known)).otherwise(out)
    return out


def quality_flags(extracted: Column, source: Column) -> Column:
    """truncation_suspect: a passage that breaks off inside a sentence; ocr_suspect: a source with few letters."""
    end = text.rstrip(F.coalesce(extracted, F.lit("")))
    letters = F.length(F.regexp_replace(source, r"(?U)[^\p{L}]", ""))
    return F.filter(
        F.array(F.when(end.rlike(r"(?U)\p{L}$"), F.lit("truncation_suspect")), F.when((F.length(source) > 20) & (letters / F.length(source) < 0.6), F.lit("ocr_suspect"))), lambda f: f.isNotNull()
    )


def verify(extractions: DataFrame, family: str = "clause_family", extracted: str = "clause_text", source: str = "section_text", found: str = "found", status: str = "status", autojunk: bool = True) -> DataFrame:
    """extractions with verification: struct<status, verbatim_similarity, completeness, quality_flags, components_present, components_total>.

    Statuses: error_skipped for an extraction whose status is api_error; not_found; verified or failed; for families captured as
    whole sections section_located or needs_review. Passages that fail are flagged verification_failed; those of a family with three
    or more components that have one or none partial_extraction.
    """
    f, a, b = F.col(family), F.col(extracted), F.col(source)
    errs, have = F.coalesce(F.col(status) == "api_error", F.lit(False)), F.coalesce(F.col(found), F.lit(False))
    sectional = f.isin(registry.SECTION_FAMILIES)
    judged = ~errs & have
    rows = extractions.withColumn("sim_", F.when(judged & sectional, similarity(F.when(judged & sectional, a), b, True, autojunk)).when(judged, similarity(F.when(judged & ~sectional, a), b, False, autojunk)))
    rows = rows.withColumn("numbers_", component_numbers(F.when(judged, a))).withColumn("parts_", F.when(judged, completeness_by(f, F.col("numbers_"))))
    passes = F.col("sim_") >= F.when(sectional, SECTION).otherwise(VERBATIM)
    present, total = F.size(F.filter(F.map_values("parts_"), lambda x: x)), F.size("parts_")
    state = F.when(errs, "error_skipped").when(~have, "not_found").when(sectional, F.when(passes, "section_located").otherwise("needs_review")).otherwise(F.when(passes, "verified").otherwise("failed"))
    flags = F.when(judged, F.concat(quality_flags(a, b), F.when(passes, F.array().cast("array<string>")).otherwise(F.array(F.lit("verification_failed"))), F.when((present <= 1) & (total >= 3), F.array(F.lit("partial_extraction"))).otherwise(F.array().cast("array<string>"))))
    record = F.struct(state.alias("status"), F.bround(F.col("sim_"), 3).alias("verbatim_similarity"), F.col("parts_").alias("completeness"), flags.alias("quality_flags"), F.when(judged, present).alias("components_present"), F.when(judged, total).alias("components_total"))
    return rows.withColumn("verification", record).drop("sim_", "parts_", "numbers_")
