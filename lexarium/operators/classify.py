"""Document classification: form codes of filings, then ordered patterns over the opening, then novel types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import registry, text

OPENING, WIDE, CODE_OPENING, NOTICE, NOVEL = 10_000, 15_000, 1000, 500, 3000
# The header line of a form code, the two ways a rule is named, and how a novel type ends.
CODE = r"(?md)^(424B[1-5]|FWP|F-4|18-K(?:/A)?|S-\d+)\s*\n"
FILED = r"(?d)Filed\s+Pursuant\s+to\s+Rule\s+(\d+\([a-z]\)\(\d+\))"
RULE = r"(?md)^Rule\s+(\d+\([a-z]\)\(\d+\))"
NOVEL_TYPE = r"(?:^|\n)\s*([A-Z][A-Z\s]{5,60}(?:STATEMENT|MEMORANDUM|CIRCULAR|CERTIFICATE|NOTICE|AGREEMENT))"
#: Rule numbers of form codes: "424(b)(5)" is 424B5.
RULE_FORM = r"^424\(b\)\(([1-5])\)$"


def form_code(body: Column) -> Column:
    """The form code in the opening, whichever of its three spellings comes first; null if none or of an unknown rule."""
    head = F.substring(body, 1, CODE_OPENING)
    at = lambda p: F.when(head.rlike(p), F.length(F.split(head, p, 2)[0]))
    rule = lambda p: F.when(F.regexp_extract(head, p, 1).rlike(RULE_FORM), F.concat(F.lit("424B"), F.regexp_extract(F.regexp_extract(head, p, 1), RULE_FORM, 1)))
    first = F.least(at(CODE), at(FILED), at(RULE))
    return F.when(at(CODE) == first, F.regexp_extract(head, CODE, 1)).when(at(FILED) == first, rule(FILED)).when(at(RULE) == first, rule(RULE))


def classify(docs: DataFrame, key: str = "storage_key", body: str = "text", forms: list[tuple[str, ...]] | None = None, codes: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(key, instrument_family, document_role, document_form, confidence, reasoning, evidence_text, novel_types_observed, schema_version).

    high: a known form code; medium: the first pattern, in order, that the opening has (a wider one after an "important notice");
    low: none. The patterns of a registry are literals under one alternation, which alone runs on texts that have none.
    """
    forms = registry.forms() if forms is None else forms
    codes = registry.form_codes() if codes is None else codes
    t = F.coalesce(F.col(body), F.lit(""))
    rows = docs.select(key, t.alias("t")).withColumn("code", form_code(F.substring("t", 1, OPENING)))
    wide = F.substring("t", 1, NOTICE).rlike(r"(?iuUd)^important\s+notice")
    rows = rows.withColumn("opening", F.when(wide, F.substring("t", 1, WIDE)).otherwise(F.substring("t", 1, OPENING)))
    known = F.lit(None).cast("array<string>")
    for c, kind in codes.items():
        known = F.when(F.col("code") == c, F.array(*map(F.lit, kind))).otherwise(known)
    hit = F.coalesce(*(F.when(F.col("opening").rlike(text.pattern(p)), F.array(F.lit(text.pattern(p)), *map(F.lit, kind))) for p, *kind in forms)) if forms else F.lit(None).cast("array<string>")
    any_form = F.col("opening").rlike(text.pattern("|".join(f"(?:{p})" for p, *_ in forms))) if forms else F.lit(False)
    rows = rows.withColumn("known", known).withColumn("hit", F.when(F.col("known").isNull() & any_form, hit))
    matched = F.expr("regexp_substr(opening, hit[0])")
    start = F.length(F.split(F.col("opening"), F.col("hit")[0], F.lit(2))[0])
    evidence = text.strip(F.substring(F.col("opening"), F.greatest(F.col("start") - 20, F.lit(0)) + 1, F.least(F.col("start"), F.lit(20)) + F.length("matched") + 50))
    rows = rows.withColumn("matched", F.when(F.col("hit").isNotNull(), matched)).withColumn("start", F.when(F.col("hit").isNotNull(), start))
    novel = F.nullif(text.strip(F.regexp_extract(F.substring("opening", 1, NOVEL), NOVEL_TYPE, 1)), F.lit(""))
    none = F.array(F.lit("Other"), F.lit("Standalone"), F.lit("Other"))
    kind = F.coalesce("known", F.slice("hit", 2, 3), none)
    by_code, by_text = F.col("known").isNotNull(), F.col("hit").isNotNull()
    return rows.select(
        key,
        kind[0].alias("instrument_family"),
        kind[1].alias("document_role"),
        kind[2].alias("document_form"),
        F.when(by_code, "high").when(by_text, "medium").otherwise("low").alias("confidence"),
        F.when(by_code, F.concat(F.lit("SEC form code "), "code", F.lit(" in file header"))).when(by_text, F.concat(F.lit("Matched '"), "matched", F.lit("' in opening text"))).otherwise("No known document type pattern matched in opening text").alias("reasoning"),
        F.when(by_code, F.col("code")).when(by_text, F.substring(evidence, 1, 200)).otherwise(F.substring("opening", 1, 200)).alias("evidence_text"),
        F.when(by_code | by_text | novel.isNull(), F.array().cast("array<string>")).otherwise(F.array(text.title_case(novel))).alias("novel_types_observed"),
        F.lit("1.0").alias("schema_version"),
    )


def country_of(docs: DataFrame, key: str = "storage_key", prefix: str = "pdip__", countries: DataFrame | None = None) -> DataFrame:
    """docs with country: by the three letters after the key's prefix; empty if none."""
    known = registry.table_of(docs.sparkSession, registry.COUNTRIES, "code country") if countries is None else countries
    k = F.col(key)
    joined = docs.withColumn("code_", F.when(k.startswith(prefix), F.substring(k, len(prefix) + 1, 3))).join(F.broadcast(known.select(F.col("code").alias("code_"), "country")), "code_", "left")
    return joined.withColumn("country", F.coalesce("country", F.lit(""))).drop("code_")


def label_families(annotations: DataFrame, label: str = "label", known: dict[str, str | None] | None = None) -> DataFrame:
    """annotations with label_family; null for a label without one."""
    own = {k: v for k, v in (registry.labels() if known is None else known).items() if v}
    pairs = annotations.sparkSession.createDataFrame(list(own.items()) or [("", "")], "label_ string, label_family string")
    return annotations.drop("label_family").join(F.broadcast(pairs), F.col(label) == F.col("label_"), "left").drop("label_")


def unmapped_labels(annotations: DataFrame, label: str = "label", known: dict[str, str | None] | None = None) -> DataFrame:
    """Labels that the registry doesn't have."""
    own = annotations.sparkSession.createDataFrame([(k,) for k in (registry.labels() if known is None else known)], "label_ string")
    return annotations.where(F.col(label).isNotNull()).join(F.broadcast(own), F.col(label) == F.col("label_"), "left_anti").select(label).distinct()
