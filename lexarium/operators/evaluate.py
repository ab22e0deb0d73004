"""Evaluation: precision and recall against annotations, splits, the best extraction of a document, round reports, parse checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

VERIFIED, FAILED, ERRORS = ("verified", "section_located"), ("failed", "needs_review"), ("api_error", "error_skipped")


def rate(a: Column, b: Column) -> Column:
    """a / b to three places; zero if b is."""
    return F.when(b == 0, 0.0).otherwise(F.bround(a / b, 3))


def presence(rows: DataFrame, family: str, key: str) -> DataFrame:
    return rows.select(F.col(family).alias("family"), F.col(key).alias("key")).where("family IS NOT NULL").distinct()


def validation(annotated: DataFrame, found: DataFrame, restrict_to_annotated: bool = False) -> DataFrame:
    """(family, tp, fn, fp, precision, recall, f1) of two distinct (family, key) sets, for the families of both.

    Found keys that nobody annotated count as false positives; with ``restrict_to_annotated`` only keys with any annotation do.
    """
    if restrict_to_annotated:
        found = found.join(annotated.select("key").distinct(), "key", "left_semi")
    both = annotated.withColumn("a", F.lit(1)).join(found.withColumn("b", F.lit(1)), ["family", "key"], "full_outer")
    n = both.groupBy("family").agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("tp"), F.count_if(F.col("b").isNull()).alias("fn"), F.count_if(F.col("a").isNull()).alias("fp"))
    return n.select("family", "tp", "fn", "fp", rate(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), rate(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), rate(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def validation_totals(report: DataFrame) -> DataFrame:
    """The counts of all families together and their rates."""
    n = report.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fn", "fp")))
    return n.select("*", rate(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), rate(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def split_size(n_documents: int) -> int:
    """Calibration documents for so many annotated ones."""
    return 2 if n_documents < 15 else 3 if n_documents < 40 else 5


def split(annotations: DataFrame, family: str, calibration: int = 5, seed: int = 42, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, part): the family's documents, ``calibration`` of them, by a seeded hash, for calibration and the others for evaluation."""
    docs = annotations.where(F.col("label_family") == family).select(doc_id).distinct()
    if (n := docs.count()) < calibration:
        raise ValueError(f"{family}: {n} documents, {calibration} asked for")
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.col(doc_id).cast("string")))
    chosen = docs.orderBy(key, doc_id).limit(calibration).select(doc_id, F.lit("calibration").alias("part"))
    return docs.join(F.broadcast(chosen), doc_id, "left").withColumn("part", F.coalesce("part", F.lit("evaluation")))


def best_per_document(records: DataFrame, key: str = "storage_key", tie: str = "candidate_id") -> DataFrame:
    """The best found extraction of each document, with is_primary and duplicates_count, and all that weren't found.

    Best: verified, then confidence, then a heading match, then the longest text; of equals the least tie.
    """
    found = F.coalesce(F.col("extraction.found"), F.lit(False))
    confidence = F.when(F.col("extraction.confidence") == "high", 2).when(F.col("extraction.confidence") == "medium", 1).otherwise(0)
    order = [F.coalesce(F.col("verification.status").isin(*VERIFIED), F.lit(False)).desc(), confidence.desc(), F.coalesce("heading_match", F.lit(False)).desc(), F.coalesce(F.length("extraction.clause_text"), F.lit(0)).desc(), F.col(tie).asc()]
    w = Window.partitionBy(key)
    ranked = records.where(found).withColumn("rank_", F.row_number().over(w.orderBy(*order))).withColumn("n_", F.count("*").over(w))
    best = ranked.where("rank_ = 1").withColumn("is_primary", F.lit(True)).withColumn("duplicates_count", F.col("n_") - 1).drop("rank_", "n_")
    return best.unionByName(records.where(~found).withColumn("is_primary", F.lit(None).cast("boolean")).withColumn("duplicates_count", F.lit(None).cast("long")))


def histogram(rows: DataFrame, by: list[str], value: Column, name: str) -> DataFrame:
    """For each of ``by`` a map from values to counts."""
    n = rows.groupBy(*by, value.alias("v_")).agg(F.count("*").alias("c_"))
    return n.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("v_", "c_")))).alias(name))


def round_report(records: DataFrame, annotations: DataFrame | None = None, family: str = "clause_family") -> DataFrame:
    """One row a family: counts, pass rate, mixes of sources and confidence; with annotations also recall over verified documents."""
    found, status = F.coalesce(F.col("extraction.found"), F.lit(False)), F.coalesce(F.col("verification.status"), F.lit(""))
    good = found & status.isin(*VERIFIED)
    n = records.groupBy(family).agg(
        F.count("*").alias("total_candidates"),
        F.count_if(found).alias("found_count"),
        F.count_if(~found & ~status.isin(*ERRORS)).alias("not_found_count"),
        F.count_if(status.isin(*ERRORS)).alias("api_error_count"),
        F.count_if(good).alias("verbatim_pass_count"),
        F.count_if(found & status.isin(*FAILED)).alias("verbatim_fail_count"),
        F.count_if(F.coalesce("heading_match", F.lit(False))).alias("heading_match_count"),
    )
    n = n.withColumn("body_only_count", F.col("total_candidates") - F.col("heading_match_count")).withColumn("verbatim_pass_rate", rate(F.col("verbatim_pass_count"), F.col("found_count")))
    n = n.join(histogram(records, [family], F.coalesce("source_format", F.lit("unknown")), "source_mix"), family, "left")
    n = n.join(histogram(records.where(found), [family], F.coalesce("extraction.confidence", F.lit("unknown")), "confidence_distribution"), family, "left")
    if annotations is not None:
        wanted = annotations.select(F.col("label_family").alias(family), F.col("doc_id").cast("string").alias("id_")).where(F.col(family).isNotNull()).distinct()
        key = F.col("storage_key")
        own = records.where(good).select(family, F.when(F.contains(key, F.lit("__")), F.regexp_replace(key, r"(?s)^.*?__", "")).otherwise(key).alias("id_")).distinct().withColumn("hit_", F.lit(1))
        recall = wanted.join(own, [family, "id_"], "left").groupBy(family).agg(F.count("*").alias("annotated_count"), F.count("hit_").alias("matched_count"))
        n = n.join(recall.withColumn("recall", rate(F.col("matched_count"), F.col("annotated_count"))), family, "left")
    return n


def parse_status(pages: DataFrame, key: str = "storage_key", body: str = "text", short: int = 50) -> DataFrame:
    """(key, page_count, total_chars, short_pages, parse_status): empty without text or if all pages are short, partial if most are."""
    from ..functions.text import strip

    size = F.length(strip(F.coalesce(F.col(body), F.lit(""))))
    n = pages.groupBy(key).agg(F.count("*").alias("page_count"), F.sum(size).alias("total_chars"), F.count_if(size < short).alias("short_pages"))
    state = F.when((F.col("total_chars") == 0) | (F.col("short_pages") == F.col("page_count")), "empty").when(F.col("short_pages") * 2 > F.col("page_count"), "partial").otherwise("ok")
    return n.withColumn("parse_status", state)


def parse_checks(headers: DataFrame, pages: DataFrame, key: str = "storage_key", page: str = "page") -> DataFrame:
    """Per document: pages promised and found, whether they run from 0 without gaps, empty pages, a missing header or missing pages."""
    n = pages.groupBy(key).agg(F.count("*").alias("n_pages"), F.array_sort(F.collect_list(page)).alias("order_"), F.count_if(F.coalesce(F.length("text"), F.lit(0)) == 0).alias("empty_pages"))
    n = n.withColumn("contiguous", F.col("order_") == F.transform(F.sequence(F.lit(0), F.col("n_pages") - 1), lambda k: k.cast(pages.schema[page].dataType))).drop("order_")
    both = headers.select(key, F.col("page_count").alias("promised"), "parse_status").join(n, key, "full_outer")
    return both.select(key, "promised", F.coalesce("n_pages", F.lit(0)).alias("n_pages"), (F.col("promised").eqNullSafe(F.coalesce("n_pages", F.lit(0)))).alias("count_matches"), F.coalesce("contiguous", F.lit(False)).alias("contiguous"), F.coalesce("empty_pages", F.lit(0)).alias("empty_pages"), F.col("promised").isNull().alias("no_header"), "parse_status")


def parse_gates(checks: DataFrame, expected: int, most_errors: float = 0.05, least_coverage: float = 0.9) -> DataFrame:
    """One row about parse_checks: documents, those with an error (no header, pages missing, gaps), their share, the share of ``expected`` that is there, and whether both gates pass."""
    bad = F.col("no_header") | ~F.col("count_matches") | ~F.col("contiguous")
    n = checks.agg(F.count("*").alias("documents"), F.count_if(bad).alias("errors"), F.coalesce(F.sum("empty_pages"), F.lit(0)).alias("empty_pages"))
    n = n.withColumn("error_rate", F.when(F.col("documents") > 0, F.col("errors") / F.col("documents")).otherwise(F.lit(0.0))).withColumn("coverage", F.col("documents") / F.lit(max(1, expected)))
    return n.withColumn("passed", (F.col("error_rate") <= most_errors) & (F.col("coverage") >= least_coverage))


def flat_extractions(records: DataFrame) -> DataFrame:
    """Verified candidates as flat rows for export: page numbers from 1 and only where pages are known, Yes and No, lists joined, nothing null but numbers."""
    flat = F.col("source_format") == "flat_jsonl"
    page = lambda k: F.when(flat & F.col(f"page_range.{k}").isNotNull(), (F.col(f"page_range.{k}") + 1).cast("string")).otherwise("")
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    joined = lambda c: F.coalesce(F.array_join(c, ", "), F.lit(""))
    return records.select(
        some("candidate_id").alias("candidate_id"), some("storage_key").alias("storage_key"), some("country").alias("country"), F.coalesce(F.nullif("document_title", F.lit("")), some("storage_key")).alias("document_title"), some("section_heading").alias("section_heading"),
        page("start").alias("page_start"), page("end").alias("page_end"), F.when(F.col("heading_match"), "Yes").otherwise("No").alias("heading_match"), joined("cue_families_hit").alias("cue_families"), some("extraction.confidence").alias("llm_confidence"), some("extraction.reasoning").alias("llm_reasoning"),
        some("extraction.clause_text").alias("clause_text"), F.length(some("extraction.clause_text")).alias("clause_length"), some("section_text").alias("section_text"), some("verification.status").alias("verbatim_status"), F.col("verification.verbatim_similarity").alias("verbatim_similarity"),
        joined("verification.quality_flags").alias("quality_flags"), some("source_format").alias("source_format"), some("run_id").alias("run_id"), some("clause_family").alias("clause_family"),
    )


def display(flat: DataFrame) -> DataFrame:
    """flat_extractions as a table to look at: the ends of keys, the beginnings of titles and texts, how a candidate was found, capitals."""
    capital = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))
    return flat.select(
        "candidate_id", F.right("storage_key", F.lit(40)).alias("document"), F.left("document_title", F.lit(50)).alias("title"), F.left("section_heading", F.lit(80)).alias("section"), F.when(F.col("heading_match") == "Yes", "Heading").otherwise("Body").alias("found_by"),
        capital("llm_confidence").alias("confidence"), capital("verbatim_status").alias("verbatim"),
    )
