"""Expert annotations: flattening of payloads, label summaries, fetch states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

# What the labels of the two voting clauses begin with.
MODIFICATION, ACCELERATION = "VotingCollectiveActionModification", "VotingRequirementforAcceleration"

PAYLOAD = (
    "document_title string, source_url string, metadata map<string,array<string>>, clauses array<struct<id:string,item_index:int,original_width:int,original_height:int,"
    "value:struct<x:double,y:double,width:double,height:double,rotation:double,text:array<string>,rectanglelabels:array<string>>>>"
)


def flatten(payloads: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row a clause: text and its status (present, empty, missing), first label, place on the page, document metadata."""
    rows = payloads.select(doc_id, "document_title", "metadata", F.explode("clauses").alias("c"))
    joined = text.strip(F.array_join("c.value.text", "\n"))
    first = lambda k: F.try_element_at(F.try_element_at("metadata", F.lit(k)), F.lit(1))
    return rows.select(
        doc_id,
        F.col("c.id").alias("clause_id"),
        F.try_element_at("c.value.rectanglelabels", F.lit(1)).alias("label"),
        F.col("c.item_index").alias("page_index"),
        F.nullif(joined, F.lit("")).alias("text"),
        F.when(F.col("c.value.text").isNull(), "missing").when(joined == "", "empty").otherwise("present").alias("text_status"),
        F.struct("c.value.x", "c.value.y", "c.value.width", "c.value.height").alias("bbox"),
        F.struct(F.col("c.original_width").alias("width"), F.col("c.original_height").alias("height")).alias("original_dims"),
        first("DebtorCountry").alias("country"),
        first("InstrumentType").alias("instrument_type"),
        first("GoverningLaw").alias("governing_law"),
        first("CurrencyDenomination").alias("currency"),
        "document_title",
    )


def label_summary(payloads: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, clause_count, raw_clause_labels, cac_modification_labels, cac_acceleration_labels, cac_candidate)."""
    clauses = F.col("clauses")
    raw = F.filter(F.flatten(F.transform(clauses, lambda c: F.coalesce(c["value"]["rectanglelabels"], F.array().cast("array<string>")))), lambda x: F.coalesce(x != "", F.lit(False)))
    raw = F.coalesce(raw, F.array().cast("array<string>"))
    rows = payloads.select(doc_id, F.greatest(F.size("clauses"), F.lit(0)).alias("clause_count"), raw.alias("raw_clause_labels"))
    rows = rows.withColumn("cac_modification_labels", F.filter("raw_clause_labels", lambda x: x.startswith(MODIFICATION))).withColumn("cac_acceleration_labels", F.filter("raw_clause_labels", lambda x: x.startswith(ACCELERATION)))
    return rows.withColumn("cac_candidate", F.size("cac_modification_labels") > 0)


def fetch_status(error: Column, http_status: Column, has_payload: Column, has_error_key: Column, n_clauses: Column, tag_status: Column) -> Column:
    """The terminal state of a fetch."""
    return (
        F.when(error == "not_found", "not_found")
        .when(F.contains(error, F.lit("invalid JSON")), "invalid_json")
        .when(error.isNotNull() & ((http_status >= 500) | (http_status == 429)), "failed_http")
        .when(error.isNotNull() | ~has_payload, "failed_request")
        .when(has_error_key, "api_error")
        .when((F.coalesce(n_clauses, F.lit(0)) == 0) & (tag_status == "Annotated"), "annotated_zero_clauses")
        .otherwise("success")
    )


def stats(flat: DataFrame, payloads: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row: documents, documents without clauses, clauses, clauses with text, distinct labels without a family."""
    docs = payloads.agg(F.count("*").alias("documents"), F.count_if(F.coalesce(F.size("clauses"), F.lit(0)) <= 0).alias("zero_clause_documents"))
    own = flat.agg(F.count("*").alias("clauses"), F.count_if(F.col("text_status") == "present").alias("with_text"), F.count_distinct(F.when(F.col("label_family").isNull(), F.col("label"))).alias("unmapped_labels"))
    return docs.join(own)  # one row each
