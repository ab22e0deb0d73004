"""Where a document came from: source pages, keys, names of issuers and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public pages of the sources, and the index page of a filing (cik, accession number without and with dashes).
FILING_INDEX = "https://www.sec.gov/Archives/edgar/data/%s/%s/%s-index.htm"
NSM_SEARCH = "https://data.fca.org.uk/search/"
PDIP_SEARCH = "https://publicdebtispublic.mdi.georgetown.edu/search/"


def storage_key(source: Column, native_id: Column) -> Column:
    return F.concat_ws("__", source, native_id)


def metadata_field(metadata: Column, name: str) -> Column:
    """A field of metadata that is a JSON object in a string; null if it isn't."""
    return F.get_json_object(metadata, f"$.{name}")


def source_page(source: Column, download_url: Column, metadata: Column) -> Column:
    """struct<url, kind>: by source; (null, none) for an unknown one or a filing without usable numbers."""
    page = lambda u, k: F.struct(u.cast("string").alias("url"), F.lit(k).alias("kind"))
    nothing = page(F.lit(None), "none")
    cik, accession = F.nullif(metadata_field(metadata, "cik"), F.lit("")), F.nullif(metadata_field(metadata, "accession_number"), F.lit(""))
    number = F.when(F.trim(cik).rlike(r"^[+-]?\d+$"), cik.try_cast("bigint"))
    filing = F.when(number.isNotNull() & accession.isNotNull(), page(F.format_string(FILING_INDEX, number.cast("string"), F.replace(accession, F.lit("-"), F.lit("")), accession), "filing_index")).otherwise(nothing)
    path = F.lower(F.regexp_extract(download_url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1))
    artefact = F.when(path.endswith(".pdf"), page(download_url, "artifact_pdf")).when(path.endswith(".html") | path.endswith(".htm"), page(download_url, "artifact_html")).otherwise(page(F.lit(NSM_SEARCH), "search_page"))
    return F.when(source == "edgar", filing).when(source == "nsm", artefact).when(source == "pdip", page(F.lit(PDIP_SEARCH), "search_page")).otherwise(nothing)


def with_source_page(docs: DataFrame, source: str = "source", download_url: str = "download_url", metadata: str = "source_metadata") -> DataFrame:
    """docs with source_page_url and source_page_kind: kept where both are given, else both derived."""
    have = [c in docs.columns for c in ("source_page_url", "source_page_kind")]
    url, kind = (F.col(c) if h else F.lit(None).cast("string") for c, h in zip(("source_page_url", "source_page_kind"), have, strict=True))
    derived = source_page(F.col(source), F.col(download_url), F.col(metadata))
    pair = F.when(url.isNull() | kind.isNull(), derived).otherwise(F.struct(url.alias("url"), kind.alias("kind")))
    return docs.withColumn("pair_", pair).withColumn("source_page_url", F.col("pair_.url")).withColumn("source_page_kind", F.col("pair_.kind")).drop("pair_")


def valid_lei(c: Column, excluded: str | None = None) -> Column:
    out = c.rlike(r"^[\p{L}\p{N}]{20}$")
    return out & (c != excluded) if excluded else out


def file_kind(path: Column) -> Column:
    """pdf, text, html or unsupported, by extension."""
    ext = F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))
    return F.when(ext == ".pdf", "pdf").when(ext == ".txt", "text").when(ext.isin(".htm", ".html"), "html").otherwise("unsupported")
