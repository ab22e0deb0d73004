"""Readers of manifests, parsed pages, markdown, CSV files, payloads and telemetry; writers of flat exports.

Schemas are stated, never inferred. Paths go to Spark's readers as they are, so any store that Spark reads will do.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotate

HEADER = "storage_key string, page_count int, parse_tool string, parse_version string, parse_status string, parsed_at timestamp"
PAGE = "page int, text string, char_count int"
TELEMETRY = "timestamp timestamp, run_id string, document_id string, step string, duration_ms long, status string, error_message string"
FILINGS = "cik string, name string, filings struct<recent struct<accessionNumber:array<string>,filingDate:array<string>,form:array<string>,primaryDocument:array<string>,primaryDocDescription:array<string>>,files:array<struct<name:string>>>"
OLDER = "accessionNumber array<string>, filingDate array<string>, form array<string>, primaryDocument array<string>, primaryDocDescription array<string>"
HITS = "hits struct<total:struct<value:int>,hits:array<struct<_id:string,_source:struct<submitted_date:string,publication_date:string,company:string,lei:string,type:string,type_code:string,headline:string,download_link:string,disclosure_id:string,latest_flag:string,seq_id:string,hist_seq:string>>>>"


def stem(path: Column) -> Column:
    """The file name without its extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file): the lines of text files."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def parsed_pages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(headers, pages) of parsed files: lines with a page number are pages, the others headers; bad lines are neither.

    Pages carry the key of their file's name.
    """
    own = lines(spark, path).withColumn("key_", stem(F.col("file"))).withColumn("p", F.from_json("value", PAGE)).withColumn("h", F.from_json("value", HEADER))
    headers = own.where("p.page IS NULL AND h.storage_key IS NOT NULL").select("h.*")
    return headers, own.where("p.page IS NOT NULL").select(F.col("key_").alias("storage_key"), "p.*")


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """(storage_key, text) of whole files; blank ones are skipped."""
    whole = spark.read.text(path, wholetext=True).select(stem(F.col("_metadata.file_path")).alias("storage_key"), F.col("value").alias("text"))
    return whole.where(F.length(F.regexp_replace("text", r"(?U)\s+", "")) > 0)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header, all of whose columns must be as stated; a byte order mark is no part of it."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, multiLine=True, escape='"')


def all_strings(df: DataFrame) -> DataFrame:
    """Every column a string, nulls empty."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns))


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """One annotation payload a file; the file's name is the document."""
    return spark.read.schema(annotate.PAYLOAD).json(path, multiLine=True).withColumn("doc_id", stem(F.col("_metadata.file_path")))


def telemetry(spark: SparkSession, path: str) -> DataFrame:
    """Events with their fixed fields, and all others in extras: map<string,string>."""
    names = [c.split()[0] for c in TELEMETRY.split(", ")]
    raw = spark.read.text(path).where(F.trim("value") != "")
    rest = F.map_filter(F.from_json("value", "map<string,string>"), lambda k, _: ~k.isin(*names))
    return raw.select(F.from_json("value", TELEMETRY).alias("t"), rest.alias("extras")).where("t IS NOT NULL").select("t.*", "extras")


def filings(payload: DataFrame, forms: list[str] | None = None) -> DataFrame:
    """One row a filing, from parallel arrays that may differ in length; the longest sets the number, what is missing is null."""
    r = "filings.recent."
    rows = payload.select("cik", "name", F.explode(F.arrays_zip(*(F.col(r + c).alias(c) for c in ("accessionNumber", "filingDate", "form", "primaryDocument", "primaryDocDescription")))).alias("f"))
    rows = rows.select("cik", "name", F.col("f.accessionNumber").alias("accession_number"), F.col("f.filingDate").alias("filing_date"), F.col("f.form").alias("form"), F.col("f.primaryDocument").alias("primary_document"), F.col("f.primaryDocDescription").alias("description"))
    return rows.where(F.col("form").isin(*forms)) if forms else rows


def older_files(payload: DataFrame) -> DataFrame:
    """(cik, name, file): the further files of a company's filings."""
    return payload.select("cik", "name", F.explode("filings.files").alias("f")).select("cik", "name", F.col("f.name").alias("file"))


def all_filings(payload: DataFrame, older: DataFrame, forms: list[str] | None = None) -> DataFrame:
    """The filings of payloads and of their older files (cik, name, and the arrays of OLDER), each accession number once, the newer payload's first."""
    wrapped = older.select("cik", "name", F.struct(F.struct(*(F.col(c.split()[0]) for c in OLDER.split(", "))).alias("recent"), F.array().cast("array<struct<name:string>>").alias("files")).alias("filings"))
    both = filings(payload, forms).withColumn("rank_", F.lit(0)).unionByName(filings(wrapped, forms).withColumn("rank_", F.lit(1)))
    rest = [c for c in both.columns if c not in ("cik", "accession_number", "rank_")]
    return both.groupBy("cik", "accession_number").agg(F.min(F.struct("rank_", *rest)).alias("f")).select("cik", "accession_number", *(F.col(f"f.{c}") for c in rest))


def search_hits(payload: DataFrame, source: str = "nsm") -> DataFrame:
    """Documents of a search answer, one row a hit, with what has no column of its own as metadata."""
    rows = payload.select(F.explode("hits.hits").alias("h")).select("h._id", "h._source.*")
    return rows.select(
        F.lit(source).alias("source"),
        F.coalesce("disclosure_id", "_id").alias("native_id"),
        F.concat_ws("__", F.lit(source), F.coalesce("disclosure_id", "_id")).alias("storage_key"),
        F.col("headline").alias("title"),
        F.col("company").alias("issuer_name"),
        "lei",
        F.col("type").alias("doc_type"),
        F.col("publication_date").try_cast("date").alias("publication_date"),
        F.col("submitted_date").try_cast("timestamp").alias("submitted_date"),
        F.col("download_link").alias("download_url"),
        F.to_json(F.struct("type_code", "latest_flag", "seq_id", "hist_seq")).alias("source_metadata"),
    )


def promoted(results: DataFrame, fields: dict[str, str], metadata: str = "metadata") -> DataFrame:
    """Search results whose metadata (map<string,array<string>>) gives columns: the first value of each field; the rest stays a map."""
    own = [F.try_element_at(F.try_element_at(F.col(metadata), F.lit(k)), F.lit(1)).alias(c) for k, c in fields.items()]
    return results.select(*(c for c in results.columns if c != metadata), *own, F.map_filter(metadata, lambda k, _: ~k.isin(*fields)).alias("other_metadata"))


def pdf_link(html: Column) -> Column:
    """The first link of a page that ends in .pdf."""
    return F.nullif(F.regexp_extract(html, r"""(?i)href\s*=\s*["']?([^"'\s>]+\.pdf)(?=["'\s>?#])""", 1), F.lit(""))


def binaries(spark: SparkSession, path: str, pattern: str = "*", done: DataFrame | None = None) -> DataFrame:
    """(path, storage_key, length, content) of files by a name pattern, without those whose key is in ``done``; content is read only if used."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    own = found.select("path", stem(F.col("path")).alias("storage_key"), "length", "content")
    return own if done is None else own.join(done.select("storage_key"), "storage_key", "left_anti").select(*own.columns)


def outstanding_files(found: DataFrame, *outputs: DataFrame) -> DataFrame:
    """The files whose key has not every output (storage_key, length) with something in it."""
    for out in outputs:
        found = found.join(out.where("length > 0").select("storage_key").distinct().withColumn("have_", F.lit(1)), "storage_key", "left").withColumn("missing_", F.col("have_").isNull() | (F.col("missing_") if "missing_" in found.columns else F.lit(False))).drop("have_")
    return found.where("missing_").drop("missing_") if outputs else found


def _dealt(key: tuple, files: pd.DataFrame, task_bytes: int) -> pd.DataFrame:
    """Longest first, each file to the task that has least so far; files of one length by path."""
    own = files.sort_values(["length", "path"], ascending=[False, True], ignore_index=True)
    least = [(0, t) for t in range(max(1, -(-int(own["length"].sum()) // task_bytes)))]
    tasks = []
    for length in own["length"].tolist():
        load, t = heapq.heappop(least)
        tasks.append(t)
        heapq.heappush(least, (load + max(length, 1), t))
    return pd.DataFrame({"path": own["path"], "group": key[0], "task": tasks})


def by_size(files: DataFrame, task_bytes: int = 64 << 20, group_files: int = 100_000) -> DataFrame:
    """Files (path, length, ...) dealt to tasks of about so many bytes, longest first, so that no task has much over the mean unless one file has.

    A listing of any size is dealt in groups by the hash of the path, of about ``group_files`` files or 1024 tasks, whichever is less;
    each group has as many tasks as its bytes ask for. Deal paths and lengths, and read contents afterwards. Paths are distinct,
    as those of a listing are; lengths aren't null.
    """
    total, n = files.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    groups = max(1, -(-total // (task_bytes << 10)), -(-n // group_files))
    own = files.select("path", "length", F.pmod(F.xxhash64("path"), F.lit(groups)).cast("int").alias("group"))
    tasks = own.groupBy("group").applyInPandas(lambda key, rows: _dealt(key, rows, task_bytes), "path string, group int, task int")
    sizes = {r["group"]: r["n"] for r in own.groupBy("group").agg(F.greatest(F.lit(1), F.ceil(F.sum("length") / task_bytes)).alias("n")).collect()}  # a row a group
    first, starts = 0, []
    for g in range(groups):
        starts.append((g, first))
        first += int(sizes.get(g, 0))
    offsets = files.sparkSession.createDataFrame(starts, "group int, first_ int")
    numbered = tasks.join(F.broadcast(offsets), "group").select("path", (F.col("first_") + F.col("task")).alias("task_"))
    return files.join(numbered, "path").repartitionById(max(1, first), F.col("task_")).drop("task_")


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header; arrays are joined by "; ", other nested columns are JSON. For reports, whose rows are few."""
    flat = [F.array_join(c, "; ").alias(c) if k == "array<string>" else F.to_json(c).alias(c) if k.startswith(("array", "map", "struct")) else F.col(c) for c, k in df.dtypes]
    df.select(*flat).coalesce(1).write.mode("overwrite").csv(path, header=True)


def export_jsonl(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").partitionBy(*partitions).json(path) if partitions else df.write.mode("overwrite").json(path)
