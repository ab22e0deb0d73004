"""Loading: manifests to documents and countries, append of what is new, replacement of what a run covers.

Spark tables have no keys; uniqueness comes from anti-joins on append, and idempotence from overwriting exactly the partitions a run
writes.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import provenance, search

KNOWN = (
    "source native_id storage_key title issuer_name lei doc_type publication_date submitted_date download_url file_path file_hash page_count parse_tool parse_version "
    "is_sovereign issuer_type scope_status source_page_url source_page_kind countries source_metadata"
).split()
TYPES = {"publication_date": "date", "submitted_date": "timestamp", "page_count": "int", "is_sovereign": "boolean", "countries": "array<struct<country_code:string,country_name:string,role:string>>"}


def documents(lines: DataFrame, line: str = "value") -> DataFrame:
    """Manifest lines (one JSON object each) as typed documents; unknown fields go to source_metadata, where given ones win.

    Blank lines are skipped; lines that aren't objects, or have no key, are left to ``malformed``.
    """
    raw = F.try_parse_json(F.col(line))
    fields = F.from_json(F.col(line), "map<string,string>")
    rows = lines.where(F.trim(F.col(line)) != "").where(raw.isNotNull()).select(F.col(line).alias("line_"), fields.alias("m"))
    rows = rows.where(F.col("m").isNotNull())
    typed = [F.from_json("line_", f"{c} {TYPES[c]}")[c].alias(c) if c == "countries" else F.try_element_at("m", F.lit(c)).try_cast(TYPES.get(c, "string")).alias(c) for c in KNOWN if c not in ("source_metadata", "storage_key")]
    key = F.coalesce(F.try_element_at("m", F.lit("storage_key")), provenance.storage_key(F.try_element_at("m", F.lit("source")), F.try_element_at("m", F.lit("native_id"))))
    rest = F.map_filter("m", lambda k, _: ~k.isin(*KNOWN))
    given = F.try_element_at("m", F.lit("source_metadata"))
    own = F.from_json(given, "map<string,string>")
    # a string that isn't JSON stays as it is
    merged = F.when(given.isNotNull() & own.isNull(), given).when((F.size(rest) > 0) | (F.size(F.coalesce(own, F.create_map().cast("map<string,string>"))) > 0), F.to_json(F.map_concat(F.map_filter(rest, lambda k, _: ~F.array_contains(F.map_keys(F.coalesce(own, F.create_map().cast("map<string,string>"))), k)), F.coalesce(own, F.create_map().cast("map<string,string>")))))
    return provenance.with_source_page(rows.select(key.alias("storage_key"), *typed, merged.alias("source_metadata")).where("storage_key IS NOT NULL"))


def malformed(lines: DataFrame, line: str = "value") -> DataFrame:
    """The lines that aren't blank and aren't JSON objects."""
    return lines.where((F.trim(F.col(line)) != "") & F.from_json(F.col(line), "map<string,string>").isNull())


def document_id(key: Column) -> Column:
    """A stable surrogate."""
    return F.xxhash64(key)


def backfill(docs: DataFrame, headers: DataFrame, columns: tuple[str, ...] = ("page_count", "parse_tool", "parse_version"), key: str = "storage_key") -> DataFrame:
    """docs with the headers' values where their own are null."""
    own = headers.select(key, *(F.col(c).alias(f"{c}_h") for c in columns)).dropDuplicates([key])
    return docs.join(own, key, "left").select(*(F.coalesce(c, f"{c}_h").alias(c) if c in columns else F.col(c) for c in docs.columns))


def countries(docs: DataFrame) -> DataFrame:
    """(document_id, country_code, country_name, role), each once; rows without a code are skipped; role: issuer if none is given."""
    rows = docs.select(document_id(F.col("storage_key")).alias("document_id"), F.explode("countries").alias("c")).where("c.country_code IS NOT NULL AND c.country_code != ''")
    return rows.select("document_id", "c.country_code", "c.country_name", F.coalesce("c.role", F.lit("issuer")).alias("role")).dropDuplicates(["document_id", "country_code", "role"])


def first_of(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("rank_", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("rank_ = 1").drop("rank_")


def last_of(rows: DataFrame, key: list[str], order: str, value: list[str]) -> DataFrame:
    """For each key the values of the row last in order."""
    return rows.groupBy(*key).agg(F.max_by(F.struct(*value), F.col(order)).alias("last_")).select(*key, "last_.*")


def new_rows(rows: DataFrame, existing: DataFrame, key: list[str], skip: list[str] | None = None) -> DataFrame:
    """The rows whose key isn't there yet, each key once. skip: a part of the key; what has any row there is left out whole."""
    own = skip or key
    return rows.dropDuplicates(key).join(existing.select(*own).distinct(), own, "left_anti")


def append_new(rows: DataFrame, table: str, key: list[str], skip: list[str] | None = None) -> int:
    """Appends the rows with new keys to a table, creating it; returns how many. For pages key is document and page, skip the document."""
    spark = rows.sparkSession
    fresh = new_rows(rows, spark.table(table), key, skip) if spark.catalog.tableExists(table) else rows.dropDuplicates(key)
    fresh = fresh.persist()
    try:
        n = fresh.count()
        if n or not spark.catalog.tableExists(table):
            fresh.write.mode("append").saveAsTable(table)
        return n
    finally:
        fresh.unpersist()


def replace_run(rows: DataFrame, path: str, run_id: str, patterns: list[str], source: str | None = None) -> None:
    """In a table partitioned by run_id, pattern_name and source, puts the rows in place of what this run had of these patterns.

    A pattern that matches nothing any more keeps no old rows; with ``source`` only that source's rows are replaced. Rows of other
    runs, patterns and sources stay. Rows that aren't of this run, patterns and source are refused.
    """
    spark = rows.sparkSession
    parts = ["run_id", "pattern_name", "source"]
    own = (F.col("run_id") == run_id) & F.col("pattern_name").isin(*patterns) & (F.col("source") == source if source is not None else F.lit(True))
    made = rows.groupBy(*parts, F.coalesce(own, F.lit(False)).alias("own")).count().collect()  # a row a pattern and source
    if other := [r for r in made if not r["own"]]:
        raise ValueError(f"rows outside the run: {other[0]}")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    kept = {(r["pattern_name"], r["source"]) for r in made}
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return
    name = lambda s: s.getPath().getName().split("=", 1)[1]
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    children = lambda p: [s for s in fs.listStatus(p) if "=" in s.getPath().getName()]
    for run in (s for s in children(root) if unescape(name(s)) == run_id):
        for pattern in (s for s in children(run.getPath()) if unescape(name(s)) in patterns):
            for at in children(pattern.getPath()):
                key = (unescape(name(pattern)), unescape(name(at)))
                if key not in kept and (source is None or key[1] == source):
                    fs.delete(at.getPath(), True)


def resolved(rows: DataFrame, docs: DataFrame, key: str = "storage_key", value: str = "document_id") -> tuple[DataFrame, DataFrame]:
    """(rows with the documents' ids, rows without a document): misses are kept and can be counted, not dropped in silence."""
    known = docs.select(key, value).dropDuplicates([key])
    return rows.join(known, key), rows.join(known.select(key), key, "left_anti")


def upsert(rows: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """existing with rows in place of those of the same key, and the new ones."""
    return existing.join(rows.select(*key).distinct(), key, "left_anti").unionByName(rows.dropDuplicates(key), allowMissingColumns=True)


def publish(tables: dict[str, DataFrame], database: str) -> dict[str, int]:
    """Writes each table that has rows to a database; returns their counts. A plan runs once: it is kept on disk while it is counted and written."""
    done = {}
    for name, df in tables.items():
        if df is None:
            continue
        df = df.persist(StorageLevel.DISK_ONLY)
        try:
            if n := df.count():
                df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
                done[name] = n
        finally:
            df.unpersist()
    return done


def publish_with_index(tables: dict[str, DataFrame], database: str, pages: str = "document_pages", key: tuple[str, ...] = ("document_id", "page_number"), body: str = "page_text") -> dict[str, int]:
    """Publishes tables and, if the pages are among them, builds their search index anew: tables ``search_postings`` and ``search_totals``."""
    done = publish(tables, database)
    if pages in done:
        spark = next(df for df in tables.values() if df is not None).sparkSession
        own = spark.table(f"{database}.{pages}").select(F.concat_ws("_", *key).alias("page_key"), body)
        search.write_index(own, "page_key", f"{database}.search", body)
    return done


def outstanding(discovered: DataFrame, loaded: DataFrame, key: list[str]) -> DataFrame:
    return discovered.join(loaded.select(*key), key, "left_anti")


def failures(telemetry: DataFrame, run_id: str, step: str) -> DataFrame:
    """The events of a run's step that ended in a failure; a null status counts as one."""
    fine = F.coalesce("status", F.lit("")).isin("success", "success_after_429", "rate_limited", "not_found")
    return telemetry.where((F.col("run_id") == run_id) & (F.col("step") == step) & ~fine)


def run_ddl(spark: SparkSession, script: str) -> int:
    """Runs a script's statements one by one; returns how many."""
    statements = [s.strip() for s in "\n".join(line.split("--")[0] for line in script.splitlines()).split(";")]
    for s in filter(None, statements):
        spark.sql(s)
    return sum(map(bool, statements))


SCHEMA = """
CREATE TABLE IF NOT EXISTS documents (document_id BIGINT, source STRING, native_id STRING, storage_key STRING, title STRING, issuer_name STRING, lei STRING, doc_type STRING, publication_date DATE, submitted_date TIMESTAMP, download_url STRING, file_path STRING, file_hash STRING, page_count INT, parse_tool STRING, parse_version STRING, is_sovereign BOOLEAN, issuer_type STRING, scope_status STRING, source_page_url STRING, source_page_kind STRING, source_metadata STRING) USING parquet PARTITIONED BY (source);
CREATE TABLE IF NOT EXISTS document_countries (document_id BIGINT, country_code STRING, country_name STRING, role STRING) USING parquet;
CREATE TABLE IF NOT EXISTS document_pages (document_id BIGINT, page_number INT, page_text STRING, char_count INT) USING parquet;
CREATE TABLE IF NOT EXISTS document_markdown (document_id BIGINT, markdown_text STRING) USING parquet;
CREATE TABLE IF NOT EXISTS clauses (doc_id STRING, clause_id STRING, label STRING, label_family STRING, page_index INT, text STRING, text_status STRING, bbox STRUCT<x: DOUBLE, y: DOUBLE, width: DOUBLE, height: DOUBLE>, original_dims STRUCT<width: INT, height: INT>, country STRING, instrument_type STRING, governing_law STRING, currency STRING, document_title STRING) USING parquet;
CREATE TABLE IF NOT EXISTS source_events (source STRING, native_id STRING, event_type STRING, detected_at TIMESTAMP, details STRING) USING parquet;
CREATE TABLE IF NOT EXISTS pipeline_runs (run_id STRING, step STRING, status STRING, started_at TIMESTAMP, finished_at TIMESTAMP, n_records BIGINT, error STRING) USING parquet;
"""
