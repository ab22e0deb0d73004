"""Harvests from services: search criteria, details with retries and a breaker, resume, and downloads that check what they get.

Requests run in tasks, one stream of them a partition, spaced as the service asks. Transports are functions, so tests bring their own.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from urllib.parse import urljoin
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotate, provenance

Details = Callable[[str], tuple[int, dict | None]]
Bytes = Callable[[str], bytes]

PDF = b"%PDF"


# --------------------------------------------------------------------------- criteria


def criteria(leis: DataFrame, names: list[str], column: str = "leis", excluded: str | None = None) -> DataFrame:
    """(label, criteria): a search a name, and one for each usable LEI of a column of lists parted by ";"; criteria is a JSON array."""
    field = lambda a, b, last: F.struct(F.lit("company_lei").alias("name"), F.array(a, b, F.lit("disclose_org"), F.lit(last)).alias("value"))
    whole = lambda c: F.concat(F.lit("["), F.to_json(c), F.lit(', {"name": "latest_flag", "value": "Y"}]'))
    lei = leis.select(F.explode(F.split(F.coalesce(F.col(column), F.lit("")), ";")).alias("v")).select(F.trim("v").alias("v")).where(provenance.valid_lei(F.col("v"), excluded))
    own = lei.select(F.concat(F.lit("lei:"), "v").alias("label"), whole(field(F.lit(""), F.col("v"), "")).alias("criteria"))
    by_name = leis.sparkSession.createDataFrame([(n,) for n in names], "v string").select(F.concat(F.lit("name:"), "v").alias("label"), whole(field(F.col("v"), F.lit(""), "related_org")).alias("criteria"))
    return by_name.unionByName(own)


def safe_id(raw: Column) -> Column:
    """An id that can't leave its folder."""
    return F.replace(F.replace(F.replace(raw, F.lit("/"), F.lit("_")), F.lit(".."), F.lit("_")), F.lit("\\"), F.lit("_"))


def quoted(c: Column) -> Column:
    """Percent-encoded, with nothing but letters, digits and ``_.-~`` left as it is."""
    out = F.url_encode(c)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


# --------------------------------------------------------------------------- details


def completed(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """The keys in files of JSON lines; blank lines and lines cut short are skipped."""
    lines = spark.read.text(path)
    return lines.select(F.get_json_object("value", f"$.{key}").alias(key)).where(F.from_json("value", f"{key} string").isNotNull() & F.col(key).isNotNull() & (F.col(key) != "")).distinct()


HARVEST = "doc_id string, tag_status string, status string, attempts_used int, http_status int, error string, payload string"


def harvest(inventory: DataFrame, fetch: Details, done: DataFrame | None = None, tries: int = 3, wait: float = 0.0, space: float = 0.0, stop: int = 10) -> DataFrame:
    """HARVEST for each (doc_id, tag_status) of inventory that isn't done: the terminal state of its fetch, and the payload as JSON.

    fetch gives a status code and a decoded answer, or raises ValueError for an answer that is no JSON. 429 and 5xx are tried again,
    ``wait`` seconds later and twice as long each time; requests are ``space`` seconds apart. After ``stop`` failures in a row a
    partition's other documents are ``not_attempted``, so that a later run takes them up.
    """

    def one(doc: str) -> tuple[int, int | None, str | None, dict | None]:
        for k in range(tries):
            code, answer, error = None, None, None
            try:
                code, answer = fetch(doc)
                error = "not_found" if code == 404 else f"HTTP {code}" if code >= 400 else None
            except ValueError as e:
                return k + 1, code or 200, f"invalid JSON: {e}", None
            except OSError as e:
                code, error = getattr(e, "code", 503), str(e)
            if error is None or code not in (429, *range(500, 600)):
                return k + 1, code, error, answer
            if k + 1 < tries:
                time.sleep(wait * 2**k)
        return tries, code, error, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bad = 0
        for batch in batches:
            out = []
            for doc, tag in zip(batch["doc_id"], batch["tag_status"], strict=True):
                if bad >= stop:
                    out.append((doc, tag, "not_attempted", 0, None, None, None))
                    continue
                time.sleep(space)
                n, code, error, answer = one(doc)
                bad = bad + 1 if error and error != "not_found" else 0
                out.append((doc, tag, None, n, code, error, None if answer is None else json.dumps(answer, ensure_ascii=False)))
            frame = pd.DataFrame(out, columns=["doc_id", "tag_status", "status", "attempts_used", "http_status", "error", "payload"])
            yield frame.astype({"attempts_used": "int32", "http_status": "Int32"})

    left = inventory.select(F.col("doc_id").cast("string").alias("doc_id"), "tag_status")
    if done is not None:
        left = left.join(done.select("doc_id"), "doc_id", "left_anti")
    rows = left.mapInPandas(run, HARVEST)
    has = F.col("payload").isNotNull()
    n = F.coalesce(F.json_array_length(F.get_json_object("payload", "$.clauses")), F.lit(0))
    state = annotate.fetch_status(F.col("error"), F.col("http_status"), has, F.get_json_object("payload", "$.error").isNotNull(), n, F.col("tag_status"))
    return rows.withColumn("status", F.coalesce("status", state))


def summary(records: DataFrame, selected: int, resumed: int = 0) -> DataFrame:
    """One row about a harvest's records (status, attempts_used, raw_clause_labels, cac_candidate, country, instrument_type): counts by state, tries, country, and country and instrument; labels, and those of no known kind."""
    unknown = lambda c: F.coalesce(c, F.lit("Unknown"))
    own = records.select(F.coalesce("status", F.lit("unknown")).alias("status"), F.coalesce("attempts_used", F.lit(1)).alias("tries"), "raw_clause_labels", F.coalesce("cac_candidate", F.lit(False)).alias("cac"), unknown(F.col("country")).alias("country"), unknown(F.col("instrument_type")).alias("instrument"))
    fine = own.groupBy("status", "tries", "country", "instrument", "cac").agg(F.count("*").alias("n"))  # few rows; all maps come from it
    by = lambda c: fine.groupBy(c).agg(F.sum("n").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(c).cast("string").alias("k"), "n")))).alias("m"))
    nested = fine.groupBy("country", "instrument").agg(F.sum("n").alias("n")).groupBy("country").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("instrument", "n")))).alias("m")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("country", F.to_json("m").alias("j"))))).alias("nested"))
    labels = own.select(F.explode("raw_clause_labels").alias("l")).distinct().agg(F.array_sort(F.collect_list("l")).alias("labels"))
    totals = fine.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.when(F.col("cac"), F.col("n"))), F.lit(0)).alias("cac"))
    parts = totals.join(by("status").withColumnRenamed("m", "status_counts")).join(by("tries").withColumnRenamed("m", "retry_distribution")).join(by("country").withColumnRenamed("m", "counts_by_country")).join(nested).join(labels)
    known = lambda l: l.startswith(annotate.MODIFICATION) | l.startswith(annotate.ACCELERATION)  # noqa: E731, E741
    return parts.select(
        F.lit(selected).cast("long").alias("selected_total"), (F.col("total") - resumed).alias("new_attempted"), F.lit(resumed).cast("long").alias("skipped_via_resume"), F.col("total").alias("terminal_total"), "status_counts", "retry_distribution",
        F.coalesce(F.try_element_at("status_counts", F.lit("annotated_zero_clauses")), F.lit(0)).alias("zero_clause_on_annotated_count"), F.col("labels").alias("distinct_raw_labels"), F.filter("labels", lambda l: ~known(l)).alias("unmapped_labels"),
        F.col("cac").alias("cac_candidate_count"), "counts_by_country", F.col("nested").alias("counts_by_country_instrument"),
    )


def require(rows: DataFrame, key: str, count: int | None = None, where: Column | None = None, count_where: int | None = None, ids: list[str] | None = None) -> DataFrame:
    """rows, if they are as many as expected, as many meet a condition, and all the ids are there; else ValueError."""
    n, m = rows.agg(F.count("*"), F.count_if(where if where is not None else F.lit(True))).first()
    if count is not None and n != count:
        raise ValueError(f"expected {count} rows, got {n}")
    if count_where is not None and m != count_where:
        raise ValueError(f"expected {count_where} rows of the kind, got {m}")
    if ids:
        there = {str(r[key]) for r in rows.where(F.col(key).cast("string").isin(*map(str, ids))).select(key).distinct().collect()}  # no more than ids
        if missing := [i for i in ids if str(i) not in there]:
            raise ValueError(f"not there: {', '.join(map(str, missing))}")
    return rows


# --------------------------------------------------------------------------- downloads


def get_bytes(url: str, agent: str = "lexarium") -> bytes:
    with urlopen(Request(url, headers={"User-Agent": agent}), timeout=120) as r:  # noqa: S310
        return r.read()


DOWNLOAD = "storage_key string, download_url string, status string, url string, file_hash string, file_size_bytes long, content binary"


def download(records: DataFrame, fetch: Bytes = get_bytes, done: DataFrame | None = None, magic: bytes = PDF, space: float = 0.0) -> DataFrame:
    """DOWNLOAD for each (storage_key, download_url): downloaded, skipped_exists, skipped_no_url, skipped_no_pdf_link, failed_invalid_pdf or failed_http.

    A URL that doesn't end in .pdf is a page, whose first link that does is followed. Content that doesn't begin with ``magic`` is
    not kept. The result is a table to write; a key in ``done`` is skipped.
    """
    import hashlib
    import re

    link = re.compile(r"""href=["']([^"']*\.pdf)["']""", re.IGNORECASE)

    def one(url: str | None) -> tuple[str, str | None, bytes | None]:
        if not url:
            return "skipped_no_url", None, None
        at = url
        try:
            time.sleep(space)
            if not url.lower().endswith(".pdf"):
                if not (found := link.search(fetch(url).decode("utf-8", "replace"))):
                    return "skipped_no_pdf_link", None, None
                at = urljoin(url, found[1])
            content = fetch(at)
        except OSError:
            return "failed_http", at, None
        return ("downloaded", at, content) if content.startswith(magic) else ("failed_invalid_pdf", at, None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, url in zip(batch["storage_key"], batch["download_url"], strict=True):  # a row at a time: content may be large
                status, at, content = one(url)
                digest, size = (hashlib.sha256(content).hexdigest(), len(content)) if content is not None else (None, None)
                yield pd.DataFrame([(key, url, status, at, digest, size, content)], columns=["storage_key", "download_url", "status", "url", "file_hash", "file_size_bytes", "content"]).astype({"file_size_bytes": "Int64"})

    own = records.select("storage_key", "download_url")
    if done is None:
        return own.mapInPandas(run, DOWNLOAD)
    have = done.select("storage_key").distinct()
    kept = own.join(have, "storage_key", "left_semi").select("storage_key", "download_url", F.lit("skipped_exists").alias("status"), *(F.lit(None).cast(k).alias(c) for c, k in (("url", "string"), ("file_hash", "string"), ("file_size_bytes", "long"), ("content", "binary"))))
    return own.join(have, "storage_key", "left_anti").mapInPandas(run, DOWNLOAD).unionByName(kept)


# --------------------------------------------------------------------------- SQLite


def sqlite(spark: SparkSession, path: str, table: str, columns: str, slices: int = 8) -> DataFrame:
    """A table of an SQLite file that all executors see, read in ranges of its row numbers; columns: a DDL schema."""
    import sqlite3

    names = [c.split()[0] for c in columns.split(",")]
    select = f"SELECT {', '.join(names)} FROM {table} WHERE rowid > ? AND rowid <= ?"  # noqa: S608
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {table}").fetchone()  # noqa: S608
    if high is None:
        return spark.createDataFrame([], columns)
    step = -(-(high - low + 1) // slices)
    ranges = spark.createDataFrame([(a, a + step) for a in range(low - 1, high, step)], "a long, b long").repartition(slices)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in zip(batch["a"], batch["b"], strict=True):
                with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
                    rows = db.execute(select, (int(a), int(b)))
                    while part := rows.fetchmany(10_000):
                        yield pd.DataFrame(part, columns=names)

    return ranges.mapInPandas(run, columns)
