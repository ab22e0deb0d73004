"""Writers that don't leave half a result: atomic replacement, telemetry and feedback, run manifests, manifests of documents."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..operators import provenance, runs


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return bool(fs.exists(at))


def write_once(df: DataFrame, path: str, overwrite: bool = False, fmt: str = "parquet", **options: str) -> None:
    """df at path, all or nothing: written beside it, then renamed. A path that is there is refused unless overwrite is asked for, and stays until the new one is whole."""
    spark = df.sparkSession
    fs, at = _fs(spark, path)
    if fs.exists(at) and not overwrite:
        raise FileExistsError(path)
    part, old = f"{path.rstrip('/')}.part-{uuid.uuid4().hex}", f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    (_, part_at), (_, old_at) = _fs(spark, part), _fs(spark, old)
    try:
        df.write.format(fmt).options(**options).save(part)
        if fs.exists(at) and not fs.rename(at, old_at):
            raise OSError(f"can't move {path}")
        if not fs.rename(part_at, at):
            fs.rename(old_at, at)
            raise OSError(f"can't write {path}")
        fs.delete(old_at, True)
    finally:
        fs.delete(part_at, True)


def write_text(spark: SparkSession, path: str, body: str) -> None:
    """A small file, written beside its place and renamed over it in one step, so that readers see the old one or the new one."""
    fs, at = _fs(spark, path)
    _, part = _fs(spark, f"{path}.part-{uuid.uuid4().hex}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    context = jvm.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    options[0] = jvm.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(part), fs.makeQualified(at), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())  # one small file


# --------------------------------------------------------------------------- telemetry and feedback


def append_lines(spark: SparkSession, lines: list[str], path: str) -> None:
    """Lines as one more file of a folder of text files; readers never see half a file."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


@contextmanager
def timed(spark: SparkSession, path: str, run_id: str, step: str, document_id: str | None = None, **extra: object) -> Iterator[dict]:
    """Appends a telemetry event with the time that the block took; failed, with the error, if it raises. The block may add fields."""
    more: dict = dict(extra)
    began = time.perf_counter()
    status, error = "success", None
    try:
        yield more
    except Exception as e:
        status, error = "failed", f"{type(e).__name__}: {e}"
        raise
    finally:
        own = {"document_id": document_id, "duration_ms": int((time.perf_counter() - began) * 1000), "error_message": error}
        append_lines(spark, [runs.telemetry_line(run_id, step, status, **own, **more)], path)


FEEDBACK = "given_at timestamp, candidate_id string, verdict string, comment string"


def append_feedback(spark: SparkSession, path: str, candidate_id: str, verdict: str, comment: str = "") -> None:
    """One more judgement of a candidate; earlier ones stay."""
    spark.createDataFrame([(datetime.now(UTC), candidate_id, verdict, comment)], FEEDBACK).coalesce(1).write.mode("append").parquet(path)


# --------------------------------------------------------------------------- run manifests


def save_run(run: DataFrame, folder: str) -> None:
    """The state of a run's families as RUN_MANIFEST.json; a family that is complete gets its own COMPLETE.json, once. A run has few families."""
    spark = run.sparkSession
    rows = run.orderBy("family").collect()
    if not rows:
        return
    by = {s: [r["family"] for r in rows if r["state"] == s] for s in runs.STATES}
    now = datetime.now(UTC).isoformat()
    old = json.loads(read_text(spark, f"{folder}/RUN_MANIFEST.json") or "{}")
    body = {"run_id": rows[0]["run_id"], "families_completed": by["complete"], "families_in_progress": by["in_progress"], "families_pending": by["pending"], "created_at": old.get("created_at", now), "updated_at": now}
    write_text(spark, f"{folder}/RUN_MANIFEST.json", json.dumps(body, indent=2) + "\n")
    for family in by["complete"]:
        if not is_complete(spark, folder, family):
            write_text(spark, f"{folder}/{family}/COMPLETE.json", json.dumps({"family": family, "completed_at": now, "run_id": rows[0]["run_id"]}, indent=2) + "\n")


def load_run(spark: SparkSession, folder: str) -> DataFrame:
    """The run that save_run wrote; fields that it doesn't know are left alone."""
    body = json.loads(read_text(spark, f"{folder}/RUN_MANIFEST.json") or "{}")
    names = {"families_completed": "complete", "families_in_progress": "in_progress", "families_pending": "pending"}
    at = datetime.fromisoformat(body["updated_at"]) if body else None
    return spark.createDataFrame([(body["run_id"], f, s, at) for k, s in names.items() for f in body.get(k, [])], runs.RUN)


def is_complete(spark: SparkSession, folder: str, family: str) -> bool:
    return exists(spark, f"{folder}/{family}/COMPLETE.json")


# --------------------------------------------------------------------------- manifests of documents


@F.arrow_udf(T.StringType())
def _with_fields(lines: pa.Array, urls: pa.Array, kinds: pa.Array) -> pa.Array:
    """JSON objects with the two fields after their others, whose order and nesting stay; what is no object is given back."""
    out = []
    for line, url, kind in zip(lines.to_pylist(), urls.to_pylist(), kinds.to_pylist(), strict=True):
        try:
            own = json.loads(line or "")
        except ValueError:
            own = None
        if isinstance(own, dict):
            rest = {k: v for k, v in own.items() if k not in ("source_page_url", "source_page_kind")}
            line = json.dumps(rest | {"source_page_url": url, "source_page_kind": kind}, ensure_ascii=False)
        out.append(line)
    return pa.array(out, pa.string())


def backfilled(lines: DataFrame, line: str = "value") -> DataFrame:
    """Manifest lines with source_page_url and source_page_kind, derived where one of them is missing; other fields stay, in their order,
    fields of these names inside others too. Lines that are no objects stay as they are."""
    field = lambda c: F.get_json_object(line, f"$.{c}")
    rows = lines.select(line, field("source").alias("source"), field("download_url").alias("download_url"), field("source_metadata").alias("source_metadata"), field("source_page_url").alias("source_page_url"), field("source_page_kind").alias("source_page_kind"))
    whole = F.col("source_page_url").isNotNull() & F.col("source_page_kind").isNotNull()
    paired = provenance.with_source_page(rows.withColumn("have_", whole))
    return paired.select(F.when(F.col("have_"), F.col(line)).otherwise(_with_fields(F.col(line), "source_page_url", "source_page_kind")).alias(line))


METADATA = "tag_status country instrument_type creditor_country creditor_type entity_type maturity_date".split()


def regenerated(loaded: DataFrame, inventory: DataFrame, url: str) -> DataFrame:
    """A manifest line (value) for each loaded document (native_id, storage_key, file_path, file_hash, is_sovereign, issuer_type, scope_status), enriched by its inventory row (id, ...); url: the download URL, with %s for the id."""
    inv = inventory.select(F.col("id").alias("native_id"), *(F.col(c).alias(f"inv_{c}") for c in ("document_title", "document_date", *METADATA))).dropDuplicates(["native_id"])
    rows = loaded.where("native_id IS NOT NULL").join(inv, "native_id", "left")
    own = lambda c: F.nullif(text.strip(F.coalesce(F.col(f"inv_{c}"), F.lit(""))), F.lit(""))
    kept = lambda c: F.coalesce(F.col(f"inv_{c}"), F.lit("")).alias(c)
    record = F.struct(
        F.lit("pdip").alias("source"), "native_id", "storage_key", own("document_title").alias("title"), own("country").alias("issuer_name"), own("instrument_type").alias("doc_type"), text.free_date(F.col("inv_document_date")).cast("string").alias("publication_date"),
        F.format_string(url, F.col("native_id")).alias("download_url"), "file_path", "file_hash", F.coalesce("is_sovereign", F.lit(True)).alias("is_sovereign"), F.coalesce("issuer_type", F.lit("sovereign")).alias("issuer_type"), F.coalesce("scope_status", F.lit("in_scope")).alias("scope_status"),
        F.struct(*(kept(c) for c in METADATA), F.coalesce("inv_document_date", F.lit("")).alias("document_date_raw")).alias("source_metadata"),
    )
    return rows.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))
