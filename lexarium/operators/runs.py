"""Runs: the state of a run's families, telemetry and text reports, prompts and answers of an external extractor."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATES = ("pending", "in_progress", "complete")
RUN = "run_id string, family string, state string, changed_at timestamp"


def create_run(spark: SparkSession, run_id: str, families: list[str]) -> DataFrame:
    """All families pending."""
    return spark.createDataFrame([(run_id, f, "pending", datetime.now(UTC)) for f in families], RUN)


def advance(run: DataFrame, family: str, state: str) -> DataFrame:
    """The family moved on; it may not move back."""
    if state not in STATES:
        raise ValueError(state)
    rank = F.array_position(F.array(*map(F.lit, STATES)), F.col("state"))
    move = (F.col("family") == family) & (rank < STATES.index(state) + 1)
    return run.withColumn("changed_at", F.when(move, F.lit(datetime.now(UTC))).otherwise(F.col("changed_at"))).withColumn("state", F.when(move, state).otherwise(F.col("state")))


def complete(run: DataFrame) -> DataFrame:
    return run.where("state = 'complete'").select("run_id", "family")


def status_lines(counts: DataFrame, name: str, value: str, width: int = 24) -> DataFrame:
    """(line): left-justified names and right-justified counts."""
    return counts.select(F.concat(F.rpad(F.col(name).cast("string"), width, " "), F.lpad(F.format_number(F.col(value), 0), 10, " ")).alias("line"))


def prompt(family: Column, heading: Column, body: Column, examples: list[tuple[str, str]] | None = None) -> Column:
    """array<struct<role, content>>: an extraction request for a candidate, with examples as earlier turns."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))
    system = F.concat(F.lit("Copy from the section the text of the clause of the kind named, word for word. Answer with one JSON object: found (boolean), clause_text, confidence (high, medium or low), reasoning. Kind: "), F.replace(family, F.lit("_"), F.lit(" ")))
    turns = [m for question, answer in examples or [] for m in (message("user", F.lit(question)), message("assistant", F.lit(answer)))]
    return F.array(message("system", system), *turns, message("user", F.concat(F.lit("Section: "), heading, F.lit("\n\n"), body)))


EXTRACTION = "found boolean, clause_text string, confidence string, reasoning string, status string"


def answer(body: Column) -> Column:
    """The extraction in an answer, inside a code fence or not; status parse_error if it has none."""
    inner = F.coalesce(F.nullif(F.regexp_extract(body, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.lit("")), F.nullif(F.regexp_extract(body, r"(?s)(\{.*\})", 1), F.lit("")))
    own = F.from_json(inner, EXTRACTION)
    bad = F.struct(F.lit(False).alias("found"), F.lit(None).cast("string").alias("clause_text"), F.lit("low").alias("confidence"), F.lit(None).cast("string").alias("reasoning"), F.lit("parse_error").alias("status"))
    good = F.struct(own["found"].alias("found"), own["clause_text"].alias("clause_text"), F.coalesce(own["confidence"], F.lit("low")).alias("confidence"), own["reasoning"].alias("reasoning"), F.coalesce(own["status"], F.lit("ok")).alias("status"))
    return F.when(own["found"].isNull(), bad).otherwise(good)


def telemetry_line(run_id: str, step: str, status: str, **extra: object) -> str:
    return json.dumps({"timestamp": datetime.now(UTC).isoformat(), "run_id": run_id, "step": step, "status": status} | extra, ensure_ascii=False, default=str)
