"""Queries of the streaming operators, as batches over the events; the tests hold streams against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import events as stream
from .base import query, table


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, CAST(sum(value) AS DOUBLE) AS total FROM events GROUP BY ALL")
def event_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.tumbling(table(spark, sf_dir, "events"), ["event_type"]).drop("window_end")


@query("SELECT w AS window_start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL '1 hour', ts), time_bucket(INTERVAL '1 hour', ts - INTERVAL '30 minutes') + INTERVAL '30 minutes']) AS w FROM events) GROUP BY ALL")
def event_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.tumbling(table(spark, sf_dir, "events"), ["event_type"], slide="30 minutes").select("window_start", "event_type", "n")


@query("""
WITH f AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL '30 minutes' THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM f)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS n FROM s GROUP BY user_id, k
""")
def event_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.sessions(table(spark, sf_dir, "events"), ["user_id"])


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_type", "event_id", (F.col("event_id") % 11 < 6).alias("failed"))


@query("""
WITH e AS (SELECT event_type, event_id, CAST(event_id % 11 < 6 AS INT) AS bad FROM events),
r AS (SELECT *, sum(1 - bad) OVER w AS run, sum(bad) OVER w AS in_all FROM e WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)),
i AS (SELECT *, sum(bad) OVER (PARTITION BY event_type, run ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS in_a_row FROM r),
t AS (SELECT *, sum(CASE WHEN in_a_row >= 8 OR in_all >= 500 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS trips FROM i)
SELECT event_type, event_id, CASE WHEN trips = 1 THEN 'abort' ELSE 'pause' END AS action, CAST(in_a_row AS INT) AS in_a_row, CAST(in_all AS INT) AS in_all
FROM t WHERE trips = 0 AND in_a_row > 0 AND in_a_row % 3 = 0 OR trips = 1 AND (in_a_row >= 8 OR in_all >= 500)
""")
def breaker_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.breaker_rows(outcomes(spark, sf_dir), "event_type", ["event_id"], "failed", total=500)


@query("""
WITH w AS (SELECT event_type, event_id, count(*) OVER x AS seen, sum(CASE WHEN value < 30 THEN 1 ELSE 0 END) OVER x AS zeroes FROM events WINDOW x AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)),
b AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY seen) AS r FROM w WHERE seen <= 50 AND zeroes > 5 OR seen >= 100 AND zeroes / seen > 0.1)
SELECT event_type, event_id, seen, CAST(zeroes AS BIGINT) AS zeroes FROM b WHERE r = 1
""")
def anomaly_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", "event_id", (F.col("value") < 30).alias("zero"))
    return stream.gate(e, "event_type", ["event_id"], "zero")
