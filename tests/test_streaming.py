"""Streams against their batch forms over the events."""

import pytest
from pyspark.sql import functions as F

from lexarium.plans import stream as plans
from lexarium.streaming import events as stream


@pytest.fixture
def source(spark, sf_dir, tmp_path):
    """The events as a stream of four files in order of time."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for k in range(4):
        events.where(F.col("event_id") % 4 == k).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    return events, spark.readStream.schema(events.schema).parquet(str(tmp_path / "in/*"))


def _run(df, name, mode="complete"):
    query = stream.start(df, name, mode)
    query.awaitTermination()
    return sorted(map(str, df.sparkSession.table(name).collect()))


def test_windows(source):
    batch, rows = source
    own = lambda df: stream.tumbling(df, ["event_type"]).withColumn("total", F.round("total", 4))  # noqa: E731  sums differ by their order
    assert _run(own(rows), "tumbling") == sorted(map(str, own(batch).collect()))


def test_sessions(source):
    batch, rows = source
    assert _run(stream.sessions(rows, ["user_id"]), "sessions") == sorted(map(str, stream.sessions(batch, ["user_id"]).collect()))


def test_first_seen(source):
    batch, rows = source
    twice = rows.unionByName(rows)
    assert len(_run(stream.first_seen(twice, ["event_id"], "ts", "400 days"), "seen", "append")) == batch.count()


def test_load_new(source, tmp_path, spark):
    batch, rows = source
    spark.sql("DROP TABLE IF EXISTS loaded_events")
    for _ in range(2):
        stream.load_new(rows.select("event_id", "value"), "loaded_events", ["event_id"], str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.table("loaded_events").count() == batch.count()
    spark.sql("DROP TABLE loaded_events")


def test_breaker(spark, sf_dir, tmp_path):
    batch = plans.outcomes(spark, sf_dir)
    want = sorted(map(str, stream.breaker_rows(batch, "event_type", ["event_id"], "failed", total=40).collect()))
    batch.coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        rows = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
        got = _run(stream.breaker(rows, "event_type", "event_id", "failed", total=40), "breaker", "append")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert got == want and want


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_gate_over_batches_and_a_restart(spark, tmp_path, rocks):
    """A stream in four files, stopped in the middle, finds what the batch gate finds."""
    rows = spark.range(900).selectExpr("concat('k', id % 3) AS k", "id AS at", "id % 3 = 0 AND id > 600 OR id % 3 = 1 AND id % 30 < 3 AS zero")
    want = sorted(map(str, stream.gate(rows, "k", ["at"], "zero").collect()))
    read = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    for half in (0, 1):
        for k in (2 * half, 2 * half + 1):
            rows.where(F.col("at").between(225 * k, 225 * k + 224)).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
        out = stream.gate_stream(read(), "k", "at", "zero").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out"))
        out.awaitTermination()
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).select("k", "at", "seen", "zeroes").collect())) == want and len(want) >= 2


@pytest.mark.parametrize("skip", [False, True])
def test_pauses_end_by_a_timer(spark, tmp_path, rocks, skip):
    """Rows after the failures wait for the timer, through a restart, or are skipped; each is told of once."""
    import time

    rows = spark.createDataFrame([("a", f"{k:02}", k in (1, 2, 5)) for k in range(8)] + [("b", "00", False)], "k string, at string, failed boolean")
    rows.where("at < '04'").coalesce(1).write.parquet(str(tmp_path / "in/0"))
    read = lambda: stream.pauses(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in/*")), "k", "at", "failed", pause=2, hold_seconds=3, skip=skip)
    told = lambda: sorted(tuple(r) for r in spark.read.schema("k string, at string, action string").parquet(str(tmp_path / "out")).collect())

    def run(**trigger):
        return read().writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(**trigger).start(str(tmp_path / "out"))

    def wait(query, n):
        """Until n rows are told, by batches of a second; then the query ends."""
        deadline = time.time() + 40
        while time.time() < deadline and not ((tmp_path / "out/_spark_metadata").exists() and len(told()) >= n):
            time.sleep(0.5)
        query.stop()

    wait(run(processingTime="1 second"), 4 + skip)
    rows.where("at >= '04'").coalesce(1).write.parquet(str(tmp_path / "in/1"))
    time.sleep(5)
    query = run(processingTime="1 second")
    wait(query, 9)
    got = told()
    assert len(got) == 9 and len({(k, at) for k, at, _ in got}) == 9
    assert [x for _, at, x in got if at == "02"] == ["paused"]
