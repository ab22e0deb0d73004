"""Versions of tables, and the index that grows, against full rebuilds."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from lexarium.operators import grep, search, segments
from lexarium.sources import files, sinks, snapshots
from lexarium.streaming import events


def test_versions_are_whole(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/set"
    a, b = spark.range(5).toDF("a"), spark.range(3).toDF("b")
    one = snapshots.publish({"a": a, "b": b, "none": None, "empty": a.where("a < 0")}, root, spark)
    assert one.version == 1 and sorted(one.tables) == ["a", "b"]
    # a run that dies before any of its steps leaves the old set
    for step in ("write_part", "commit"):
        with monkeypatch.context() as m:
            m.setattr(snapshots, step, lambda *x, **y: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError):
                snapshots.publish({"a": a.limit(1), "b": b.limit(1)}, root, spark)
        now = snapshots.latest(spark, root)
        assert now.version == 1 and now.table(spark, "a").count() == 5 and now.table(spark, "b").count() == 3
    write = sinks.write_text
    with monkeypatch.context() as m:  # after the manifest is written beside its place, before the rename
        m.setattr(sinks, "write_text", lambda *x: (write(*x), (_ for _ in ()).throw(RuntimeError("killed"))))
        with pytest.raises(RuntimeError):
            snapshots.publish({"a": a.limit(1)}, root, spark)
    assert snapshots.latest(spark, root).version == 1
    two = snapshots.publish({"a": a.limit(2)}, root, spark)
    assert two.version == 2 and two.table(spark, "a").count() == 2 and two.table(spark, "b").count() == 3
    assert one.table(spark, "a").count() == 5  # readers of the old version aren't disturbed
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, one, {})
    assert sorted(snapshots.views(spark, two, "v_")) == ["v_a", "v_b"] and spark.sql("SELECT count(*) FROM v_a").first()[0] == 2
    gone = snapshots.clean(spark, root, keep=1, hours=0)
    assert len(gone) >= 2 and snapshots.latest(spark, root).table(spark, "b").count() == 3
    with pytest.raises(FileNotFoundError):
        snapshots.at_version(spark, root, 1)


def test_replace_run_in_one_version(spark, tmp_path):
    root = f"file://{tmp_path}/runs"
    rows = lambda *x: spark.createDataFrame(list(x), "run_id string, pattern_name string, source string, v int")
    got = lambda s: sorted(map(tuple, s.table(spark, "m").collect()))
    snapshots.replace_run(rows(("r", "p", "a", 1), ("r", "p", "b", 2), ("r", "q/=", "a", 3)), root, "m", "r", ["p", "q/="])
    snapshots.replace_run(rows(("s", "p", "a", 4)), root, "m", "s", ["p"])
    now = snapshots.replace_run(rows(("r", "p", "a", 9)), root, "m", "r", ["p"])
    assert got(now) == [("r", "p", "a", 9), ("r", "q/=", "a", 3), ("s", "p", "a", 4)]
    now = snapshots.replace_run(rows(), root, "m", "r", ["q/="], "b")
    assert len(got(now)) == 3
    now = snapshots.replace_run(rows(), root, "m", "r", ["q/=", "p"], "a")
    assert got(now) == [("s", "p", "a", 4)]
    for bad in (("t", "p", "a", 1), ("r", "p", None, 1), ("r", "z", "a", 1)):
        with pytest.raises(ValueError):
            snapshots.replace_run(rows(bad), root, "m", "r", ["p"])
    assert got(snapshots.latest(spark, root)) == [("s", "p", "a", 4)]


def _same(spark, snap, live, query, k=10):
    docs = spark.createDataFrame(sorted(live.items()), "key string, text string")
    want = [(r["key"], round(r["score"], 9)) for r in search.scored_pages(docs, query, "key", k=k).collect()]
    found = segments.search(spark, snap, "idx", query, k)
    assert [(r["key"], round(r["score"], 9)) for r in found.rows.collect()] == want
    return found


def test_index_grows_and_shrinks_as_a_rebuild(spark, tmp_path):
    root = f"file://{tmp_path}/idx"
    text = lambda i: " ".join(["notes"] * (i % 7) + ["Trustee's"] * (i % 3 == 0) + ["filler", "bonds"] * (i % 11) + (["rare"] if i == 17 else []))
    frame = lambda d: spark.createDataFrame(sorted(d.items()), "key string, text string")
    live: dict[str, str | None] = {}
    for lot in range(5):
        new = {f"k{i}": text(i) for i in range(lot * 30, lot * 30 + 40)}  # ten keys of each lot come again
        if lot == 2:
            new |= {"k5": None, "k6": "the of", "k70": "notes replaced"}
        segments.add(frame(new), root, "idx", "key")
        live |= new
        out = [f"k{lot * 30 + 3}", "k17" if lot == 3 else "absent"]
        snap = segments.remove(spark.createDataFrame([(x,) for x in out], "key string"), root, "idx", "key")
        live = {key: v for key, v in live.items() if key not in out}
        if lot in (1, 4):
            for q in (["notes"], ["trustee", "rare"], ["bond", "note", "absentee"]):
                _same(spark, snap, live, q)
    assert segments.totals(snap, "idx")[0] == len(live)
    assert not segments.search(spark, snap, "idx", ["rare"]).rows.count()  # its only page is gone
    assert not segments.search(spark, snap, "idx", ["the"]).rows.count()
    assert len(snap.parts("idx.docs")) == 5
    merged = segments.merge(spark, root, "idx", fanout=5)
    assert len(merged.parts("idx.docs")) == 1 and not merged.parts("idx.gone") and len(merged.parts("idx.df")) == 1
    assert merged.parts("idx.docs")[0]["rows"] == len(live)
    assert segments.merge(spark, root, "idx", fanout=5).version == merged.version
    _same(spark, merged, live, ["bonds", "notes"], 7)
    snap = segments.remove(spark.createDataFrame([(x,) for x in live], "key string"), root, "idx", "key")
    assert segments.totals(snap, "idx") == (0, 0) and not segments.search(spark, snap, "idx", ["notes"]).rows.count()


def test_few_blocks_and_files_are_read(spark, tmp_path):
    root = f"file://{tmp_path}/big"
    rows = spark.range(20000).select(F.col("id").cast("string").alias("key"), F.concat(F.expr("repeat('notes ', 1 + int(id % 5))"), F.expr("repeat('other words ', int(id % 400))"), F.concat(F.lit("w"), F.translate(F.conv(F.col("id"), 10, 5), "01234", "vwxyz"))).alias("text"))
    snap = segments.add(rows, root, "idx", "key")
    found = segments.search(spark, snap, "idx", ["notes"], 10)
    want = [(r["key"], round(r["score"], 9)) for r in search.scored_pages(rows, ["notes"], "key").collect()]
    assert [(r["key"], round(r["score"], 9)) for r in found.rows.collect()] == want
    assert found.blocks >= 78 and found.scored <= found.blocks // 4
    scan = segments._of_terms(snap.table(spark, "idx.postings"), ["note"]).select("max_tf")
    scan.collect()
    leaf = scan._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = leaf.metrics().get("numFiles").get().value()
    files = len(list((tmp_path / "big").rglob("idx.postings-*/bucket=*/*.parquet")))
    assert 0 < read <= files // 8


def test_manifest_is_plain(spark, tmp_path):
    root = f"file://{tmp_path}/m"
    snapshots.publish({"a": spark.range(1)}, root, spark)
    body = json.loads(next((tmp_path / "m" / "_log").glob("0*.json")).read_text())
    assert body["version"] == 1 and body["tables"]["a"]["parts"][0]["rows"] == 1


def test_tasks_have_alike_bytes(spark):
    rng = random.Random(5)
    rows = [(f"f{i}", int(rng.paretovariate(1.1) * 1000)) for i in range(3000)]
    rows = [(p, min(n, 400_000)) for p, n in rows] + [("zero", 0), ("tie1", 7), ("tie2", 7)]
    listing = spark.createDataFrame(rows, "path string, length long")
    for group_files in (100_000, 700):
        dealt = files.by_size(listing, 500_000, group_files)
        loads = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum("length").alias("n")).collect()]
        assert dealt.count() == len(rows) and sorted(map(tuple, dealt.select("path", "length").collect())) == sorted(rows)
        assert len(loads) >= sum(n for _, n in rows) // 500_000
        assert max(loads) <= 1.3 * sum(loads) / len(loads)
    assert files.by_size(listing.where("length < 0")).count() == 0


def test_filing_feed(spark, tmp_path):
    t = lambda day, hour=0: dt.datetime(2024, 1, day, hour)
    schema = "native_id string, detected_at timestamp"
    lots = [  # discovered, downloaded
        ([("a", t(1)), ("b", t(1)), ("a", t(1, 5)), (None, t(1))], [("a", t(2)), ("a", t(2, 1))]),
        ([("c", t(12)), ("d", t(12))], [("d", t(12, 3)), ("x", t(12))]),
        ([("old", t(2))], [("d", t(13))]),  # too late
        ([("e", t(28))], [("y", t(28))]),
        ([("f", t(29))], [("y2", t(29))]),
    ]
    listener = events.LateRows()
    spark.streams.addListener(listener)
    try:
        for n, (found, fetched) in enumerate(lots):
            for side, rows in (("found", found), ("fetched", fetched)):
                spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / side))
            read = lambda side: spark.readStream.schema(schema).parquet(str(tmp_path / side))
            feed = events.filings(read("found"), read("fetched"), ["native_id"])
            query = feed.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            assert query.awaitTermination(120), n
    finally:
        spark.streams.removeListener(listener)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=lambda r: r[0])
    assert got == [("a", t(1), t(2)), ("b", t(1), None), ("c", t(12), None), ("d", t(12), t(12, 3))]
    assert sum(listener.dropped.values()) >= 1


def test_default_clause_headers(spark):
    pages = spark.createDataFrame([("d", 1, "Risks. The Trustee."), ("d", 2, "12. Governing Law\nThe Notes. "), ("d", 3, "5.\nNegative Pledge\nNo lien.")], "storage_key string, page int, text string")
    ranges = spark.createDataFrame([("d", c, 1, 1) for c in ("GOVERNING_LAW", "NEGATIVE_PLEDGE", "TRUSTEE_FISCAL_AGENT", "CROSS_DEFAULT", "UNKNOWN")], "storage_key string, clause_type string, first_page int, last_page int")
    got = {r["clause_type"]: (r["page"], r["quote"]) for r in grep.clause_text(pages, ranges).collect()}
    assert set(got) == {"GOVERNING_LAW", "NEGATIVE_PLEDGE", "TRUSTEE_FISCAL_AGENT"}
    assert got["GOVERNING_LAW"][0] == 2 and got["GOVERNING_LAW"][1].startswith("12. Governing Law") and got["NEGATIVE_PLEDGE"][0] == 3
