"""Harvests with transports of their own, and writers that leave no half results."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from lexarium.operators import evaluate, provenance, runs
from lexarium.sources import files, harvest, parse, rest, sinks


def test_numbered_pages():
    asked = []

    def fetch(url, params):
        asked.append((params["page"], params["size"]))
        at = params["page"] * params["size"]
        own = list(range(at, min(37, at + params["size"])))
        if 13 in own and len(own) > 1:
            raise OSError("a bad record")
        if own == [13]:
            raise OSError("the bad record")
        return {"rows": [{"n": k} for k in own]}

    assert [x["n"] for x in rest.numbered(fetch, "u", {}, lambda a: a["rows"], size=8)] == [k for k in range(37) if k != 13]
    assert [x["n"] for x in rest.numbered(lambda u, p: {"rows": [{"n": 1}] * (2 if p["p"] == 1 else 1)}, "u", {}, lambda a: a["rows"], size=2, page="p", limit="l", first=1)] == [1, 1, 1]
    assert max(n for _, n in asked) == 8


def test_graphql_in_smaller_pages():
    def post(url, body):
        v = body["variables"]
        if v["size"] > 2:
            return {"errors": ["null field"]}
        return {"data": {"docs": [{"id": k} for k in range(v["from"], min(5, v["from"] + v["size"]))]}}

    fetch = rest.spaced(rest.graphql("query Q {}", post), 0.0)
    assert [x["id"] for x in rest.pages(fetch, "u", {"term": "t"}, lambda a: a["docs"], size=8, smallest=1)] == list(range(5))


def test_retries_of_a_transport(monkeypatch):
    import io
    from urllib.error import HTTPError

    answers = [HTTPError("u", 429, "slow", None, None), HTTPError("u", 503, "down", None, None), io.BytesIO(b'{"ok": 1}')]

    def urlopen(request, timeout):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    monkeypatch.setattr(rest, "urlopen", urlopen)
    assert rest.http("http://x", {"q": 1}, wait=0.0) == {"ok": 1}
    answers.append(HTTPError("u", 404, "gone", None, None))
    with pytest.raises(HTTPError):
        rest.http("http://x", {}, wait=0.0)


def test_harvest(spark, tmp_path):
    def fetch(doc):
        n = int(doc)
        if n == 1:
            return 404, None
        if n == 2:
            raise ValueError("cut")
        if n == 3:
            return 503, None
        if n == 4:
            return 200, {"error": "no"}
        return 200, {"clauses": [] if n == 5 else [{"id": "c"}]}

    inventory = spark.createDataFrame([(k, "Annotated") for k in range(1, 8)] + [(9, "Open")], "doc_id int, tag_status string")
    (tmp_path / "done.jsonl").write_text('{"doc_id": "7", "x": 1}\n\n{"doc_id": "6", "x')
    done = harvest.completed(spark, str(tmp_path / "done.jsonl"))
    assert [r["doc_id"] for r in done.collect()] == ["7"]
    got = {r["doc_id"]: (r["status"], r["attempts_used"]) for r in harvest.harvest(inventory.coalesce(1), fetch, done).collect()}
    assert got == {"1": ("not_found", 1), "2": ("invalid_json", 1), "3": ("failed_http", 3), "4": ("api_error", 1), "5": ("annotated_zero_clauses", 1), "6": ("success", 1), "9": ("success", 1)}
    many = spark.range(20).select(F.lit(3).alias("doc_id"), F.lit("Open").alias("tag_status")).coalesce(1)
    states = [r["status"] for r in harvest.harvest(many, fetch, tries=1, stop=4).collect()]
    assert states == ["failed_http"] * 4 + ["not_attempted"] * 16


def test_require(spark):
    df = spark.createDataFrame([("1", "Bond"), ("2", "Loan")], "id string, kind string")
    assert harvest.require(df, "id", 2, F.col("kind") == "Bond", 1, ["1", "2"]) is df
    for bad in ({"count": 3}, {"where": F.col("kind") == "Bond", "count_where": 2}, {"ids": ["1", "9"]}):
        with pytest.raises(ValueError):
            harvest.require(df, "id", **bad)


def test_download(spark):
    web = {"http://x/a.pdf": b"%PDF-1", "http://x/b.pdf": b"<html>", "http://x/p": b'<a href="/c.PDF">', "http://x/c.PDF": b"%PDF-2", "http://x/q": b"no link"}

    def fetch(url):
        if url not in web:
            raise OSError("404")
        return web[url]

    rows = spark.createDataFrame([("a", "http://x/a.pdf"), ("b", "http://x/b.pdf"), ("p", "http://x/p"), ("q", "http://x/q"), ("z", "http://x/z.pdf"), ("n", None), ("e", "http://x/a.pdf")], "storage_key string, download_url string")
    got = {r["storage_key"]: r for r in harvest.download(rows, fetch, rows.where("storage_key = 'e'")).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"a": "downloaded", "b": "failed_invalid_pdf", "p": "downloaded", "q": "skipped_no_pdf_link", "z": "failed_http", "n": "skipped_no_url", "e": "skipped_exists"}
    assert bytes(got["p"]["content"]) == b"%PDF-2" and got["a"]["file_size_bytes"] == 6 and got["b"]["content"] is None


def test_older_filings(spark):
    body = '{"cik": "9", "name": "N", "filings": {"recent": {"accessionNumber": ["a", "b"], "filingDate": ["2020-01-01"], "form": ["424B5", "10-K"], "primaryDocument": [], "primaryDocDescription": []}, "files": [{"name": "older-1.json"}]}}'
    payload = spark.createDataFrame([(body,)], "v string").select(F.from_json("v", files.FILINGS).alias("p")).select("p.*")
    assert [(r["cik"], r["file"]) for r in files.older_files(payload).collect()] == [("9", "older-1.json")]
    older = spark.createDataFrame([("9", "N", ["a", "c"], ["1999-01-01", "1998-01-01"], ["424B5", "424B5"], [], [])], "cik string, name string, " + files.OLDER)
    got = {r["accession_number"]: r["filing_date"] for r in files.all_filings(payload, older, ["424B5"]).collect()}
    assert got == {"a": "2020-01-01", "c": "1998-01-01"}


def test_outstanding_files(spark):
    found = spark.createDataFrame([("a",), ("b",), ("c",)], "storage_key string")
    one = spark.createDataFrame([("a", 3), ("b", 0), ("c", 1)], "storage_key string, length int")
    two = spark.createDataFrame([("a", 3), ("b", 5)], one.schema)
    assert sorted(r["storage_key"] for r in files.outstanding_files(found, one, two).collect()) == ["b", "c"]


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "old.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, name TEXT)")
        db.executemany("INSERT INTO t VALUES (?, ?)", [(k, f"n{k}") for k in range(3, 103)])
        db.execute("CREATE TABLE empty (id INTEGER)")
    got = harvest.sqlite(spark, path, "t", "id long, name string", 7).collect()
    assert sorted((r["id"], r["name"]) for r in got) == [(k, f"n{k}") for k in range(3, 103)]
    assert harvest.sqlite(spark, path, "empty", "id long").count() == 0


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_once(spark.range(3).toDF("n"), path)
    with pytest.raises(FileExistsError):
        sinks.write_once(spark.range(4).toDF("n"), path)
    sinks.write_once(spark.range(5).toDF("n"), path, overwrite=True)
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("n"))
    with pytest.raises(Exception, match="boom"):
        sinks.write_once(broken, path, overwrite=True)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_telemetry_and_feedback(spark, tmp_path):
    path = str(tmp_path / "telemetry")
    with sinks.timed(spark, path, "r", "parse", "d1") as more:
        more["pages"] = 3
    with pytest.raises(KeyError), sinks.timed(spark, path, "r", "parse", "d2"):
        raise KeyError("x")
    events = {r["document_id"]: r for r in files.telemetry(spark, path).collect()}
    assert events["d1"]["status"] == "success" and events["d1"]["extras"] == {"pages": "3"} and events["d1"]["duration_ms"] >= 0
    assert events["d2"]["status"] == "failed" and events["d2"]["error_message"].startswith("KeyError")
    for v in ("good", "bad"):
        sinks.append_feedback(spark, str(tmp_path / "feedback"), "c1", v)
    assert spark.read.parquet(str(tmp_path / "feedback")).count() == 2


def test_run_manifest(spark, tmp_path):
    folder = str(tmp_path / "run")
    run = runs.create_run(spark, "r1", ["f", "g", "h"])
    sinks.save_run(run, folder)
    made = json.loads((tmp_path / "run/RUN_MANIFEST.json").read_text())
    assert made["families_pending"] == ["f", "g", "h"] and not sinks.is_complete(spark, folder, "f")
    sinks.save_run(runs.advance(runs.advance(run, "f", "complete"), "g", "in_progress"), folder)
    again = json.loads((tmp_path / "run/RUN_MANIFEST.json").read_text())
    assert (again["families_completed"], again["families_in_progress"], again["families_pending"], again["created_at"]) == (["f"], ["g"], ["h"], made["created_at"])
    assert sinks.is_complete(spark, folder, "f") and json.loads((tmp_path / "run/f/COMPLETE.json").read_text())["run_id"] == "r1"
    assert {r["family"]: r["state"] for r in sinks.load_run(spark, folder).collect()} == {"f": "complete", "g": "in_progress", "h": "pending"}


def test_manifest_backfill(spark):
    lines = [
        '{"source": "pdip", "native_id": "1", "title": "a, \\"b\\""}',
        '{"source": "nsm", "native_id": "2", "download_url": "http://x/a.pdf", "source_page_url": null, "source_page_kind": "none"}',
        '{"source": "nsm", "source_page_url": "u", "source_page_kind": "k"}',
        "not json",
        "{}",
    ]
    once = sinks.backfilled(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = [r["value"] for r in once.collect()]
    assert got[2:4] == lines[2:4]
    first, second, last = json.loads(got[0]), json.loads(got[1]), json.loads(got[4])
    assert list(first) == ["source", "native_id", "title", "source_page_url", "source_page_kind"] and first["title"] == 'a, "b"' and first["source_page_url"] == provenance.PDIP_SEARCH
    assert (second["source_page_url"], second["source_page_kind"]) == ("http://x/a.pdf", "artifact_pdf") and last == {"source_page_url": None, "source_page_kind": "none"}
    assert [r["value"] for r in sinks.backfilled(once).collect()][:4] == got[:4]  # a second time changes nothing


def test_manifest_from_inventory(spark):
    loaded = spark.createDataFrame([("7", "pdip__7", "f", "h", None, None, None), ("8", "pdip__8", "g", "i", False, "x", "y")], "native_id string, storage_key string, file_path string, file_hash string, is_sovereign boolean, issuer_type string, scope_status string")
    columns = "id document_title document_date tag_status country instrument_type creditor_country creditor_type entity_type maturity_date".split()
    inventory = spark.createDataFrame([("7", " T ", "March 1, 2020", "Annotated", "Ghana", "Bond", "", "", "", "")], ", ".join(f"{c} string" for c in columns))
    got = {r["native_id"]: r for r in (json.loads(x["value"]) for x in sinks.regenerated(loaded, inventory, "http://x/pdf/%s").collect())}
    assert (got["7"]["title"], got["7"]["publication_date"], got["7"]["is_sovereign"], got["7"]["source_metadata"]["document_date_raw"]) == ("T", "2020-03-01", True, "March 1, 2020")
    assert (got["8"]["title"], got["8"]["is_sovereign"], got["8"]["download_url"], got["8"]["source_metadata"]["country"]) == (None, False, "http://x/pdf/8", "")


def test_parse_headers(spark):
    parse.register("broken2", lambda b: 1 / 0 if b == b"x" else ["p"] * (b == b"y"))
    df = spark.createDataFrame([("f", b"x"), ("g", b"y"), ("h", b"z")], "path string, content binary")
    got = {r["path"]: (r["parse_status"], r["page_count"]) for r in parse.headers(parse.parse(df, "broken2")).collect()}
    assert got == {"f": ("failed", 0), "g": ("ok", 1), "h": ("empty", 0)}


def test_byte_order_mark(spark, tmp_path):
    (tmp_path / "b.csv").write_bytes("﻿id,name\n1,x\n".encode())
    assert files.csv(spark, str(tmp_path / "b.csv"), "id string, name string").first()["id"] == "1"


def test_gates(spark):
    checks = spark.createDataFrame([(False, True, True, 1)] * 19 + [(True, True, True, 0)], "no_header boolean, count_matches boolean, contiguous boolean, empty_pages int")
    assert evaluate.parse_gates(checks, 20).first()["passed"] and not evaluate.parse_gates(checks, 23).first()["passed"]
    assert not evaluate.parse_gates(checks.where("no_header").unionByName(checks.limit(1)), 2).first()["passed"]
    assert evaluate.parse_gates(checks.where("false"), 0).first()["documents"] == 0


@pytest.mark.parametrize("nested", [{"source_page_url": "own", "a": 1}, {"b": {"source_page_kind": None}}, {"text": '"source_page_url": "x", '}])
def test_backfill_leaves_nested_fields(spark, nested):
    line = json.dumps({"source": "nsm", "source_page_kind": None, "source_metadata": nested, "download_url": "http://x/a.pdf", "n": 1.50})
    got = json.loads(sinks.backfilled(spark.createDataFrame([(line,)], "value string")).first()["value"])
    assert list(got) == ["source", "source_metadata", "download_url", "n", "source_page_url", "source_page_kind"]
    assert got["source_metadata"] == nested and got["source_page_url"] == "http://x/a.pdf" and got["n"] == 1.5


def _service(folder, mode):
    """A source over files that say how many items a query has; pages with item 13 fail unless they are small."""
    from lexarium.sources import rest

    def answer(q, start, size):
        n = int((folder / q).read_text())
        if start <= 13 < start + size and size > 2:
            raise OSError("too large")
        return {"hits": {"hits": [{"id": f"{q}{k}"} for k in range(start, min(n, start + size))], "total": {"value": n}}}

    class Own(rest.SearchSource):
        fetch = staticmethod(lambda url, p: answer(p["q"], p["from"] if "from" in p else p["page"] * p["size"], p["size"]))
        post = staticmethod(lambda url, body: {"data": answer(body["variables"]["q"], body["variables"]["from"], body["variables"]["size"])})

        @classmethod
        def name(cls):
            return f"own_{mode}"

    return Own


@pytest.mark.parametrize("mode", ["offset", "page", "graphql"])
def test_paged_source_in_batch_and_stream(spark, tmp_path, mode):
    """All kinds of paging; a stream that is stopped and started again reads each item once, a failing page included."""
    (tmp_path / "a").write_text("23")
    (tmp_path / "b").write_text("0")
    spark.dataSource.register(_service(tmp_path, mode))
    options = {"url": "x", "queries": "a|b", "size": "7", "mode": mode, "document": "query"}
    ids = lambda df: sorted(json.loads(r["item"])["id"] for r in df.collect())
    if mode != "page":
        options["smallest"] = "1"
    batch = spark.read.format(f"own_{mode}").options(**options).load()
    assert ids(batch) == sorted(f"a{k}" for k in range(23))
    for a, b in ((23, 0), (23, 0), (40, 5), (41, 12)):
        (tmp_path / "a").write_text(str(a))
        (tmp_path / "b").write_text(str(b))
        rows = spark.readStream.format(f"own_{mode}").options(**options).load()
        query = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
        assert ids(spark.read.parquet(str(tmp_path / "out"))) == sorted([*(f"a{k}" for k in range(a)), *(f"b{k}" for k in range(b))])


def test_small_files_are_replaced_whole(spark, tmp_path):
    for body in ("one", "two"):
        sinks.write_text(spark, str(tmp_path / "f/x.json"), body)
        assert sinks.read_text(spark, str(tmp_path / "f/x.json")) == body
    assert [p.name for p in (tmp_path / "f").iterdir() if "part" in p.name and not p.name.startswith(".")] == []
