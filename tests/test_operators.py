"""Operators on inline texts with the vocabulary of the real registries."""

import pytest
from pyspark.sql import functions as F

from lexarium.functions import registry
from lexarium.operators import annotate, classify, evaluate, grep, ingest, locate, provenance, runs, search, sections, verify
from lexarium.sources import files, parse, rest


def test_grep_across_pages(spark):
    pages = spark.createDataFrame([("d", 0, "The Notes rank pari"), ("d", 1, "passu. Governed by the laws of Ghana"), ("e", 0, ""), ("f", 0, None)], "storage_key string, page int, text string")
    got = grep.grep(grep.searchable(pages), run_id="r").orderBy("start").collect()
    assert [(r["pattern_name"], r["page_index"], r["matched_text"]) for r in got] == [("pari_passu", 0, "pari\n\npassu"), ("feature__governing_law", 1, "Governed by the laws of")]
    assert got[0]["context_before"] == "The Notes rank " and got[0]["context_after"].startswith(". Gov")
    assert grep.grep(grep.searchable(pages), patterns=[]).count() == 0


def test_page_ranges(spark):
    hits = spark.createDataFrame([("d", p, "x", n) for p, n in ((1, 1), (2, 1), (4, 1), (9, 2), (10, 1))], "k string, page int, pattern_name string, match_count long")
    r = grep.best_page_range(hits, "k").first()
    assert (r["first_page"], r["last_page"], r["matches"]) == (1, 5, 3)


def test_page_scan_and_metadata(spark):
    pages = spark.createDataFrame([("d", 1, "Events of Default and the Trustee, trustee. ISIN XS0029456067; English law"), ("d", 2, None)], "k string, page int, text string")
    hits = {r["pattern_name"]: (r["match_count"], r["samples"]) for r in grep.page_hits(pages, registry.page_patterns(), "k").collect()}
    assert hits == {"EVENTS_OF_DEFAULT": (1, ["Events of Default"]), "TRUSTEE_FISCAL_AGENT": (2, ["Trustee", "trustee"])}
    m = grep.metadata(pages.where("page = 1"), "k").first()
    assert (m["isin"], m["governing_law"], m["listing_exchange"]) == (["XS0029456067"], ["English law"], [])


def test_browse_and_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a Debt", 3), (2, "debt", 9), (3, "x", 1)], "id int, t string, n int")
    assert [r["id"] for r in search.browse(rows, "DEBT", "t", order="n", n=[3, 9], id=None).collect()] == [2, 1]
    (tmp_path / "a.pdf").write_bytes(b"123")
    (tmp_path / "b.pdf").write_bytes(b"1")
    found = files.binaries(spark, str(tmp_path), "*.pdf", spark.createDataFrame([("a",)], "storage_key string"))
    assert [(r["storage_key"], r["length"]) for r in files.by_size(found).collect()] == [("b", 1)]


def test_sections_of_headings():
    got = sections.sections_of("# T\n\nlead\n\n## A\nx\n\n### B\ny\n\n## C\nz")
    assert [(s["heading"], s["text"][:6]) for s in got] == [("A", "lead\n\n"), ("C", "## C\nz")]
    assert sections.sections_of("DEFINITIONS AND TERMS\nbody here")[0]["heading"] == "DEFINITIONS AND TERMS"
    assert sections.sections_of(None) == sections.sections_of(" \n ") == []
    assert [s["heading"] for s in sections.sections_of("# A\nx\n# B\ny")] == ["A", "B"]


def test_large_sections():
    long = "\n\n".join(["w" * 90] * 10)
    parts = sections.split_large(long, 400)
    assert [len(p) for p in parts] == [366, 366, 182] and "\n\n".join(parts) == long
    assert all(len(p) <= 300 for p in sections.split_large("ab " * 500, 300)) and sections.split_large("short", 300) == ["short"]
    assert sections.split_large("head\n\n" + "x" * 300, 250)[0].startswith("head\n\nx")


def _sections(spark, *rows):
    return spark.createDataFrame([(f"k__s{i}", "k", h, 1, t, (i, i), "flat_jsonl", len(t), i) for i, (h, t) in enumerate(rows)], "section_id string, storage_key string, heading string, heading_level int, text string, page_range struct<start:int,end:int>, source_format string, char_count int, section_index int")


def test_locate(spark):
    s = _sections(
        spark,
        ("Status of the Notes", "nothing"),
        ("x", "The notes rank equally, unsecured and unsubordinated."),
        ("x", "pari passu only"),
        ("x", "see \"X\" as set forth in the summary of provisions ..... pari passu, unsecured and unsubordinated"),
        ("Governing law", "This is governed by the laws of Ghana."),
    )
    got = {(r["clause_family"], r["section_index"]): r for r in locate.locate(s, ["pari_passu", "governing_law", "unknown"]).collect()}
    assert set(got) == {("pari_passu", 0), ("pari_passu", 1), ("governing_law", 4)}
    assert got["pari_passu", 0]["heading_match"] and got["pari_passu", 0]["cue_families_hit"] == ["heading"]
    assert got["pari_passu", 1]["cue_families_hit"] == ["obligation", "ranking"]
    assert locate.locate(s, ["unknown"]).count() == 0
    once, twice = (sorted(r["candidate_id"] for r in locate.locate(s, run_id="a").collect()) for _ in range(2))
    assert once == twice


def test_cluster(spark):
    s = _sections(spark, *[("Pari passu", "x" * 40)] * 3, ("y", "none"), ("Pari passu", "x" * 40))
    got = locate.cluster(locate.locate(s, ["pari_passu"]), most=80).orderBy("section_index").collect()
    assert [(r["section_index"], r["n_sections"], r["page_range"]["end"]) for r in got] == [(0, 2, 1), (2, 1, 2), (4, 1, 4)]
    assert got[0]["section_text"] == "x" * 40 + "\n\n" + "x" * 40
    assert locate.drop_stubs(locate.cluster(locate.locate(s, ["pari_passu"]), most=80)).count() == 0


def test_verify(spark):
    source = "The Issuer  shall pay all additional\namounts without deduction. " * 3
    rows = [
        (1, "pari_passu", "shall pay all additional amounts", source, True, "ok"),
        (2, "pari_passu", "shall pay all additionel amounts without deductian and more words follow here", source, True, "ok"),
        (3, "pari_passu", "", source, True, "ok"),
        (4, "pari_passu", None, source, False, "ok"),
        (5, "pari_passu", "x", source, True, "api_error"),
        (6, "trustee_duties", source.replace("pay", "psy", 1), source, True, "ok"),
        (7, "collective_action", "nothing of it", source, True, "ok"),
    ]
    df = spark.createDataFrame(rows, "id int, clause_family string, clause_text string, section_text string, found boolean, status string")
    got = {r["id"]: r["verification"] for r in verify.verify(df).collect()}
    assert [got[k]["status"] for k in range(1, 8)] == ["verified", "failed", "failed", "not_found", "error_skipped", "section_located", "failed"]
    assert got[1]["verbatim_similarity"] == 1.0 and got[3]["verbatim_similarity"] == 0.0 and 0.85 <= got[6]["verbatim_similarity"] < 1
    assert "verification_failed" in got[2]["quality_flags"] and "partial_extraction" in got[7]["quality_flags"]
    assert "truncation_suspect" in got[1]["quality_flags"] and got[4]["quality_flags"] is None
    assert verify.window_similarity("abcdef", "xxabcdxfyy") > 0.7 and verify.window_similarity("abc", "xyz") == 0.0


def test_classify_label_country(spark):
    keys = spark.createDataFrame([("pdip__GHA12",), ("pdip__zzz",), ("nsm__GHA1",)], "storage_key string")
    assert [r["country"] for r in classify.country_of(keys).orderBy("storage_key").collect()] == ["", "Ghana", ""]
    labels = spark.createDataFrame([("GoverningLaw_Enforcement",), ("InternalReference",), ("New",), (None,)], "label string")
    assert {r["label"]: r["label_family"] for r in classify.label_families(labels).collect()} == {"GoverningLaw_Enforcement": "governing_law", "InternalReference": None, "New": None, None: None}
    assert [r["label"] for r in classify.unmapped_labels(labels).collect()] == ["New"]


def test_validation(spark):
    a = spark.createDataFrame([("f", "1"), ("f", "2"), ("g", "1")], "family string, key string")
    b = spark.createDataFrame([("f", "1"), ("f", "9"), ("h", "1")], "family string, key string")
    got = {r["family"]: tuple(r)[1:] for r in evaluate.validation(a, b).collect()}
    assert got == {"f": (1, 1, 1, 0.5, 0.5, 0.5), "g": (0, 1, 0, 0.0, 0.0, 0.0), "h": (0, 0, 1, 0.0, 0.0, 0.0)}
    assert {r["family"]: r["fp"] for r in evaluate.validation(a, b, True).collect()} == {"f": 0, "g": 0, "h": 1}


def test_split(spark):
    notes = spark.createDataFrame([("f", d) for d in range(10)] * 2, "label_family string, doc_id int")
    one, two = (sorted((r["doc_id"], r["part"]) for r in evaluate.split(notes, "f", 3).collect()) for _ in range(2))
    assert one == two and sum(p == "calibration" for _, p in one) == 3 and len(one) == 10
    with pytest.raises(ValueError):
        evaluate.split(notes, "f", 11)
    assert [evaluate.split_size(n) for n in (14, 15, 39, 40)] == [2, 3, 3, 5]


def test_provenance(spark):
    rows = [("edgar", None, '{"cik": "0000914021", "accession_number": "0001193125-20-188103"}'), ("edgar", None, '{"cik": "x", "accession_number": "1"}'), ("nsm", "https://a/b.HTML?x=1", None), ("nsm", None, None), ("pdip", "u", "bad json"), ("luxse", "u", None), (None, None, None)]
    got = [(r["p"]["url"], r["p"]["kind"]) for r in spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, s string, d string, m string").select("k", provenance.source_page(F.col("s"), F.col("d"), F.col("m")).alias("p")).orderBy("k").collect()]
    assert got == [("https://www.sec.gov/Archives/edgar/data/914021/000119312520188103/0001193125-20-188103-index.htm", "filing_index"), (None, "none"), ("https://a/b.HTML?x=1", "artifact_html"), (provenance.NSM_SEARCH, "search_page"), (provenance.PDIP_SEARCH, "search_page"), (None, "none"), (None, "none")]


def test_append_once_and_replace(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    spark.sql("DROP TABLE IF EXISTS append_once")
    assert ingest.append_new(rows, "append_once", ["k"]) == 2 and ingest.append_new(rows, "append_once", ["k"]) == 0
    assert ingest.append_new(rows.unionByName(spark.createDataFrame([("c", 4)], rows.schema)), "append_once", ["k"]) == 1
    spark.sql("DROP TABLE append_once")
    pages = spark.createDataFrame([("d", 1), ("d", 2), ("e", 1)], "doc string, page int")
    spark.sql("DROP TABLE IF EXISTS append_pages")
    assert ingest.append_new(pages.where("doc = 'd' AND page = 1"), "append_pages", ["doc", "page"], ["doc"]) == 1
    assert ingest.append_new(pages, "append_pages", ["doc", "page"], ["doc"]) == 1  # d has a page, so all of d is left out
    spark.sql("DROP TABLE append_pages")
    path = str(tmp_path / "runs")
    rows = lambda *own: spark.createDataFrame(list(own), "run_id string, pattern_name string, source string, v int")
    there = lambda: sorted(tuple(r[c] for c in ("run_id", "pattern_name", "source", "v")) for r in spark.read.parquet(path).collect())
    ingest.replace_run(rows(("r1", "p", "s", 1), ("r1", "p", "t", 2), ("r1", "q/x", "s", 3)), path, "r1", ["p", "q/x"])
    ingest.replace_run(rows(("r2", "p", "s", 9)), path, "r2", ["p"])
    ingest.replace_run(rows(("r1", "p", "s", 4)), path, "r1", ["p"], "s")  # other sources stay
    assert there() == [("r1", "p", "s", 4), ("r1", "p", "t", 2), ("r1", "q/x", "s", 3), ("r2", "p", "s", 9)]
    ingest.replace_run(rows(("r1", "p", "t", 5)), path, "r1", ["p", "q/x"])  # what matches nothing any more goes
    assert there() == [("r1", "p", "t", 5), ("r2", "p", "s", 9)]
    with pytest.raises(ValueError, match="outside the run"):
        ingest.replace_run(rows(("r3", "p", "t", 5)), path, "r1", ["p"])


def test_schema_script(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lex_test")
    spark.sql("USE lex_test")
    try:
        assert ingest.run_ddl(spark, ingest.SCHEMA) == ingest.run_ddl(spark, ingest.SCHEMA) == 7
        assert spark.table("documents").schema["publication_date"].dataType.simpleString() == "date"
        done = ingest.publish({"pages_copy": spark.createDataFrame([(1,)], "a int"), "none": spark.createDataFrame([], "a int"), "gone": None}, "lex_test")
        assert done == {"pages_copy": 1}
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE lex_test CASCADE")


def test_countries_and_failures(spark):
    docs = spark.createDataFrame([("k", [("GHA", "Ghana", None), ("GHA", "Ghana", None), (None, "x", None), ("FRA", "France", "guarantor")])], "storage_key string, countries array<struct<country_code:string,country_name:string,role:string>>")
    assert {(r["country_code"], r["role"]) for r in ingest.countries(docs).collect()} == {("GHA", "issuer"), ("FRA", "guarantor")}
    t = spark.createDataFrame([("r", "s", "success", 1), ("r", "s", None, 2), ("r", "s", "boom", 3), ("q", "s", "boom", 4)], "run_id string, step string, status string, n int")
    assert sorted(r["n"] for r in ingest.failures(t, "r", "s").collect()) == [2, 3]


def test_files(spark, tmp_path):
    (tmp_path / "d1.jsonl").write_text('{"storage_key": "d1", "page_count": 2, "parse_status": "ok"}\n{"page": 0, "text": "a", "char_count": 1}\nbroken\n{"page": 1, "text": "b", "char_count": 1}\n')
    headers, pages = files.parsed_pages(spark, str(tmp_path / "*.jsonl"))
    assert headers.first()["page_count"] == 2 and sorted((r["storage_key"], r["page"]) for r in pages.collect()) == [("d1", 0), ("d1", 1)]
    (tmp_path / "m.md").write_text("# x\n")
    (tmp_path / "n.md").write_text(" \n")
    assert [r["storage_key"] for r in files.markdown(spark, str(tmp_path / "*.md")).collect()] == ["m"]
    (tmp_path / "t.log").write_text('{"run_id": "r", "step": "s", "status": "ok", "extra": 5}\n\n')
    assert files.telemetry(spark, str(tmp_path / "t.log")).first()["extras"] == {"extra": "5"}
    (tmp_path / "p.json").write_text('{"document_title": "T", "metadata": {"DebtorCountry": ["G"]},\n "clauses": []}')
    assert files.payloads(spark, str(tmp_path / "p.json")).first()["doc_id"] == "p"
    (tmp_path / "c.csv").write_text("id,name\n1,\"a, b\"\n")
    assert files.csv(spark, str(tmp_path / "c.csv"), "id string, name string").first()["name"] == "a, b"
    files.export_csv(spark.createDataFrame([(1, ["a", "b"])], "n int, l array<string>"), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).first()["l"] == "a; b"


def test_parsers(spark):
    assert parse.html_pages("<p>a<br>b<div style='page-break-after:always'>c</div>d<style>x</style>") == ["a\nb\nc", "d"]
    assert parse.text_pages("x<PAGE>y<PAGE>") == ["x", "y"]
    assert parse.text_pages("<PAGE>") == []
    assert parse.decode(b"\x93x\x94") == "“x”" and parse.decode(b"\x81") == "\x81"
    assert parse.filing_pages("<DOCUMENT><TEXT>\n<PAGE>a<PAGE>b</TEXT>") == ["a", "b"]
    parse.register("broken", lambda b: 1 / 0)
    df = spark.createDataFrame([("f", b"x")], "path string, content binary")
    assert "ZeroDivisionError" in parse.parse(df, "broken").first()["error"]


def test_paged_search(spark):
    def fetch(url, params):
        if params["size"] > 20:
            raise OSError("too large")
        return {"hits": {"hits": [{"n": k} for k in range(params["from"], min(45, params["from"] + params["size"]))]}}

    assert [x["n"] for x in rest.pages(fetch, "u", {}, lambda a: a["hits"]["hits"], size=40)] == list(range(45))

    class Local(rest.SearchSource):
        fetch = staticmethod(lambda url, params: {"hits": {"hits": [{"q": params["q"]}] if params["from"] == 0 else []}})

    spark.dataSource.register(Local)
    got = spark.read.format("paged_search").option("url", "u").option("queries", "a|b").load().collect()
    assert sorted(r["query"] for r in got) == ["a", "b"]


def test_search(spark):
    docs = spark.createDataFrame([(1, "debt debt restructuring"), (2, "debt of the state"), (3, "nothing"), (4, None)], "id int, text string")
    got = search.scored_pages(docs, ["Debt", "restructuring"], "id").collect()
    assert [r["id"] for r in got] == [1, 2] and got[0]["score"] > got[1]["score"] > 0
    assert search.scored_pages(docs, ["absent"], "id").count() == 0
    assert docs.select(search.highlight(F.lit("a < b  c"), "b c").alias("h")).first()["h"] == "a &lt; <mark>b  c</mark>"


def test_search_terms(spark):
    pairs = dict(caresses="caress", ponies="poni", agreed="agre", motoring="motor", conflated="conflat", hopping="hop", filing="file", happy="happi", relational="relat", digitizer="digit", hopefulness="hope", triplicate="triplic", replacement="replac", adoption="adopt", controll="control", actions="action", governing="govern", sky="sky")
    assert {w: search.stem(w) for w in pairs} == pairs
    docs = spark.createDataFrame([(1, "Collective ACTION clauses, 2 of them"), (2, "Préstamos y garantías del año 2020"), (3, "the and of")], "id int, text string")
    got = {r["id"]: r["t"] for r in docs.select("id", search.terms(F.col("text")).alias("t")).collect()}
    assert got == {1: ["collect", "action", "claus"], 2: ["prestamo", "y", "garantia", "del", "ano"], 3: []}
    assert search.query_terms(["The", "Préstamos", "clause"]) == ["claus", "prestamo"]


def test_stored_index(spark):
    docs = spark.createDataFrame([("a_0", "collective action clauses are important"), ("a_1", "governing law of this prospectus"), ("b_0", "a clause on actions")], "page_key string, text string")
    search.write_index(docs, "page_key", "idx_test")
    try:
        index, total = search.read_index(spark, "idx_test")
        hits = search.search(index, total, search.query_terms(["collective", "action"]), "page_key")
        assert [r["page_key"] for r in hits.collect()] == ["a_0", "b_0"]
        assert hits.collect() == search.scored_pages(docs, ["collective", "action"], "page_key").collect()
        pages = docs.select("page_key", F.substring("page_key", 1, 1).alias("doc"))
        whole = spark.createDataFrame([("a", "T"), ("b", "U"), ("c", "V")], "doc string, title string")
        assert {(r["title"], r["page_key"]) for r in search.hits_with_documents(hits, pages, whole, "page_key", "doc").collect()} == {("T", "a_0"), ("U", "b_0")}
    finally:
        spark.sql("DROP TABLE idx_test_postings")
        spark.sql("DROP TABLE idx_test_totals")


def test_clause_text(spark):
    body = "Rights. " + "A sentence of some length stands here. " * 80
    pages = [(1, "Contents\n12. Governing Law 7"), (2, "Intro page."), (3, "line a\nline b\n12.\nGoverning Law\nThe Notes are governed. "), (4, body), (5, "p5. "), (6, "p6. "), (7, "p7. "), (8, "p8. ")]
    df = spark.createDataFrame([("d", *p) for p in pages] + [("e", 1, "none"), ("f", 2, "y"), ("f", 1, "see 12. Governing Law")], "storage_key string, page int, text string")
    headers = {"law": r"12\.\s+Governing Law"}
    ranges = spark.createDataFrame([("d", "law", 2, 2), ("e", "law", 1, 1), ("f", "law", 2, 2)], "storage_key string, clause_type string, first_page int, last_page int")
    got = {r["storage_key"]: r for r in grep.clause_text(df, ranges, headers).collect()}
    assert set(got) == {"d", "f"} and got["f"]["page"] == 1 and got["f"]["quote"] == "12. Governing Law\ny" and got["f"]["range_end"] == 2
    d = got["d"]
    assert (d["page"], d["range_start"], d["range_end"], d["context_before"]) == (3, 2, 7, "line a\nline b")
    assert d["quote"].startswith("12.\nGoverning Law\nThe Notes are governed. \nRights. A sentence") and d["quote"].endswith("stands here.") and len(d["quote"]) < 3000 and d["context_after"].split("\n")[-1] == "p7."
    only = ranges.where("storage_key = 'd'").withColumn("first_page", F.lit(1)).withColumn("last_page", F.lit(1))
    assert grep.clause_text(df, only, headers).first()["page"] == 1
    broken = spark.createDataFrame([("g", 1, "x\n20.\nGoverning Law y")], df.schema)
    assert grep.clause_text(broken, spark.createDataFrame([("g", "law", 1, 1)], ranges.schema), {"law": r"20\. Governing Law"}).first()["quote"] == "20.\nGoverning Law y"


def test_matches_with_control_characters(spark):
    df = spark.createDataFrame([(1, "x of\x01the y"), (2, "\x01of the\x02of\tthe"), (3, "of the"), (4, None), (5, ""), (6, "a of the " * 3000)], "doc_id int, text string")
    got = grep.grep(df, [{"name": "n", "pattern": r"of\s+the"}], "doc_id", starts=None, context=3).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["start"], r["matched_text"]))
    assert by.pop(6) == [(9 * k + 2, "of the") for k in range(3000)]
    assert by == {2: [(1, "of the"), (8, "of\tthe")], 3: [(0, "of the")]}


def test_pages_of_offsets(spark):
    from lexarium.functions import text as fn

    sizes = [k % 7 for k in range(1000)]
    starts = [sum(s + 2 for s in sizes[:k]) for k in range(1000)]
    df = spark.createDataFrame([(["x" * s for s in sizes],)], "pages array<string>").withColumn("starts", fn.page_starts(F.col("pages")))
    assert df.first()["starts"] == starts
    offsets = [0, 1, starts[63], starts[64] - 1, starts[64], starts[999], starts[999] + 9]
    got = df.select(F.explode(F.array(*map(F.lit, offsets))).alias("o"), "starts").select(fn.page_of(F.col("o"), F.col("starts")).alias("p")).collect()
    assert [r["p"] for r in got] == [max(k for k in range(1000) if starts[k] <= o) for o in offsets]


def test_headings_in_capitals():
    body = "# x\nTITLE LINE HERE\ntext\n\nOTHER HEADING LINE\n# next\n\nLAST HEADING LINE\n"
    assert [(at, n, h) for at, n, h in sections.headings(body)] == [(0, 1, "x"), (body.index("# next"), 1, "next")]
    body = "para\n\nFIRST HEADING\nbody\n\nSECOND (HEADING)\nmore"
    assert [h for _, _, h in sections.headings(body)] == ["FIRST HEADING", "SECOND (HEADING)"]


def test_cuts_are_greedy():
    import random

    r = random.Random(2)
    for _ in range(200):
        sizes = [r.randint(1, 30) for _ in range(r.randint(0, 40))]
        want, room, at = [], 35, 0
        while at < len(sizes):
            stop, total = at + 1, sizes[at]
            while stop < len(sizes) and total + sizes[stop] <= room:
                total += sizes[stop]
                stop += 1
            want.append((at, stop))
            at, room = stop, 40
        assert sections.cuts(sizes, 40, 35) == want


def test_contained(spark):
    docs = spark.createDataFrame([(1, "start of  a longer\ntext with many words in it and an end"), (2, "nothing"), (3, None), (4, "xx of a longer text with many words in itself")], "doc_id int, text string")
    items = spark.createDataFrame([("a", "of a longer text with many words in it"), ("b", "thing"), ("c", " "), ("d", "of a longer text with many words in at"), ("e", "longer text")], "item_id string, item string")
    for most in (1 << 20, 10):
        got = verify.contained(items, docs, "item_id", "item", "doc_id", "text", most_bytes=most)
        assert {tuple(r) for r in got.collect()} == {("a", 1), ("a", 4), ("b", 2), ("e", 1), ("e", 4)} and got.count() == 5


def test_fuzzy_verification(spark, sf_dir):
    """The registered near misses against difflib itself."""
    from difflib import SequenceMatcher

    from lexarium.plans import QUERIES
    from lexarium.plans.domain import near_misses

    source = {(r["conv_id"], r["turn"]): r for r in near_misses(spark, sf_dir).collect()}
    seen = set()
    for r in QUERIES["verification_fuzzy"](spark, sf_dir).collect():
        x = source[r["conv_id"], r["turn"]]
        a, b = " ".join((x["clause_text"] or "").split()), " ".join(x["section_text"].split())
        whole = x["clause_family"] == "events_of_default"
        if not a or a in b:
            ratio = float(bool(a))
        elif whole:
            ratio = SequenceMatcher(None, a, b).ratio()
        else:
            m = SequenceMatcher(None, a, b).find_longest_match(0, len(a), 0, len(b))
            at = max(0, m.b - m.a)
            ratio = SequenceMatcher(None, a, b[at : at + len(a) + len(a) // 20]).ratio() if m.size else 0.0
        assert abs(r["similarity"] - ratio) <= 0.0006, x
        passes = ratio >= (0.85 if whole else 0.95)
        assert r["status"] == (("section_located" if passes else "needs_review") if whole else ("verified" if passes else "failed"))
        assert ("verification_failed" in r["flags"]) == (not passes) and 0 <= r["components_present"] <= r["components_total"]
        seen.add((r["status"], 0 < ratio < 1))
    assert {s for s, between in seen if between} >= {"failed", "verified"} or {s for s, between in seen if between} >= {"failed"}


def test_runs(spark):
    run = runs.advance(runs.advance(runs.create_run(spark, "r", ["f", "g"]), "f", "complete"), "f", "in_progress")
    assert {r["family"]: r["state"] for r in run.collect()} == {"f": "complete", "g": "pending"}
    assert [r["family"] for r in runs.complete(run).collect()] == ["f"]


def test_annotation_stats(spark):
    raw = spark.createDataFrame([("d", [{"id": "c"}]), ("e", [])], "doc_id string, clauses array<struct<id:string>>")
    payloads = raw.select("doc_id", F.lit("t").alias("document_title"), F.create_map().cast("map<string,array<string>>").alias("metadata"), F.from_json(F.to_json(F.struct("clauses")), annotate.PAYLOAD)["clauses"].alias("clauses"))
    flat = classify.label_families(annotate.flatten(payloads))
    assert tuple(annotate.stats(flat, payloads).first()) == (2, 1, 1, 0, 0)
    assert registry.cues_of("nope") is None
