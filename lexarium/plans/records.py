"""Queries of records and registries: what the other operators read is built from the tables, and the default registries run whole.

The SQL of the registries' queries is made from the registries' own patterns, which DuckDB matches with its own engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import registry, text
from ..operators import annotate, classify, evaluate, grep, ingest, locate, runs, sections, verify
from ..sources import files, harvest, parse
from .base import query, table


def chosen(options: list[str], k: Column) -> Column:
    """The option of number k modulo their number."""
    return F.element_at(F.array(*map(F.lit, options)), (F.pmod(k, F.lit(len(options))) + 1).cast("int"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(options: list[str]) -> str:
    return "[" + ", ".join(map(_quoted, options)) + "]"


# --------------------------------------------------------------------------- the default registries over planted texts

#: Sentences and headings of the kinds that the registries look for, and some that only look like it.
SENTENCES = [
    "The Notes are governed by and construed in accordance with English law, and any dispute is subject to the jurisdiction of the courts of England.",
    "The Bonds rank pari passu and rank equally in right of payment, without any preference among themselves, as direct, unconditional and unsecured and unsubordinated obligations.",
    "A modification of the terms needs the consent of the holders of not less than 75% of the aggregate principal amount, or an extraordinary resolution; aggregation provisions and a single series modification apply to each reserved matter, with a quorum.",
    "See \"Collective Action Clauses\" as set forth in the prospectus; refer to the section described under \"Ranking\".",
    "The Issuer irrevocably waives sovereign immunity and submits to the jurisdiction of the courts; it will not create any lien to secure public external indebtedness unless the Notes are secured equally and ratably.",
    "Each of the following is an event of default: failure to pay principal, a cross default, a moratorium, or acceleration of other indebtedness beyond a threshold of US$25,000,000.",
    "All payments will be made without withholding or deduction for any taxes; additional amounts will be paid. The trustee may be indemnified and must act on instructions of holders.",
    "ISIN XS0123456789 is listed on the London Stock Exchange; the fiscal agent is Citibank, N.A., London Branch, under New York law.",
    "Nothing of this kind is said here.",
]
HEADINGS = ["Governing Law and Jurisdiction", "Status of the Notes", "Collective Action", "Negative Pledge", "Events of Default", "Taxation", "Some other matter", "Meetings of Noteholders", "Ranking"]
OPENINGS = [
    "FORM OF TRUST DEED dated", "424B5\nprospectus supplement", "\n  ANNUAL ECONOMIC STATEMENT of", "IMPORTANT NOTICE\n" + "x" * 11000 + " final terms", "Contrato de préstamo", "LOAN AGREEMENT between", "This INDENTURE is made", "Fiscal Agency Agreement",
    "Offering Memorandum", "Pricing   Supplement", "base prospectus", "guarantee agreement", "amendment no. 2", "Rule 424(b)(3)\n", "18-K/A\nannual report", "",
]


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents, each with a sentence after its text and a heading."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.concat("text", F.lit("\n"), chosen(SENTENCES, F.col("doc_id"))).alias("text"), chosen(HEADINGS, F.expr("doc_id div 3")).alias("heading"))


_PLANTED = f"p AS (SELECT doc_id, text || chr(10) || {_list(SENTENCES)}[doc_id % {len(SENTENCES)} + 1] AS text, {_list(HEADINGS)}[doc_id // 3 % {len(HEADINGS)} + 1] AS heading FROM documents)"


def _values(rows: list[tuple[str, ...]]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(_quoted, r)) + ")" for r in rows) + ")"


_PATTERNS = _values([(p["name"], f"(?i){p['pattern']}") for p in registry.patterns()])


@query(f"""
WITH {_PLANTED}, c AS (SELECT doc_id, name, text, string_split_regex(text, re) AS gaps, regexp_extract_all(text, re) AS found FROM p, {_PATTERNS} t(name, re))
SELECT doc_id, name AS pattern_name, CAST(length(array_to_string(gaps[1:k], '')) + length(array_to_string(found[1:k - 1], '')) AS BIGINT) AS start, found[k] AS matched_text FROM c, LATERAL (SELECT unnest(range(1, len(found) + 1)) AS k)
""")
def registry_grep(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grep.grep(planted(spark, sf_dir), key="doc_id", starts=None)
    return found.select("doc_id", "pattern_name", F.col("start").cast("long").alias("start"), "matched_text")


_PAGE_PATTERNS = _values([(p["name"], f"(?i){p['pattern']}") for p in registry.page_patterns()])


@query(f"WITH {_PLANTED} SELECT doc_id, name AS pattern_name, len(regexp_extract_all(text, re)) AS match_count FROM p, {_PAGE_PATTERNS} t(name, re) WHERE regexp_matches(text, re)")
def registry_page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = planted(spark, sf_dir).withColumn("page", F.lit(1))
    return grep.page_hits(pages, registry.page_patterns(), "doc_id").select("doc_id", "pattern_name", "match_count")


_FACTS = registry.METADATA


@query(f"WITH {_PLANTED} SELECT doc_id, " + ", ".join(f"array_to_string(list_sort(list_distinct(regexp_extract_all(text, {_quoted(p)}))), '|') AS {name}" for name, p in _FACTS) + " FROM p")
def registry_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = grep.metadata(planted(spark, sf_dir), "doc_id")
    return m.select("doc_id", *(F.array_join(F.array_sort(name), "|").alias(name) for name, _ in _FACTS))


_CUES = _values([(f, g, f"(?i){p}") for f, groups in sorted(registry.cues().items()) for g, ps in groups.items() for p in ps])
_NEGATIVES = _values([(c, f"(?im){p}") for c, ps in registry.negatives().items() for p in ps])
_FAMILY_LIST = _list(registry.families())


@query(f"""
WITH {_PLANTED},
h AS (SELECT DISTINCT doc_id, family, grp FROM p, {_CUES} t(family, grp, re) WHERE CASE WHEN grp = 'heading' THEN regexp_matches(heading, re) ELSE regexp_matches(text, re) END),
n AS (SELECT doc_id, count(DISTINCT category) AS n, string_agg(DISTINCT category, ',' ORDER BY category) AS negatives FROM p, {_NEGATIVES} t(category, re) WHERE regexp_matches(text, re) GROUP BY doc_id),
g AS (SELECT doc_id, family, bool_or(grp = 'heading') AS heading_match, count(*) FILTER (grp <> 'heading') AS groups, string_agg(grp, ',' ORDER BY grp) AS cues FROM h GROUP BY ALL)
SELECT g.doc_id, family AS clause_family, heading_match, cues, coalesce(negatives, '') AS negatives FROM g JOIN p USING (doc_id) LEFT JOIN n USING (doc_id)
WHERE heading_match OR groups >= 2 AND NOT (length(text) <= 50000 AND coalesce(n, 0) > groups)
""")
def registry_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All families, cues and negatives."""
    place = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))
    own = planted(spark, sf_dir).select("doc_id", F.col("doc_id").cast("string").alias("section_id"), F.lit(0).alias("section_index"), "heading", "text", place.alias("page_range"), F.lit("flat_jsonl").alias("source_format"))
    c = locate.locate(own, key="doc_id")
    return c.select("doc_id", "clause_family", "heading_match", F.array_join(F.array_sort("cue_families_hit"), ",").alias("cues"), F.array_join(F.array_sort("negative_signals"), ",").alias("negatives"))


_COMPONENTS = _values([(f, c, f"(?i){p}") for f, parts in registry.components().items() for c, ps in parts.items() for p in ps])


@query(f"""
WITH {_PLANTED}, f AS (SELECT DISTINCT family FROM {_COMPONENTS} t(family, component, re)),
h AS (SELECT doc_id, family, string_agg(DISTINCT component, ',' ORDER BY component) AS present FROM p, {_COMPONENTS} t(family, component, re) WHERE regexp_matches(text, re) GROUP BY ALL),
n AS (SELECT family, count(DISTINCT component) AS total FROM {_COMPONENTS} t(family, component, re) GROUP BY family)
SELECT doc_id, f.family, coalesce(present, '') AS present, n.total FROM p CROSS JOIN f LEFT JOIN h USING (doc_id, family) JOIN n ON n.family = f.family
""")
def registry_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All families' components in every text."""
    each = F.array(*(F.struct(F.lit(f).alias("family"), verify.completeness_of(F.col("numbers"), f).alias("m")) for f in registry.components()))
    rows = planted(spark, sf_dir).select("doc_id", verify.component_numbers(F.col("text")).alias("numbers")).select("doc_id", F.explode(each).alias("e"))
    present = F.array_sort(F.map_keys(F.map_filter("e.m", lambda _, v: v)))
    return rows.select("doc_id", "e.family", F.array_join(present, ",").alias("present"), F.size("e.m").cast("long").alias("total"))


def _opened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(chosen(OPENINGS, F.col("doc_id")), F.lit("\n"), "text").alias("text"))


_FORM_SQL = "CASE " + " ".join(f"WHEN regexp_matches(o, {_quoted('(?i)' + p)}) THEN {_quoted(form)}" for p, _, _, form in registry.forms()) + " END"
_CODE_FORMS = {"424B5": 1, "424B3": 13, "18-K/A": 14}


@query(f"""
WITH d AS (SELECT doc_id, {_list(OPENINGS)}[doc_id % {len(OPENINGS)} + 1] || chr(10) || text AS t FROM documents),
e AS (SELECT doc_id, CASE WHEN starts_with(t, 'IMPORTANT NOTICE') THEN substr(t, 1, 15000) ELSE substr(t, 1, 10000) END AS o,
      CASE doc_id % {len(OPENINGS)} {" ".join(f"WHEN {k} THEN {_quoted(registry.form_codes()[c][2])}" for c, k in _CODE_FORMS.items())} END AS coded FROM d),
f AS (SELECT doc_id, o, coded, {_FORM_SQL} AS found FROM e)
SELECT doc_id, coalesce(coded, found, 'Other') AS form, CASE WHEN coded IS NOT NULL THEN 'high' WHEN found IS NOT NULL THEN 'medium' ELSE 'low' END AS confidence,
       CASE WHEN coded IS NULL AND found IS NULL AND starts_with(ltrim(o, ' ' || chr(10)), 'ANNUAL ECONOMIC STATEMENT') THEN 'Annual Economic Statement' ELSE '' END AS novel FROM f
""")
def classify_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All forms and form codes."""
    c = classify.classify(_opened(spark, sf_dir), "doc_id")
    return c.select("doc_id", F.col("document_form").alias("form"), "confidence", F.array_join("novel_types_observed", ",").alias("novel"))


_HEADS = ["424B5\nrest", "Filed Pursuant to Rule 424(b)(3) x", "x\nRule 424(b)(2)", "Filed Pursuant to Rule 999(a)(1)", "nothing", "18-K/A\n", "x" * 1001 + "\nFWP\n", "Rule 424(b)(1) and\nFWP\n"]


@query("SELECT doc_id, ['424B5', '424B3', '424B2', NULL, NULL, '18-K/A', NULL, '424B1'][doc_id % 8 + 1] AS code FROM documents")
def form_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", classify.form_code(F.concat(chosen(_HEADS, F.col("doc_id")), F.lit("\n"), "text")).alias("code"))


# --------------------------------------------------------------------------- annotations


_LABELS = ["GoverningLaw_Enforcement", "VotingCollectiveActionModification_Single_Limb", "", "Unknown_Label"]


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload a conversation, a clause a turn, through JSON: texts present, missing and empty; labels known, unknown and none."""
    t = F.coalesce("text", F.lit(""))
    words = F.when(F.col("turn") % 3 == 0, F.array(F.lit("  "), t)).when(F.col("turn") % 3 == 2, F.array(F.lit("")))
    label = chosen(_LABELS, F.col("turn"))
    value = F.struct((F.col("turn") * 1.5).alias("x"), F.lit(2.0).alias("y"), words.alias("text"), F.when(label == "", F.array().cast("array<string>")).otherwise(F.array(label)).alias("rectanglelabels"))
    clause = F.struct(F.col("turn"), F.concat_ws("c", "conv_id", "turn").alias("id"), F.col("turn").cast("int").alias("item_index"), F.lit(10).alias("original_width"), value.alias("value"))
    per = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(clause)).alias("clauses"))
    meta = F.create_map(F.lit("DebtorCountry"), F.when(F.col("conv_id") % 2 == 0, F.array(F.lit("Ghana"), F.lit("x"))).otherwise(F.array().cast("array<string>")))
    raw = per.select(F.to_json(F.struct(F.col("conv_id").cast("string").alias("doc_id"), F.lit("T").alias("document_title"), meta.alias("metadata"), "clauses")).alias("v"))
    return raw.select(F.from_json("v", "doc_id string, " + annotate.PAYLOAD).alias("p")).select("p.*")


_STRIPPED = r"regexp_replace(regexp_replace(coalesce(text, ''), '^\s+', ''), '\s+$', '')"


@query(rf"""
WITH t AS (SELECT conv_id, turn, {_STRIPPED} AS s FROM conversations)
SELECT CAST(conv_id AS VARCHAR) AS doc_id, conv_id || 'c' || turn AS clause_id, CASE turn % 4 WHEN 0 THEN 'GoverningLaw_Enforcement' WHEN 1 THEN 'VotingCollectiveActionModification_Single_Limb' WHEN 3 THEN 'Unknown_Label' END AS label,
       CASE turn % 4 WHEN 0 THEN 'governing_law' WHEN 1 THEN 'collective_action' END AS label_family, CAST(turn AS INT) AS page_index, CASE WHEN turn % 3 = 0 AND s <> '' THEN s END AS text,
       CASE WHEN turn % 3 = 1 THEN 'missing' WHEN turn % 3 = 2 OR s = '' THEN 'empty' ELSE 'present' END AS text_status, CAST(turn * 1.5 AS DOUBLE) AS x, CASE WHEN conv_id % 2 = 0 THEN 'Ghana' END AS country FROM t
""")
def annotation_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = classify.label_families(annotate.flatten(payloads(spark, sf_dir)))
    return flat.select("doc_id", "clause_id", "label", "label_family", "page_index", "text", "text_status", F.col("bbox.x").alias("x"), "country")


@query("""
WITH l AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'GoverningLaw_Enforcement' WHEN 1 THEN 'VotingCollectiveActionModification_Single_Limb' WHEN 3 THEN 'Unknown_Label' END AS label FROM conversations)
SELECT CAST(conv_id AS VARCHAR) AS doc_id, CAST(count(*) AS INT) AS clause_count, coalesce(string_agg(label, ',' ORDER BY turn), '') AS labels, coalesce(string_agg(label, ',' ORDER BY turn) FILTER (turn % 4 = 1), '') AS modification, bool_or(turn % 4 = 1) AS candidate FROM l GROUP BY conv_id
""")
def label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = annotate.label_summary(payloads(spark, sf_dir))
    return s.select("doc_id", "clause_count", F.array_join("raw_clause_labels", ",").alias("labels"), F.array_join("cac_modification_labels", ",").alias("modification"), F.col("cac_candidate").alias("candidate"))


@query("SELECT DISTINCT 'Unknown_Label' AS label FROM conversations WHERE turn % 4 = 3")
def unmapped_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.unmapped_labels(annotate.flatten(payloads(spark, sf_dir)))


@query("""
SELECT event_id, ['not_found', 'invalid_json', 'failed_http', 'failed_request', 'failed_request', 'api_error', 'annotated_zero_clauses', 'success', 'success'][event_id % 9 + 1] AS status FROM events
""")
def fetch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 9
    error = F.when(k == 0, "not_found").when(k == 1, "invalid JSON: x").when(k.isin(2, 3), "boom")
    http = F.when(k == 0, 404).when(k == 2, 503).when(k == 3, 400).otherwise(200)
    status = annotate.fetch_status(error, http, k >= 5, k == 5, F.when(k == 7, 3).when(k > 5, 0), F.when(k.isin(6, 7), "Annotated").otherwise("Open"))
    return table(spark, sf_dir, "events").select("event_id", status.alias("status"))


# --------------------------------------------------------------------------- texts and pages


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as lines of letters and spaces."""
    a = F.trim(F.concat(F.lit("x "), F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z ]", "")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", a.alias("a"))


_PLAIN = "a AS (SELECT conv_id, turn, trim('x ' || regexp_replace(coalesce(text, ''), '[^A-Za-z ]', '', 'g')) AS a FROM conversations)"


@query(f"WITH {_PLAIN} SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN a WHEN 1 THEN a || ' and ' || a WHEN 2 THEN a || ' y' || chr(10) ELSE a || chr(10) || a END AS plain FROM a")
def markdown_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, a = F.col("turn") % 4, F.col("a")
    body = F.when(k == 0, F.concat(F.lit("<!-- image --># "), a)).when(k == 1, F.concat(F.lit("**"), a, F.lit("** and `"), a, F.lit("`"))).when(k == 2, F.concat(F.lit("| "), a, F.lit(" | y |\n|---|---|"))).otherwise(F.concat(F.lit("- "), a, F.lit("\n2. ["), a, F.lit("](http://y)")))
    return _plain(spark, sf_dir).select("conv_id", "turn", text.strip_markdown(body).alias("plain"))


@query(f"WITH {_PLAIN} SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'The bonds ' || lower(a) || chr(10) || 'Next.' WHEN 1 THEN 'hyphenated ' || lower(a) ELSE a || chr(10) || chr(10) || 'Next' END AS flowing FROM a")
def reflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, a = F.col("turn") % 3, F.col("a")
    body = F.when(k == 0, F.concat(F.lit("The\nbonds\n "), F.lower(a), F.lit(" \nNext."))).when(k == 1, F.concat(F.lit("hyphen-\nated "), F.lower(a))).otherwise(F.concat(a, F.lit("\n \nNext")))
    return _plain(spark, sf_dir).select("conv_id", "turn", text.reflow(body).alias("flowing"))


@query(rf"""
WITH {_PLAIN}, b AS (SELECT conv_id || '_' || turn AS path, turn % 3 AS k, regexp_replace(a, ' +', ' ', 'g') AS a FROM a)
SELECT path, 0 AS page, CASE k WHEN 2 THEN 'in ' || a ELSE a END AS text FROM b UNION ALL SELECT path, 1, CASE k WHEN 0 THEN 'Two & ' || a ELSE 'p2' END FROM b WHERE k < 2
""")
def parse_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select("path", "page", "text")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page breaks of styles, page markers in an envelope, and a filing around HTML."""
    own = _plain(spark, sf_dir).select(F.concat_ws("_", "conv_id", "turn").alias("path"), (F.col("turn") % 3).alias("k"), F.regexp_replace("a", " +", " ").alias("a"))
    bodies = {
        "html": F.concat(F.lit("<p>"), "a", F.lit("<script>x</script></p><p style='page-break-before: always'>Two &amp; "), "a", F.lit("</p>")),
        "text": F.concat(F.lit("<DOCUMENT>x<TEXT>\n<PAGE>"), "a", F.lit("\n<PAGE>\np2\n<PAGE>")),
        "filing": F.concat(F.lit("<DOCUMENT><TEXT><html><p>in "), "a", F.lit("</p></html></TEXT>")),
    }
    out = None
    for k, (kind, body) in enumerate(bodies.items()):
        pages = parse.parse(own.where(F.col("k") == k).select("path", body.cast("binary").alias("content")), kind)
        out = pages if out is None else out.unionByName(pages)
    return out


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS d FROM orders")
def free_text_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, at = F.col("o_orderkey") % 5, F.col("o_orderdate").cast("timestamp")
    day = F.dayofmonth(at)
    ordinal = F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "rd").otherwise("th")
    month = F.date_format(at, "MMMM")
    t = (
        F.when(k == 0, F.date_format(at, "yyyy-MM-dd"))
        .when(k == 1, F.concat(month, F.lit(" "), day, F.lit(", "), F.year(at)))
        .when(k == 2, F.concat(day, ordinal, F.lit("  "), F.upper(month), F.lit(" "), F.year(at)))
        .when(k == 3, F.concat(F.lit(" "), F.lower(month), F.lit(" "), day, F.lit(" "), F.year(at), F.lit(" ")))
        .otherwise(chosen(["31 February 2001", "soon", "", "2020-13-01"], F.expr("o_orderkey div 5")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.free_date(t).cast("string").alias("d"))


@query("""
SELECT conv_id || '__s' || row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS section_id, heading, heading_level, text FROM (SELECT 1 AS conv_id, 1 AS turn, '' AS heading, 2 AS heading_level, '' AS text WHERE FALSE)
UNION ALL SELECT conv_id || '__s' || (n - 1), 'Turn ' || turn, 2, CASE WHEN n = 1 THEN 'Lead.' || chr(10) || chr(10) ELSE '' END || '## Turn ' || turn || chr(10) || chr(10) || a || chr(10) || chr(10) || '### Deep' || chr(10) || chr(10) || 'more'
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM (SELECT conv_id, turn, trim('x ' || regexp_replace(coalesce(text, ''), '[^A-Za-z ]', '', 'g')) AS a FROM conversations))
""")
def markdown_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A markdown text a conversation: a title, a lead, a section a turn, a deeper heading in each."""
    part = F.struct("turn", F.concat(F.lit("## Turn "), "turn", F.lit("\n\n"), "a", F.lit("\n\n### Deep\n\nmore\n\n")).alias("t"))
    whole = _plain(spark, sf_dir).groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
    docs = whole.select(F.col("conv_id").cast("string").alias("key"), F.concat(F.lit("# Conversation\n\nLead.\n\n"), F.array_join(F.transform("p", lambda x: x["t"]), "")).alias("text"))
    return sections.markdown_sections(docs, "key").select("section_id", "heading", "heading_level", "text")


@query("""
SELECT doc_id, doc_id % 4 = 0 AS found, CASE WHEN doc_id % 4 = 0 THEN text END AS clause_text, CASE WHEN doc_id % 4 = 0 THEN 'high' ELSE 'low' END AS confidence, CASE WHEN doc_id % 4 < 2 THEN 'ok' ELSE 'parse_error' END AS status FROM documents
""")
def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in a fence, after words, without an object, and none."""
    k = F.col("doc_id") % 4
    given = F.to_json(F.struct(F.lit(True).alias("found"), F.col("text").alias("clause_text"), F.lit("high").alias("confidence")))
    body = F.when(k == 0, F.concat(F.lit("```json\n"), given, F.lit("\n```"))).when(k == 1, 'Sure: {"found": false}').when(k == 2, F.regexp_replace("text", "[{}]", ""))
    return table(spark, sf_dir, "documents").select("doc_id", runs.answer(body).alias("a")).select("doc_id", "a.found", "a.clause_text", "a.confidence", "a.status")


# --------------------------------------------------------------------------- sources


@query("""
SELECT 'nsm__' || CASE WHEN c_custkey % 3 = 0 THEN 'i' || c_custkey ELSE 'd' || c_custkey END AS storage_key, 'H' || c_custkey AS title, c_name AS issuer_name, CASE WHEN c_custkey % 2 = 0 THEN '2020-01-02' END AS publication_date, 'u' || c_custkey || '.pdf' AS download_url FROM customer
""")
def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer a nation, a hit a customer, through JSON."""
    k = F.col("c_custkey")
    src = F.struct(F.when(k % 3 != 0, F.concat(F.lit("d"), k)).alias("disclosure_id"), F.concat(F.lit("H"), k).alias("headline"), F.col("c_name").alias("company"), F.when(k % 2 == 0, "2020-01-02").otherwise("no date").alias("publication_date"), F.concat(F.lit("u"), k, F.lit(".pdf")).alias("download_link"))
    hit = F.struct(F.concat(F.lit("i"), k).alias("_id"), src.alias("_source"))
    raw = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.to_json(F.struct(F.struct(F.collect_list(hit).alias("hits")).alias("hits"))).alias("v"))
    own = raw.select(F.from_json("v", files.HITS).alias("p")).select("p.*")
    return files.search_hits(own).select("storage_key", "title", "issuer_name", F.col("publication_date").cast("string").alias("publication_date"), "download_url")


@query("""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS size FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS cik, CAST(o_orderkey AS VARCHAR) AS accession_number, CASE WHEN n < size THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS filing_date, o_orderpriority AS form FROM o WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as parallel arrays, that of dates one short, through JSON."""
    row = F.struct("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), "o_orderpriority")
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(row)).alias("o"))
    recent = F.struct(F.transform("o", lambda x: x["o_orderkey"].cast("string")).alias("accessionNumber"), F.slice(F.transform("o", lambda x: x["d"]), F.lit(1), F.size("o") - 1).alias("filingDate"), F.transform("o", lambda x: x["o_orderpriority"]).alias("form"), F.array().cast("array<string>").alias("primaryDocument"), F.array().cast("array<string>").alias("primaryDocDescription"))
    raw = per.select(F.to_json(F.struct(F.col("o_custkey").cast("string").alias("cik"), F.lit("N").alias("name"), F.struct(recent.alias("recent")).alias("filings"))).alias("v"))
    return files.filings(raw.select(F.from_json("v", files.FILINGS).alias("p")).select("p.*"), ["1-URGENT", "2-HIGH"]).select("cik", "accession_number", "filing_date", "form")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line a document: objects with known, unknown and wrong fields, every seventh no JSON, every eleventh blank."""
    k = F.col("doc_id")
    line = F.to_json(F.struct(
        F.lit("nsm").alias("source"), k.cast("string").alias("native_id"), F.when(k % 2 == 0, F.concat(F.lit("key_"), k)).alias("storage_key"), F.left("text", F.lit(80)).alias("title"), F.when(k % 3 == 0, F.lit("many")).otherwise(F.col("n_chars").cast("string")).alias("page_count"),
        F.lit("http://x/a.pdf").alias("download_url"), F.col("lang").alias("extra"), F.when(k % 5 == 0, F.struct(F.lit("own").alias("extra"), k.alias("k"))).alias("source_metadata"),
    ))
    return table(spark, sf_dir, "documents").select(F.when(k % 11 == 0, "  ").when(k % 7 == 0, F.concat(F.lit("not json "), k)).otherwise(line).alias("value"))


@query("""
SELECT CASE WHEN doc_id % 2 = 0 THEN 'key_' || doc_id ELSE 'nsm__' || doc_id END AS storage_key, substr(text, 1, 80) AS title, CASE WHEN doc_id % 3 <> 0 THEN CAST(n_chars AS INT) END AS page_count, 'http://x/a.pdf' AS source_page_url, 'artifact_pdf' AS source_page_kind,
       CASE WHEN doc_id % 5 = 0 THEN 'own' ELSE lang END AS extra, CASE WHEN doc_id % 5 = 0 THEN CAST(doc_id AS VARCHAR) END AS k FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0
""")
def manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = ingest.documents(manifest(spark, sf_dir))
    return d.select("storage_key", "title", "page_count", "source_page_url", "source_page_kind", F.get_json_object("source_metadata", "$.extra").alias("extra"), F.get_json_object("source_metadata", "$.k").alias("k"))


@query("SELECT 'not json ' || doc_id AS value FROM documents WHERE doc_id % 7 = 0 AND doc_id % 11 <> 0")
def manifest_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.malformed(manifest(spark, sf_dir))


@query(r"""
SELECT doc_id, url_encode(left(text, 200)) AS quoted, replace(replace(replace(left(text, 50) || '/..\x', '/', '_'), '..', '_'), '\', '_') AS safe FROM documents
""")
def download_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = lambda n: F.left("text", F.lit(n))
    return table(spark, sf_dir, "documents").select("doc_id", harvest.quoted(head(200)).alias("quoted"), harvest.safe_id(F.concat(head(50), F.lit("/..\\x"))).alias("safe"))


@query("""
SELECT 'name:Republic of' AS label, '[{"name":"company_lei","value":["Republic of","","disclose_org","related_org"]}, {"name": "latest_flag", "value": "Y"}]' AS criteria
UNION ALL SELECT 'lei:' || v, '[{"name":"company_lei","value":["","' || v || '","disclose_org",""]}, {"name": "latest_flag", "value": "Y"}]' FROM (SELECT 'LEI' || lpad(CAST(c_custkey AS VARCHAR), 17, '0') AS v FROM customer WHERE c_custkey % 2 = 0)
""")
def search_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    leis = F.when(k % 2 == 0, F.concat(F.lit(" LEI"), F.lpad(k.cast("string"), 17, "0"), F.lit("; short ;"))).when(k % 3 == 0, F.lit(""))
    return harvest.criteria(table(spark, sf_dir, "customer").select(leis.alias("leis")), ["Republic of"])


def extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified candidates, a turn each."""
    k = F.col("turn")
    place = F.struct(k.cast("int").alias("start"), (k + 1).cast("int").alias("end"))
    ext = F.struct(F.when(k % 3 > 0, "high").alias("confidence"), F.lit(None).cast("string").alias("reasoning"), F.when(k % 3 == 1, F.col("text")).alias("clause_text"))
    ver = F.struct(F.lit("verified").alias("status"), F.lit(0.5).alias("verbatim_similarity"), F.when(k % 2 == 0, F.array(F.lit("a"), F.lit("b"))).alias("quality_flags"))
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("_", "conv_id", "turn").alias("candidate_id"), F.concat(F.lit("pdip__"), "conv_id").alias("storage_key"), F.when(k % 2 == 0, "Ghana").alias("country"), F.when(k % 4 == 1, "").when(k % 4 == 2, F.col("text")).alias("document_title"), F.col("role").alias("section_heading"),
        place.alias("page_range"), F.when(k % 2 == 0, "flat_jsonl").otherwise("docling_md").alias("source_format"), (k % 3 == 0).alias("heading_match"), F.array(F.lit("heading"), F.col("role")).alias("cue_families_hit"), ext.alias("extraction"), F.col("text").alias("section_text"), ver.alias("verification"),
        F.lit("r1").alias("run_id"), F.lit("pari_passu").alias("clause_family"),
    )


_FLAT = """
f AS (SELECT conv_id || '_' || turn AS candidate_id, 'pdip__' || conv_id AS storage_key, CASE WHEN turn % 2 = 0 THEN 'Ghana' ELSE '' END AS country, CASE WHEN turn % 4 = 2 AND text <> '' THEN text ELSE 'pdip__' || conv_id END AS document_title, coalesce(role, '') AS section_heading,
      CASE WHEN turn % 2 = 0 THEN CAST(turn + 1 AS VARCHAR) ELSE '' END AS page_start, CASE WHEN turn % 2 = 0 THEN CAST(turn + 2 AS VARCHAR) ELSE '' END AS page_end, CASE WHEN turn % 3 = 0 THEN 'Yes' ELSE 'No' END AS heading_match, 'heading, ' || role AS cue_families,
      CASE WHEN turn % 3 > 0 THEN 'high' ELSE '' END AS llm_confidence, '' AS llm_reasoning, CASE WHEN turn % 3 = 1 THEN coalesce(text, '') ELSE '' END AS clause_text, coalesce(text, '') AS section_text, 'verified' AS verbatim_status, CAST(0.5 AS DOUBLE) AS verbatim_similarity,
      CASE WHEN turn % 2 = 0 THEN 'a, b' ELSE '' END AS quality_flags, CASE WHEN turn % 2 = 0 THEN 'flat_jsonl' ELSE 'docling_md' END AS source_format, 'r1' AS run_id, 'pari_passu' AS clause_family FROM conversations)
"""


@query(f"WITH {_FLAT} SELECT *, length(clause_text) AS clause_length FROM f")
def flat_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.flat_extractions(extractions(spark, sf_dir))


@query(f"WITH {_FLAT} SELECT candidate_id, right(storage_key, 40) AS document, left(document_title, 50) AS title, left(section_heading, 80) AS section, CASE heading_match WHEN 'Yes' THEN 'Heading' ELSE 'Body' END AS found_by, CASE WHEN llm_confidence = '' THEN '' ELSE 'High' END AS confidence, 'Verified' AS verbatim FROM f")
def display_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.display(evaluate.flat_extractions(extractions(spark, sf_dir)))


@query("""
WITH n AS (SELECT conv_id, count(*) AS n, count(*) FILTER (coalesce(length(text), 0) = 0) AS e, bool_and(turn BETWEEN 0 AND 1000) AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS whole FROM conversations GROUP BY conv_id),
c AS (SELECT *, NOT whole OR conv_id % 7 = 0 OR conv_id % 20 = 1 AS bad FROM n)
SELECT count(*) AS documents, count(*) FILTER (bad) AS errors, CAST(sum(e) AS BIGINT) AS empty_pages, count(*) FILTER (bad) / count(*) AS error_rate, CAST(1 AS DOUBLE) AS coverage, count(*) FILTER (bad) / count(*) <= 0.05 AS passed FROM c
""")
def parse_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers that promise too much, and none for some."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("storage_key"), F.col("turn").alias("page"), "text")
    heads = turns.groupBy("storage_key").agg(F.count("*").alias("n")).where("storage_key % 20 != 1").select("storage_key", (F.col("n") + F.when(F.col("storage_key") % 7 == 0, 1).otherwise(0)).alias("page_count"), F.lit("ok").alias("parse_status"))
    return evaluate.parse_gates(evaluate.parse_checks(heads, turns), turns.select("storage_key").distinct().count())


@query("""
SELECT count(*) AS terminal_total, count(*) - 5 AS new_attempted, count(*) FILTER (event_id % 3 = 0) AS cac_candidate_count, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_id % 4 = 0) AS once,
       count(*) FILTER (event_id % 5 = 0) AS unknown_country, 'A_x,VotingCollectiveActionModification_y' AS labels, 'A_x' AS unmapped FROM events
""")
def harvest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("status"), (k % 4 + 1).cast("int").alias("attempts_used"), F.when(k % 2 == 0, F.array(F.lit("A_x"))).otherwise(F.array(F.lit("VotingCollectiveActionModification_y"), F.lit("A_x"))).alias("raw_clause_labels"), (k % 3 == 0).alias("cac_candidate"),
        F.when(k % 5 > 0, "Ghana").alias("country"), F.lit("Bond").alias("instrument_type"),
    )
    s = harvest.summary(rows, 9, 5)
    return s.select(
        "terminal_total", "new_attempted", "cac_candidate_count", F.coalesce(F.try_element_at("status_counts", F.lit("view")), F.lit(0)).alias("views"), F.col("retry_distribution")["1"].alias("once"), F.col("counts_by_country")["Unknown"].alias("unknown_country"),
        F.array_join("distinct_raw_labels", ",").alias("labels"), F.array_join("unmapped_labels", ",").alias("unmapped"),
    )


@query("SELECT doc_id, quality, CASE WHEN doc_id % 3 = 0 THEN 'missed' ELSE 'known' END AS state FROM labels")
def resolved_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "documents").where("doc_id % 3 != 0").select("doc_id", F.lit(1).alias("document_id"))
    hits, misses = ingest.resolved(table(spark, sf_dir, "labels"), known, "doc_id")
    return hits.select("doc_id", "quality", F.lit("known").alias("state")).unionByName(misses.select("doc_id", "quality", F.lit("missed").alias("state")))


@query("SELECT conv_id || '_' || turn AS path, CASE WHEN turn % 3 = 2 THEN 1 ELSE 2 END AS page_count, CASE turn % 3 WHEN 0 THEN 'html' WHEN 1 THEN 'text' ELSE 'filing' END AS parse_tool, 'ok' AS parse_status FROM conversations")
def parse_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.headers(_parsed(spark, sf_dir)).select("path", "page_count", "parse_tool", "parse_status")


@query("""
WITH t AS (SELECT conv_id, turn, regexp_replace(regexp_replace(coalesce(text, ''), '^\\s+', ''), '\\s+$', '') AS s FROM conversations)
SELECT count(DISTINCT conv_id) AS documents, CAST(0 AS BIGINT) AS zero_clause_documents, count(*) AS clauses, count(*) FILTER (turn % 3 = 0 AND s <> '') AS with_text, count(DISTINCT CASE WHEN turn % 4 = 3 THEN 1 END) AS unmapped_labels FROM t
""")
def annotation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = payloads(spark, sf_dir)
    return annotate.stats(classify.label_families(annotate.flatten(own)), own)


@query("""
SELECT conv_id || '__s' || turn || '_' || k AS part, CAST(n AS BIGINT) AS n FROM (
  SELECT conv_id, turn, k, length(array_to_string(w[40 * k + 1:40 * k + 40], chr(10) || chr(10))) AS n FROM (
    SELECT conv_id, turn, list_transform(range(100), lambda i: 'p' || lpad(CAST(i AS VARCHAR), 3, '0') || lpad('', 8, 'x')) AS w FROM conversations), LATERAL (SELECT unnest(range(3)) AS k))
""")
def large_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections over the limit, cut between paragraphs: a hundred of 12 characters, 40 of which and their joints fit in 560."""
    body = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(F.lit("p"), F.lpad(i.cast("string"), 3, "0"), F.lit("xxxxxxxx"))), "\n\n")
    docs = table(spark, sf_dir, "conversations").select(F.concat(F.col("conv_id"), F.lit("__s"), F.col("turn")).alias("key"), body.alias("text"))
    cut = sections.markdown_sections(docs, "key", most=560)
    return cut.select(F.concat("key", F.lit("_"), "section_index").alias("part"), F.col("char_count").cast("long").alias("n"))
