"""Queries of the text operators. The test texts have no legal vocabulary, so registries here are small ones of their words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import classify, evaluate, grep, locate, provenance, runs, search, sections, segments, verify
from ..session import shared_folder
from ..sources import parse
from .base import query, table

#: name, pattern; in a dialect that any engine reads alike.
PATTERNS = [
    {"name": "of_the", "version": "1", "pattern": r"of\s+the"},
    {"name": "license", "version": "1", "pattern": r"license|rights\s+reserved"},
    {"name": "mail", "version": "1", "pattern": r"[a-z0-9._]+@[a-z0-9.]+"},
]
CUES = {"motion": {"heading": ["^user$"], "tion": ["tion [a-z]+"], "article": ["the [a-z]+", "and [a-z]+"], "verb": ["is [a-z]+ed"]}, "place": {"heading": [], "inner": ["in the"], "outer": ["out[a-z]*"], "upon": ["on [a-z]+"]}}
NEGATIVES = {"short": ["^[A-Za-z. ]{1,40}$"], "odd": ["#", "[*]{2,}"]}
COMPONENTS = {"motion": {"article": ["the"], "number": ["[0-9]+"], "mail": ["@"], "tion": ["tion", "sion"]}}

# every match with its start, as SQL: from the gaps between matches and the matches; some texts have control characters
_CUT = r"""
t AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN replace(text, ' the ', chr(1) || 'the' || chr(2)) ELSE text END AS text FROM documents),
cut AS (SELECT doc_id, text, name, string_split_regex(text, '(?i)' || p) AS gaps, regexp_extract_all(text, '(?i)' || p) AS found
        FROM t, (VALUES ('of_the', 'of\s+the'), ('license', 'license|rights\s+reserved'), ('mail', '[a-z0-9._]+@[a-z0-9.]+')) AS pat(name, p)),
hits AS (SELECT doc_id, text, name, found[k] AS m, length(array_to_string(gaps[1:k], '')) + length(array_to_string(found[1:k - 1], '')) AS start
         FROM cut, LATERAL (SELECT unnest(range(1, len(found) + 1)) AS k))
"""


def _controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents, every tenth with control characters around words."""
    own = F.when(F.col("doc_id") % 10 == 0, F.replace("text", F.lit(" the "), F.lit("\x01the\x02"))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", own.alias("text"))


def _grep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grep.grep(_controls(spark, sf_dir), PATTERNS, "doc_id", starts=None, run_id="r1")


@query(f"WITH {_CUT} SELECT doc_id, name AS pattern_name, CAST(start AS BIGINT) AS start, CAST(start + length(m) AS BIGINT) AS \"end\", m AS matched_text FROM hits")
def grep_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grep(spark, sf_dir).select("doc_id", "pattern_name", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "matched_text")


@query(f"WITH {_CUT} SELECT doc_id, name AS pattern_name, CAST(start AS BIGINT) AS start, substr(text, greatest(start - 500, 0) + 1, least(start, 500)) AS context_before, substr(text, start + length(m) + 1, 500) AS context_after FROM hits")
def grep_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grep(spark, sf_dir).select("doc_id", "pattern_name", F.col("start").cast("long").alias("start"), "context_before", "context_after")


@query(f"WITH {_CUT} SELECT name AS pattern_name, count(*) AS matches, count(DISTINCT doc_id) AS docs FROM hits GROUP BY name")
def grep_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grep(spark, sf_dir).groupBy("pattern_name").agg(F.count("*").alias("matches"), F.count_distinct("doc_id").alias("docs"))


@query(f"WITH {_CUT} SELECT doc_id, name AS pattern_name, count(*) AS n FROM hits GROUP BY ALL")
def pattern_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grep.clause_counts(_controls(spark, sf_dir), PATTERNS, "doc_id").select("doc_id", F.explode("counts").alias("pattern_name", "n"))


@query("""
SELECT conv_id, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn) AS text, list(s ORDER BY turn) AS starts
FROM (SELECT *, CAST(coalesce(sum(length(coalesce(text, '')) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS s FROM conversations) GROUP BY conv_id
""")
def searchable_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grep.searchable(table(spark, sf_dir, "conversations"), "conv_id", "turn")


@query(r"""
WITH j AS (SELECT conv_id, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn) AS text, list(s ORDER BY turn) AS starts
           FROM (SELECT *, coalesce(sum(length(coalesce(text, '')) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM conversations) GROUP BY conv_id),
cut AS (SELECT *, string_split_regex(text, '(?i)of\s+the') AS gaps, regexp_extract_all(text, '(?i)of\s+the') AS found FROM j),
hits AS (SELECT conv_id, starts, length(array_to_string(gaps[1:k], '')) + length(array_to_string(found[1:k - 1], '')) AS start FROM cut, LATERAL (SELECT unnest(range(1, len(found) + 1)) AS k))
SELECT conv_id, CAST(start AS BIGINT) AS start, CAST(len(list_filter(starts, lambda x: x <= start)) - 1 AS BIGINT) AS page_index FROM hits
""")
def page_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grep.grep(grep.searchable(table(spark, sf_dir, "conversations"), "conv_id", "turn"), PATTERNS[:1], "conv_id")
    return found.select("conv_id", F.col("start").cast("long").alias("start"), F.col("page_index").cast("long").alias("page_index"))


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as sections, the role as the heading."""
    turns = table(spark, sf_dir, "conversations").withColumn("key", F.col("conv_id").cast("string"))
    own = sections.page_sections(turns, "key", "turn")
    return own.join(turns.select("key", F.col("turn").cast("int").alias("turn"), "role"), (own["key"] == turns["key"]) & (own["page_range.start"] == F.col("turn"))).select(own["section_id"], own["key"], F.col("role").alias("heading"), "heading_level", own["text"], "page_range", "source_format", "char_count", "section_index")


@query("""
SELECT conv_id || '__s' || n AS section_id, CAST(conv_id AS VARCHAR) AS key, '(page ' || (turn + 1) || ')' AS heading, CAST(turn AS BIGINT) AS page, length(text) AS char_count, n AS section_index
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n FROM conversations WHERE regexp_replace(text, '\\s', '', 'g') <> '')
""")
def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("key", F.col("conv_id").cast("string"))
    own = sections.page_sections(turns, "key", "turn")
    return own.select("section_id", "key", "heading", F.col("page_range.start").cast("long").alias("page"), F.col("char_count").cast("long").alias("char_count"), F.col("section_index").cast("long").alias("section_index"))


_LOCATE = r"""
s AS (SELECT CAST(conv_id AS VARCHAR) AS key, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS section_index FROM conversations WHERE regexp_replace(text, '\s', '', 'g') <> ''),
n AS (SELECT *, list_filter(['short', 'odd'], lambda c: CASE c WHEN 'short' THEN regexp_matches(text, '(?im)^[A-Za-z. ]{1,40}$') ELSE regexp_matches(text, '#') OR regexp_matches(text, '[*]{2,}') END) AS negative_signals FROM s),
g AS (SELECT *, 'motion' AS clause_family, role = 'user' AS heading_match, list_filter(['article', 'tion', 'verb'], lambda c: CASE c WHEN 'article' THEN regexp_matches(text, '(?i)the [a-z]+|and [a-z]+') WHEN 'tion' THEN regexp_matches(text, '(?i)tion [a-z]+') ELSE regexp_matches(text, '(?i)is [a-z]+ed') END) AS groups FROM n
      UNION ALL
      SELECT *, 'place', FALSE, list_filter(['inner', 'outer', 'upon'], lambda c: CASE c WHEN 'inner' THEN regexp_matches(text, '(?i)in the') WHEN 'outer' THEN regexp_matches(text, '(?i)out[a-z]*') ELSE regexp_matches(text, '(?i)on [a-z]+') END) FROM n),
c AS (SELECT *, CASE WHEN heading_match THEN list_concat(['heading'], groups) ELSE groups END AS cue_families_hit FROM g
      WHERE heading_match OR len(groups) >= 2 AND NOT (length(text) <= 50000 AND len(negative_signals) > len(groups)))
"""


@query(f"WITH {_LOCATE} SELECT clause_family, key, section_index, heading_match, array_to_string(cue_families_hit, ',') AS cues, array_to_string(negative_signals, ',') AS negatives FROM c")
def locate_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = locate.locate(_sections(spark, sf_dir), cues=CUES, negatives=NEGATIVES, key="key")
    return c.select("clause_family", "key", F.col("section_index").cast("long").alias("section_index"), "heading_match", F.array_join("cue_families_hit", ",").alias("cues"), F.array_join("negative_signals", ",").alias("negatives"))


@query(r"""
WITH g AS (SELECT CAST(conv_id AS VARCHAR) || '__s' || (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) AS section_id, text, role FROM conversations WHERE regexp_replace(text, '\s', '', 'g') <> ''),
h AS (SELECT section_id, 'article' AS family, unnest(regexp_extract_all(text, '(?i)the [a-z]+')) AS m FROM g UNION ALL SELECT section_id, 'article', unnest(regexp_extract_all(text, '(?i)and [a-z]+')) FROM g
      UNION ALL SELECT section_id, 'tion', unnest(regexp_extract_all(text, '(?i)tion [a-z]+')) FROM g UNION ALL SELECT section_id, 'verb', unnest(regexp_extract_all(text, '(?i)is [a-z]+ed')) FROM g
      UNION ALL SELECT section_id, 'heading', 'user' FROM g WHERE role = 'user')
SELECT section_id, family, m AS matched_text, count(*) AS n FROM h GROUP BY ALL
""")
def cue_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _sections(spark, sf_dir)
    hits = F.concat(locate.heading_hits(F.col("heading"), CUES["motion"]["heading"]), locate.body_hits(F.col("text"), CUES["motion"]))
    return s.select("section_id", F.explode(hits).alias("h")).groupBy("section_id", "h.family", "h.matched_text").agg(F.count("*").alias("n"))


@query(f"""
WITH RECURSIVE {_LOCATE},
o AS (SELECT clause_family, key, section_index, text, heading_match, row_number() OVER (PARTITION BY clause_family, key ORDER BY section_index) AS r FROM c),
w AS (SELECT clause_family, key, section_index, r, length(text) AS size, section_index AS first FROM o WHERE r = 1
      UNION ALL
      SELECT o.clause_family, o.key, o.section_index, o.r, CASE WHEN o.section_index = w.section_index + 1 AND w.size + length(o.text) <= 900 THEN w.size + length(o.text) ELSE length(o.text) END,
             CASE WHEN o.section_index = w.section_index + 1 AND w.size + length(o.text) <= 900 THEN w.first ELSE o.section_index END
      FROM w JOIN o ON o.clause_family = w.clause_family AND o.key = w.key AND o.r = w.r + 1)
SELECT w.clause_family, w.key, first AS section_index, count(*) AS n_sections, bool_or(o.heading_match) AS heading_match, string_agg(o.text, chr(10) || chr(10) ORDER BY o.section_index) AS section_text
FROM w JOIN o USING (clause_family, key, r) GROUP BY w.clause_family, w.key, first HAVING length(string_agg(o.text, chr(10) || chr(10) ORDER BY o.section_index)) >= 100
""")
def cluster_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = locate.locate(_sections(spark, sf_dir), cues=CUES, negatives=NEGATIVES, key="key")
    c = c.withColumn("section_text", F.col("section_text"))
    joined = locate.drop_stubs(locate.cluster(c, "key", 900))
    return joined.select("clause_family", "key", F.col("section_index").cast("long").alias("section_index"), F.col("n_sections").cast("long").alias("n_sections"), "heading_match", "section_text")


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS squeezed FROM documents")
def squeezed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.squeeze(F.col("text")).alias("squeezed"))


def _extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as passages: with other white space, empty, not found, failed calls, with a word that the source doesn't have."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    k = F.col("doc_id") % 5
    passage = F.when(k == 1, "").when(k == 0, F.replace("text", F.lit(" "), F.lit(" \n "))).otherwise(F.col("text"))
    return docs.select("doc_id", F.when(k == 3, "events_of_default").otherwise("motion").alias("clause_family"), passage.alias("clause_text"), F.concat(F.lit("Before. "), "text", F.lit(" After.")).alias("section_text"), (k != 2).alias("found"), F.when(k == 4, "api_error").otherwise("ok").alias("status"))


@query(r"""
WITH e AS (SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN '' WHEN doc_id % 5 = 0 THEN replace(text, ' ', ' ' || chr(10) || ' ') ELSE text END AS c, 'Before. ' || text || ' After.' AS text, doc_id % 5 AS k FROM documents),
v AS (SELECT *, CASE WHEN trim(regexp_replace(c, '\s+', ' ', 'g')) = '' THEN 0.0 WHEN contains(trim(regexp_replace(text, '\s+', ' ', 'g')), trim(regexp_replace(c, '\s+', ' ', 'g'))) THEN 1.0 END AS sim FROM e)
SELECT doc_id, CASE WHEN k = 4 THEN 'error_skipped' WHEN k = 2 THEN 'not_found' WHEN k = 3 THEN CASE WHEN sim >= 0.85 THEN 'section_located' ELSE 'needs_review' END ELSE CASE WHEN sim >= 0.95 THEN 'verified' ELSE 'failed' END END AS status,
       CASE WHEN k IN (2, 4) THEN NULL ELSE CAST(sim AS DOUBLE) END AS similarity FROM v
""")
def verification_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.verify(_extractions(spark, sf_dir)).select("doc_id", F.col("verification.status").alias("status"), F.col("verification.verbatim_similarity").alias("similarity"))


def near_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as passages of longer sources: as they are, with letters changed, cut short with words added, of another text, and as sections of a family that is captured whole."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("t"))
    k = (F.col("conv_id") + F.col("turn")) % 5
    passage = F.when(k == 1, F.regexp_replace("t", "tion", "tlon")).when(k == 2, F.concat(F.substring("t", 1, 60), F.lit(" and some words more"))).when(k == 3, F.reverse("t")).when(k == 4, F.regexp_replace("t", "e", "")).otherwise(F.col("t"))
    family = F.when(k == 4, "events_of_default").otherwise("collective_action")
    return turns.select("conv_id", "turn", family.alias("clause_family"), passage.alias("clause_text"), F.concat(F.lit("Section. "), "t", F.lit("\n\nMore of the section.")).alias("section_text"), F.lit(True).alias("found"), F.lit("ok").alias("status"))


@query()
def verification_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that containment doesn't decide: the ratios of D20 and D21, with the default components. The tests hold it against plain difflib."""
    v = verify.verify(near_misses(spark, sf_dir))
    return v.select("conv_id", "turn", F.col("verification.status").alias("status"), F.col("verification.verbatim_similarity").alias("similarity"), F.array_join("verification.quality_flags", ",").alias("flags"), F.col("verification.components_present").alias("components_present"), F.col("verification.components_total").alias("components_total"))


@query(r"""
SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(trim(regexp_replace(d.text, '\s+', ' ', 'g')), trim(regexp_replace(b.text, '\s+', ' ', 'g')))
WHERE trim(regexp_replace(b.text, '\s+', ' ', 'g')) <> ''
""")
def verbatim_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.contained(table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item")), table(spark, sf_dir, "documents").select("doc_id", "text"), "item_id", "item", "doc_id", "text")


@query("SELECT doc_id, regexp_matches(text, '(?i)the') AS article, regexp_matches(text, '[0-9]+') AS number, contains(text, '@') AS mail, regexp_matches(text, '(?i)tion|sion') AS tion FROM documents")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = verify.completeness(F.col("text"), "motion", COMPONENTS)
    return table(spark, sf_dir, "documents").select("doc_id", parts.alias("m")).select("doc_id", *(F.col("m")[c].alias(c) for c in ("article", "number", "mail", "tion")))


@query(r"""
SELECT doc_id, array_to_string(list_filter(['truncation_suspect', 'ocr_suspect'], lambda f: CASE f WHEN 'truncation_suspect' THEN regexp_matches(regexp_replace(text, '\s+$', ''), '\p{L}$')
       ELSE length(text) > 20 AND length(regexp_replace(text, '[^\p{L}]', '', 'g')) / length(text) < 0.6 END), ',') AS flags FROM documents
""")
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(verify.quality_flags(F.col("text"), F.col("text")), ",").alias("flags"))


_FORMS = [("license[a-z]*", "Bond", "Supplement", "Prospectus"), (r"rights\s+reserved", "Loan", "Standalone", "Loan Agreement"), ("ation", "Other", "Amendment", "Other"), ("ung", "Bond", "Standalone", "Indenture")]


@query(r"""
WITH f AS (SELECT doc_id, substr(text, 1, 10000) AS o FROM documents),
h AS (SELECT *, CASE WHEN regexp_matches(o, '(?i)license[a-z]*') THEN 1 WHEN regexp_matches(o, '(?i)rights\s+reserved') THEN 2 WHEN regexp_matches(o, '(?i)ation') THEN 3 WHEN regexp_matches(o, '(?i)ung') THEN 4 ELSE 5 END AS k FROM f),
m AS (SELECT *, ['(?i)license[a-z]*', '(?i)rights\s+reserved', '(?i)ation', '(?i)ung', '^$'][k] AS p FROM h),
e AS (SELECT *, regexp_extract(o, p) AS matched, length(string_split(regexp_replace(o, p, chr(1)), chr(1))[1]) AS start FROM m)
SELECT doc_id, ['Bond', 'Loan', 'Other', 'Bond', 'Other'][k] AS instrument_family, ['Supplement', 'Standalone', 'Amendment', 'Standalone', 'Standalone'][k] AS document_role,
       ['Prospectus', 'Loan Agreement', 'Other', 'Indenture', 'Other'][k] AS document_form, CASE WHEN k < 5 THEN 'medium' ELSE 'low' END AS confidence,
       CASE WHEN k < 5 THEN substr(regexp_replace(regexp_replace(substr(o, greatest(start - 20, 0) + 1, least(start, 20) + length(matched) + 50), '^\s+', ''), '\s+$', ''), 1, 200) ELSE substr(o, 1, 200) END AS evidence_text FROM e
""")
def doc_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = classify.classify(table(spark, sf_dir, "documents"), "doc_id", forms=_FORMS)
    return c.select("doc_id", "instrument_family", "document_role", "document_form", "confidence", "evidence_text")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'Argentina' WHEN c_custkey % 4 = 1 THEN 'Zambia' ELSE '' END AS country FROM customer
""")
def country_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 4
    keys = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.when(k == 0, "pdip__ARG").when(k == 1, "pdip__ZMB").when(k == 2, "pdip__XXX").otherwise("nsm__ARG"), F.col("c_custkey").cast("string")).alias("storage_key"))
    return classify.country_of(keys).select("c_custkey", "country")


_VALIDATION = """
a AS (SELECT DISTINCT d.source AS family, d.doc_id AS key FROM labels l JOIN documents d USING (doc_id) WHERE l.toxic = 1),
b AS (SELECT DISTINCT source AS family, doc_id AS key FROM documents WHERE length(text) > 3000),
j AS (SELECT family, a.key IS NOT NULL AS ina, b.key IS NOT NULL AS inb FROM a FULL JOIN b USING (family, key)),
n AS (SELECT family, count(*) FILTER (ina AND inb) AS tp, count(*) FILTER (ina AND NOT inb) AS fn, count(*) FILTER (inb AND NOT ina) AS fp FROM j GROUP BY family)
"""


def _validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").join(docs.select("doc_id", "source"), "doc_id")
    return evaluate.validation(evaluate.presence(toxic, "source", "doc_id"), evaluate.presence(docs.where(F.length("text") > 3000), "source", "doc_id"))


@query(f"WITH {_VALIDATION} SELECT family, tp, fn, fp, CASE WHEN tp + fp = 0 THEN 0 ELSE round_even(tp / (tp + fp), 3) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE round_even(tp / (tp + fn), 3) END AS recall, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE round_even(2 * tp / (2 * tp + fp + fn), 3) END AS f1 FROM n")
def validation_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir)


@query(f"WITH {_VALIDATION}, t AS (SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(fp) AS BIGINT) AS fp FROM n) SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE round_even(tp / (tp + fp), 3) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE round_even(tp / (tp + fn), 3) END AS recall FROM t")
def validation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.validation_totals(_validation(spark, sf_dir))


@query("SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) <= 2 THEN 'calibration' ELSE 'evaluation' END AS part FROM (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1)")
def calibration_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", F.lit("toxic").alias("label_family"))
    return evaluate.split(own, "toxic", 2)


@query("SELECT doc_id, 'edgar__' || doc_id AS storage_key, CASE WHEN doc_id % 4 = 0 THEN 'https://www.sec.gov/Archives/edgar/data/' || doc_id || '/000119312520188103/0001193125-20-188103-index.htm' WHEN doc_id % 4 = 1 THEN CASE WHEN doc_id % 8 = 1 THEN 'http://x/a.PDF?q=1' ELSE 'https://data.fca.org.uk/search/' END WHEN doc_id % 4 = 2 THEN 'https://publicdebtispublic.mdi.georgetown.edu/search/' END AS url, CASE WHEN doc_id % 4 = 0 THEN 'filing_index' WHEN doc_id % 8 = 1 THEN 'artifact_pdf' WHEN doc_id % 4 IN (1, 2) THEN 'search_page' ELSE 'none' END AS kind FROM documents")
def provenance_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 4
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(k == 0, "edgar").when(k == 1, "nsm").when(k == 2, "pdip").otherwise("luxse").alias("source"), F.when(F.col("doc_id") % 8 == 1, "http://x/a.PDF?q=1").alias("download_url"), F.format_string('{"cik": "000%d", "accession_number": "0001193125-20-188103"}', "doc_id").alias("source_metadata"))
    page = provenance.source_page(F.col("source"), F.col("download_url"), F.col("source_metadata"))
    return docs.select("doc_id", provenance.storage_key(F.lit("edgar"), F.col("doc_id").cast("string")).alias("storage_key"), page["url"].alias("url"), page["kind"].alias("kind"))


@query()
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("path"), F.col("html").cast("binary").alias("content"))
    return parse.parse(pages, "html").select(F.col("path").alias("page_id"), "page", "char_count", F.sha2("text", 256).alias("text_sha256"))


@query("SELECT CAST(conv_id AS VARCHAR) AS key, count(*) AS page_count, CAST(sum(length(trim(coalesce(text, ''), chr(32) || chr(10) || chr(9)))) AS BIGINT) AS total_chars, count(*) FILTER (length(trim(coalesce(text, ''), chr(32) || chr(10) || chr(9))) < 50) AS short_pages, CASE WHEN sum(length(coalesce(text, ''))) = 0 OR short_pages = page_count THEN 'empty' WHEN short_pages * 2 > page_count THEN 'partial' ELSE 'ok' END AS parse_status FROM conversations GROUP BY conv_id")
def page_rollup_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.parse_status(table(spark, sf_dir, "conversations").withColumn("key", F.col("conv_id").cast("string")), "key")


_STOP_SQL = ", ".join(f"'{w}'" for w in sorted(search.STOP))


@query(f"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(strip_accents(coalesce(text, ''))), '[^a-z]+'), lambda x: x <> '' AND x NOT IN ({_STOP_SQL})) AS w FROM documents),
s AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM t),
p AS (SELECT doc_id, len(w) AS l, term, len(list_filter(w, lambda x: x = term)) AS tf FROM t, (VALUES ('tion'), ('license'), ('der')) q(term)),
d AS (SELECT term, count(*) AS df FROM p WHERE tf > 0 GROUP BY term)
SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score FROM p JOIN d USING (term), s WHERE tf > 0 GROUP BY doc_id
ORDER BY sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))) DESC, doc_id LIMIT 10
""")
def bm25_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without stems, which SQL has no function for; the stop word of the query plays no part."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.scored_pages(docs, ["the", "tion", "LICENSE", "der"], "doc_id", stems=False).select("doc_id", F.round("score", 6).alias("score"))


_CHANGED_SQL = f"""
WITH own AS (SELECT 'd' || doc_id AS page_key, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
  UNION ALL SELECT 'b' || item_id, text FROM benchmark),
t AS (SELECT page_key, list_filter(regexp_split_to_array(lower(strip_accents(coalesce(text, ''))), '[^a-z]+'), lambda x: x <> '' AND x NOT IN ({_STOP_SQL})) AS w FROM own),
s AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM t),
p AS (SELECT page_key, len(w) AS l, term, len(list_filter(w, lambda x: x = term)) AS tf FROM t, (VALUES ('tion'), ('license'), ('der')) q(term)),
d AS (SELECT term, count(*) AS df FROM p WHERE tf > 0 GROUP BY term)
SELECT page_key, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score FROM p JOIN d USING (term), s WHERE tf > 0 GROUP BY page_key
ORDER BY sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * l / mean))) DESC, page_key LIMIT 10
"""


@query(_CHANGED_SQL)
def index_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index that takes all documents, then all benchmark items, then loses the documents labelled toxic: the scores of a rebuild."""
    root = shared_folder(spark, "index")
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    segments.add(docs.select(F.concat(F.lit("d"), "doc_id").alias("page_key"), "text"), root, "pages", "page_key", stems=False)
    segments.add(items.select(F.concat(F.lit("b"), "item_id").alias("page_key"), "text"), root, "pages", "page_key", stems=False)
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.concat(F.lit("d"), "doc_id").alias("page_key"))
    index = segments.remove(toxic, root, "pages", "page_key")
    found = segments.search(spark, index, "pages", ["the", "tion", "LICENSE", "der"], stems=False)
    return found.rows.select(F.col("key").alias("page_key"), F.round("score", 6).alias("score"))


@query()
def bm25_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked pages (turns) with stems, joined to what they are part of."""
    turns = table(spark, sf_dir, "conversations").select(F.concat_ws("_", "conv_id", "turn").alias("page_key"), "conv_id", "turn", "text")
    hits = search.scored_pages(turns, ["licenses", "having", "ands", "ings"], "page_key")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    return search.hits_with_documents(hits, turns.select("page_key", "conv_id"), convs, "page_key", "conv_id").select("conv_id", "page_key", "n_turns", F.round("score", 6).alias("score"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified extractions: a document of the key is a customer, its candidates the orders."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ext = F.struct((k % 4 != 0).alias("found"), F.when(k % 3 == 0, "high").when(k % 3 == 1, "medium").otherwise("low").alias("confidence"), F.rpad(F.lit("x"), (k % 7 + 1).cast("int"), "x").alias("clause_text"))
    status = F.when(k % 11 == 0, "error_skipped").when(k % 5 == 0, "failed").when(k % 4 != 0, "verified").otherwise("not_found")
    return o.select(F.concat(F.lit("pdip__"), F.col("o_custkey").cast("string")).alias("storage_key"), k.alias("candidate_id"), ext.alias("extraction"), F.struct(status.alias("status")).alias("verification"), (k % 2 == 0).alias("heading_match"), F.when(k % 6 == 0, "flat_jsonl").otherwise("docling_md").alias("source_format"), F.when(k % 13 < 6, "a").otherwise("b").alias("clause_family"))


_RECORDS = """
r AS (SELECT 'pdip__' || o_custkey AS storage_key, o_orderkey AS k, o_orderkey % 4 <> 0 AS found, CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS conf, o_orderkey % 7 + 1 AS size,
      CASE WHEN o_orderkey % 11 = 0 THEN 'error_skipped' WHEN o_orderkey % 5 = 0 THEN 'failed' WHEN o_orderkey % 4 <> 0 THEN 'verified' ELSE 'not_found' END AS status, o_orderkey % 2 = 0 AS heading, CASE WHEN o_orderkey % 13 < 6 THEN 'a' ELSE 'b' END AS fam,
      CASE WHEN o_orderkey % 6 = 0 THEN 'flat_jsonl' ELSE 'docling_md' END AS fmt FROM orders)
"""


@query(f"WITH {_RECORDS}, w AS (SELECT *, row_number() OVER (PARTITION BY storage_key ORDER BY status = 'verified' DESC, conf DESC, heading DESC, size DESC, k) AS n, count(*) OVER (PARTITION BY storage_key) - 1 AS dup FROM r WHERE found) SELECT storage_key, k AS candidate_id, TRUE AS is_primary, dup AS duplicates_count FROM w WHERE n = 1 UNION ALL SELECT storage_key, k, NULL, NULL FROM r WHERE NOT found")
def dedup_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.best_per_document(_records(spark, sf_dir)).select("storage_key", "candidate_id", "is_primary", "duplicates_count")


@query(f"""
WITH {_RECORDS}, n AS (SELECT fam AS clause_family, count(*) AS total_candidates, count(*) FILTER (found) AS found_count, count(*) FILTER (NOT found AND status <> 'error_skipped') AS not_found_count, count(*) FILTER (status = 'error_skipped') AS api_error_count,
  count(*) FILTER (found AND status = 'verified') AS verbatim_pass_count, count(*) FILTER (found AND status = 'failed') AS verbatim_fail_count, count(*) FILTER (heading) AS heading_match_count, count(*) FILTER (NOT heading) AS body_only_count, count(*) FILTER (fmt = 'flat_jsonl') AS flat FROM r GROUP BY fam),
a AS (SELECT fam AS clause_family, count(DISTINCT storage_key) AS matched_count FROM r WHERE found AND status = 'verified' AND CAST(substr(storage_key, 7) AS BIGINT) % 2 = 0 GROUP BY fam),
c AS (SELECT count(*) AS annotated_count FROM customer WHERE c_custkey % 2 = 0)
SELECT n.*, round_even(verbatim_pass_count / found_count, 3) AS verbatim_pass_rate, annotated_count, matched_count, round_even(matched_count / annotated_count, 3) AS recall FROM n JOIN a USING (clause_family), c
""")
def family_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select("c_custkey")
    notes = known.select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("label_family"), F.col("c_custkey").alias("doc_id"))
    r = evaluate.round_report(_records(spark, sf_dir), notes)
    return r.withColumn("flat", F.col("source_mix")["flat_jsonl"]).drop("source_mix", "confidence_distribution")


@query(r"SELECT doc_id, name AS pattern_name, len(m) AS match_count, array_to_string(s[1:5], '|') AS samples FROM (SELECT doc_id, name, m, list_transform(list_filter(list_zip(m, range(len(m))), lambda x: list_position(m, x[1]) = x[2] + 1), lambda x: x[1]) AS s FROM (SELECT doc_id, name, regexp_extract_all(text, '(?i)' || p) AS m FROM documents, (VALUES ('of_the', 'of\s+the'), ('license', 'license|rights\s+reserved'), ('mail', '[a-z0-9._]+@[a-z0-9.]+')) t(name, p))) WHERE len(m) > 0")
def page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("page", F.lit(1))
    return grep.page_hits(docs, PATTERNS, "doc_id").select("doc_id", "pattern_name", "match_count", F.array_join("samples", "|").alias("samples"))


@query("""
WITH h AS (SELECT user_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS page, count(*) AS n FROM events GROUP BY ALL),
i AS (SELECT *, CASE WHEN page - lag(page) OVER w <= 2 THEN 0 ELSE 1 END AS b FROM h WINDOW w AS (PARTITION BY user_id ORDER BY page)),
c AS (SELECT user_id, isl, min(page) AS a, max(page) AS z, sum(n) AS matches FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY page) AS isl FROM i) GROUP BY ALL)
SELECT user_id, greatest(a - 1, 1) AS first_page, z + 1 AS last_page, CAST(matches AS BIGINT) AS matches FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY matches DESC, isl) AS r FROM c) WHERE r = 1
""")
def best_page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "events").groupBy("user_id", F.expr("unix_timestamp(ts) div 3600").alias("page")).agg(F.count("*").alias("match_count")).withColumn("pattern_name", F.lit("p"))
    return grep.best_page_range(hits, "user_id").select("user_id", "first_page", "last_page", "matches")


@query(r"""
WITH q AS (SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN replace(text, ' ', '  ') WHEN 1 THEN replace(text, ' a', ' b') WHEN 2 THEN 'Not said: ' || text ELSE text END AS q FROM documents)
SELECT doc_id, contains(text, left(q, 200)) OR contains(trim(regexp_replace(text, '\s+', ' ', 'g')), trim(regexp_replace(left(q, 200), '\s+', ' ', 'g'))) AS quoted FROM q
""")
def quote_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 4
    quote = F.when(k == 0, F.replace("text", F.lit(" "), F.lit("  "))).when(k == 1, F.replace("text", F.lit(" a"), F.lit(" b"))).when(k == 2, F.concat(F.lit("Not said: "), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", grep.quoted(quote, F.col("text")).alias("quoted"))


#: Headers of two clause types; the second breaks over lines in some pages.
_HEADERS = {"ing": r"[A-Z][a-z]+ing\b", "the": r"\. The [a-z]+"}


@query(r"""
WITH p AS (SELECT conv_id, turn + 1 AS page, CASE WHEN (conv_id + turn) % 3 = 0 THEN regexp_replace(coalesce(text, ''), '\. The ', '.' || chr(10) || 'The ', 'g') ELSE coalesce(text, '') END AS t FROM conversations),
h(clause_type, re) AS (VALUES ('ing', '[A-Z][a-z]+ing\b'), ('the', '\. The [a-z]+')),
f AS (SELECT conv_id, page, clause_type, re, CASE WHEN regexp_matches(t, re) THEN t WHEN regexp_matches(regexp_replace(t, chr(10) || '([A-Z])', ' \1', 'g'), re) THEN regexp_replace(t, chr(10) || '([A-Z])', ' \1', 'g') END AS u FROM p, h),
b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, clause_type ORDER BY NOT (page BETWEEN 2 AND 3), page) AS r FROM f WHERE u IS NOT NULL),
w AS (SELECT conv_id, clause_type, page, length(string_split_regex(u, re)[1]) AS pos FROM b WHERE r = 1),
n AS (SELECT w.conv_id, clause_type, w.page, pos, max(p.page) AS range_end, string_agg(p.t, chr(10) ORDER BY p.page) AS t FROM w JOIN p ON p.conv_id = w.conv_id AND p.page BETWEEN w.page AND w.page + 4 GROUP BY ALL),
c AS (SELECT *, substr(t, pos + 1) AS rest, substr(t, pos + 1, 3000) AS cut FROM n),
e AS (SELECT *, CASE WHEN strpos(reverse(cut), ' .') > 0 AND 2 * (length(cut) - strpos(reverse(cut), ' .') - 1) > 3000 THEN substr(cut, 1, length(cut) - strpos(reverse(cut), ' .')) ELSE cut END AS quote FROM c),
s AS (SELECT *, string_split(substr(t, 1, pos), chr(10)) AS bl, string_split(substr(rest, length(quote) + 1), chr(10)) AS al FROM e)
SELECT conv_id, clause_type, page, range_end, trim(quote, ' ' || chr(10)) AS quote, trim(array_to_string(bl[greatest(1, len(bl) - 4):], chr(10)), ' ' || chr(10)) AS context_before, trim(array_to_string(al[1:5], chr(10)), ' ' || chr(10)) AS context_after FROM s
""")
def clause_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents, turns as pages; the range is the second page, so many headers are found outside it."""
    t = F.coalesce("text", F.lit(""))
    turns = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).alias("page"), F.when((F.col("conv_id") + F.col("turn")) % 3 == 0, F.regexp_replace(t, r"\. The ", ".\nThe ")).otherwise(t).alias("text"))
    ranges = turns.select("conv_id").distinct().select("conv_id", F.explode(F.array(*map(F.lit, _HEADERS))).alias("clause_type"), F.lit(2).alias("first_page"), F.lit(2).alias("last_page"))
    found = grep.clause_text(turns, ranges, _HEADERS, "conv_id")
    return found.select("conv_id", "clause_type", "page", "range_end", "quote", "context_before", "context_after")


@query(r"SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS tokens, md5(text) AS md5, sha256(text) AS sha256, regexp_replace(replace(lower(source || ' (' || lang || ')'), ' ', '-'), '[(),]', '', 'g') AS slug FROM documents")
def text_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.estimated_tokens(F.col("text")).alias("tokens"), F.md5("text").alias("md5"), F.sha2("text", 256).alias("sha256"), text.slug(F.concat("source", F.lit(" ("), "lang", F.lit(")"))).alias("slug"))


@query("SELECT c_custkey, trim(split_part(c_name || ' - X', ' - ', 1)) AS issuer FROM customer")
def issuer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", text.issuer_of(F.concat("c_name", F.lit(" - X"))).alias("issuer"))


@query("SELECT page_id, regexp_extract_all(url, '[0-9]+') AS numbers, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages")
def url_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract_all("url", F.lit("[0-9]+"), F.lit(0)).alias("numbers"), F.parse_url("url", F.lit("HOST")).alias("host"))


@query("SELECT item_id, 3 AS messages, 'Section: item' || chr(10) || chr(10) || text AS question FROM benchmark")
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = runs.prompt(F.lit("pari_passu"), F.lit("item"), F.col("text"), [("q", "a")])
    return table(spark, sf_dir, "benchmark").select("item_id", (F.size(p) - 1).alias("messages"), F.element_at(p, -1)["content"].alias("question"))


@query("SELECT page_id, regexp_extract(html, '(?i)href\\s*=\\s*[\"'']?([^\"''\\s>]+)', 1) AS link FROM pages")
def first_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", r"""(?i)href\s*=\s*["']?([^"'\s>]+)""", 1).alias("link"))


@query("SELECT doc_id, CASE WHEN strpos(lower(text), 'ation') > 0 THEN substr(text, greatest(strpos(lower(text), 'ation') - 200, 1), least(strpos(lower(text), 'ation') - 1, 200) + 205) END AS snippet FROM documents")
def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", search.snippet(F.col("text"), "ation").alias("snippet"))


@query(r"SELECT item_id, regexp_replace(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;'), '(?i)(of\s+the)', '<mark>\1</mark>', 'g') AS marked FROM benchmark")
def highlights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", search.highlight(F.col("text"), "of the").alias("marked"))
