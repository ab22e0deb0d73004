"""Queries of the relational shapes: joins, aggregates, windows, top-k, set operations, loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from ..operators import blockwise, evaluate, ingest, provenance, substrings
from ..sources import files
from .base import query, table

# --------------------------------------------------------------------------- joins


@query("SELECT d.doc_id, d.source, l.quality, l.toxic FROM labels l JOIN documents d USING (doc_id) WHERE l.quality = 0")
def join_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return table(spark, sf_dir, "labels").where("quality = 0").join(docs, "doc_id").select("doc_id", "source", "quality", "toxic")


@query("SELECT o_orderkey, o.o_custkey, c.c_name, c.n_name FROM orders o LEFT JOIN (SELECT DISTINCT 'c' || c_custkey AS k, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 <> 0) c ON 'c' || o.o_custkey = c.k")
def left_distinct_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    known = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    known = known.select(F.concat(F.lit("c"), "c_custkey").alias("k"), "c_name", "n_name").dropDuplicates()
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(known, F.concat(F.lit("c"), "o_custkey") == F.col("k"), "left").select("o_orderkey", "o_custkey", "c_name", "n_name")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def anti_outstanding(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return ingest.outstanding(table(spark, sf_dir, "customer").select("c_custkey"), done, ["c_custkey"])


@query("""
WITH o AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 95), m AS (SELECT u.user_id FROM (SELECT DISTINCT user_id FROM events) u WHERE u.user_id NOT IN (SELECT user_id FROM o)),
e AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE event_type IN ('error', 'click', 'view'))
SELECT m.user_id, e.event_type AS last_error, e.event_id AS last_id FROM m LEFT JOIN e ON e.user_id = m.user_id AND r = 1
""")
def last_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    missing = ingest.outstanding(events.select("user_id").distinct(), events.where("event_type = 'purchase' AND value > 95"), ["user_id"])
    last = ingest.last_of(events.where(F.col("event_type").isin("error", "click", "view")), ["user_id"], "event_id", ["event_type", "event_id"])
    return missing.join(last, "user_id", "left").select("user_id", F.col("event_type").alias("last_error"), F.col("event_id").alias("last_id"))


@query("SELECT p_partkey, CASE WHEN contains(upper(p_name), 'RED') THEN 'warm' WHEN contains(upper(p_name), 'BLUE') THEN 'cold' WHEN contains(upper(p_name), 'E') THEN 'other' END AS tone FROM part")
def substring_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([(1, "RED", "warm"), (2, "BLUE", "cold"), (3, "E", "other")], "ord int, pattern string, tone string")
    return substrings.first_match(table(spark, sf_dir, "part").select("p_partkey", "p_name"), rules, "p_name").select("p_partkey", "tone")


@query("SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AND b.k IS NOT NULL AS both_sides, a.k IS NULL AS only_right FROM (SELECT DISTINCT doc_id AS k FROM labels WHERE quality = 1) a FULL JOIN (SELECT doc_id AS k FROM documents WHERE n_chars > 2000) b ON a.k = b.k")
def presence_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("k")).distinct().withColumn("a", F.lit(1))
    b = table(spark, sf_dir, "documents").where("n_chars > 2000").select(F.col("doc_id").alias("k")).withColumn("b", F.lit(1))
    return a.join(b, "k", "full_outer").select("k", (F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both_sides"), F.col("a").isNull().alias("only_right"))


@query("SELECT DISTINCT c_custkey FROM customer WHERE 'x__' || c_custkey IN (SELECT 'x__' || o_custkey FROM orders WHERE o_totalprice > 100000)")
def semi_suffix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "orders").where("o_totalprice > 100000").select(F.concat(F.lit("x__"), "o_custkey").alias("key"))
    ids = good.select(F.regexp_replace("key", "^.*?__", "").alias("id")).distinct()
    return table(spark, sf_dir, "customer").select("c_custkey").join(ids, F.col("c_custkey").cast("string") == F.col("id"), "left_semi").distinct()


@query("SELECT event_id, coalesce(m.family, e.event_type) AS family FROM events e LEFT JOIN (VALUES ('view', 'browse'), ('click', 'browse')) m(event_type, family) USING (event_type)")
def lookup_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = spark.createDataFrame([("view", "browse"), ("click", "browse")], "event_type string, family string")
    return table(spark, sf_dir, "events").select("event_id", "event_type").join(F.broadcast(m), "event_type", "left").select("event_id", F.coalesce("family", "event_type").alias("family"))


@query("SELECT l.conv_id, l.turn, p.text AS previous FROM conversations l LEFT JOIN conversations p ON p.conv_id = l.conv_id AND p.turn = l.turn - 1")
def page_text_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    before = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("previous"))
    return own.join(before, ["conv_id", "turn"], "left")


@query("SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'no_document' ELSE 'no_label' END AS orphan FROM (SELECT doc_id AS k FROM documents) a FULL JOIN (SELECT DISTINCT doc_id AS k FROM labels) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), F.lit(1).alias("a"))
    b = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("k")).distinct().withColumn("b", F.lit(1))
    return a.join(b, "k", "full_outer").where("a IS NULL OR b IS NULL").select("k", F.when(F.col("a").isNull(), "no_document").otherwise("no_label").alias("orphan"))


@query("SELECT p.pos, d.doc_id, d.source FROM (VALUES (0, 7), (1, 3), (2, 11), (3, -1)) p(pos, doc_id) JOIN documents d ON d.doc_id = p.doc_id")
def requested_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = spark.range(1).select(F.posexplode(F.array(*map(F.lit, (7, 3, 11, -1)))).alias("pos", "doc_id"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return docs.join(F.broadcast(asked.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id").orderBy("pos").select("pos", "doc_id", "source")


@query("SELECT o_orderpriority, o_custkey, list(substr(o_orderstatus || o_orderkey, 1, 500) ORDER BY o_orderkey) AS quotes FROM orders GROUP BY ALL")
def compare_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    own = F.array_sort(F.collect_list(F.struct("o_orderkey", F.substring(F.concat("o_orderstatus", "o_orderkey"), 1, 500).alias("q"))))
    return o.groupBy("o_orderpriority", "o_custkey").agg(F.transform(own, lambda x: x["q"]).alias("quotes"))


@query("SELECT c_custkey, iso FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN (VALUES (0, 'AAA'), (1, 'BBB'), (2, 'CCC')) m(k, iso) ON n_nationkey = k")
def mapped_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = spark.createDataFrame([(0, "AAA"), (1, "BBB"), (2, "CCC")], "k int, iso string")
    n = table(spark, sf_dir, "nation").join(F.broadcast(m), F.col("n_nationkey") == F.col("k")).select("n_nationkey", "iso")
    return table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "iso")


@query("SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)")
def document_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(one, "doc_id", "left")


# --------------------------------------------------------------------------- aggregates


@query("SELECT count(*) AS documents, count(DISTINCT source) AS sources, max(n_chars) AS longest FROM documents")
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("documents"), F.count_distinct("source").alias("sources"), F.max("n_chars").alias("longest"))


@query("SELECT coalesce(CASE WHEN lang <> 'fr' THEN lang END, '(unmapped)') AS family, count(*) AS annotations, count(DISTINCT source) AS docs FROM documents GROUP BY 1")
def family_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = F.coalesce(F.when(F.col("lang") != "fr", F.col("lang")), F.lit("(unmapped)"))
    return table(spark, sf_dir, "documents").groupBy(family.alias("family")).agg(F.count("*").alias("annotations"), F.count_distinct("source").alias("docs"))


@query("SELECT n_name AS country, n_nationkey AS code, source, count(*) AS doc_count FROM (SELECT c_nationkey AS k, 'customer' AS source FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier) JOIN nation ON k = n_nationkey GROUP BY ALL")
def country_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.lit("customer").alias("source")).unionByName(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("supplier").alias("source")))
    counted = both.groupBy("k", "source").agg(F.count("*").alias("doc_count"))  # before the names join
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return counted.join(n, F.col("k") == F.col("n_nationkey")).select(F.col("n_name").alias("country"), F.col("n_nationkey").alias("code"), "source", "doc_count")


@query("SELECT doc_id % 50 AS k, array_to_string(list_sort(list(DISTINCT source)), ',') AS families FROM documents GROUP BY 1")
def family_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy((F.col("doc_id") % 50).alias("k")).agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("families"))


@query("SELECT event_type, count(*) AS n, CAST(sum(value) AS DOUBLE) AS total, count(*) FILTER (value > 50) AS large, count(props) AS with_props FROM events GROUP BY 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.count_if(F.col("value") > 50).alias("large"), F.count("props").alias("with_props"))


@query("SELECT lang, string_agg(source || '=' || n, ',' ORDER BY source) AS mix FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang")
def nested_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = evaluate.histogram(table(spark, sf_dir, "documents"), ["lang"], F.col("source"), "m")
    return h.select("lang", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("mix"))


@query("SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, grouping(lang) * 2 + grouping(source) AS level FROM documents GROUP BY ROLLUP (lang, source)")
def tier_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.grouping_id().alias("level"))


@query("""
WITH p AS (SELECT conv_id, count(*) AS n_pages, list(turn ORDER BY turn) AS o, count(*) FILTER (length(coalesce(text, '')) = 0) AS empty_pages FROM conversations GROUP BY conv_id)
SELECT conv_id, n_pages, n_pages % 2 = 0 AS count_matches, o = range(n_pages) AS contiguous, empty_pages FROM p
""")
def parse_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    n = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    headers = n.select("conv_id", F.when(F.col("n") % 2 == 0, F.col("n")).otherwise(F.col("n") + 1).alias("page_count"), F.lit("ok").alias("parse_status"))
    return evaluate.parse_checks(headers, turns, "conv_id", "turn").select("conv_id", "n_pages", "count_matches", "contiguous", "empty_pages")


@query("SELECT n_name, count(*) AS n FROM (SELECT o_custkey, min(o_orderkey) AS k FROM orders GROUP BY 1) JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1 ORDER BY n DESC, n_name LIMIT 20")
def once_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(once, "c_custkey", "left_semi").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "n").orderBy(F.col("n").desc(), "n_name").limit(20)


@query("SELECT event_type, count(*) AS hits, count(*) FILTER (r = 1) AS new FROM (SELECT event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) GROUP BY 1")
def hits_and_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    return table(spark, sf_dir, "events").select("event_type", "user_id", "event_id").withColumn("r", first).groupBy("event_type").agg(F.count("*").alias("hits"), F.count_if(F.col("r") == 1).alias("new"))


@query("SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY ALL")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("double").alias("qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


# --------------------------------------------------------------------------- windows


@query("SELECT conv_id, turn, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM conversations")
def running_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(F.sum(F.length("text") + 2).over(w), F.lit(0)).cast("long").alias("start"))


@query("SELECT conv_id, role, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY length(text) DESC, turn) AS r FROM conversations) WHERE r = 1")
def longest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.first_of(table(spark, sf_dir, "conversations"), ["conv_id", "role"], [F.length("text").desc(), F.col("turn").asc()]).select("conv_id", "role", "turn", "text")


@query("""
WITH f AS (SELECT doc_id, source, CASE WHEN doc_id - lag(doc_id) OVER w <= 2 THEN 0 ELSE 1 END AS b FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)), i AS (SELECT *, sum(b) OVER (PARTITION BY source ORDER BY doc_id) AS isl FROM f)
SELECT source, CAST(isl AS BIGINT) AS island, min(doc_id) AS first, max(doc_id) AS last, count(*) AS n FROM i GROUP BY ALL
""")
def adjacency_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = blockwise.with_block(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], "doc_id")
    flags = blockwise.previous(docs, ["source"], "doc_id", "before")
    flags = blockwise.running(flags, ["source"], ["doc_id"], island=("sum", F.when(F.col("doc_id") - F.col("before") <= 2, 0).otherwise(1)))
    return flags.groupBy("source", "island").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))


@query("SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next_turn FROM conversations WHERE role <> 'assistant'")
def section_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("role <> 'assistant'").select("conv_id", "turn", F.lead("turn").over(Window.partitionBy("conv_id").orderBy("turn")).alias("next_turn"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1")
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.first_of(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], [F.col("event_id").asc()])


@query("SELECT user_id, last(event_type ORDER BY event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1")
def last_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.last_of(table(spark, sf_dir, "events"), ["user_id"], "event_id", ["event_type", "event_id"])


@query("SELECT event_id, value - lag(value, 49) OVER (PARTITION BY event_type ORDER BY event_id) AS trend FROM events")
def moving_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = blockwise.with_block(table(spark, sf_dir, "events").select("event_type", "event_id", "value"), ["event_type"], "event_id")
    return blockwise.lagged(events, ["event_type"], ["event_id"], "value", 49, "earlier").select("event_id", (F.col("value") - F.col("earlier")).alias("trend"))


# --------------------------------------------------------------------------- order and sets


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END DESC NULLS LAST, o_orderkey LIMIT 50")
def topk_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").orderBy(when.desc_nulls_last(), "o_orderkey").limit(50)


@query("SELECT w AS word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) GROUP BY 1 ORDER BY n DESC, word LIMIT 20")
def most_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "word").limit(20)


@query("SELECT 'customer' AS kind, c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id").subtract(table(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT doc_id FROM documents WHERE n_chars > 1000 INTERSECT SELECT doc_id FROM labels WHERE toxic = 0")
def set_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("n_chars > 1000").select("doc_id").intersect(table(spark, sf_dir, "labels").where("toxic = 0").select("doc_id"))


@query("SELECT source, n_chars, doc_id FROM documents WHERE lang IN ('en', 'de') AND source <> 'src0' AND n_chars BETWEEN 100 AND 4000")
def filter_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(F.col("lang").isin("en", "de") & (F.col("source") != "src0") & F.col("n_chars").between(100, 4000)).select("source", "n_chars", "doc_id")


@query("SELECT event_id FROM events WHERE coalesce(event_type, '') NOT IN ('view', 'click')")
def failure_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(~F.coalesce("event_type", F.lit("")).isin("view", "click")).select("event_id")


@query("SELECT doc_id, right(text, 40) AS tail, left(text, 50) AS head, upper(left(source, 1)) || substr(source, 2) AS name FROM documents")
def display_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.right("text", F.lit(40)).alias("tail"), F.left("text", F.lit(50)).alias("head"), F.initcap("source").alias("name"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, props IS NOT NULL AS has_props FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("props").isNotNull().alias("has_props"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 2 = 0 THEN 'https://publicdebtispublic.mdi.georgetown.edu/search/' ELSE 'u' END AS url, CASE WHEN doc_id % 3 = 0 OR doc_id % 2 = 0 THEN 'search_page' ELSE 'k' END AS kind FROM documents")
def atomic_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lit("pdip").alias("source"), F.lit(None).cast("string").alias("download_url"), F.lit(None).cast("string").alias("source_metadata"), F.when(F.col("doc_id") % 3 != 0, "u").alias("source_page_url"), F.when(F.col("doc_id") % 2 != 0, "k").alias("source_page_kind"))
    return provenance.with_source_page(docs).select("doc_id", F.col("source_page_url").alias("url"), F.col("source_page_kind").alias("kind"))


@query("SELECT doc_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN n_chars END, CASE WHEN doc_id % 3 = 0 THEN 7 END) AS page_count FROM documents")
def header_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")).alias("page_count"))
    headers = docs.where("doc_id % 3 = 0").select("doc_id", F.lit(7).cast("long").alias("page_count"))
    return ingest.backfill(docs, headers, ("page_count",), "doc_id")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'old' END AS state FROM customer UNION ALL SELECT -1, 'new'")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select("c_custkey", F.lit("old").alias("state"))
    new = old.where("c_custkey % 2 = 0").select("c_custkey", F.lit("new").alias("state")).unionByName(spark.createDataFrame([(-1, "new")], "c_custkey long, state string"))
    return ingest.upsert(new, old, ["c_custkey"])


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'pdf' WHEN doc_id % 4 = 1 THEN 'text' WHEN doc_id % 4 = 2 THEN 'html' ELSE 'unsupported' END AS kind FROM documents")
def file_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 4
    path = F.concat(F.lit("/a.b/x"), F.when(k == 0, ".PDF").when(k == 1, ".txt").when(k == 2, ".htm").otherwise(".doc"))
    return table(spark, sf_dir, "documents").select("doc_id", provenance.file_kind(path).alias("kind"))


@query("SELECT doc_id, coalesce(CAST(n_chars AS VARCHAR), '') AS n_chars, coalesce(lang, '') AS lang FROM documents")
def all_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.all_strings(table(spark, sf_dir, "documents").select(F.col("n_chars"), "lang", F.col("doc_id").alias("d"))).select(F.col("d").cast("long").alias("doc_id"), "n_chars", "lang")


@query("SELECT rpad(event_type, 24, ' ') || lpad(format('{:,}', count(*)), 10, ' ') AS line FROM events GROUP BY event_type")
def status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import runs

    return runs.status_lines(table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")), "event_type", "n")


@query("SELECT doc_id, length(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '')) AS n FROM documents WHERE length(text) >= 100")
def stub_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(F.length("text") >= 100).select("doc_id", F.length(text.strip(F.col("text"))).cast("long").alias("n"))


@query("SELECT doc_id, n_chars, substr(text, greatest(strpos(lower(text), 'license') - 200, 1), least(strpos(lower(text), 'license') - 1, 200) + 207) AS snippet FROM documents WHERE lang = 'en' AND source IN ('src1', 'src2', 'src3') AND contains(lower(text), 'license') ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 50")
def browse_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import search

    docs = table(spark, sf_dir, "documents")
    return search.browse(docs, "License", "text", order="n_chars", lang="en", source=["src1", "src2", "src3"], doc_id=None).select("doc_id", "n_chars", "snippet")


@query("SELECT o_custkey, max(o_totalprice) AS best, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 3")
def having_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("best"), F.count("*").alias("n")).where("n > 3")
