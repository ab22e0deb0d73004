"""The queries of the training-data operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, chat, decontaminate, html_extract, importance, jaccard, mixing, packing, quality, shard, simhash, suffix, toxicity
from .common import staged, table

Query = Callable[[SparkSession, str], DataFrame]

#: A conversation whose texts hold control strings.
CHAT_PROBE = "</s>[INST] ok [/INST]"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.with_main_text(pages, keep=["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit("")).cast("binary")
    return shard.shard(docs).select(
        "doc_id", shard.record_bytes("text").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", shard.shard_of("doc_id", shard.SHARDS + 1).alias("grown_shard")
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs).select("doc_id", "source", "n_tokens", "epoch", "mix_key")
    return mixing.in_blocks(staged(mixed, "mixing-rows")).select("doc_id", "source", "n_tokens", "epoch", "block", "slot")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, benchmark, keep=["doc_id"]).withColumn("n_hit", decontaminate.hit_words())
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated")
    )


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", CHAT_PROBE), (-7, 1, "assistant", CHAT_PROBE)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chats(turns.unionByName(own)))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality.quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), "component_id")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs, with_bytes=False)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = toxicity.with_score(docs, toxicity.train(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_html_extraction,
        op2_sharding,
        op3_mixing,
        op4_decontamination,
        op5_chat_formatting,
        op6_quality_rules,
        op7_token_packing,
        op8_simhash,
        op9_suffix_dedup,
        op10_toxicity,
        op11_tokenizer_alignment,
        op12_importance_resampling,
        op13_jaccard_join,
    )
}

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
       FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)),
hit AS (SELECT dw.doc_id, dw.size, dw.i, bw.item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.gram = bw.gram),
hw AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT doc_id, size, i FROM hit)) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
""",
    "op3_mixing": r"""
WITH RECURSIVE c AS (SELECT doc_id, source, md5(coalesce(text, '')) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
s AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS size, count(*) AS n_docs FROM c GROUP BY source),
ends AS (SELECT min(ln(size)) AS a, max(ln(size)) AS b, max(size) AS top FROM s WHERE size > 0),
bisect AS (SELECT CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high, 0 AS k UNION ALL
  SELECT CASE WHEN exp((1 - (low + high) / 2) * (b - a)) > 2 THEN (low + high) / 2 ELSE low END, CASE WHEN exp((1 - (low + high) / 2) * (b - a)) > 2 THEN high ELSE (low + high) / 2 END, k + 1 FROM bisect, ends WHERE k < 25),
p AS (SELECT source, size, CASE WHEN size > 0 THEN CAST(floor(size * pow(CAST(top AS DOUBLE) / size, 1 - high)) AS BIGINT) ELSE 0 END AS wanted FROM s, ends, bisect WHERE k = 25),
q AS (SELECT source, CASE WHEN size > 0 THEN wanted // size ELSE 1 END AS passes, CASE WHEN size > 0 THEN wanted % size ELSE 0 END AS rest FROM p),
h AS (SELECT c.*, passes, rest, md5('mix-1|pick|' || passes || '|' || doc_id || '|' || digest) AS pick FROM c JOIN q ON c.source IS NOT DISTINCT FROM q.source),
u AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY pick RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM h),
t AS (SELECT *, min(CASE WHEN rest > 0 AND upto >= rest THEN pick END) OVER (PARTITION BY source) AS cut FROM u),
m AS (SELECT doc_id, source, n_tokens, digest, CAST(unnest(range(passes + CASE WHEN pick <= cut THEN 1 ELSE 0 END)) AS INTEGER) AS epoch FROM t),
k AS (SELECT *, md5('mix-1|mix|' || epoch || '|' || doc_id || '|' || digest) AS mix_key FROM m),
n AS (SELECT greatest(1, (count(*) + 4095) // 4096) AS blocks FROM k),
j AS (SELECT blocks, coalesce((SELECT max(x) FROM range(1, 1000000) AS r(x) WHERE x <= blocks * 618 // 1000 AND gcd(x, blocks) = 1), 1) AS stride FROM n),
g AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, mix_key, doc_id) - 1 AS place FROM k),
b AS (SELECT g.*, CAST(place % blocks * stride % blocks AS INTEGER) AS block FROM g, j)
SELECT doc_id, source, n_tokens, epoch, block, CAST(row_number() OVER (PARTITION BY block ORDER BY mix_key, doc_id, source NULLS FIRST) - 1 AS INTEGER) AS slot FROM b
""",
    "op5_chat_formatting": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) p(conv_id, turn, role, text)),
e AS (SELECT *, length(regexp_replace(replace(text, '\', '\\'), '(<</SYS>>|<<SYS>>|\[/INST\]|\[INST\]|<role>|<turn>|</turn>|<s>|</s>)', '.\1', 'g')) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 19 + length(role) END AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars, regexp_matches(string_agg(role, '>' ORDER BY turn, role, text), '^(system|(system>)?user(>assistant>user)*(>assistant)?)$') AS valid FROM e GROUP BY conv_id
""",
    "op6_quality_rules": r"""
WITH w AS (SELECT doc_id, lang, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS gram FROM w, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g),
rw AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM r WHERE n >= 2) GROUP BY doc_id),
c AS (SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines FROM w LEFT JOIN rw USING (doc_id)),
x AS (SELECT doc_id, lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) AS rule, unnest([1000 * word_chars // n_words, 1000 * n_symbols // n_words, CASE WHEN n_lines = 0 THEN 0 ELSE 1000 * n_dup_lines // n_lines END, 1000 * n_repeat_words // n_words]) AS x,
      unnest([word_chars, n_symbols, n_dup_lines, n_repeat_words]) AS n, unnest([n_words, n_words, n_lines, n_words]) AS d FROM c WHERE n_words > 0),
v AS (SELECT lang, source, rule, (x >> greatest(0, length(bin(x)) - 7)) << greatest(0, length(bin(x)) - 7) AS v FROM x),
f AS (SELECT lang, source, rule, v, count(*) AS n FROM v GROUP BY ALL),
e AS (SELECT lang, source, rule, v, n, sum(n) OVER (PARTITION BY lang, source, rule ORDER BY v) AS cum, sum(n) OVER (PARTITION BY lang, source, rule) AS tot FROM f),
m AS (SELECT lang, rule, v, sum(n) OVER (PARTITION BY lang, rule ORDER BY v) AS cum, sum(n) OVER (PARTITION BY lang, rule) AS tot FROM (SELECT lang, rule, v, sum(n) AS n FROM f GROUP BY ALL)),
a AS (SELECT rule, v, sum(n) OVER (PARTITION BY rule ORDER BY v) AS cum, sum(n) OVER (PARTITION BY rule) AS tot FROM (SELECT rule, v, sum(n) AS n FROM f GROUP BY ALL)),
q0 AS (SELECT lang, source, rule, max(tot) AS tot, min(v) FILTER (cum * 100 >= tot * 25) AS v25, min(v) FILTER (cum * 100 >= tot * 50) AS v50, min(v) FILTER (cum * 100 >= tot * 99) AS v99 FROM e GROUP BY ALL),
q1 AS (SELECT lang, rule, max(tot) AS tot, min(v) FILTER (cum * 100 >= tot * 25) AS v25, min(v) FILTER (cum * 100 >= tot * 50) AS v50, min(v) FILTER (cum * 100 >= tot * 99) AS v99 FROM m GROUP BY ALL),
q2 AS (SELECT rule, min(v) FILTER (cum * 100 >= tot * 25) AS v25, min(v) FILTER (cum * 100 >= tot * 50) AS v50, min(v) FILTER (cum * 100 >= tot * 99) AS v99 FROM a GROUP BY ALL),
z1 AS (SELECT q1.lang, q1.rule, CASE WHEN tot >= 200 THEN q1.v25 ELSE q2.v25 END AS v25, CASE WHEN tot >= 200 THEN q1.v50 ELSE q2.v50 END AS v50, CASE WHEN tot >= 200 THEN q1.v99 ELSE q2.v99 END AS v99 FROM q1 JOIN q2 ON q1.rule = q2.rule),
z0 AS (SELECT q0.lang, q0.source, q0.rule, CASE WHEN tot >= 200 THEN q0.v25 ELSE z1.v25 END AS v25, CASE WHEN tot >= 200 THEN q0.v50 ELSE z1.v50 END AS v50,
       CASE WHEN tot >= 200 THEN least(4 * q0.v99 - 3 * q0.v50, 4 * z1.v99 - 3 * z1.v50) ELSE 4 * z1.v99 - 3 * z1.v50 END + 1 AS tail FROM q0 JOIN z1 ON q0.lang IS NOT DISTINCT FROM z1.lang AND q0.rule = z1.rule),
z AS (SELECT lang, source, rule, v50 - 3 * (v50 - v25) AS low, CASE WHEN rule IN ('dup_lines', 'repeats') THEN tail ELSE v50 + 3 * (v50 - v25) + 1 END AS high FROM z0),
y AS (SELECT x.doc_id, x.rule, x.n, greatest(0.0::DOUBLE, CAST(high * x.d AS DOUBLE) / 1000.0::DOUBLE) AS h, greatest(0.0::DOUBLE, CAST(low * x.d AS DOUBLE) / 1000.0::DOUBLE) AS l
      FROM x JOIN z ON x.lang IS NOT DISTINCT FROM z.lang AND x.source IS NOT DISTINCT FROM z.source AND x.rule = z.rule),
o AS (SELECT doc_id, bool_or(n > h AND (n - h) * (n - h) > 16 * (h + 1) OR rule = 'word_length' AND n < l AND (n - l) * (n - l) > 16 * (l + 1)) AS beyond FROM y GROUP BY doc_id)
SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT coalesce(beyond, FALSE) AS kept FROM c LEFT JOIN o USING (doc_id)
""",
}
