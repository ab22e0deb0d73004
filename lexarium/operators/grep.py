"""Pattern search over whole documents, with exact offsets, pages and contexts.

Documents are scanned once for all patterns (``functions.scan``): an automaton over the literals that their matches must have says which
of them to run. Only rows with a match reach the cutting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import registry, scan, text

CONTEXT = 500


def searchable(pages: DataFrame, key: str = "storage_key", page: str = "page", body: str = "text", *more: str) -> DataFrame:
    """One row a document: (key, text, starts): its pages joined by blank lines in page order, and where each starts."""
    gathered = pages.groupBy(key, *more).agg(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.coalesce(F.col(body), F.lit("")).alias("t")))).alias("pages"))
    texts = F.transform("pages", lambda x: x["t"])
    return gathered.select(key, *more, F.array_join(texts, "\n\n").alias("text"), text.page_starts(texts).alias("starts"))


def grep(docs: DataFrame, patterns: list[dict[str, str]] | None = None, key: str = "storage_key", body: str = "text", starts: str | None = "starts", context: int = CONTEXT, run_id: str = "", ignore_case: bool = True) -> DataFrame:
    """(key, run_id, pattern_name, pattern_version, start, end, page_index, matched_text, context_before, context_after) for each match.

    Matches of a pattern don't overlap, may straddle pages, and belong to the page they start on. Without ``starts`` a document is
    one page. Null and empty texts have no matches.
    """
    own = registry.patterns() if patterns is None else patterns
    found = scan.found(F.col(body), tuple(scan.compiled(p["pattern"], ignore_case) for p in own))
    named = lambda names: F.get(F.array(*map(F.lit, names)), F.col("m.p")) if names else F.lit("")
    rows = docs.where(F.col(body).isNotNull()).select(key, body, *([starts] if starts else []), F.explode(found).alias("m"))
    full, start, end = F.col(body), F.col("m.start"), F.col("m.start") + F.length("m.text")
    return rows.select(
        key,
        F.lit(run_id).alias("run_id"),
        named([p["name"] for p in own]).alias("pattern_name"),
        named([p.get("version", "") for p in own]).alias("pattern_version"),
        start.alias("start"),
        end.alias("end"),
        (text.page_of(start, F.col(starts)) if starts else F.lit(0)).alias("page_index"),
        F.col("m.text").alias("matched_text"),
        text.before(full, start, context).alias("context_before"),
        text.after(full, end, context).alias("context_after"),
    )


def clause_counts(docs: DataFrame, patterns: list[dict[str, str]], key: str, body: str = "text", ignore_case: bool = True) -> DataFrame:
    """(key, counts: map<name, n>): how often each pattern matches, without zeroes."""
    counts = F.create_map(*(x for p in patterns for x in (F.lit(p["name"]), F.regexp_count(F.coalesce(F.col(body), F.lit("")), F.lit(text.pattern(p["pattern"], ignore_case))).cast("long"))))
    return docs.select(key, F.map_filter(counts, lambda _, n: n > 0).alias("counts"))


def page_hits(pages: DataFrame, patterns: list[dict[str, str]], key: str, page: str = "page", body: str = "text", samples: int = 5) -> DataFrame:
    """(key, page, pattern_name, match_count, samples): per page with a match, the count and up to ``samples`` distinct matches in order."""
    each = F.array(*(F.struct(F.lit(p["name"]).alias("pattern_name"), F.regexp_extract_all(F.col(body), F.lit(text.pattern(p["pattern"])), F.lit(0)).alias("found")) for p in patterns))
    rows = pages.where(F.col(body).isNotNull()).select(key, page, F.explode(each).alias("m")).where(F.size("m.found") > 0)
    return rows.select(key, page, "m.pattern_name", F.size("m.found").cast("long").alias("match_count"), F.slice(F.array_distinct("m.found"), 1, samples).alias("samples"))


def metadata(docs: DataFrame, key: str, body: str = "text") -> DataFrame:
    """(key, and for each fact of the registry its distinct matches in order)."""
    found = [F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(body), F.lit("")), F.lit(p), F.lit(0))).alias(name) for name, p in registry.METADATA]
    return docs.select(key, *found)


def best_page_range(hits: DataFrame, key: str, page: str = "page", gap: int = 2, widen: int = 1, first: int = 1) -> DataFrame:
    """(key, pattern_name, first_page, last_page, matches): of the page clusters at most ``gap`` apart that with most matches (first of ties), widened."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(key, "pattern_name").orderBy(page)
    island = F.sum(F.when(F.col(page) - F.lag(page).over(w) <= gap, 0).otherwise(1)).over(w)
    clusters = hits.withColumn("island", island).groupBy(key, "pattern_name", "island").agg(F.min(page).alias("a"), F.max(page).alias("b"), F.sum("match_count").alias("matches"))
    best = clusters.groupBy(key, "pattern_name").agg(F.max_by(F.struct("a", "b", "matches"), F.struct("matches", -F.col("island"))).alias("x"))
    return best.select(key, "pattern_name", F.greatest(F.col("x.a") - widen, F.lit(first)).alias("first_page"), (F.col("x.b") + widen).alias("last_page"), F.col("x.matches").alias("matches"))


def clause_text(pages: DataFrame, ranges: DataFrame, headers: dict[str, str] | None = None, key: str = "storage_key", page: str = "page", body: str = "text", most: int = 3000, more: int = 4, lines: int = 5) -> DataFrame:
    """(key, clause_type, page, range_start, range_end, quote, context_before, context_after) for each of ranges (key, clause_type, first_page, last_page) whose header is found.

    The first page of the range, one more included, that has the header is taken, else the first of the whole document; where a
    page has it only with line breaks before capitals collapsed, the offset is that of the collapsed page, which has the same
    length. Without ``headers`` a type goes by the registry's header, or by its pattern of the page scan; a type without one gives
    no row. The quote runs from the header over up to ``more`` further pages, ``most`` code points, cut after the last sentence end
    past the middle. Pages are numbered from 1; null pages are empty; headers are in the common dialect, with case as given.
    """
    headers = registry.clause_headers() if headers is None else headers
    text_of = F.coalesce(F.col(body), F.lit(""))
    flat = F.regexp_replace(text_of, r"\n(?=[A-Z])", " ")
    first = lambda t, p: F.when(t.rlike(text.pattern(p, False)), F.length(F.get(F.split(t, text.pattern(p, False), 2), F.lit(0))))
    each = F.array(*(F.struct(F.lit(n).alias("clause_type"), F.coalesce(first(text_of, p), first(flat, p)).alias("at")) for n, p in sorted(headers.items())))
    hits = pages.select(key, F.col(page).alias("page"), F.explode(each).alias("h")).where("h.at IS NOT NULL").select(key, "page", "h.clause_type", "h.at")
    inside = (F.col("page") >= F.col("first_page")) & (F.col("page") <= F.col("last_page") + 1)
    best = ranges.select(key, "clause_type", "first_page", "last_page").join(hits, [key, "clause_type"]).groupBy(key, "clause_type", "first_page", "last_page").agg(F.min(F.struct((~inside).alias("outside"), "page", "at")).alias("b"))
    best = best.select(key, "clause_type", F.col("first_page").alias("range_start"), F.col("b.page").alias("found"), F.col("b.at").alias("at"))
    # the page that has the header and those after it
    near = best.join(pages.select(key, F.col(page).alias("page"), text_of.alias("t")), key).where((F.col("page") >= F.col("found")) & (F.col("page") <= F.col("found") + more))
    whole = near.groupBy(key, "clause_type", "range_start", "found", "at").agg(F.array_sort(F.collect_list(F.struct("page", "t"))).alias("p"))
    head = F.get("p", F.lit(0))["t"]
    rest = F.concat(F.substring(head, F.col("at") + 1, F.length(head)), F.array_join(F.transform(F.slice("p", 2, more), lambda x: F.concat(F.lit("\n"), x["t"])), ""))
    whole = whole.select(key, "clause_type", F.col("found").alias("page"), "range_start", F.element_at("p", -1)["page"].alias("range_end"), F.substring(head, F.lit(1), F.col("at")).alias("before"), rest.alias("rest"))
    whole = whole.withColumn("cut", cut_at_sentence(F.col("rest"), most))
    last = lambda c: F.array_join(F.reverse(F.slice(F.reverse(F.split(c, "\n", -1)), 1, lines)), "\n")
    after = F.split(F.substring(F.col("rest"), F.length("cut") + 1, F.length("rest")), "\n", -1)
    return whole.select(key, "clause_type", "page", "range_start", "range_end", text.strip(F.col("cut")).alias("quote"), text.strip(last(F.col("before"))).alias("context_before"), text.strip(F.array_join(F.slice(after, 1, lines), "\n")).alias("context_after"))


def cut_at_sentence(body: Column, most: int) -> Column:
    """At most ``most`` code points, cut after the last sentence end if that is past the middle."""
    cut = F.substring(body, 1, most)
    gap = F.locate(" .", F.reverse(cut))
    end = F.length(cut) - gap - 1
    return F.when((gap > 0) & (2 * end > most), F.substring(cut, F.lit(1), end + 1)).otherwise(cut)


def quoted(quote: Column, full: Column, n: int = 200) -> Column:
    """Whether the first n code points of a quote stand in the text, as they are or with white space squeezed."""
    head = F.substring(quote, 1, n)
    return F.contains(full, head) | F.contains(text.squeeze(full), text.squeeze(head))
