"""Pages of HTML and text files, from their bytes; other kinds through registered parsers.

Parsers are row functions over whole files, in Arrow batches. A parser takes bytes and gives pages.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BREAK = "\x00break\x00"
# What makes a page break, the page marker of text files, and the envelope of filings.
BEFORE = re.compile(r"page-break-before\s*:\s*always", re.IGNORECASE)
AFTER = re.compile(r"page-break-after\s*:\s*always", re.IGNORECASE)
PAGE = "<PAGE>"
ENVELOPE = re.compile(r"\A\s*<DOCUMENT>.*?<TEXT>\s*", re.DOTALL | re.IGNORECASE)
BODY = re.compile(r"<TEXT>\s*(.*?)\s*</TEXT>", re.DOTALL | re.IGNORECASE)
MARKUP = re.compile(r"<(?:html|body|div|table|p|font)\b", re.IGNORECASE)


def decode(raw: bytes) -> str:
    """UTF-8, else Windows-1252, else Latin-1."""
    for name in ("utf-8", "cp1252"):
        try:
            return raw.decode(name)
        except UnicodeDecodeError:
            pass
    return raw.decode("latin-1")


class _Text(HTMLParser):
    """Text between tags, without scripts and styles, and marks at page breaks."""

    VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.quiet = 0
        self.open: list[tuple[str, bool]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.quiet += 1
        style = dict(attrs).get("style") or ""
        after = False
        if BEFORE.search(style):
            self.parts.append(BREAK)
        elif AFTER.search(style):
            after = True
        if tag in self.VOID:
            self.parts += [BREAK] * after
        else:
            self.open.append((tag, after))

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.quiet = max(0, self.quiet - 1)
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.parts += [BREAK] * sum(a for _, a in self.open[k:])
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        if not self.quiet:
            self.parts.append(data)


def _tidy(text: str) -> str:
    return "\n".join(x for line in text.splitlines() if (x := line.strip()))


def html_pages(html: str) -> list[str]:
    """The pages of an HTML text, cut at CSS page breaks; blank ones are dropped."""
    reader = _Text()
    reader.feed(html)
    reader.close()
    return [p for x in "\n".join(reader.parts).split(BREAK) if (p := _tidy(x))]


def text_pages(text: str) -> list[str]:
    """The pages of a plain text, cut at page markers; without markers it is one page as it stands."""
    if PAGE not in text:
        return [text]
    pages = [p.strip() for p in ENVELOPE.sub("", text).split(PAGE)]
    return pages[not pages[0] : len(pages) - (len(pages) > 1 and not pages[-1])]


def filing_pages(raw: str, name: str = "") -> list[str]:
    """The pages of a filing in its envelope: HTML by extension or looks, else text."""
    found = BODY.search(raw)
    body = found[1] if found else raw
    return html_pages(body) if name.lower().endswith((".htm", ".html")) or MARKUP.search(body[:2000]) else text_pages(body)


Parser = Callable[[bytes], list[str]]
PARSERS: dict[str, Parser] = {"html": lambda b: html_pages(decode(b)), "text": lambda b: text_pages(decode(b)), "filing": lambda b: filing_pages(decode(b))}


def register(name: str, parser: Parser) -> None:
    """Adds a parser, such as one for PDF files."""
    PARSERS[name] = parser


def parse(files: DataFrame, parser: str, key: str = "path", content: str = "content", tool: str | None = None, version: str = "1.0.0") -> DataFrame:
    """(key, page, text, char_count, parse_tool, parse_version, error): the pages of each file; one row without page for a file that fails or has none."""
    own = PARSERS[parser]
    kind = files.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, raw in zip(batch[key], batch[content], strict=True):
                try:
                    pages, error = own(bytes(raw)) if raw is not None else [], None
                except Exception as e:  # noqa: BLE001  a bad file is a row, not the end of the job
                    pages, error = [], f"{type(e).__name__}: {e}"
                rows += [(k, n, t, len(t), error) for n, t in enumerate(pages)] or [(k, None, None, 0, error)]
            out = pd.DataFrame(rows, columns=[key, "page", "text", "char_count", "error"])
            out["page"] = out["page"].astype("Int32")
            yield out

    pages = files.select(key, content).mapInPandas(run, f"{key} {kind}, page int, text string, char_count int, error string")
    return pages.select(key, "page", "text", "char_count", F.lit(tool or parser).alias("parse_tool"), F.lit(version).alias("parse_version"), "error")


def headers(parsed: DataFrame, key: str = "path") -> DataFrame:
    """(key, page_count, parse_tool, parse_version, parse_status, error, parsed_at): the header table of a parse; status ok, empty or failed."""
    n = parsed.groupBy(key, "parse_tool", "parse_version").agg(F.count("page").cast("int").alias("page_count"), F.sum("char_count").alias("chars_"), F.max("error").alias("error"))
    state = F.when(F.col("error").isNotNull(), "failed").when(F.coalesce("chars_", F.lit(0)) == 0, "empty").otherwise("ok")
    return n.select(key, "page_count", "parse_tool", "parse_version", state.alias("parse_status"), "error", F.current_timestamp().alias("parsed_at"))
