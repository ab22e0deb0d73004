"""A Python data source, batch and stream, over paged search services: by offset, page number or GraphQL, in smaller pages after errors.

The transport is a function (url, parameters) -> decoded JSON, so tests and offline runs bring their own.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

Fetch = Callable[[str, dict], dict]


def http(url: str, params: dict, tries: int = 4, wait: float = 1.0, agent: str = "lexarium") -> dict:
    """GET with retries after 429 and 5xx answers, waiting twice as long each time."""
    for k in range(tries):
        try:
            with urlopen(Request(f"{url}?{urlencode(params)}", headers={"User-Agent": agent}), timeout=60) as r:  # noqa: S310
                return json.load(r)
        except OSError as e:
            code = getattr(e, "code", 503)
            if k + 1 == tries or (code != 429 and code < 500):
                raise
            time.sleep(wait * 2**k)
    raise AssertionError


def pages(fetch: Fetch, url: str, params: dict, items: Callable[[dict], list], size: int = 100, offset: str = "from", limit: str = "size", smallest: int = 10) -> Iterator[dict]:
    """The items of all pages; a page that fails is asked for again in halves down to ``smallest``."""
    at = 0
    while True:
        own = size
        while True:
            try:
                got = items(fetch(url, params | {offset: at, limit: own}))
                break
            except OSError:
                if own // 2 < smallest:
                    raise
                own //= 2
        yield from got
        at += len(got)
        if len(got) < own:
            return


def numbered(fetch: Fetch, url: str, params: dict, items: Callable[[dict], list], size: int = 100, page: str = "page", limit: str = "size", first: int = 0, smallest: int = 1) -> Iterator[dict]:
    """The items of all numbered pages. A page that fails is asked for again in halves, whose numbers follow from their size; one of ``smallest`` items that still fails is passed over."""
    at = 0
    while True:
        own = size
        while True:
            try:
                got = items(fetch(url, params | {page: first + at // own, limit: own}))
                break
            except OSError:
                if own <= smallest:
                    got = None
                    break
                own = max(smallest, own // 2)
                while at % own:
                    own //= 2
        if got is None:
            at += own
            continue
        yield from got
        at += own
        if len(got) < own:
            return


def graphql(query: str, post: Callable[[str, dict], dict]) -> Fetch:
    """A transport that sends a query with the parameters as variables; an answer with errors counts as failed, so that it is asked for in smaller pages."""

    def fetch(url: str, params: dict) -> dict:
        answer = post(url, {"query": query, "variables": params})
        if answer.get("errors"):
            raise OSError(str(answer["errors"]))
        return answer.get("data") or {}

    return fetch


def post_json(url: str, body: dict, agent: str = "lexarium") -> dict:
    with urlopen(Request(url, data=json.dumps(body).encode(), headers={"User-Agent": agent, "Content-Type": "application/json"}), timeout=60) as r:  # noqa: S310
        return json.load(r)


def spaced(fetch: Fetch, seconds: float) -> Fetch:
    """fetch, with at least so many seconds from one request to the next."""
    last = [0.0]

    def own(url: str, params: dict) -> dict:
        time.sleep(max(0.0, last[0] + seconds - time.monotonic()))
        last[0] = time.monotonic()
        return fetch(url, params)

    return own


def _at(answer: dict | None, path: str):
    for p in path.split("."):
        answer = (answer or {}).get(p)
    return answer


class Service:
    """A search service by its options: url; mode (offset, page or graphql, with a document); items and total, paths to the list and to
    the number of all items; size and smallest, of pages; queries, parted by |."""

    def __init__(self, options: dict, fetch: Fetch, post: Fetch):
        self.url, self.mode = options["url"], options.get("mode", "offset")
        if self.mode not in ("offset", "page", "graphql"):
            raise ValueError(f"no mode {self.mode}")
        self.fetch = graphql(options["document"], post) if self.mode == "graphql" else fetch
        self.list, self.count = options.get("items", "hits.hits"), options.get("total", "hits.total.value")
        self.size, self.smallest, self.first = int(options.get("size", 100)), int(options.get("smallest", 1)), int(options.get("first", 0))
        self.queries = options.get("queries", "").split("|")

    def items(self, answer: dict) -> list:
        return _at(answer, self.list) or []

    def all(self, query: str) -> Iterator[dict]:
        """Every item, page by page until a short one."""
        walk = numbered if self.mode == "page" else pages
        more = {"first": self.first} if self.mode == "page" else {}
        return walk(self.fetch, self.url, {"q": query}, self.items, self.size, smallest=self.smallest, **more)

    def total(self, query: str) -> int:
        """How many items there are now."""
        own = {"page": self.first} if self.mode == "page" else {"from": 0}
        return int(_at(self.fetch(self.url, {"q": query, "size": 1, **own}), self.count) or 0)

    def between(self, query: str, start: int, end: int) -> Iterator[dict]:
        """The items start to end - 1, which the service has said that it has; one that can't be had is an error, so that none is lost.

        Numbered pages begin at multiples of their size: of those around an item the largest that can be had is taken.
        """
        at = start
        while at < end:
            own = self.size
            while True:
                own = max(own, 1)
                low = at // own * own if self.mode == "page" else at
                where = {"page": self.first + low // own} if self.mode == "page" else {"from": at}
                try:
                    got = self.items(self.fetch(self.url, {"q": query, "size": own, **where}))
                    break
                except OSError:
                    if own <= self.smallest:
                        raise
                    own //= 2
            part = got[at - low : end - low]
            if not part:
                raise OSError(f"{self.url} has no item {at} of {end}")
            yield from part
            at += len(part)


class Part(InputPartition):
    def __init__(self, query: str, start: int = 0, end: int | None = None):
        self.query, self.start, self.end = query, start, end


def _rows(query: str, items: Iterator[dict]) -> Iterator[tuple]:
    for item in items:
        yield query, json.dumps(item, ensure_ascii=False)


class _Reader(DataSourceReader):
    """A query is a partition."""

    def __init__(self, service: Service):
        self.service = service

    def partitions(self) -> list[Part]:
        return [Part(q) for q in self.service.queries]

    def read(self, partition: Part) -> Iterator[tuple]:
        return _rows(partition.query, self.service.all(partition.query))


class _Stream(DataSourceStreamReader):
    """New items of each query as they are added at its end. The offset is how many of each have been read, so that Spark's checkpoint
    knows what is left; a batch's items are read in parts of a page."""

    def __init__(self, service: Service):
        self.service = service

    def initialOffset(self) -> dict:
        return {q: 0 for q in self.service.queries}

    def latestOffset(self) -> dict:
        return {q: self.service.total(q) for q in self.service.queries}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        size = self.service.size
        return [Part(q, a, min(a + size, end[q])) for q in end for a in range(start.get(q, 0), end[q], size)]

    def read(self, partition: Part) -> Iterator[tuple]:
        return _rows(partition.query, self.service.between(partition.query, partition.start, partition.end))

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the offsets."""


class SearchSource(DataSource):
    """``format("paged_search")`` with the options of ``Service``, for ``spark.read`` and ``spark.readStream``; rows (query, item as JSON)."""

    fetch: Fetch = staticmethod(http)
    post: Fetch = staticmethod(lambda url, body: post_json(url, body))

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return "query string, item string"

    def _service(self) -> Service:
        return Service(dict(self.options), type(self).fetch, type(self).post)

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self._service())

    def streamReader(self, schema: StructType) -> _Stream:
        return _Stream(self._service())
