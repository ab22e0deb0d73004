"""Each operator against a brute-force version, on the small tables and on fixtures with nulls, ties, repeats and clashing names."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from lexarium.llm import chat, decontaminate, html_extract, mixing, packing, quality, queries, shard, simhash, suffix, toxicity

LONG = "alpha beta gamma " * 3000


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, very long and repeated texts, null and repeated ids, and columns named like results."""
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "one two three"), (5, "one two three"), (None, "one two three"), (None, None), (6, "x" * 5000), (7, "ONE two Three"), (8, "é ü 漢字 😀 " * 30)]
    rows = [(i, t, "en" if k % 2 else None, None if k % 3 else "s", -1, "c", "k") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int, fingerprint string, n_words string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def docs_of(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


# ------------------------------------------------------------------ 1 html


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=x>Home</a></ul></nav>
<div class="content-wrap"><main><article><h1>Head &amp; more</h1><p>First  block
of text.<p>Second <b>bold</b> &lt;tag&gt;.<aside>side</aside><form><input>mail</form><script>var a="<p>no</p>"</script>
<div class="ad">buy</div><p>Short.</p><section id="comments"><p>me too</p></section></article></main></div><div id="sidebar">links</div><footer>&copy; x</footer></body></html>"""


def test_html_article():
    assert html_extract.extract(PAGE) == "Head & more\nFirst block of text.\nSecond bold <tag>.\nShort."


def test_html_without_article():
    body = "".join(f"<p>Sentence number {k} of the body text, long enough to count as content here.</p>" for k in range(8))
    page = f'<body><div class=menu><a href=a>A</a><a href=b>B</a></div><div class=body>{body}<p>End.</p></div><div class="footer">foot</div></body>'
    assert html_extract.extract(page).split("\n") == [f"Sentence number {k} of the body text, long enough to count as content here." for k in range(8)] + ["End."]


@pytest.mark.parametrize("html", [None, "", "   ", "<div", "<p></p>", "</div></p>", "<script>x", "<nav>only menu</nav>"])
def test_html_without_text(html):
    assert html_extract.extract(html) == ""


def test_html_unclosed_and_plain():
    assert html_extract.extract("just text") == "just text"
    assert html_extract.extract('<body><div class="ad">x<article><p>kept</article>') == "kept"


_PARTS = [f"Sentence number {k} of the body text, long enough to count as content here." for k in range(6)]
_BODY = "".join(f"<p>{x}</p>" for x in _PARTS)
_MENU = '<div class="menu"><a href=a>A</a><a href=b>B</a></div>'


@pytest.mark.parametrize("page", [
    f'<body>{_MENU}<div class="content has-sidebar">{_BODY}</div><div class="sidebar">links</div></body>',
    f'<body>{_MENU}<article class="post category-notices">{_BODY}</article></body>',
    f'<body>{_MENU}<main class="with-sidebar">{_BODY}<div class="share"><a href=c>C</a></div></main></body>',
    f'<body>{_MENU}<article><div class="body with-sidebar">{_BODY}</div><div class="comments"><p>me too</p></div></article></body>',
])
def test_html_marks_of_wrappers(page):
    assert html_extract.extract(page).split("\n") == _PARTS


def test_html_marks_of_text_sections():
    page = f'<article>{_BODY}<h2 id="related-work">Related work</h2><section id="search">{_BODY}</section><section id="popular-methods">{_BODY}</section><section id="comments"><p>me too</p></section><article class="teaser">more</article></article>'
    assert html_extract.extract(page).split("\n") == [*_PARTS, "Related work", *_PARTS, *_PARTS]


_READERS = "".join(f"<p>Reader number {k} says that this is a long and well-written remark about it.</p>" for k in range(20))


@pytest.mark.parametrize("page, text", [
    (f'<body><div class="post"><h1>T</h1><p>{_PARTS[0]}</p></div><div id="comments">{_READERS}</div></body>', ["T", _PARTS[0]]),
    (f'<body><article><h1>T</h1><p>{_PARTS[0]}</p><div id="comments">{_READERS}</div></article></body>', ["T", _PARTS[0]]),
    (f'<body><article><h1>T</h1><p>{_PARTS[0]}</p></article><section class="comments-area"><article>{_READERS}</article></section></body>', ["T", _PARTS[0]]),
    (f'<body><div class="post"><p>{_PARTS[0]}</p></div><ol class="commentlist"><li><article>{_READERS}</article></li></ol></body>', [_PARTS[0]]),
    (f'<body><div id="comment-12">{_READERS}</div><div class="cookie-notice">{_BODY}{_BODY}</div><div><p>{_PARTS[0]}</p><p>{_PARTS[1]}</p></div></body>', _PARTS[:2]),
    (f'<body><form>{_READERS}</form><div><p>{_PARTS[0]}</p><p>{_PARTS[1]}</p></div></body>', _PARTS[:2]),
    (f'<body><form><h2>Write to us</h2>{_READERS}</form><article><p>{_PARTS[0]}</p></article></body>', [_PARTS[0]]),
    (f'<body><article><p>{_PARTS[0]}</p><section class="notice">{_READERS}</section><div class="ad">{_READERS}</div></article></body>', [_PARTS[0]]),
    (f'<body><h1>Title</h1><p>By me.</p><div>{_BODY}</div></body>', ["Title", "By me.", *_PARTS]),
    (f'<body><h1>Title</h1><div>{_BODY}</div><div class="sidebar">{_READERS}</div></body>', ["Title", *_PARTS]),
    (f'<body class="comments-open"><form id="aspnet"><div class="sidebar-left"><h1>T</h1>{_BODY}</div><div class="sidebar">{_READERS}</div></form></body>', ["T", *_PARTS]),
    (f'<body><div class="page-with-comments tag-cookie">{_BODY}</div></body>', _PARTS),
    (f'<body><nav><ul><li><a href=a>Home</a></ul><article>{_BODY}</article></body>', _PARTS),
    (f'<body><div id="comments">{_READERS}</div></body>', []),
    (f'<body><div hidden><article>{_READERS}</article></div><article>{_BODY}</article></body>', _PARTS),
])
def test_html_nothing_stays_by_its_size(page, text):
    """Comments, notices, forms and adverts go however long they are; a wrapper is known by the article or headline in it."""
    assert html_extract.extract(page) == "\n".join(text)


#: Start tags of the generated trees, with the rank that each has outside an article and inside one.
_STARTS = {
    "div": (0, 0), "section": (0, 0), "article": (0, 0), "main": (0, 0), "p": (0, 0), "h1": (0, 0), "h2": (0, 0), "blockquote": (0, 0), "nav": (5, 5), "aside": (5, 5), "form": (1, 1), "header": (5, 0),
    'div class="ad"': (4, 4), 'div class="post"': (0, 0), 'div class="side-menu"': (2, 2), 'div class="menu-rules"': (2, 0), 'div id="cookie-box"': (3, 0), 'div class="comments"': (6, 6), 'div id="comment-7"': (6, 6), 'div class="has-sidebar"': (0, 0),
}


def brute_extract(tree):
    """The main text of a generated tree, [start tag, children or text, inline elements], by sets of ancestors; it knows nothing of the operator's parser."""
    nodes, lines = [], []

    def walk(node, above, linked):
        start, inner, *extra = node
        k = len(nodes)
        inside = any(nodes[x]["tag"] in ("article", "main") for x in above)
        nodes.append({"tag": start.split()[0], "up": above, "rank": _STARTS.get(start, (0, 0))[inside], "named": 'class="post"' in start, "tags": 1 + 2 * sum(extra)})
        for child in inner if isinstance(inner, list) else []:
            walk(child, [*above, k], linked)
        if isinstance(inner, str):
            lines.append((inner, k))

    walk(["#page", [["body", tree]]], [], False)
    chain = lambda k: [*nodes[k]["up"], k]
    text = lambda k: any(k in chain(at) for _, at in lines)
    path = [max(nodes[x]["rank"] for x in chain(k)) for k in range(len(nodes))]
    regions = [k for k, n in enumerate(nodes) if n["tag"] in ("article", "main") and text(k) and not n["rank"]]
    heads = [k for k, n in enumerate(nodes) if (n["tag"] == "h1" or n["named"] and not n["rank"]) and text(k)]

    def left(gone):
        return [x for x in lines if not gone & set(chain(x[1]))]

    def without(cores, most):
        low = min((path[k] for k in cores if path[k] <= most), default=None)
        return {k for k, n in enumerate(nodes) if n["rank"]} - {x for k in cores if path[k] == low for x in chain(k)}

    first = regions if any(path[k] <= 4 for k in regions) else heads
    for gone in (without(first, 4 if first is regions else 2), without(regions, 5), {k for k, n in enumerate(nodes) if n["rank"] not in (0, 2)}):
        kept = left(gone)
        if kept:
            break
    ratios = [len(t) / nodes[at]["tags"] for t, at in kept]
    mean = sum(ratios) / max(1, len(ratios))
    cut = (sum((r - mean) ** 2 for r in ratios) / max(1, len(ratios))) ** 0.5
    good = []
    for i in range(len(ratios)):
        near = [(ratios[j], math.exp(-((i - j) ** 2) / 2)) for j in range(len(ratios)) if abs(i - j) <= 2]
        good.append(sum(r * w for r, w in near) / sum(w for _, w in near) >= cut)
    good = good if any(good) else [True] * len(kept)
    for i in reversed(range(len(good) - 1)):
        good[i] |= good[i + 1] and nodes[kept[i][1]]["tag"] in ("h1", "h2")
    chars = lambda k, flag: sum(len(t) for (t, at), g in zip(kept, good, strict=True) if g == flag and k in chain(at))
    held = [chars(k, True) for k in range(len(nodes))]
    fit = [k for k, n in enumerate(nodes) if n["tag"] in ("body", "article", "main", "section", "div", "blockquote") and held[k] and 10 * held[k] >= 7 * held[0]]
    start = at = max(fit, key=lambda k: len(chain(k)), default=0)
    own = max((x for x in chain(start) if nodes[x]["tag"] in ("article", "main")), default=len(nodes))
    for k in reversed(chain(start)[:-1]):
        if nodes[k]["tag"] in ("#page", "body") or k in gone or nodes[k]["rank"] >= 4:
            break
        more, other = held[k] - held[at], chars(k, False) - chars(at, False)
        if more > 0 and more >= other or own <= k and more + other:
            at = k
    whole = nodes[at]["tag"] in ("#page", "body")
    bare = {k for k, n in enumerate(nodes) if whole and not held[k] and n["tag"] in ("article", "main", "section", "div", "blockquote") and k != at}
    inside = [at in chain(k) and not bare & (set(chain(k)) - set(chain(at))) for _, k in kept]
    before = set()
    if any(inside) and not any(nodes[k]["tag"] == "h1" for (_, k), x in zip(kept, inside, strict=True) if x):
        start = inside.index(True)
        heads = [i for i in range(start) if nodes[kept[i][1]]["tag"] == "h1"]
        before = {i for i in range(heads[-1], start) if nodes[kept[i][1]]["up"] == nodes[kept[heads[-1]][1]]["up"]} if heads else set()
    return "\n".join(t for i, (t, _) in enumerate(kept) if inside[i] or i in before)


def as_html(node):
    start, inner, *extra = node
    inner = inner if isinstance(inner, str) else "".join(map(as_html, inner))
    return f"<{start}>{inner}{'<i></i>' * sum(extra)}</{start.split()[0]}>"


def test_html_against_brute_force(spark, sf_dir):
    import random

    r = random.Random(4)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    say = lambda n: " ".join(r.choices(words, k=n))
    starts = [x for x in _STARTS if x.split()[0] not in ("p", "h1", "h2")]

    def tree(depth):
        out = []
        for _ in range(r.randint(1, 4)):
            if depth and r.random() < 0.6:
                start = r.choice(["div", "div", "article", *starts])
                out.append([start, tree(depth - 1)])
            else:
                out.append([r.choice(["p", "p", "p", "h1", "h2"]), say(r.choice((1, 2, 5, 40))), r.choice((0, 0, 1, 4))])
        return out

    for _ in range(2000):
        page = tree(4)
        html = as_html(["body", page])
        assert html_extract.extract(html) == brute_extract(page), html


def test_html_pages_of_the_table(spark, sf_dir):
    """The given pages hold one article each: its text between block tags, by regular expressions."""
    import html as entities

    for x in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect():
        inner = re.sub(r"(?s)<(script|style|aside|form|nav)\b.*?</\1>|<!--.*?-->|<div class=\"ad\">.*?</div>", "", re.search(r"(?s)<article>(.*?)(</article>|<footer>|$)", x["html"])[1])
        blocks = re.split(r"</?(?:p|h\d|div|ul|ol|li|section|table|tr|td|th|blockquote|pre)\b[^>]*>", inner)
        said = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\b[^>]*>", " ", b))).split()) for b in blocks]
        assert html_extract.extract(x["html"]) == "\n".join(b for b in said if b)


_LINKS = "".join(f'<li><a href="/{k}">Topic number {k} of the site</a></li>' for k in range(60))


@pytest.mark.parametrize("wrap", ["<div><h1>Head line</h1>{}</div>", "<article><h1>Head line</h1>{}</article>", "<section><h1>Head line</h1><div>{}</div></section>"])
def test_html_ratios_decide(monkeypatch, wrap):
    """An unmarked list with more text than the article stays out by its ratios; without them it is text."""
    page = f"<body><div><ul>{_LINKS}</ul></div>{wrap.format(_BODY)}</body>"
    assert html_extract.extract(page).split("\n") == ["Head line", *_PARTS]
    monkeypatch.setattr(html_extract, "content_lines", lambda lines: [True] * len(lines))
    assert "Topic number 7" in html_extract.extract(page)


@pytest.mark.parametrize("page", [
    f"<body><div>Word</div><article><h1>Head line</h1><p>By me.</p><div>{_BODY}</div><p>The end.</p></article><div>Other</div></body>",
    f"<body><main><div><h1>Head line</h1><p>By me.</p><section><div>{_BODY}</div></section></div><p>The end.</p></main><ul>{_LINKS}</ul></body>",
])
def test_html_short_parts_of_an_article(page):
    """Short lines beside the dense part of an article are its text; a list of links there isn't, nor is what stands outside."""
    got = html_extract.extract(page).split("\n")
    assert [x for x in got if "Topic" not in x] == ["Head line", "By me.", *_PARTS, "The end."]


@pytest.mark.parametrize("page", [
    f'<article>{_BODY}<h2 id="social-impact">Social impact</h2><p id="share">Shares of it.</p><div class="promotion-rules">{_BODY}</div></article>',
    f'<body><form action="/x"><div class="menu"><a href=a>A</a></div><article>{_BODY}<h2 id="social-impact">Social impact</h2><p id="share">Shares of it.</p><div>{_BODY}</div></article></form></body>',
])
def test_html_drops_nothing_else(page):
    assert html_extract.extract(page).split("\n") == [*_PARTS, "Social impact", "Shares of it.", *_PARTS]


@pytest.mark.parametrize("page", ["<div>" * 30000 + "deep", "<div><p>" * 20000 + "deep", "<span><article>" + "<div>" * 20000 + "deep" + "</span>" * 20000, "<ul><li>" * 20000 + "deep", "<b>" * 20000 + "deep" + "<p>" * 20000])
def test_html_deep_pages(page):
    began = time.perf_counter()
    assert html_extract.extract(page) == "deep"
    assert time.perf_counter() - began < 5


def test_html_odd(spark):
    long = "<article>" + "<p>Some words of a very long page that goes on.</p>" * 20000 + "</article>"
    rows = [(1, None, "a"), (1, "<p>x y</p>", "b"), (1, "<p>x y</p>", "b"), (None, "", "c"), (2, long, "d")]
    pages = spark.createDataFrame(rows, "page_id long, html string, TEXT string")
    got = html_extract.with_main_text(pages).collect()
    assert [(r["page_id"], r["text"]) for r in got[:4]] == [(1, ""), (1, "x y"), (1, "x y"), (None, "")]
    assert got[4]["text"].count("\n") == 19999 and len(got[0]) == 3
    assert html_extract.with_main_text(pages.where("false")).count() == 0


def test_html_query(spark, sf_dir):
    got = queries.QUERIES["op1_html_extraction"](spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert all(r["n_chars"] == len(r["text"]) and "<p" not in r["text"] for r in got)


# ------------------------------------------------------------------ 2 sharding


def brute_shard(doc_id, shards):
    """The shard with the greatest of the chained 64-bit hashes of seed, shard and id, as signed numbers."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def h(s):
        out = xxhash.xxh64_intdigest(shard.SEED.to_bytes(8, "little"), 42)
        out = xxhash.xxh64_intdigest(s.to_bytes(4, "little"), out)
        return signed(out if doc_id is None else xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), out))

    return max(range(shards), key=lambda s: (h(s), s))


def test_sharding_query(spark, sf_dir):
    docs = docs_of(spark, sf_dir)
    rows = queries.QUERIES["op2_sharding"](spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(docs.keys())
    slots = {}
    for r in rows:
        text = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 16, zlib.crc32(text), "key")
        assert (r["shard"], r["grown_shard"]) == (brute_shard(r["doc_id"], 40), brute_shard(r["doc_id"], 41))
        assert r["grown_shard"] in (r["shard"], 40)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert any(r["grown_shard"] == 40 for r in rows)


def test_sharding_is_repeatable_and_shuffles(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    one = {r["doc_id"]: (r["shard"], r["slot"]) for r in shard.shard(docs, shards=3, bucket_bytes=20000).collect()}
    two = {r["doc_id"]: (r["shard"], r["slot"]) for r in shard.shard(docs.repartition(5), shards=3, bucket_bytes=20000).collect()}
    assert one == two
    in_order = sorted(one, key=one.get)
    assert in_order != sorted(in_order, key=lambda d: (one[d][0], d))


def test_permutation():
    assert sorted(shard.permutation(100, 1, 2).tolist()) == list(range(100))
    first = Counter(int(shard.permutation(4, s, 0)[0]) for s in range(4000))
    assert min(first.values()) > 850


def test_sharding_odd(odd, none):
    got = shard.shard(odd, shards=4)
    assert got.count() == odd.count() and got.columns.count("shard") == 1
    rows = got.collect()
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert all(r["shard"] == brute_shard(r["doc_id"], 4) for r in rows)
    assert shard.shard(none).count() == 0


def test_sharding_spreads_rows_of_one_id(spark):
    docs = spark.createDataFrame([(None, f"text {k} " * 60) for k in range(1000)], "doc_id long, text string")
    rows = shard.shard(docs, shards=2, bucket_bytes=1 << 14).collect()
    assert len({r["shard"] for r in rows}) == 1 and max(Counter(r["bucket"] for r in rows).values()) < 100
    assert sorted(r["slot"] for r in rows) == list(range(1000))


# ------------------------------------------------------------------ 3 mixing


def test_exponent(spark):
    import math

    sources = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10), ("z", 0)], "source string, n_tokens long")
    assert abs(mixing.exponent(sources, max_repeats=10) - 0.5) < 1e-6
    assert mixing.exponent(sources, max_repeats=1) == 1
    a = mixing.exponent(sources, max_repeats=None, entropy=1.0)
    w = [t**a for t in (1000, 100, 10)]
    assert abs(-sum(x / sum(w) * math.log(x / sum(w)) for x in w) - 1.0) < 1e-5


def test_mixing_budgets(spark):
    rows = [(i, "big" if i < 900 else "small" if i < 990 else None, "w " * (i % 7 + 1)) for i in range(1000)] + [(2000, "empty", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("epoch", F.lit("clash"))
    got = mixing.mix(docs, max_repeats=3.0).collect()
    own, size = Counter(), Counter()
    for i, s, t in rows:
        size[s] += len((t or "").split())
    times = Counter((r["doc_id"], r["source"]) for r in got)
    for r in got:
        own[r["source"]] += r["n_tokens"]
    assert set(times) == {(i, s) for i, s, _ in rows}  # no document is lost
    power = mixing.exponent(spark.createDataFrame(list(size.items()), "source string, n_tokens long"), max_repeats=3.0)
    for s in ("big", "small", None):
        want = size[s] * (size["big"] / size[s]) ** (1 - power)
        assert want - 1 <= own[s] < want + 8, s
    assert max(times.values()) <= 3 and own["small"] / size["small"] > 1.5
    assert len({r["mix_key"] for r in got}) == len(got)


def test_mixing_fixed_budget(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w w w w w") for i in range(400)], "doc_id long, source string, text string")
    assert 995 <= sum(r["n_tokens"] for r in mixing.mix(docs, budget=1000).collect()) < 1010


def test_mixing_odd(spark, odd, none):
    assert {r["doc_id"] for r in mixing.mix(odd).collect()} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    assert mixing.mix(none).count() == 0
    same = spark.createDataFrame([(None, "s", f"w{k}") for k in range(500)], "doc_id long, source string, text string")
    assert len({r["mix_key"] for r in mixing.mix(same).collect()}) == 500


def test_mixing_blocks_have_budgets(spark, none):
    """Every block has each source's part within one row, and small sources are spread over the blocks."""
    rows = [(i, "hot" if i % 3 == 0 else None if i % 97 == 1 else f"s{i % 7}", f"w{i} w", "x", -1) for i in range(6000)] + [(9000 + i, "few", "w", "x", -1) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, Block string, SLOT int")
    mixed = mixing.staged(mixing.mix(docs), "test-mix")
    got = mixing.in_blocks(mixed, block_docs=64).collect()
    assert len(got) == mixed.count() and "Block" not in got[0].asDict() and "SLOT" not in got[0].asDict()
    blocks = max(r["block"] for r in got) + 1
    assert blocks == -(-len(got) // 64)
    own, size = Counter((r["source"], r["block"]) for r in got), Counter(r["source"] for r in got)
    for s, n in size.items():
        assert {own[s, b] for b in range(blocks)} <= {n // blocks, -(-n // blocks)}, s
    full = Counter(r["block"] for r in got)
    assert max(full.values()) - min(full.values()) <= 1 and max(full.values()) <= 64
    assert sorted((r["block"], r["slot"]) for r in got) == [(b, k) for b in range(blocks) for k in range(full[b])]
    at = sorted(r["block"] for r in got if r["source"] == "few")
    gaps = [(b - a) % blocks for a, b in zip(at, at[1:] + at[:1], strict=True)]
    assert min(gaps) >= blocks / len(at) / 4 and max(gaps) <= 3 * blocks / len(at)
    assert mixing.in_blocks(mixing.mix(none)).count() == 0
    for n in range(1, 300):
        assert sorted(k * mixing.stride(n) % n for k in range(n)) == list(range(n))


# ------------------------------------------------------------------ 4 decontamination


def brute_contamination(text, items, n=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words_of = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = words_of(text), set(), set()
    for item, t in items:
        own = words_of(t)
        size = min(n, len(own))
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination(spark, odd, block_bytes):
    long = " ".join(f"w{k}" for k in range(40))
    items = [(1, long), (2, "Two three"), (3, ""), (None, "one TWO three"), (10, "漢字 😀 é"), (11, "beta gamma alpha"), (12, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    more = spark.createDataFrame([(20, f"start, {long.upper()} end", "en", "s", 0, "", ""), (21, " ".join(f"w{k}" for k in range(12)), "en", "s", 0, "", "")], odd.schema)
    docs = odd.unionByName(more)
    got = decontaminate.find_contamination(docs, bench, block_bytes=block_bytes).withColumn("n_hit", decontaminate.hit_words()).collect()
    assert len(got) == docs.count()
    named = [("null" if i is None else i, t) for i, t in items]
    for r in got:
        assert (r["n_words"], r["n_hit"], r["items"]) == brute_contamination(r["text"], named), r["doc_id"]


def test_gram_set_is_small():
    import random

    r = random.Random(3)
    vocab = ["".join(r.choices("abcdefgh", k=r.randint(1, 9))) for _ in range(5000)]
    items = [(str(k), " ".join(r.choices(vocab, k=r.randint(5, 400)))) for k in range(2000)]
    grams = decontaminate.Grams(iter(items), 13)
    assert grams.nbytes < 5 * sum(len(t.encode()) for _, t in items)
    assert decontaminate.Grams([], 13).nbytes <= 8


def test_contaminated_documents_go(spark):
    docs = spark.createDataFrame([(1, "a b c " + "x " * 56, 5), (2, "a b c " + "x " * 58, 5)], "doc_id long, text string, n_words long")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and [r["doc_id"] for r in left.collect()] == [2]
    cut = decontaminate.remove_spans(docs, bench).collect()
    assert cut[0]["text"] == " " + "x " * 56


# ------------------------------------------------------------------ 5 chat


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\\\</s>", "<\\/s>", "<", "[", "[INST", "</s", None, "", "<role>x</turn><turn>", "<<SYS>>\\n<</SYS>>", "a\nb"]
    roles = ["system", "user", "assistant", "tool", None, "</turn>"]
    rows = [(c, t, roles[(c + t) % len(roles)], nasty[(c * 5 + t * 3) % len(nasty)], "extra") for c in range(30) for t in range(6)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss string")
    formatted = chat.format_chats(turns)
    got = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    pieces = {}
    for r in sorted(formatted.collect(), key=lambda r: (r["conv_id"], r["turn_no"], r["part"])):
        pieces.setdefault(r["conv_id"], []).append(r)
    for c in range(30):
        own = [(r or "", t or "") for k, _, r, t, _ in rows if k == c]
        text = "".join(p["text"] for p in pieces[c])
        assert chat.parse(text, chat.Template()) == own
        said = "".join(t for r, t in own if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["formatted_chars"]) == (6, len(said), len(text))
        assert got[c]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_chat_order(spark):
    rows = [(1, 0, "user"), (1, 1, "assistant"), (2, 0, "assistant"), (3, 0, "system"), (3, 1, "user"), (3, 2, "user"), (None, 0, "user")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string").withColumn("text", F.lit("x"))
    assert {r["conv_id"]: r["valid"] for r in chat.digests(chat.format_chats(turns)).collect()} == {1: True, 2: False, 3: False, None: True}
    assert chat.digests(chat.format_chats(turns.where("false"))).count() == 0


def test_chat_ids_of_any_type(spark):
    rows = [("a", 0, "user", "x"), ("a", 1, "assistant", "y"), (None, 0, "user", "z"), ("b", 0, "user", "u"), ("b", 0, "user", "u")]
    turns = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").withColumns({"part": F.lit(1), "c": F.lit("clash"), "turn_no": F.lit("clash")})
    assert {r["conv_id"]: r["n_turns"] for r in chat.digests(chat.format_chats(turns)).collect()} == {"a": 2, None: 1, "b": 2}
    long = spark.range(20000).select(F.lit(1.5).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("say "), "id").alias("text"))
    (got,) = chat.digests(chat.format_chats(long)).collect()
    assert (got["conv_id"], got["n_turns"], got["valid"]) == (1.5, 20000, True)


# ------------------------------------------------------------------ 6 quality


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_quality_counts(spark, sf_dir, odd):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    docs = docs.unionByName(spark.createDataFrame([(99, "a b c\n\nx\n a b c\nx\na b c a b c\nx "), (98, "\n\n"), (97, "q\n")], "doc_id long, text string"))
    for r in quality.with_counts(docs).collect():
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == brute_counts(r["text"]), r["doc_id"]


def test_quality_fences_merge(spark):
    """Sketches give the same fences however the rows are dealt, and junk in a group of its own kind goes."""
    plain = [(i, " ".join(f"w{(i * 7 + k * 13) % 997}{'a' * (k % 5)}" for k in range(80)), "en", "s") for i in range(400)]
    junk = [(1000 + i, " ".join(f"#{k}$$%%&&{i}" for k in range(80)), "en", "s") for i in range(5)]
    docs = spark.createDataFrame(plain + junk, "doc_id long, text string, lang string, source string")
    one = {r["doc_id"]: r["kept"] for r in quality.quality(docs).collect()}
    two = {r["doc_id"]: r["kept"] for r in quality.quality(docs.repartition(7)).collect()}
    assert one == two
    assert all(one[i] for i in range(400)) and not any(one[1000 + i] for i in range(5))


def test_quality_keeps_clean_documents(spark, sf_dir):
    wide = sf_dir.replace("sf0.001", "sf0.1")
    got = queries.QUERIES["op6_quality_rules"](spark, wide).join(spark.read.parquet(f"{wide}/labels.parquet").select("doc_id", "quality"), "doc_id").where("NOT base_failed").collect()
    good, bad = [r["kept"] for r in got if r["quality"]], [r["kept"] for r in got if not r["quality"]]
    assert sum(good) >= 0.995 * len(good) and sum(bad) <= 0.02 * len(bad)


@pytest.mark.parametrize("share", [30, 40])
def test_quality_group_full_of_junk(spark, share):
    """A group that is a third junk loses the junk, whatever the other groups are, and keeps the rest."""
    say = lambda i, w: " ".join(f"{w}{(i * 7 + k * 13) % 997}{'a' * (k % 5)}" for k in range(80))
    junk = lambda i: " ".join(f"w{k}{'#$%' if k % 2 else ''}{i}" for k in range(80))
    rows = [(i, junk(i) if i % 100 < share else say(i, "w"), "en", "hot") for i in range(600)] + [(1000 + i, say(i, "v"), "en", "s") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(docs).collect()}
    assert all(kept[i] == (i >= 1000 or i % 100 >= share) for i in kept)
    counted = quality.with_counts(docs, keep=["doc_id", "lang", "source"])
    by = {r["source"]: r for r in quality.rejections(counted, quality.fences(counted)).collect()}
    assert by["hot"]["symbols"] == 6 * share and by["s"]["symbols"] == 0


def test_quality_odd(odd, none):
    got = quality.quality(odd).collect()
    assert len(got) == odd.count() and all(r["kept"] is not None for r in got)
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] == 0)
    assert quality.quality(none).count() == 0


# ------------------------------------------------------------------ 7 packing


def test_packing_is_lossless(spark, odd, none):
    import numpy as np

    length = 64
    docs = odd.select(F.monotonically_increasing_id().alias("doc_id"), "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = packing.pack(docs, length=length, block_tokens=5000).collect()
    with open(packing.VOCABULARY, "rb") as f:
        encode = packing.encoder(f.read()).encode_ordinary
    kind = packing.id_type(packing.PAD, length)
    found = {}
    for r in rows:
        ids, pos, cu = np.frombuffer(r["input_ids"], kind), np.frombuffer(r["position_ids"], kind), r["cu_seqlens"]
        assert len(ids) == len(pos) == length and cu[-1] == r["n_tokens"] <= length and (ids[cu[-1] :] == packing.PAD).all()
        for k, (d, s) in enumerate(zip(r["doc_ids"], r["starts"], strict=True)):
            found.setdefault(d, []).append((s, ids[cu[k] : cu[k + 1]].tolist()))
            assert pos[cu[k] : cu[k + 1]].tolist() == list(range(cu[k + 1] - cu[k]))
    for d, text in texts.items():
        assert [x for _, part in sorted(found.get(d, [])) for x in part] == encode(text)
    assert packing.pack(none).count() == 0
    named = odd.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text", F.lit("clash").alias("starts"), F.lit("clash").alias("id"))
    assert {d for r in packing.pack(named).collect() for d in r["doc_ids"]} == {"d3", "d4", "d5", "d6", "d7", "d8", None}


def test_packing_query(spark, sf_dir):
    import numpy as np

    with open(packing.VOCABULARY, "rb") as f:
        encode = packing.encoder(f.read()).encode_ordinary
    found = {}
    for r in queries.QUERIES["op7_token_packing"](spark, sf_dir).collect():
        ids = np.frombuffer(r["input_ids"], "<u2")
        for k, (d, s) in enumerate(zip(r["doc_ids"], r["starts"], strict=True)):
            found.setdefault(d, []).append((s, ids[r["cu_seqlens"][k] : r["cu_seqlens"][k + 1]].tolist()))
    for d, text in docs_of(spark, sf_dir).items():
        assert [x for _, part in sorted(found.get(d, [])) for x in part] == encode(text or "")


def test_best_fit_decreasing():
    import random

    for seed in range(50):
        r = random.Random(seed)
        sizes = [r.randint(1, 50) for _ in range(r.randint(0, 200))]
        free, want = [], []
        for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
            fits = [i for i in range(len(free)) if free[i] >= sizes[k]]
            if fits:
                i = min(fits, key=lambda i: free[i])
                free[i] -= sizes[k]
            else:
                free.append(50 - sizes[k])
            want = sorted(free)
        rows = packing.best_fit(sizes, 50)
        assert sorted(x for row in rows for x in row) == list(range(len(sizes)))
        assert sorted(50 - sum(sizes[k] for k in row) for row in rows) == want


# ------------------------------------------------------------------ 8 simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def brute_components(prints):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_simhash_query(spark, sf_dir):
    prints = {i: brute_fingerprint(t) for i, t in docs_of(spark, sf_dir).items()}
    want = brute_components(prints)
    for r in queries.QUERIES["op8_simhash"](spark, sf_dir).collect():
        assert (int(r["fingerprint"], 16), r["component_id"]) == (prints[r["doc_id"]], want[r["doc_id"]])


@pytest.mark.parametrize("bucket", [512, 4, 2])
def test_simhash_links(spark, bucket):
    """Clouds of near fingerprints, with small buckets so that these are cut several times."""
    import random

    r = random.Random(bucket)
    values = set()
    for _ in range(6):
        base = r.getrandbits(64)
        cloud = {base}
        for _ in range(60):
            x = r.choice(sorted(cloud))
            for b in r.sample(range(64), r.choice((1, 2, 2, 3))):
                x ^= 1 << b
            cloud.add(x)
        values |= cloud
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    label = {r["node"]: r["label"] for r in simhash.components(simhash.links(nodes, bucket=bucket)).collect()}
    want = brute_components({v: v % (1 << 64) for v in signed})
    groups = Counter(want.values())
    got = Counter(label.get(v, v) for v in signed)
    assert sorted(groups.values()) == sorted(got.values())
    assert all((label.get(a, a) == label.get(b, b)) == (want[a] == want[b]) for a in signed[:80] for b in signed[:80])


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}
    assert simhash.components(edges.where("false")).count() == 0


def test_simhash_odd(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns and Counter(r["doc_id"] for r in left.collect()) == Counter({r["component_id"] for r in got})
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_keeps_one_row_of_each_group(spark):
    """Null and repeated ids with unrelated texts: no group goes without a row, and none keeps two."""
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [(None, words(0)), (None, words(1)), (None, words(2)), (7, words(3)), (7, words(4)), (7, words(4)), (8, words(4)), (5, words(5)), (7, words(5)), (None, words(5)), (9, words(2)), (None, None), (None, words(1))]
    docs = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, digest string")
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    want = [(None, words(0)), (None, words(1)), (9, words(2)), (7, words(3)), (7, words(4)), (5, words(5)), (None, None)]
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(want)


def test_simhash_keeps_the_same_row_again(spark):
    """Of rows that share id and text but not the rest, the same one stays however the rows are dealt."""
    text = " ".join(f"w{j}" for j in range(30))
    docs = spark.createDataFrame([(5, text, k) for k in range(20)] + [(5, text, 3)] + [(None, "other words of another text", k) for k in range(5)], "doc_id long, text string, n int")
    kept = [sorted((r["doc_id"] or 0, r["n"]) for r in simhash.drop_near_duplicates(docs.repartition(p)).collect()) for p in (1, 3, 7)]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2


# ------------------------------------------------------------------ 9 suffix array


def brute_repeats(texts, length):
    """(removed, spans, kept sha256) for each text."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def test_suffix_order():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        s = np.append(rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(1, 60))), 0)
        assert suffix.suffix_order(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


@pytest.mark.parametrize("group", [512, 3])
def test_suffix_repeats(spark, group):
    import random

    r = random.Random(9)
    vocab = ["".join(r.choices("abcdéf", k=r.randint(1, 9))) for _ in range(300)]
    say = lambda n: " ".join(r.choices(vocab, k=n))
    passages = [say(60) for _ in range(4)]
    texts = []
    for k in range(60):
        parts = [say(r.randint(5, 60))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            cut = r.randint(0, 80)
            parts += [p[cut : cut + r.randint(150, 400)], say(r.randint(0, 20))]
        texts.append("".join(parts))
    counted = [f"{say(3)} {k} {passages[0][:190]}{k % 7}{say(2)}" for k in range(40)] + [f"{'b' * (k % 3)}{k} {'word ' * 50}{k}" for k in range(40)]
    texts += [*counted, "\x00ab " * 200, " \t " * 200, ("long" * 40 + " ") * 4, "漢字😀" * 80, "漢字😀" * 60]
    texts += [texts[0], texts[1][3:], None, "", "z" * 1000, "ab" * 150, passages[0], "q" * 199, "q" * 199, "\x00" * 450, "x" * 50 + passages[1] + "x" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_bytes", F.lit("clash"))
    got = {x["doc_id"]: x for x in suffix.remove_repeats(docs, group=group, sort_bytes=20000).collect()}
    for k, want in enumerate(brute_repeats(texts, 200)):
        x = got[k]
        assert (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) == want, k


def test_suffix_rows_of_one_id_with_equal_murmur_hashes(spark):
    """Two texts under null ids that Spark's 32-bit hash can't tell apart are two rows."""
    text = lambda i: " ".join(hashlib.md5(f"{i}-{j}".encode()).hexdigest() for j in range(20))
    a, b = text(63245), text(138078)
    docs = spark.createDataFrame([(None, a), (None, b), (9, b)], "doc_id long, text string")
    assert docs.select(F.hash("text").alias("h")).distinct().count() == 1
    got = Counter((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.remove_repeats(docs, with_bytes=False).collect())
    none, n = hashlib.sha256(b"").hexdigest(), len(a)
    assert got == Counter([(n, 0, 0, hashlib.sha256(a.encode()).hexdigest()), (n, n, 1, none), (n, n, 1, none)])


def test_suffix_query(spark, sf_dir):
    docs = docs_of(spark, sf_dir)
    want = dict(zip(docs, brute_repeats(docs.values(), 200), strict=True))
    got = queries.QUERIES["op9_suffix_dedup"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]


def test_suffix_odd(odd, none):
    got = suffix.remove_repeats(odd).collect()
    assert len(got) == odd.count()
    assert sum(r["n_removed"] for r in got if r["doc_id"] == 4) == len(LONG)
    assert suffix.remove_repeats(none).count() == 0
    named = suffix.remove_repeats(odd.select(F.concat(F.lit("d"), "doc_id").alias("sha"), F.col("text").alias("w"), F.lit(1).alias("n_bytes")), doc_id="sha", text="w")
    assert Counter(r["sha"] for r in named.collect()) == Counter(None if r["doc_id"] is None else f"d{r['doc_id']}" for r in odd.collect())


def test_suffix_removals_come_from_the_order(spark, monkeypatch):
    """Every repeat, those of whole copies too, is found by sorting: without its result nothing goes."""
    passage = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(1, passage), (2, passage), (3, f"x {passage} y")], "doc_id long, text string")
    assert all(r["n_removed"] > 300 for r in suffix.remove_repeats(docs).collect())
    monkeypatch.setattr(suffix, "_sorted_repeats", lambda length, sort_bytes: lambda batches: (b.slice(0, 0).select([]) for b in ()))
    assert all(r["n_removed"] == 0 for r in suffix.remove_repeats(docs).collect())


def test_hot_join(spark):
    """Keys above the limit are dealt over lots; each row still meets its match once."""
    from lexarium.llm.common import hot_join, staged

    big = spark.range(40000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).cast("long").alias("k"), F.col("id").alias("v"), F.lit("x").alias("lot"))
    small = staged(big.groupBy("k").agg(F.count("*").alias("n")).where("k < 50"), "test-small")
    for how in ("inner", "left"):
        got = hot_join(big, small, ["k"], "n", how, parts=10)
        assert sorted((r["k"], r["v"], r["n"]) for r in got.collect()) == sorted((r["k"], r["v"], r["n"]) for r in big.join(small, "k", how).collect())


# ------------------------------------------------------------------ 10 toxicity


def test_toxicity_held_out(spark, sf_dir):
    wide = sf_dir.replace("sf0.001", "sf0.1")
    got = queries.QUERIES["op10_toxicity"](spark, wide)
    known = got.where("held_out").join(spark.read.parquet(f"{wide}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    good, bad = [r["score"] for r in known if r["toxic"]], [r["score"] for r in known if not r["toxic"]]
    assert sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad)) > 0.97
    assert sum(x >= 0.3 for x in good) >= 0.9 * len(good) and sum(x >= 0.3 for x in bad) <= 0.01 * len(bad)


def brute_features(text):
    """The coordinates of a text's distinct words, stems, pairs and skip pairs, by the hashes of one word at a time."""
    import numpy as np

    from lexarium.llm.common import mix, prefix_hash, span_hash

    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    one = lambda b: int(span_hash(prefix_hash(b), np.array([0]), np.array([len(b)]))[0])
    h = [one(np.frombuffer(w.encode(), np.uint8)) for w in words]
    out = set(h) | {int(mix(np.array([one(np.frombuffer(w[:5].encode(), np.uint8)) * int(toxicity._W[0]) % (1 << 64)], np.uint64))[0]) for w in words if len(w) > 5}
    for gap, a, b in ((1, *toxicity._W[:2]), (2, *toxicity._W[2:])):
        out |= {int(mix(np.array([(x * int(a) + y * int(b)) % (1 << 64)], np.uint64))[0]) for x, y in zip(h, h[gap:], strict=False)}
    return {x >> (64 - toxicity.BITS) for x in out}


def test_toxicity_is_ftrl_proximal(spark, sf_dir):
    """Weights and scores against one coordinate at a time in plain Python, over 200 rows."""
    wide = sf_dir.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{wide}/labels.parquet").orderBy("doc_id").limit(300)
    docs = spark.read.parquet(f"{wide}/documents.parquet").join(labels.select("doc_id"), "doc_id").select("doc_id", "text")
    rows = sorted(toxicity.examples(docs, labels).collect(), key=lambda r: (r["id"], r["h"], r["label"]))[:200]
    texts = {str(r["doc_id"]): r["text"] for r in docs.collect()}
    own = [(brute_features(texts[r["id"]]), r["label"]) for r in rows]
    assert all(set(r["features"]) == f for r, (f, _) in zip(rows, own, strict=True))
    assert not {int(r["id"]) for r in rows} & {d for d in range(100000) if zlib.crc32(str(d).encode()) % 4 == 2}
    import numpy as np

    z, n, size = {}, {}, 1 << toxicity.BITS
    alpha, beta, l1, l2 = 0.5, 1.0, 0.2, 0.1

    def weight(k):
        if k != size and abs(z.get(k, 0.0)) <= l1:
            return 0.0
        shrunk = z.get(k, 0.0) - (0 if k == size else math.copysign(l1, z[k]))
        return -shrunk / ((beta + math.sqrt(n.get(k, 0.0))) / alpha + l2)

    for p in range(2):
        for i in np.random.default_rng([toxicity.SEED, p]).permutation(len(own)):
            f, y = own[i]
            w = {k: weight(k) for k in [*f, size]}
            g = 1 / (1 + math.exp(-max(-40.0, min(40.0, sum(w.values()))))) - y
            for k in w:
                sigma = (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / alpha
                z[k] = z.get(k, 0.0) + g - sigma * w[k]
                n[k] = n.get(k, 0.0) + g * g
    import pyarrow as pa

    model = toxicity.fit([(np.array(sorted(f)), y) for f, y in own], passes=2, alpha=alpha, beta=beta, l1=l1, l2=l2)
    want = {k: weight(k) for k in z if k != size and weight(k)}
    got = dict(zip(model.index.tolist(), model.weight.tolist(), strict=True))
    assert got.keys() == want.keys() and len(want) > 50 and all(abs(got[k] - want[k]) < 1e-8 for k in want) and abs(model.bias - weight(size)) < 1e-8
    probe = [texts[r["id"]] for r in rows[:40]] + [None, ""]
    for x, t in zip(toxicity.score(pa.array(probe, pa.string()), model, model.dense()), probe, strict=True):
        assert abs(x - 1 / (1 + math.exp(-sum(want.get(k, 0.0) for k in brute_features(t)) - weight(size)))) < 1e-8


def test_toxicity_sample_is_bounded(spark):
    """A repeated id or row doesn't fill the sample; rows beyond the bounds are left to chance, very long texts are left out."""
    docs = spark.createDataFrame([(1, "same words here")] * 500 + [(k, f"text {k} of many " * 5) for k in range(3000)] + [(5000, "x " * (1 << 19) + "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 50 + [(k, 0) for k in range(3000)] + [(5000, 1)], "doc_id long, toxic int")
    rows = toxicity.examples(docs, labels, sample={1: 10, 0: 400}).collect()
    by = Counter(r["label"] for r in rows)
    assert by[1] <= 3 and 300 < by[0] < 500 and "5000" not in {r["id"] for r in rows}
    few = toxicity.examples(docs, labels, sample_bytes=4000).collect()
    assert len(few) < 100
    with pytest.raises(ValueError, match="held-out"):
        toxicity.examples(docs, labels, folds=(0, 2))


def test_toxicity_odd(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 0), (None, 1), (7, None), (8, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    got = toxicity.with_score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.drop_toxic(odd, model).columns == odd.columns
    assert toxicity.with_score(none, model).count() == 0
    blank = toxicity.train(odd, labels.where("false"))
    assert {r["score"] for r in toxicity.with_score(odd, blank).collect()} == {0.5}
