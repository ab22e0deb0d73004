"""The alignment of two tokenizers against a plain version that walks both token lists."""

import hashlib
from collections import Counter

import pytest

from lexarium.llm import align, queries


@pytest.fixture(scope="module")
def encoders():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(align.BYTE_BPE), SentencePieceProcessor(model_file=align.PIECE_BPE)
    one.encode_special_tokens = True
    with open(align.BYTE_BPE, "rb") as f:
        alphabet = f.read()
    return one, two, align.bytes_of_a(alphabet), align.bytes_of_b(two)


def brute(encoders, docs):
    """One row a document, from dicts of ends to tokens."""
    one, two, of_a, of_b = encoders
    links, rows = {}, {}
    for i, (doc_id, t) in enumerate(docs):
        a = one.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        b = two.encode(t) if t else []
        whole = (" " + (t or "")).encode()
        if b"".join(of_a[x] for x in a) != whole or b"".join(of_b[x] for x in b) != whole:
            a, b = [], []
        ends = []
        for ids, of in ((a, of_a), (b, of_b)):
            at, own = 0, {}
            for x in ids:
                at += len(of[x])
                own[at] = x
            ends.append(own)
        common = sorted(ends[0].keys() & ends[1].keys())
        groups, low = [], 0
        for high in common:
            groups.append("|".join(",".join(str(x) for at, x in sorted(own.items()) if low < at <= high) for own in ends))
            low = high
        links[i] = [(ends[0][at], ends[1][at]) for at in common]
        rows[i] = [doc_id, len(a), len(b), len(groups), len(common), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""]
    counts = Counter(x for own in links.values() for x in own)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [[*rows[i], sum(counts[x] == top[x[1]] for x in links[i]), sum(counts[x] for x in links[i])] for i in rows]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def rows_of(df):
    return sorted(([r[c] for c in COLUMNS] for r in df.collect()), key=repr)


def test_alignment_query(spark, sf_dir, encoders):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op11_tokenizer_alignment(spark, sf_dir)) == sorted(brute(encoders, docs), key=repr)


@pytest.mark.parametrize("shard_rows", [3, 1 << 20])
def test_alignment_odd(spark, encoders, shard_rows):
    """Null, empty, repeated and very long texts, strings of special tokens, bytes that neither knows, a character that B can't give back."""
    texts = [None, "", " ", "one two", "one two", "ONE  two\n\n\tthree", "<|endoftext|> <s> </s> <unk>", "é ü 漢字 😀 ́‍", "a▁b", "x" * 3000, "alpha beta gamma " * 2000, "\r\n\x00\x07"]
    docs = [(k if k % 5 else None, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "n", "g") for i, t in docs], "doc_id long, text string, n_a string, groups_sha256 string").repartition(3)
    got = rows_of(align.align(df, shard_rows=shard_rows))
    assert got == sorted(brute(encoders, docs), key=repr)
    assert [r[1:] for r in got if r[0] == 8] == [[0, 0, 0, 0, "", 0, 0]]


def test_alignment_groups_give_the_text_back(spark, encoders):
    _, _, of_a, of_b = encoders
    text = "Über naïve 漢字 tokens, 12345 <0x0A>\n"
    r = align.with_links(spark.createDataFrame([(text,)], "text string")).first()
    assert r["n_groups"] == len(r["a"]) == len(r["b"]) > 5
    own = align.Aligner(align.vocabulary(align.BYTE_BPE), align.vocabulary(align.PIECE_BPE))
    a, b, _ = own.encoded([text])
    assert b"".join(of_a[x] for x in a[0]) == b"".join(of_b[x] for x in b[0]) == (" " + text).encode()


def test_alignment_empty(spark):
    df = align.align(spark.createDataFrame([], "doc_id string, text string"))
    assert df.columns == COLUMNS and df.collect() == [] and df.schema["doc_id"].dataType.simpleString() == "string"


def test_counts_are_in_sorted_shards(spark):
    """Pairs over many shards, in runs that batches cut, are counted once."""
    links = spark.range(5000).selectExpr("array(int(id % 7), int(id % 11)) AS a", "array(int(id % 5), 3) AS b")
    counts = align.count_pairs(links, shard_rows=10)
    want = Counter()
    for k in range(5000):
        want.update([(k % 5) << 32 | k % 7, 3 << 32 | k % 11])
    keys = sorted(want)
    import numpy as np

    assert len(counts.shards) > 3
    assert counts.of(np.array([*keys, 1 << 50])).tolist() == [*(want[k] for k in keys), 0]
    assert counts.top.tolist() == [max(n for k, n in want.items() if k >> 32 == b) for b in range(5)]


def test_vocabulary_is_bounded(monkeypatch):
    monkeypatch.setattr(align, "VOCABULARY_BYTES", 1000)
    with pytest.raises(ValueError):
        align.vocabulary(align.BYTE_BPE)


def test_ranks_and_merges_agree(sf_dir):
    """Texts that are encoded by ranks get the ids that the merges give."""
    import random

    import pyarrow.parquet as pq

    own = align.Aligner(align.vocabulary(align.BYTE_BPE), align.vocabulary(align.PIECE_BPE))
    rng = random.Random(3)
    letters = [chr(c) for c in range(256)]
    texts = ["".join(rng.choices(letters if k % 2 else " \n\t\r'sdtlvemx0.\u00a0\u0085", k=rng.randrange(60))) for k in range(20000)]
    texts += [x or "" for x in pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"])["text"].to_pylist()]
    texts += ["<|endoftext|> it's WE'LL", " " * 60000 + "x", "\n" * 65535, "ab" * 32000, "'" * 5000, "1" * 9000]
    quick = [t for t in texts if align._plain(t)]
    assert own.ranked is not None and len(quick) > 20000
    assert [own.ranked.encode_ordinary(t) for t in quick] == [e.ids for e in own.one.encode_batch_fast(quick, add_special_tokens=False)]
    assert own.by_a(texts) == [e.ids for e in own.one.encode_batch_fast(texts, add_special_tokens=False)]
