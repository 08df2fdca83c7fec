"""Operator 13 against the library with the same ranks."""

import hashlib
import random
import unicodedata

import pytest
import tiktoken

from civicspark.llm import recursive_bpe as rb
from civicspark.llm.queries import op13_recursive_bpe, vocabulary, word_pattern
from civicspark.llm.support import table

SF = "/root/testdata/sf0.01"
RANKS = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def bpe():
    return rb.encoder(vocabulary(RANKS), word_pattern())


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=word_pattern(), mergeable_ranks=bpe.ranks, special_tokens={})


def both(bpe, texts):
    ids, decoded = [[] for _ in texts], [b""] * len(texts)
    for row, some, code in bpe.encoded(texts):
        ids[row] += map(int, some.split(","))
        decoded[row] += code
    return ids, decoded


def same(bpe, library, texts):
    ids, decoded = both(bpe, texts)
    assert ids == [library.encode_ordinary(t or "") for t in texts]
    assert decoded == [(t or "").encode() for t in texts]


def test_every_kind_of_character(bpe, library):
    kinds = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"][::5]
    white = [c for c in map(chr, range(0x3001)) if c.isspace()]
    same(bpe, library, [f"a{c}b {c}{c} 1{c}" for c in kinds + white])
    draw = random.Random(5)
    same(bpe, library, ["".join(draw.choices(kinds[:400] + white + list("abc AB'1") * 20, k=60)) for _ in range(300)])


def test_long_words_and_runs(bpe, library):
    same(bpe, library, [c * n for c in ("=", " ", "ab", "aab", "é") for n in (1, 2, 3, 31, 32, 33, 64, 65, 200, 999)])
    same(bpe, library, ["".join(random.Random(n).choices("etaoinshr", k=n)) for n in (60, 70, 300, 900)])


def test_pieces_of_long_texts_and_forgetting(bpe, library, monkeypatch):
    for name, value in (("CHUNK", 500), ("SEGMENT", 7), ("REMEMBERED", 20), ("QUERY_BYTES", 50)):
        monkeypatch.setattr(rb, name, value)
    same(bpe, library, ["some words, 1234 and more " * 100, None, "x " * 900, "", "one two three four " * 3, "it's\n\n  so "] * 2)


def test_rows_of_odd_tables(spark, bpe, library):
    rows = [(1, None, "c"), (2, "", "c"), (3, "Hello, world", "c"), (3, "Hello, world", "c"), (None, "naïve café 日本", "c"), (4, "word " * 300_000, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = rb.encode_documents(docs, vocabulary(RANKS), word_pattern()).collect()
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows]
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in got), key=repr) == sorted(want, key=repr)
    assert rb.token_digests(docs.limit(0), vocabulary(RANKS), word_pattern()).collect() == []


def test_digests_of_the_whole_table(spark, library):
    got = sorted(tuple(r) for r in op13_recursive_bpe(spark, SF).collect())
    want = []
    for r in table(spark, SF, "documents").collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)
