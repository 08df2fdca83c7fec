"""Operators 2, 7 and 9 against the tokenizers library and exact round trips."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from civicspark.llm import bpe, chat, packing
from civicspark.llm.queries import op7_chat, op9_packing, vocabulary, word_pattern
from civicspark.llm.support import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", "   ", "Σ ΑΣ ΌΣΟΣ İstanbul", "a\x85b\x1cc\x1dd", "<|endoftext|>x <|startoftext|>", "don't I'LL 12½³ ①",
    "日本語 テキスト😀", "é é Å", "a" * 20000, "x " * 20000, "\x00\x01", "same", "same", "ﬀ ẞ ǅ",
]


@pytest.fixture
def odd(spark):
    rows = [(i, t, "clash", None) for i, t in enumerate(ODD)] + [(None, "no id", None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens string")


def test_bpe_equals_the_library(spark, odd):
    lib = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    want = sorted(
        (str(r.doc_id), len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(lib.decode(ids, skip_special_tokens=False)))
        for r in docs.collect() for ids in [lib.encode(r.text or "", add_special_tokens=False).ids])
    got = sorted((str(r[0]), *r[1:]) for r in bpe.token_digests(docs, vocabulary("word_bpe_49k.json")).collect())
    assert got == want


def test_bpe_texts_and_decoding(odd):
    coder = bpe.encoder(vocabulary("word_bpe_49k.json"))
    rows = bpe.encode_documents(odd, vocabulary("word_bpe_49k.json")).collect()
    assert len(rows) == len(ODD) + 1
    assert all(coder.decode([int(i) for i in r.ids.split()]) == r.decoded for r in rows)


def test_bpe_empty_table(odd):
    assert bpe.token_digests(odd.limit(0), vocabulary("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "\\### Assistant: </turn> ok", "</turn></turn>###\\", "plain", "\\\\###"])
def test_escape_is_reversible_and_hides_controls(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text
    stripped = safe.replace("\\\\", "")
    assert all(stripped.count(c) == stripped.count("\\" + c) for c in chat.CONTROLS)


def digests(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.conv_id].append(r)
    out = []
    for conv, turns in by.items():
        turns.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
        loss = "".join(r.text or "" for r in turns if r.role == "assistant")
        out.append((str(conv), len(turns), brute.sha("".join(f"{r.role or ''}\n{r.text or ''}\n" for r in turns)), len(loss), brute.sha(loss)))
    return sorted(out)


def test_chat_reads_back_every_turn(spark):
    turns = chat.with_control_case(table(spark, SF, "conversations"))
    got = sorted((str(r[0]), *r[1:5]) for r in op7_chat(spark, SF).collect())
    assert got == digests(turns.collect())
    assert any(r[0] == "-7" and r[3] == 26 * 2 // 2 for r in got)


def test_chat_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 1, "assistant", ""), (1, 1, "assistant", "<|endoftext|> a\n"), (1, None, "user", "### \\"),
            (None, 0, "user", "x"), (2, 0, "assistant", "y" * 30000), (2, 0, "assistant", "y" * 30000)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    wide = turns.selectExpr("*", "'z' AS ids", "1 AS n_turns", "'q' AS formatted")
    got = sorted((str(r[0]), *r[1:5]) for r in chat.conversation_digests(wide, vocabulary("byte_bpe_50k.json")).collect())
    assert got == digests(turns.collect())
    assert chat.conversation_digests(wide.limit(0), vocabulary("byte_bpe_50k.json")).count() == 0


def check_pieces(pieces, docs):
    lib = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = defaultdict(int)
    for r in docs:
        want[r.doc_id, tuple(lib.encode(r.text or "", add_special_tokens=False).ids) + (1,)] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for (doc_id, ids), n in want.items():
        if n > 1 or doc_id is None:
            continue
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    padding = 0
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.SEQUENCE
        padding += 0 if at & (at - 1) == 0 else packing.SEQUENCE - at
    assert padding == 0
    assert sum(p.length for p in pieces) == sum(len(ids) * n for (_, ids), n in want.items())


def test_packing_holds_every_id_once(spark):
    check_pieces(op9_packing(spark, SF).collect(), table(spark, SF, "documents").collect())


def test_packing_odd_rows(odd):
    args = vocabulary("byte_bpe_50k.tiktoken"), word_pattern(), brute.SPECIAL, 50256
    check_pieces(packing.pack(odd, *args).collect(), odd.collect())
    assert packing.pack(odd.limit(0), *args).count() == 0


def test_hilbert_curve_visits_neighbours():
    grid = np.array(np.meshgrid(*[np.arange(8)] * 3, indexing="ij")).reshape(3, -1).T
    keys = packing.hilbert_keys(grid, 3)
    assert sorted(keys) == list(range(512))
    assert np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1).max() == 1


def test_copies_are_neighbours_on_the_curve(spark):
    rows = [(i, f"alpha beta gamma {i % 5} " * (20 + i % 5)) for i in range(100)]
    args = vocabulary("byte_bpe_50k.tiktoken"), word_pattern(), brute.SPECIAL, 50256
    coded = packing.encode_rows(spark.createDataFrame(rows, "doc_id bigint, text string"), *args).collect()
    keys = defaultdict(set)
    for r in coded:
        keys[r.doc_id % 5].add(r.key)
    assert all(len(k) == 1 for k in keys.values())


def test_hash_helper():
    assert brute.sha("") == hashlib.sha256(b"").hexdigest()
