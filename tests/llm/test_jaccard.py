"""Operator 3 against brute force."""

import random
from fractions import Fraction

import numpy as np
import pytest

from civicspark.llm import jaccard_join as jj
from civicspark.llm.queries import op3_jaccard_join
from civicspark.llm.shingles import Hasher
from civicspark.llm.support import table
from tests.llm import brute


def want(rows):
    docs = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    root = brute.components(docs, brute.jaccard_links(docs))
    return sorted((str(r.doc_id), len(brute.shingles(r.text)), str(root.get(r.doc_id))) for r in rows)


def shown(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def test_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    assert shown(op3_jaccard_join(spark, sf)) == want(table(spark, sf, "documents").collect())


@pytest.fixture
def planted(spark):
    """Families around the threshold, common passages, copies, short, empty and very long texts."""
    draw = random.Random(3)
    word = lambda: "w%d" % draw.randrange(4000)
    passage = [word() for _ in range(60)]
    texts = []
    for size in (4, 5, 6, 7, 8, 10, 14, 20, 40, 90, 200, 500, 900):
        for _ in range(4):
            base = [word() for _ in range(size)]
            texts.append(base)
            for edits in sorted({1, max(1, size // 60), max(1, size // 35), max(1, size // 28), max(1, size // 20)}):
                changed = list(base)
                for at in draw.sample(range(size), min(size, edits)):
                    changed[at] = word()
                texts.append(changed)
            texts.append(base + [word() for _ in range(size // 4)])
            texts.append(base[: size - size // 5])
    for _ in range(60):
        extra = [word() for _ in range(draw.randrange(20, 120))]
        texts.append(extra[:10] + passage + extra[10:])
    rows = [" ".join(t) for t in texts]
    rows += [None, "", "  \t", "one", "ONE", "one two", "a\x85b c", "Äb äb", "same words here", "same words  here\n", "x " * 30000, "x " * 29000, " ".join(f"v{i}" for i in range(20000))]
    rows += [" ".join(f"v{i}" for i in range(19000)), *["copy " + " ".join(map(str, range(30)))] * 5]
    listed = [(k * 7 % 1009 + 5, t, "clash", 1, None, "k") for k, t in enumerate(rows)]
    listed += [listed[0], listed[3], (None, rows[0], None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(listed, "doc_id bigint, text string, id string, n int, a string, key string")


def test_planted_families(planted):
    got, rows = shown(jj.join(planted)), planted.collect()
    assert len({r[2] for r in got}) < len(got)
    assert got == want(rows)


def test_other_costs_find_the_same_pairs(planted, monkeypatch):
    monkeypatch.setattr(jj, "FREQUENT", 2)
    monkeypatch.setattr(jj, "CHUNK", 3000)
    monkeypatch.setattr(jj, "COPIED", 0)
    assert shown(jj.join(planted)) == want(planted.collect())


def test_empty_table(planted):
    assert jj.join(planted.limit(0)).count() == 0


def test_linked_sets_always_share_a_searched_signature():
    draw, bands = np.random.default_rng(1), jj.Bands(Fraction(3, 4))
    none = np.empty(0, np.uint64), np.empty(0)
    for n in [*range(1, 60), 100, 333, 1000]:
        for _ in range(6):
            x = np.unique(draw.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            gone = int(draw.integers(0, n // 4 + 1))
            more = max(0, len(x) - gone) * 4 // 3 - len(x)
            y = np.unique(np.r_[x[draw.permutation(len(x))[gone:]], draw.integers(0, 2**63, max(0, more)).astype(np.uint64)])
            common = len(np.intersect1d(x, y))
            if 4 * common < 3 * (len(x) + len(y) - common):
                continue
            hot = np.sort(draw.choice(x, len(x) // 2, replace=False))
            for h, c in (none, (hot, np.arange(len(hot)) + 1.0)):
                s, t = jj.signatures(x, bands, h, c), jj.signatures(y, bands, h, c)
                searched = set(s[(s & np.uint64(1)) == 0].tolist())
                assert searched & {v & ~1 for v in t.tolist()}


def test_shingles_of_words():
    hasher = Hasher()
    for text in ("a b c d e f", "A B  c d\te", "a b", "", "a a a a a a a a", "é É b c d e"):
        assert len(hasher.members(text)) == len(brute.shingles(text))


@pytest.fixture
def small_tiles(monkeypatch):
    monkeypatch.setattr(jj, "TILE", 7)
    monkeypatch.setattr(jj, "FEW", 3)


def test_planted_families_in_small_tiles(planted, small_tiles):
    assert shown(jj.join(planted)) == want(planted.collect())


def test_family_of_loose_copies(spark, small_tiles):
    """Many edits of one text: most pairs lie below the threshold, some above it."""
    draw = random.Random(11)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(240):
        text = list(base)
        for at in draw.sample(range(len(base)), draw.choice((0, 1, 2, 3, 5, 8, 11))):
            text[at] = f"e{draw.randrange(60)}"
        rows.append((k, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert shown(jj.join(df)) == want(df.collect())


@pytest.mark.parametrize("few", [1, 24])
@pytest.mark.parametrize("sides", [False, True])
def test_tiles_find_what_sketches_allow(monkeypatch, few, sides):
    monkeypatch.setattr(jj, "FEW", few)
    draw, rows, words = np.random.default_rng(5), 90, jj.SHORT // 64
    unit = np.repeat([0, 1, 2], [60, 29, 1])
    left = draw.integers(1, 3, rows) if sides else np.zeros(rows, int)
    base = draw.integers(0, 2**63, words).astype(np.uint64)
    bits = np.array([base ^ np.bitwise_or.reduce([np.eye(1, words, p // 64, dtype=np.uint64)[0] << np.uint64(p % 64) for p in draw.integers(0, jj.SHORT, k % 30 + 1)]) for k in range(rows)])
    n, component = draw.integers(60, 90, rows), draw.integers(0, 40, rows)
    searches, ids = draw.random(rows) < 0.7, draw.permutation(rows)
    least = np.arange(rows * jj.LEAST).reshape(rows, -1)  # no two sets agree
    hashed = np.zeros_like(least)
    x, y = jj.compared(unit, left, ids, n, component, searches, least, hashed, bits, Fraction(3, 4))
    want = {
        (a, b) for a in range(rows) for b in range(a) if unit[a] == unit[b] and (not sides or left[a] != left[b])
        and component[a] != component[b] and (searches[a] or searches[b])
        and 4 * n[a] >= 3 * n[b] and 4 * n[b] >= 3 * n[a]
        and 7 * int(np.bitwise_count(bits[a] ^ bits[b]).sum()) <= n[a] + n[b]}
    assert want and sorted((max(p), min(p)) for p in zip(x, y, strict=True)) == sorted(want)


def test_texts_of_a_repeated_id_find_their_links(spark):
    """Each of several texts of an id is joined, and its rows are one document."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (3, a), (9, f"{b} more"), (7, c), (7, c), (8, f"{c} more"), (1, "lone text of six words here"), (None, a), (6, None), (6, "")]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id bigint, text string, node int, id int")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jj.join(docs).collect())
    assert got == sorted([("5", 56, 3), ("5", 56, 3), ("3", 56, 3), ("9", 57, 3), ("7", 56, 7), ("7", 56, 7), ("8", 57, 7), ("1", 2, 1),
                          ("None", 56, None), ("6", 0, 6), ("6", 0, 6)])
