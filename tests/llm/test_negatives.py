"""Operator 11 against brute force in Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.llm import hard_negatives as hn
from civicspark.llm.queries import op11_hard_negatives
from civicspark.llm.support import table

SF = "/root/testdata/sf0.01"
KIND = "vec_id bigint, embedding array<float>, label bigint, score string, rank string, slot string, block string, n string"
LONG = 2**63 - 1


def mined(rows, anchor, positives, negatives, low, high):
    """(anchor, positive, rank, negative, score, score) by comparing all rows; rows are (id, vector, label)."""
    known = [(i, [math.floor(256 * float(x)) for x in v], c) for i, v, c in rows
             if i is not None and c is not None and v is not None and None not in v and all(math.isfinite(x) for x in v)]
    out = []
    for a, (i, v, c) in enumerate(known):
        if not anchor(i):
            continue
        scored = sorted((-max(-LONG, min(LONG, sum(x * y for x, y in zip(v, w)))), j, n) for n, (j, w, _) in enumerate(known) if n != a)
        same = [(j, -s) for s, j, n in scored if known[n][2] == c][:positives]
        other = [(j, -s) for s, j, n in scored if known[n][2] != c]
        for p, ps in same:
            fits = [(j, s) for j, s in other if low * ps <= 100 * s <= high * ps][:negatives]
            out += [(i, p, r, j, ps, s) for r, (j, s) in enumerate(fits, 1)]
    return sorted(out)


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table(spark, SF, "embeddings").collect()]
    got = sorted(tuple(r) for r in op11_hard_negatives(spark, SF).collect())
    assert got == mined(rows, lambda i: i % 100 == 0, 5, 10, 30, 90)


@pytest.fixture
def odd():
    draw = np.random.default_rng(8)
    rows = [(i, [float(x) for x in draw.integers(-2, 4, 5)], i % 3) for i in range(60)]
    rows += [(60, None, 1), (61, [1.0, None, 0.0], 1), (62, [float("nan")] * 5, 1), (63, [float("-inf")] * 5, 1), (None, [1.0] * 5, 1),
             (64, [2.0] * 5, None), (65, [3.0, 1.0], 2), (66, [], 1), (70, [1.0, 1.0, 1.0, 1.0, 1.0, 2.0, 3.0], 0)]
    rows += [rows[0]] * 2 + [rows[10], (10, [1.0, 2.0, 3.0, 2.0, 1.0], 1), (20, [1.0, 2.0, 3.0, 2.0, 1.0], 0)]  # repeated rows and ids
    rows += [(i, [1.0, 1.0, 1.0, 0.0, 0.0], 2) for i in range(100, 180)]  # many ties
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], KIND)


@pytest.mark.parametrize(("block", "chunk", "copied"), [(7, 4, 0), (4096, 8192, 16_384)])
def test_ties_repeats_and_odd_rows(spark, odd, monkeypatch, block, chunk, copied):
    monkeypatch.setattr(hn, "CHUNK", chunk)
    monkeypatch.setattr(hn, "COPIED", copied)
    got = hn.mine(frame_of(spark, odd), F.col("vec_id") % 10 == 0, 4, 6, 30, 90, block=block)
    assert sorted(tuple(r) for r in got.collect()) == mined(odd, lambda i: i % 10 == 0, 4, 6, 30, 90)


def test_scores_beyond_double_and_long(spark):
    rows = [(0, [3e38, 1.0], 0), (1, [2e38, 5.0], 0), (2, [1.0, 2.0], 1), (3, [1e12, 1e11], 0), (4, [9e11, -3e10], 1), (10, [1e12, 0.0], 0), (11, [8e11, 7.0], 1)]
    got = hn.mine(frame_of(spark, rows), F.col("vec_id") % 10 == 0, 3, 3, 30, 90)
    floats = [(i, [float(np.float32(x)) for x in v], c) for i, v, c in rows]
    assert sorted(tuple(r) for r in got.collect()) == mined(floats, lambda i: i % 10 == 0, 3, 3, 30, 90)


def test_nothing_to_mine(spark):
    assert hn.mine(spark.createDataFrame([], KIND), F.col("vec_id") % 10 == 0, 3, 3, 30, 90).collect() == []
    alone = frame_of(spark, [(0, [1.0], 0), (1, [1.0], 1)])
    assert hn.mine(alone, F.col("vec_id") % 10 == 0, 3, 3, 30, 90).collect() == []
    assert hn.mine(alone, F.col("vec_id") < 0, 3, 3, 30, 90).collect() == []


@pytest.mark.parametrize("least", [-400, 1, 150, 900, 3000])
def test_index_loses_no_pair(least):
    draw = np.random.default_rng(abs(least))
    q, y = (np.floor(draw.normal(0, 30, (n, 40)) * np.linspace(2, 0, 40) ** 3) for n in (9, 50))
    y[::7] = 0
    want = {(i, j): int(s) for (i, j), s in np.ndenumerate(q @ y.T) if s >= least}
    i, j, s = hn.reaching(q, y, np.full(9, least, np.int64))
    assert dict(zip(zip(i.tolist(), j.tolist()), s.tolist())) == want
