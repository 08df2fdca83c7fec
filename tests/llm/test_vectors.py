"""Operators 6 and 10 against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.llm import graph, topk, vector_dedup
from civicspark.llm.queries import op6_top_k, op10_vector_dedup
from civicspark.llm.support import table
from tests.llm import brute

SF = "/root/testdata/sf0.01"
KIND = "vec_id bigint, embedding array<float>, label int, score string, rank string, copies string, rep string"


def usable(v):
    return v is not None and None not in v and all(math.isfinite(x) for x in v)


def top(rows, k, query):
    ints = [(r.vec_id, np.floor(256 * np.array(r.embedding, float)).astype(int)) for r in rows if r.vec_id is not None and usable(r.embedding)]
    width = max([len(v) for _, v in ints], default=0)
    ints = [(i, np.pad(v, (0, width - len(v)))) for i, v in ints]
    out = []
    for q, v in ints:
        if query(q):
            ranked = sorted((-int(v @ w), i) for i, w in ints if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(ranked, 1)]
    return sorted(out)


def test_top_k_of_all_vectors(spark):
    got = sorted(tuple(r) for r in op6_top_k(spark, SF).collect())
    assert got == top(table(spark, SF, "embeddings").collect(), 5, lambda q: q % 50 == 0)


@pytest.fixture
def odd(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.integers(-2, 3, 6)], 1) for i in range(40)]
    rows += [(40, None, 1), (41, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (42, [float("nan")] * 6, 1), (43, [float("inf")] * 6, 1), (44, [0.0] * 6, 1),
             (45, [2.0, 1.0], None), (46, [3e38] * 6, 1), (47, [], 1), (None, [1.0] * 6, 1), (60, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 1),
             (61, [2.0, 4.0, 6.0, 8.0, 10.0, 12.0], 1), (62, [1.0, 2.0, 3.0, 4.0, 5.0, 6.5], 1), (63, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 1)]
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], KIND)


@pytest.mark.parametrize("block", [3, 1000])
def test_top_k_ties_and_odd_rows(odd, block):
    rows = odd.where("vec_id IS NULL OR vec_id <> 46")
    got = sorted(tuple(r) for r in topk.search(rows, F.col("vec_id") % 3 == 0, 4, block=block, slices=3).collect())
    assert got == top(rows.collect(), 4, lambda q: q % 3 == 0)


def test_top_k_of_repeated_queries(spark):
    """A query row that stands twice, one id with two vectors, and candidates that stand twice."""
    rows = [(0, [1.0, 0.0])] * 2 + [(50, [1.0, 0.0]), (50, [0.0, 1.0])] + [(i, [i / 10, (9 - i) / 10]) for i in range(1, 9)] + [(8, [0.8, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    want = []
    for q in (0, 50):
        asked = [np.array(v, np.float32) for i, v in rows if i == q]
        score = lambda v: max(int(np.floor(256 * a.astype(float)) @ np.floor(256 * np.array(v, np.float32).astype(float))) for a in asked)  # noqa: B023, E731
        near = sorted((-score(v), i) for i, v in rows if i != q)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(near, 1)]
    for block in (1, 3, 64):
        assert sorted(tuple(r) for r in topk.search(frame, F.col("vec_id") % 50 == 0, 5, block=block, slices=2).collect()) == want


def test_top_k_few_and_none(odd):
    three = odd.where("vec_id IN (0, 1, 2)")
    assert len(topk.search(three, F.col("vec_id") == 0, 5).collect()) == 2
    assert topk.search(odd.limit(0), F.col("vec_id") == 0, 5).count() == 0


def dedup(rows, cosine):
    good = [(k, r.vec_id, np.array(r.embedding, float)) for k, r in enumerate(rows)
            if r.vec_id is not None and usable(r.embedding) and any(r.embedding)]
    width = max([len(v) for *_, v in good], default=0)
    unit = {k: np.pad(v, (0, width - len(v))) / np.linalg.norm(v) for k, _, v in good}
    ids = {k: i for k, i, _ in good}
    n, pairs = dict.fromkeys(ids, 0), []
    for a in ids:
        for b in ids:
            if a < b and float(unit[a] @ unit[b]) >= cosine:
                n[a] += 1
                n[b] += 1
                pairs.append((ids[a], ids[b]))
    root = brute.components(set(ids.values()), pairs)
    return sorted((str(r.vec_id), n.get(k, 0), str(root.get(r.vec_id, r.vec_id) if k in ids else r.vec_id)) for k, r in enumerate(rows))


@pytest.mark.parametrize("matrix_rows", [512, 7])
def test_all_vectors_by_cosine(spark, matrix_rows, monkeypatch):
    monkeypatch.setattr(vector_dedup, "MATRIX_ROWS", matrix_rows)
    rows = op10_vector_dedup(spark, SF).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in rows) == dedup(table(spark, SF, "embeddings").collect(), 0.9)
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_vectors_odd_rows(odd):
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in vector_dedup.near_duplicates(odd).collect())
    assert got == dedup(odd.collect(), 0.9)
    assert vector_dedup.near_duplicates(odd.limit(0)).count() == 0


def test_components(spark):
    draw = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in draw.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(60)]
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {r.id: r.component_id for r in graph.connected_components(links).collect()}
    want = brute.components({x for p in pairs for x in p}, pairs)
    assert got == {k: want[k] for k in {x for p in pairs if p[0] != p[1] for x in p}}
    assert graph.connected_components(links.limit(0)).count() == 0
