"""Operator 12 against a run of every order over every row."""

import re
from collections import Counter
from itertools import permutations

import pytest

from civicspark.llm import filter_audit as fa
from civicspark.llm.queries import op12_filter_audit
from civicspark.llm.support import table

SF = "/root/testdata/sf0.01"


def failures(rows):
    """The failed filters of (doc_id, text, lang) rows."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({name for name, fails in (
            ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)), ("D", bool(re.search("[#$%&*|]", t))),
            ("E", i is not None and first[t] < i)) if fails})
    return out


def audited(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failed = failures(rows)
    out = []
    for part in sorted({c or "" for *_, c in rows}):
        mine = [(i, f) for (i, _, c), f in zip(rows, failed) if (c or "") == part]
        found = []
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                fails = sum(letter in f for _, f in mine)
                found.append((part, order, step, letter, len(left), len(gone), fails - len(gone), sum(f == {letter} for _, f in mine),
                              sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        total = Counter()
        for row in found:
            total[row[3]] += row[5]
        out += [(*row, total[row[3]]) for row in found]
    return sorted(out)


def columns(df):
    names = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_whole_table(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in table(spark, SF, "documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in table(spark, SF, "labels").collect()]
    assert columns(op12_filter_audit(spark, SF)) == audited(docs, labels)


ODD = [
    (1, None, "en"), (2, "", "en"), (3, "  ", None), (3, "  ", None), (4, "  ", ""), (None, "  ", "en"), (None, "  ", "en"),
    (None, None, None), (5, "A B C " * 40, "de"), (6, "A B C " * 40, "de"), (6, "A B C " * 40, "de"), (2, "A B C " * 40, "en"),
    (7, " ".join(f"w{i}\x1cx" for i in range(120)), "de"), (8, "\n".join(f"w{i}" for i in range(120)) + "#", "en"),
    (9, "é" * 9 + "A", "en"), (10, "é" * 8 + "A", "en"), (11, "w " * 200_000, "en"), (11, "other text", "en"),
] + [(100 + i, "a copy of a text", "en") for i in range(50)]
LABELS = [(1, 1, 0), (2, None, 1), (2, 1, None), (6, 0, 1), (6, 0, 1), (None, 1, 1), (11, 1, 0), (120, 1, 1), (999, 1, 1)]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, "clash", "clash", 0) for r in ODD], "doc_id bigint, text string, lang string, part string, own string, n int")
    labels = spark.createDataFrame([(*r, "clash") for r in LABELS], "doc_id bigint, quality int, toxic int, good string")
    assert columns(fa.audit(fa.documents_by_mask(docs, labels))) == audited(ODD, LABELS)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert fa.audit(fa.documents_by_mask(docs, labels)).collect() == []
    one = spark.createDataFrame([(1, "x", "en")], docs.schema)
    assert columns(fa.audit(fa.documents_by_mask(one, labels))) == audited([(1, "x", "en")], [])


def test_ranks_are_lexicographic():
    orders = [p for p in fa._prefixes(4) if len(p) == 4]
    assert sorted(orders) == orders
    assert [fa.lehmer_rank(p, 4) for p in orders] == list(range(24))


@pytest.mark.parametrize("mask", range(1, 32))
def test_a_mask_is_removed_once_in_every_order(mask):
    covered = sorted(r for m, _, a, b in fa.removal_intervals() if m == mask for r in range(a, b))
    assert covered == list(range(120))
