"""The pipeline, stage by stage, against plain versions on whole small tables."""

import pytest

import corpus_pipeline as cp
from civicspark.llm import langid
from civicspark.llm.support import table
from tests.llm import brute
from tests.llm.test_tokens import check_pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture
def odd(spark):
    rows = [(0, None, "en", "s", None), (1, "", "en", "s", 0), (2, "123 456", None, None, 7), (3, "the thing that was there", "en", "s", 24),
            (3, "the thing that was there", "en", "s", 24), (4, "the thing that was there", "en", None, 24), (5, 'token = "abcdef99" the thing', "en", "s", 27),
            (None, "the other thing that is here", "en", "s", 28), (6, "the long thing " * 9000, "en", "s", 135000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return docs.selectExpr("*", "'x' AS base", "'y' AS score", "1 AS key")


def test_stages_on_all_documents(spark):
    docs = table(spark, SF, "documents")
    first = cp.language(spark, docs, SF)
    told = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, langid.train(docs)).collect()}
    kept = {r.doc_id: r.text for r in first.collect()}
    assert set(kept) == {i for i, (lang, score) in told.items() if lang != "und" and score >= cp.LEAST_CERTAIN}
    root = brute.components(kept, brute.jaccard_links(kept))
    second = {r.doc_id: r.text for r in cp.near_duplicates(spark, first, SF).collect()}
    assert second == {i: t for i, t in kept.items() if root[i] == i}
    third = cp.secrets(spark, spark.createDataFrame(list(second.items()), "doc_id bigint, text string").selectExpr("*", "'' AS lang", "'' AS source", "0L AS n_chars"), SF)
    masked = third.collect()
    assert set(second) == {r.doc_id for r in masked}
    for r in masked:
        if not brute.secret_base(second[r.doc_id]) and "[random]" not in r.text:
            assert r.text == second[r.doc_id]
        assert not brute.secret_base(r.text)
    check_pieces(cp.packed(spark, third, SF).collect(), masked)


def test_run_gives_what_the_stages_give(spark):
    pieces = cp.run(spark, SF).collect()
    docs = table(spark, SF, "documents")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    check_pieces(pieces, docs.collect())


def test_stages_on_odd_rows(spark, odd):
    first = cp.language(spark, odd, SF)
    assert sorted(str(r.doc_id) for r in first.collect()) == ["3", "3", "4", "5", "6", "None"]
    second = cp.near_duplicates(spark, odd, SF)
    assert sorted(str(r.doc_id) for r in second.collect()) == ["0", "1", "2", "3", "5", "6", "None"]
    third = {r.doc_id: r for r in cp.secrets(spark, odd, SF).collect()}
    assert third[5].text == '[assign]" the thing' and third[5].n_chars == 19 and third[0].text is None
    assert all(f(spark, odd.limit(0), SF).count() == 0 for _, f in cp.STAGES)
    assert [f(spark, odd, SF).columns for _, f in cp.STAGES[:-1]] == [list(cp.COLUMNS)] * 3
