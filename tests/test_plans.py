"""The physical plans that matter at scale."""

import os

import pytest

from gleanery.operators.sparse import bag_of_words, document_vectors, term_statistics, tfidf_candidates
from gleanery.plans.workbench import Workbench

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no fixture tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bench(spark):
    return Workbench.of(spark, FOLDER)


def test_terms_are_counted_and_weighted_where_the_texts_lie(bench):
    assert "Exchange" not in plan(bag_of_words(bench.docs, bench.lemmas))
    assert "Exchange" not in plan(document_vectors(bench.bag, bench.term_stats))


def test_scores_are_cut_to_the_best_before_the_shuffle(bench):
    hits, _ = tfidf_candidates(bench.queries, bench.doc_vectors, bench.term_stats, bench.lemmas)
    text = plan(hits)
    assert "MapInArrow" in text and "WindowGroupLimit" in text
    assert text.count("Exchange hashpartitioning(query_id") == 1


@pytest.mark.parametrize("method", ["tfidf", "embedding", "chunk", "hybrid", "chunk_in_hybrid"])
def test_no_search_is_a_cross_join(bench, method):
    text = plan(getattr(bench.engine, method)(bench.queries))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_snippets_do_not_read_whole_texts(bench):
    text = plan(bench.engine.tfidf(bench.queries))
    assert "doc_id:bigint,snippet:string" in text and "text:string" not in text


def test_statistics_read_the_terms_only(bench):
    text = plan(term_statistics(bench.bag, 10))
    assert "ReadSchema: struct<terms:array<string>>" in text
