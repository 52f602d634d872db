"""Many queries are searched by content, along matches, with the rows of a scan."""

import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from gleanery.operators import postings, scan, sparse
from gleanery.operators.ranking import snippet_table
from gleanery.operators.sparse import bag_of_words, document_vectors, term_statistics
from gleanery.plans.engine import build_postings
from gleanery.sources.artifacts import ArtifactStore

WORDS = ["red", "apple", "pear", "wine", "pie", "green", "cheese"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    rows = [(i % 50, " ".join(rng.choices(WORDS, k=rng.randint(0, 4)))) for i in range(60)]  # ten ids twice
    return spark.createDataFrame([*rows, (None, "red pie"), (None, "")], "doc_id LONG, text STRING")


@pytest.fixture(scope="module")
def model(corpus):
    bag = bag_of_words(corpus)
    stats = term_statistics(bag, 62)
    return stats, document_vectors(bag, stats)


@pytest.fixture(scope="module")
def asked(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices([*WORDS, "zebra", "gnu"], k=rng.randint(1, 3)))) for i in range(80)]
    more = [(80, "zebra"), (81, "zebra"), (82, ""), (83, None), (84, "red"), (84, "pie"), (None, "pear"), (None, "wine")]
    return spark.createDataFrame(rows + more, "query_id LONG, query STRING")


def many(monkeypatch):
    monkeypatch.setattr(sparse, "MANY_QUERIES", 0)
    monkeypatch.setattr(postings, "MANY_QUERIES", 0)


def rows(df):
    return sorted((str(r["query_id"]), r["rank"], str(r["doc_id"]), r["score"]) for r in df.collect())


@pytest.mark.parametrize("k,matches,answers", [(1, 1_000_000, 10), (5, 7, 100_000), (40, 300, 10), (100, 1, 100_000)])
def test_many_queries_get_the_rows_of_few(spark, corpus, model, asked, monkeypatch, k, matches, answers):
    stats, vectors = model
    want = rows(sparse.tfidf_search(asked, snippet_table(corpus.filter("doc_id >= 10")), vectors, stats, None, k))
    many(monkeypatch)
    monkeypatch.setattr(scan, "MATCHES", matches)
    monkeypatch.setattr(sparse, "ANSWER_ROWS", answers)
    got = rows(sparse.tfidf_search(asked, snippet_table(corpus.filter("doc_id >= 10")), vectors, stats, None, k))
    if k < 40:  # else ids that are null are in the lists, where rows of equal score have no order
        assert got == want
    assert sorted(r[:2] + r[3:] for r in got) == sorted(r[:2] + r[3:] for r in want)


def test_equal_and_unknown_queries_are_not_scanned_for(spark, model, asked, monkeypatch):
    stats, vectors = model
    many(monkeypatch)
    seen, whole = [], sparse.search_top_k
    monkeypatch.setattr(sparse, "search_top_k", lambda q, v, *a, **b: seen.append(q.count()) or whole(q, v, *a, **b))
    names = spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, "Zebra").otherwise("red pie").alias("query"))
    hits, _ = sparse.tfidf_candidates(names.withColumnRenamed("id", "query_id"), vectors, stats, None, 4)
    assert hits.groupBy("query_id").count().filter("count = 4").count() == 3000
    assert seen == [1]


def test_tasks_hand_in_matches_only(model, spark):
    stats, vectors = model
    asked = sparse.query_vectors(
        spark.createDataFrame([(1, ["red"]), (2, ["zebra"])], "query_id LONG, tokens ARRAY<STRING>"), stats
    )
    loader = partial(scan.SparseQueries, matching=True)
    hits, _ = scan.search_top_k(asked, vectors, loader, 99, ["doc_id"], ["doc_id"], (2, 1), matching=True)
    red = vectors.filter(F.array_contains("terms", "red")).count()
    assert hits.count() == red == hits.filter("query_id = 1 and score > 0").count()


@pytest.mark.parametrize("terms", [20_000, 3])
def test_many_queries_by_postings(spark, corpus, asked, tmp_path, monkeypatch, terms):
    store = ArtifactStore(spark, str(tmp_path), buckets=4)
    corpus = corpus.filter("doc_id is not null")
    bag = bag_of_words(corpus)
    stats = store.write("term_stats", "x", term_statistics(bag, 60))
    by_id = store.write_by_bucket("doc_vectors", "x", document_vectors(bag, stats), "doc_id")
    build_postings(store, "x")
    blocks, first = store.read("postings", "x"), store.read("first_ids", "x")
    want = rows(sparse.tfidf_candidates(asked, by_id, stats, None, 6)[0])
    many(monkeypatch)
    monkeypatch.setattr(postings, "POSTING_TERMS", terms)
    got, _ = postings.postings_search(asked, by_id, stats, blocks, first, None, 6)
    assert rows(got) == want
