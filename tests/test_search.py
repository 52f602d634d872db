import math
from collections import Counter
from functools import partial

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.functions.vectors import norm, rounded
from gleanery.operators.chunks import (
    build_chunk_vectors,
    chunk_documents,
    chunk_search,
    chunk_search_in_candidates,
)
from gleanery.operators.cleaning import Lemmas
from gleanery.operators.dense import dense_candidates, embedding_search
from gleanery.operators.encoders import (
    HashEncoder,
    ModelEncoder,
    embed_cleaned_queries,
    embed_documents,
    embed_raw_queries,
    process_queries,
)
from gleanery.operators.hybrid import rerank
from gleanery.operators.ranking import snippet_table
from gleanery.operators.scan import DenseQueries, SparseQueries, _best_cells, search_top_k
from gleanery.operators.sparse import (
    Weighting,
    bag_of_words,
    bag_rows,
    document_vectors,
    document_weights,
    query_vectors,
    term_statistics,
    tfidf_candidates,
    tfidf_search,
)

TEXTS = [
    "red apple green apple",
    "green pear",
    "the of and",
    "red red wine",
    "apple apples pie",
    "green pear",
    "",
    "blue cheese wine " + "x" * 200,
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id LONG, text STRING")


@pytest.fixture(scope="module")
def model(spark, corpus):
    pairs = spark.createDataFrame([("apples", "apple", 1)], "word STRING, lemma STRING, n_docs LONG")
    lemmas = Lemmas(pairs)
    bag = bag_of_words(corpus, lemmas)
    stats = term_statistics(bag, len(TEXTS))
    return lemmas, bag, stats, document_vectors(bag, stats)


def queries_of(spark, *texts):
    return spark.createDataFrame(
        [(f"q{i}", t) for i, t in enumerate(texts)], "query_id STRING, query STRING"
    )


def expected_weights(weighting=Weighting()):
    """Plain Python TF-IDF of TEXTS with the lemma apples -> apple."""
    stop = {"the", "of", "and"}
    bags = [
        Counter("apple" if w == "apples" else w for w in t.split() if w not in stop) for t in TEXTS
    ]
    df = Counter(w for b in bags for w in b)
    extra = 1 if weighting.smooth else 0
    idf = {w: math.log((len(TEXTS) + extra) / (n + extra)) + 1 for w, n in df.items()}
    out = []
    for b in bags:
        row = {w: ((1 + math.log(n)) if weighting.sublinear else n) * idf[w] for w, n in b.items()}
        size = math.sqrt(sum(x * x for x in row.values())) if weighting.unit_length else 1.0
        out.append({w: x / size for w, x in row.items()})
    return idf, out


@pytest.mark.parametrize(
    "weighting",
    [Weighting(), Weighting(smooth=False, sublinear=True), Weighting(unit_length=False)],
)
def test_weights(spark, corpus, model, weighting):
    lemmas, bag, _, _ = model
    stats = term_statistics(bag, len(TEXTS), weighting)
    got = document_weights(document_vectors(bag, stats, weighting)).collect()
    idf, rows = expected_weights(weighting)
    want = {(i, w): x for i, row in enumerate(rows) for w, x in row.items()}
    assert {(r["doc_id"], r["term"]) for r in got} == set(want)
    assert all(abs(r["weight"] - want[r["doc_id"], r["term"]]) < 1e-12 for r in got)
    assert all(abs(r["idf"] - idf[r["term"]]) < 1e-12 for r in stats.collect())


def test_bag_without_and_with_many_lemmas(spark, corpus, model):
    lemmas, bag, _, _ = model
    many = bag_of_words(corpus, Lemmas(lemmas.table, max_pairs=0))
    as_set = lambda df: {(r["doc_id"], r["term"], r["tf"]) for r in bag_rows(df).collect()}
    assert as_set(bag) == as_set(many)
    assert (4, "apple", 2) in as_set(bag) and (2, None, 1) in as_set(bag)
    assert (4, "apples", 1) in as_set(bag_of_words(corpus))


def test_blank_documents_count_and_can_fill_up(spark, corpus, model):
    _, _, stats, vectors = model
    assert vectors.count() == len(TEXTS)
    assert vectors.filter(F.size("terms") == 0).count() == 2


def brute_force(texts, top_n):
    _, rows = expected_weights()
    idf, _ = expected_weights()
    out = []
    for i, text in enumerate(texts):
        words = Counter("apple" if w == "apples" else w for w in text.split() if w not in {"the", "of"})
        if not words:
            continue
        vector = {w: n * idf[w] for w, n in words.items() if w in idf}
        size = math.sqrt(sum(x * x for x in vector.values())) or 1.0
        scores = [
            (round(sum(x / size * row.get(w, 0) for w, x in vector.items()), 6), -d)
            for d, row in enumerate(rows)
        ]
        best = sorted(scores, reverse=True)[:top_n]
        out += [(f"q{i}", n + 1, -d, s) for n, (s, d) in enumerate(best)]
    return sorted(out)


QUERIES = ["green apples", "zebra", "the of", "", "wine red zebra wine", "pear"]


@pytest.mark.parametrize("top_n", [1, 3, 20])
def test_tfidf_search_against_brute_force(spark, corpus, model, top_n):
    lemmas, _, stats, vectors = model
    asked = queries_of(spark, *QUERIES)
    got = tfidf_search(asked, snippet_table(corpus), vectors, stats, lemmas, top_n).collect()
    found = sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in got)
    assert found == brute_force(QUERIES, top_n)
    assert {r["query_id"] for r in got} == {"q0", "q1", "q4", "q5"}  # blank ones have no rows
    for r in got:
        text = TEXTS[r["doc_id"]]
        assert r["snippet"] == (text[:150] + "..." if len(text) > 150 else text)


def test_unknown_words_only_give_zero_scores_in_id_order(spark, corpus, model):
    lemmas, _, stats, vectors = model
    got = tfidf_search(queries_of(spark, "zebra"), snippet_table(corpus), vectors, stats, lemmas, 4).collect()
    assert sorted((r["rank"], r["doc_id"], r["score"]) for r in got) == [
        (n + 1, n, 0.0) for n in range(4)
    ]


def test_two_stage_selection(spark, corpus, model):
    lemmas, _, stats, vectors = model
    asked = queries_of(spark, *QUERIES)

    def rows(**kw):
        df = tfidf_candidates(asked, vectors, stats, lemmas, 3, **kw)[0]
        return sorted(map(tuple, df.collect()))

    assert rows() == rows(candidate_k=3) == rows(candidate_k=5) == rows(candidate_k=0)
    assert rows(candidate_k=2) == [r for r in rows() if r[1] <= 2]
    with pytest.raises(ValueError):
        rows(candidate_k=-1)


def test_nothing_asked_or_nothing_wanted(spark, corpus, model):
    lemmas, _, stats, vectors = model
    for asked, top_n in [(queries_of(spark, "pear").limit(0), 5), (queries_of(spark, "pear"), 0)]:
        assert tfidf_search(asked, snippet_table(corpus), vectors, stats, lemmas, top_n).count() == 0


@pytest.mark.parametrize("k", [1, 7, 150])
def test_slices_and_fragments_give_the_same_rows_as_one_broadcast(spark, k, monkeypatch):
    from gleanery.operators import scan

    monkeypatch.setattr(scan, "FRAGMENT_ROWS", 70)
    rng = np.random.default_rng(1)
    docs = spark.createDataFrame(
        [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(300)],
        "doc_id LONG, embedding ARRAY<FLOAT>",
    )
    asked = spark.createDataFrame(
        [(f"q{i}", rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(20)],
        "query_id STRING, query_vector ARRAY<FLOAT>",
    )
    loader = partial(DenseQueries, scaled=True)

    def rows(**bounds):
        df, max_rows = search_top_k(
            asked, docs, loader, k, ["doc_id"], ["doc_id"], (20, 100), **bounds
        )
        return sorted(map(tuple, df.collect())), max_rows

    one, bound = rows()
    assert rows(max_entries=30) == (one, bound) and bound == 20 * k  # four passes
    assert rows(max_entries=30, max_passes=1) == (one, None)
    products = F.zip_with("query_vector", "embedding", lambda x, y: x.cast("double") * y)
    dot = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    sizes = norm(F.col("query_vector")) * norm(F.col("embedding"))
    score = rounded(F.coalesce(F.try_divide(dot, sizes), F.lit(0.0)), 6).alias("score")
    native = {(r[0], r[1]): r[2] for r in asked.crossJoin(docs).select("query_id", "doc_id", score).collect()}
    order = sorted(native, key=lambda p: (p[0], -native[p], p[1]))
    want = []
    for q in {p[0] for p in order}:
        best = [p for p in order if p[0] == q][:k]
        want += [(q, n + 1, d, native[q, d]) for n, (_, d) in enumerate(best)]
    assert one == sorted(want)


def test_sparse_fragments(spark, corpus, model):
    lemmas, _, stats, vectors = model
    asked = queries_of(spark, *QUERIES)
    from gleanery.operators.cleaning import clean

    prepared = query_vectors(clean(asked, "query", lemmas), stats)

    def rows(**bounds):
        df, _ = search_top_k(
            prepared, vectors, SparseQueries, 4, ["doc_id"], ["doc_id"], (4, 10), **bounds
        )
        return sorted(map(tuple, df.collect()))

    assert rows() == rows(max_results=5) == brute_force(QUERIES, 4)
    assert rows(max_results=5, max_passes=1) == rows()


def test_many_small_batches(spark, setting):
    setting("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    docs = spark.range(0, 500, 1, 3).select(
        F.col("id").alias("doc_id"),
        F.array((F.col("id") % 10).cast("float"), F.lit(1.0).cast("float")).alias("embedding"),
    )
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "query_id LONG, query_vector ARRAY<FLOAT>")
    got = dense_candidates(asked, docs, 12)[0].collect()
    by_query = {q: [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (1, 2)}
    assert by_query[1] == [9 + 10 * i for i in range(12)]
    assert by_query[2] == list(range(12))  # a query without length scores zero everywhere


def test_empty_query_vectors_have_no_rows_and_missing_documents_an_empty_snippet(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "doc_id LONG, embedding ARRAY<FLOAT>")
    asked = spark.createDataFrame([(1, []), (2, [1.0, 1.0])], "query_id LONG, query_vector ARRAY<FLOAT>")
    corpus = spark.createDataFrame([(2, "two")], "doc_id LONG, text STRING")
    got = sorted(map(tuple, embedding_search(asked, docs, snippet_table(corpus)).select("query_id", "rank", "doc_id", "snippet").collect()))
    assert got == [(2, 1, 1, ""), (2, 2, 2, "two")]


def test_vectors_of_two_lengths_are_an_error(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "doc_id LONG, embedding ARRAY<FLOAT>").coalesce(1)
    asked = spark.createDataFrame([(2, [1.0, 1.0])], "query_id LONG, query_vector ARRAY<FLOAT>")
    with pytest.raises(Exception, match="one length"):
        dense_candidates(asked, docs)[0].collect()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=6, max_size=6), min_size=1, max_size=4), st.integers(1, 8))
def test_best_cells_are_the_first_of_a_stable_sort(values, k):
    scores = np.array(values, dtype=float)
    rows, columns = _best_cells(scores, k)
    for i, row in enumerate(scores):
        want = sorted(np.argsort(-row, kind="stable")[:k])
        assert sorted(columns[rows == i]) == want


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.floats(-5, 5), min_size=3, max_size=3), min_size=1, max_size=5),
    st.lists(st.floats(-5, 5), min_size=3, max_size=3),
)
def test_cosine_is_within_bounds(rows, query):
    import pyarrow as pa

    table = pa.table({"query_id": [1], "query_vector": [query]})
    batch = pa.record_batch({"embedding": rows})
    scorer = DenseQueries(table, scaled=True)
    scores = scorer.scores(scorer.prepare(batch), 0, 1)
    assert np.all(np.abs(scores) <= 1 + 1e-9)


# Encoders


def test_hash_encoder_ignores_case_and_punctuation(spark):
    df = spark.createDataFrame([(1, "Red, WINE!"), (2, "red wine"), (3, ""), (4, None)], "doc_id LONG, text STRING")
    got = {r["doc_id"]: r["embedding"] for r in embed_documents(df, HashEncoder(16)).collect()}
    assert got[1] == got[2] and abs(sum(x * x for x in got[1]) - 1) < 1e-6
    assert got[3] == got[4] == [0.0] * 16


def test_model_encoder_loads_once_and_sees_texts(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([(1, "abc"), (2, "é")], "doc_id LONG, text STRING")
    got = {r["doc_id"]: r["embedding"] for r in embed_documents(df, ModelEncoder(load)).collect()}
    assert got == {1: [3.0, 1.0], 2: [1.0, 1.0]}


def test_raw_and_cleaned_queries_differ(spark):
    asked = queries_of(spark, "the wines", "the", "")
    pairs = spark.createDataFrame([("wines", "wine", 1)], "word STRING, lemma STRING, n_docs LONG")
    encoder = HashEncoder(8)
    raw = {r[0]: r[1] for r in embed_raw_queries(asked, encoder).collect()}
    cleaned = {r[0]: r[1] for r in embed_cleaned_queries(asked, encoder, Lemmas(pairs)).collect()}
    assert set(raw) == {"q0", "q1"} and set(cleaned) == {"q0"}
    assert raw["q0"] != cleaned["q0"]
    records = {r["query_id"]: r for r in process_queries(asked, encoder, Lemmas(pairs)).collect()}
    assert records["q0"]["preprocessed_text"] == "wine"
    assert records["q0"]["query_embedding"] == raw["q0"]
    assert records["q2"]["query_embedding"] == [] and records["q2"]["preprocessed_text"] == ""


# Chunks


def test_chunks_overlap_and_keep_the_words(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(10)))), (2, " "), (3, "a")], "doc_id LONG, text STRING")
    got = sorted(map(tuple, chunk_documents(df, 4, 1).collect()))
    assert got == [(1, 0, "0 1 2 3"), (1, 1, "3 4 5 6"), (1, 2, "6 7 8 9"), (1, 3, "9"), (3, 0, "a")]
    with pytest.raises(ValueError):
        chunk_documents(df, 4, 4)


@pytest.fixture(scope="module")
def chunk_table(spark):
    rows = [
        (1, 0, "a", [1.0, 0.0]),
        (1, 1, "b", [0.8, 0.6]),
        (2, 0, "c", [0.6, 0.8]),
        (2, 1, "d", [0.7, 0.714142842854285]),
        (3, 0, "e", [0.0, 1.0]),
        (3, 1, "f", [1.0, 0.0]),
    ]
    return spark.createDataFrame(rows, "doc_id LONG, chunk_no INT, text STRING, embedding ARRAY<FLOAT>")


def test_threshold_is_inclusive_and_applies_after_top_k(spark, chunk_table):
    asked = spark.createDataFrame([(1, [2.0, 0.0])], "query_id LONG, query_vector ARRAY<FLOAT>")

    def rows(k, threshold):
        hits, _ = chunk_search(asked, chunk_table, k, threshold)
        return [(r["doc_id"], r["chunk_no"], r["text"], r["score"]) for r in sorted(hits.collect(), key=lambda r: r["rank"])]

    assert rows(5, 0.7) == [(1, 0, "a", 1.0), (3, 1, "f", 1.0), (1, 1, "b", 0.8), (2, 1, "d", 0.7)]
    assert rows(2, 0.7) == rows(5, 0.7)[:2]
    assert rows(3, 0.9) == rows(5, 0.7)[:2]
    assert len(rows(10, None)) == 6


def test_search_in_candidates_only(spark, chunk_table):
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "query_id LONG, query_vector ARRAY<FLOAT>")
    chosen = spark.createDataFrame([(1, 2), (1, 2), (1, 3), (2, 1), (2, 9)], "query_id LONG, doc_id LONG")
    want = [
        (1, 1, 3, 1, 1.0, "f"),
        (1, 2, 2, 1, 0.7, "d"),
        (1, 3, 2, 0, 0.6, "c"),
        (2, 1, 1, 1, 0.6, "b"),
        (2, 2, 1, 0, 0.0, "a"),
    ]
    for bound in [5, None]:
        got = chunk_search_in_candidates(asked, chosen, chunk_table, 3, bound)
        assert sorted(map(tuple, got.collect())) == want


def test_chunk_vectors_have_length_one(spark):
    df = spark.createDataFrame([(1, "one two three")], "doc_id LONG, text STRING")
    row = build_chunk_vectors(df, HashEncoder(8)).select(norm(F.col("embedding"))).first()
    assert abs(row[0] - 1) < 1e-6


# Hybrid


def test_rerank_keeps_sparse_order_on_ties_and_drops_what_has_no_vector(spark):
    candidates = spark.createDataFrame(
        [(1, 10, 1), (1, 11, 2), (1, 12, 3), (1, 13, 4), (2, 99, 1)],
        "query_id LONG, doc_id LONG, rank INT",
    )
    vectors = spark.createDataFrame(
        [(10, [0.0, 1.0]), (11, [3.0, 0.0]), (13, [1.0, 0.0]), (50, [1.0, 0.0])],
        "doc_id LONG, embedding ARRAY<FLOAT>",
    )
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0])], "query_id LONG, query_vector ARRAY<FLOAT>")
    for bound in [5, None]:
        got = rerank(candidates, asked, vectors, 2, bound).collect()
        assert sorted(map(tuple, got)) == [(1, 1, 11, 1.0), (1, 2, 13, 1.0)]


@pytest.mark.parametrize("two_rounds", [False, True])
def test_ranking_in_one_round_or_two(spark, two_rounds):
    from gleanery.operators.ranking import best_first, top_ranked

    rows = spark.range(0, 4000, 1, 16).select(
        (F.col("id") % 3).alias("query_id"),
        F.col("id").alias("doc_id"),
        (F.col("id") % 7 / 7).alias("score"),
    )
    got = top_ranked(rows, 150, best_first("doc_id"), two_rounds=two_rounds).collect()
    ranked = {q: [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in range(3)}
    for q, found in ranked.items():
        assert found == sorted((i for i in range(q, 4000, 3)), key=lambda i: (-(i % 7), i))[:150]
