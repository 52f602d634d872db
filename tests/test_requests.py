import pytest
from pyspark.sql import functions as F

from gleanery.operators.encoders import HashEncoder
from gleanery.plans.engine import (
    Engine,
    build_chunk_groups,
    build_chunks,
    build_corpus,
    build_embeddings,
    build_postings,
    build_snippets,
    build_sparse,
)
from gleanery.plans.requests import METHODS, get_documents, run_requests, validate
from gleanery.sources.artifacts import ArtifactStore
from gleanery.session import shared_folder
from gleanery.streaming.feed import answer_stream, read_answers

REQUEST = "request_id LONG, query STRING, dataset STRING, method STRING, instruction_key STRING"


@pytest.fixture(scope="module")
def engines(spark, tmp_path_factory):
    """Two datasets: one with number ids, one with string ids."""
    store = ArtifactStore(spark, str(tmp_path_factory.mktemp("store")), buckets=2)
    number = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["red wine", "green apples", "apple wine", "blue cheese"])],
        "doc_id LONG, text STRING",
    )
    string = spark.createDataFrame([("a", "old cheese"), ("b", "young wine")], "doc_id STRING, text STRING")
    out = {}
    for name, docs in {"number": number, "string": string}.items():
        encoder = HashEncoder(32)
        build_corpus(store, name, docs)
        build_sparse(store, name, docs)
        build_postings(store, name)
        build_snippets(store, name, docs)
        build_embeddings(store, name, docs, encoder)
        build_chunks(store, name, docs, encoder)
        build_chunk_groups(store, name)
        out[name] = Engine.load(store, name, encoder, postings=True, groups=True)
    return out


def requests(spark, *rows):
    return spark.createDataFrame(rows, REQUEST)


def test_validation(spark):
    rows = requests(
        spark,
        (1, "q", "d", "tfidf", None),
        (2, "", "d", "tfidf", "comparative"),
        (3, "q", None, "tfidf", None),
        (4, "q", "d", None, None),
        (5, "q", "d", "bm25", None),
        (6, "q", "x", "hybrid", None),
        (7, " ", "d", "hybrid", None),
    )
    got = {r["request_id"]: (r["error"], r["instruction_key"]) for r in validate(rows, ["d"]).collect()}
    missing = "Missing query, dataset, or method"
    assert got == {
        1: (None, "default"),
        2: (missing, "comparative"),
        3: (missing, "default"),
        4: (missing, "default"),
        5: ("Invalid method: bm25", "default"),
        6: ("Unknown dataset: x", "default"),
        7: (None, "default"),
    }


def test_every_method_answers(spark, engines):
    rows = [(i, "red wine", "number", m, "comparative") for i, m in enumerate(METHODS)]
    results, rejects = run_requests(requests(spark, *rows, (99, "q", "number", "x", None)), {"number": engines["number"]})
    got = [r.asDict(recursive=True) for r in results.collect()]
    assert [r["request_id"] for r in rejects.collect()] == [99]
    assert {r["method"] for r in got} == set(METHODS)
    assert all(r["query"] == "red wine" and r["dataset"] == "number" for r in got)
    first = {r["method"]: r for r in got if r["rank"] in (None, 1)}
    for method in ["tfidf", "embedding_brute_force", "hybrid", "faiss_with_basics"]:
        assert (first[method]["doc_id"], first[method]["snippet"]) == (0, "red wine")
        assert abs(first[method]["score"] - 1) < 1e-6
    assert first["embedding_faiss"]["snippet"] == "red wine..."
    for method in ["rag_with_faiss", "rag_with_basics"]:
        assert "Document (ID: 0): red wine" in first[method]["prompt"]
        assert first[method]["prompt"].startswith("You are a highly analytical assistant.")
        assert first[method]["retrieved_context"][0]["doc_id"] == 0
    assert len(first["rag_with_basics"]["retrieved_context"]) == 3


def test_two_datasets_share_one_result(spark, engines):
    rows = [
        (1, "wine", "number", "tfidf", None),
        (2, "wine", "string", "tfidf", None),
        (3, "cheese", "string", "rag_with_basics", None),
    ]
    got = run_requests(requests(spark, *rows), engines).results.collect()
    best = {r["request_id"]: r["doc_id"] for r in got if r["rank"] == 1}
    assert best[2] == "b" and best[1] in {"0", "2"}
    assert [r["retrieved_context"][0]["doc_id"] for r in got if r["request_id"] == 3] == ["a"]


def test_blank_queries_have_no_hits_but_still_a_reply(spark, engines):
    rows = [(i, "the", "number", m, None) for i, m in enumerate(METHODS)]
    got = [r.asDict(recursive=True) for r in run_requests(requests(spark, *rows), engines).results.collect()]
    by_method = {m: [r for r in got if r["method"] == m] for m in METHODS}
    for method in ["tfidf", "embedding_faiss", "hybrid", "faiss_with_basics"]:
        assert by_method[method] == []
    assert len(by_method["embedding_brute_force"]) == 4  # the raw text has a vector
    assert "Context:\n\nQuestion: the" in by_method["rag_with_faiss"][0]["prompt"]
    assert by_method["rag_with_basics"][0]["prompt"] is None
    assert by_method["rag_with_basics"][0]["response"].startswith("Could not find any relevant")


def test_only_bad_requests(spark, engines):
    results, rejects = run_requests(requests(spark, (1, None, None, None, None)), engines)
    assert results.count() == 0 and rejects.count() == 1


def test_document_requests(spark, monkeypatch):
    corpus = spark.createDataFrame([(0, "zero"), (1, "one")], "doc_id LONG, text STRING")
    asked = spark.createDataFrame(
        [(1, 0, "d"), (2, 5, "d"), (3, None, "d"), (4, 1, ""), (5, 1, "x"), (6, 0, "d")],
        "request_id LONG, doc_id LONG, dataset STRING",
    )
    for few in [6, None]:
        monkeypatch.setattr("gleanery.plans.requests.rows_if_few", lambda df: few)
        got = {r["request_id"]: (r["content"], r["error"]) for r in get_documents(asked, {"d": corpus}).collect()}
        assert got == {
            1: ("zero", None),
            2: (None, "Document not found"),
            3: (None, "Missing doc_id or dataset"),
            4: (None, "Missing doc_id or dataset"),
            5: (None, "Document not found"),
            6: ("zero", None),
        }


def test_stream_equals_batch_and_answers_each_request_once(spark, engines, tmp_path):
    arrived, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = requests(spark, (1, "red wine", "number", "tfidf", None), (2, "q", "number", "x", None))
    second = requests(spark, (3, "cheese", "number", "hybrid", None))
    first.write.parquet(arrived)

    def run():
        stream = spark.readStream.schema(REQUEST).parquet(arrived)
        answer_stream(stream, engines, out, str(tmp_path / "checkpoint")).awaitTermination()

    run()
    second.write.mode("append").parquet(arrived)
    run()
    run()
    columns = ["request_id", "method", "rank", "doc_id", "score", "snippet"]
    got = read_answers(spark, out).select(columns)
    want = run_requests(first.unionByName(second), engines).results.select(columns)
    as_rows = lambda df: sorted(map(str, df.collect()))
    assert as_rows(got) == as_rows(want)
    assert [r["request_id"] for r in read_answers(spark, out, "rejects").collect()] == [2]


def test_all_methods_over_several_micro_batches_once_and_clean(spark, engines, tmp_path):
    """Replayed and repeated requests are answered once; nothing but answers is left."""
    import os

    arrived, out, state = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows = [(i, q, "number", m, k) for i, (q, m, k) in enumerate(
        [(q, m, k) for q in ("red wine", "blue cheese") for m in [*METHODS, "bm25"] for k in (None, "comparative")]
    )]
    own = {"number": engines["number"]}
    place = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(place))
    for i in range(0, len(rows), 10):
        again = rows[max(0, i - 3) : i + 10]  # the last three of the batch before come again
        requests(spark, *again).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", 4).parquet(arrived)
        answer_stream(stream, own, out, state).awaitTermination()
    assert set(os.listdir(place)) == before
    want = run_requests(requests(spark, *rows), own)
    as_rows = lambda df: sorted(map(str, df.collect()))
    assert as_rows(read_answers(spark, out)) == as_rows(want.results)
    columns = ["request_id", "query", "error"]
    assert as_rows(read_answers(spark, out, "rejects").select(columns)) == as_rows(want.rejects.select(columns))
    batches = len(os.listdir(f"{out}/results"))
    assert batches > 3
    # an unfinished micro-batch is not read
    spark.read.parquet(f"{out}/results/batch=0").write.parquet(f"{out}/results/batch=99")
    assert as_rows(read_answers(spark, out)) == as_rows(want.results)


def test_repeats_are_remembered_within_the_delay_of_their_arrival(spark, engines, tmp_path):
    arrived, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = REQUEST + ", at TIMESTAMP"

    def arrive(*rows):
        import datetime as d

        made = [(*r[:5], d.datetime(2024, 1, 1) + d.timedelta(hours=r[5])) for r in rows]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(schema).parquet(arrived)
        answer_stream(stream, {"number": engines["number"]}, out, str(tmp_path / "c"), arrival="at", delay="2 hours").awaitTermination()

    arrive((1, "wine", "number", "tfidf", None, 0), (2, "cheese", "number", "tfidf", None, 1))
    arrive((1, "wine", "number", "tfidf", None, 1), (3, "apples", "number", "tfidf", None, 1))
    firsts = read_answers(spark, out).filter("rank = 1").collect()
    assert sorted(r["request_id"] for r in firsts) == [1, 2, 3]


def test_searches_run_once_for_a_text_under_several_keys(spark, engines, monkeypatch):
    asked = []
    whole = Engine.hybrid_candidates
    monkeypatch.setattr(Engine, "hybrid_candidates", lambda self, q, *a, **k: asked.append(q) or whole(self, q, *a, **k))
    rows = [(i, "red wine", "number", "rag_with_basics", k) for i, k in enumerate([None, "comparative", "other"])]
    got = run_requests(requests(spark, *rows), {"number": engines["number"]}).results.collect()
    assert [q.count() for q in asked] == [1]
    assert len({r["prompt"] for r in got}) == 2 and len(got) == 3


def test_answers_to_very_many_requests_are_joined_alike(spark, engines, monkeypatch):
    rows = [(i, ["red wine", "cheese"][i % 7 == 0], "number", ["tfidf", "rag_with_basics"][i % 2], None) for i in range(60)]
    own = {"number": engines["number"]}
    as_rows = lambda: sorted(map(str, run_requests(requests(spark, *rows), own).results.collect()))
    want = as_rows()
    monkeypatch.setattr("gleanery.plans.requests.rows_if_few", lambda df: None)
    monkeypatch.setattr("gleanery.operators.joins.HOT_ROWS", 5)
    assert as_rows() == want and len({r for r in want}) == len(want)


def test_chunk_answers_name_their_chunk(spark, engines):
    got = run_requests(requests(spark, (1, "wine red", "number", "rag_with_faiss", None)), {"number": engines["number"]})
    assert [(e["doc_id"], e["chunk_no"]) for r in got.results.collect() for e in r["retrieved_context"]] == [(0, 0)]


@pytest.mark.parametrize("method, option", [("tfidf", "by_postings"), ("chunk", "by_groups")])
def test_tables_for_few_queries_give_the_rows_of_a_scan(spark, engines, method, option):
    asked = spark.createDataFrame([(1, "red wine"), (2, "cheese"), (3, "of the"), (4, "zebra")], "query_id LONG, query STRING")
    for engine in engines.values():
        answer = getattr(engine, method)
        as_rows = lambda df: sorted(str(sorted(r.asDict().items())) for r in df.collect())
        assert as_rows(answer(asked, **{option: True})) == as_rows(answer(asked))


def test_requests_of_equal_ids_are_independent(spark, engines):
    rows = [(1, "red wine", "number", "hybrid", None), (1, "blue cheese", "number", "rag_with_basics", None),
            (1, "green apples", "number", "rag_with_basics", None), (2, "red wine", "number", "hybrid", None)]
    got = run_requests(requests(spark, *rows), {"number": engines["number"]}).results.collect()
    best = {(r["request_id"], r["query"]): r["doc_id"] for r in got if r["rank"] == 1}
    assert best == {(1, "red wine"): 0, (2, "red wine"): 0}
    context = {r["query"]: r["retrieved_context"][0]["doc_id"] for r in got if r["method"] == "rag_with_basics"}
    assert context == {"blue cheese": 3, "green apples": 1}


def test_instruction_keys_and_queries_do_not_run_together(spark, engines):
    rows = [(1, "cheese", "number", "tfidf", "red\nwine"), (2, "wine\ncheese", "number", "tfidf", "red"),
            (3, "wine\ncheese", "number", "tfidf", None), (4, "cheese", "number", "tfidf", "default\nwine")]
    asked = requests(spark, *rows)
    alone = {r[0]: run_requests(asked.filter(F.col("request_id") == r[0]), engines).results.collect() for r in rows}
    got = run_requests(asked, engines).results.collect()
    assert sorted(map(str, got)) == sorted(str(r) for some in alone.values() for r in some)


def test_one_schema_whatever_the_methods(spark, engines):
    engine = {"number": engines["number"]}
    schemas = [
        run_requests(requests(spark, (1, "wine", "number", m, None)), engine).results.schema.simpleString()
        for m in ("tfidf", "rag_with_faiss", "no method")
    ]
    assert len(set(schemas)) == 1


def test_malformed_document_ids_fail_alone(spark):
    corpora = {
        "number": spark.createDataFrame([(0, "zero")], "doc_id LONG, text STRING"),
        "string": spark.createDataFrame([("abc", "letters")], "doc_id STRING, text STRING"),
    }
    asked = spark.createDataFrame(
        [(1, "abc", "number"), (2, "abc", "string"), (3, "0", "number")],
        "request_id LONG, doc_id STRING, dataset STRING",
    )
    got = {r["request_id"]: (r["doc_id"], r["content"]) for r in get_documents(asked, corpora).collect()}
    assert got == {1: ("abc", None), 2: ("abc", "letters"), 3: ("0", "zero")}
