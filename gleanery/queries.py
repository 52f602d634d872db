"""The registered queries: every operator over the whole fixture tables.

Queries are whole tables too: all ``benchmark`` texts, unless said otherwise.
Arrays are flattened, so that results compare value by value.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.text import (
    content_words,
    normalise_text,
    snippet,
    split_words,
    suffixed_snippet,
    word_tokens,
)
from gleanery.functions.vectors import unit
from gleanery.operators import prompts
from gleanery.operators.chunks import chunk_documents
from gleanery.operators.cleaning import clean
from gleanery.operators.encoders import process_queries
from gleanery.operators.joins import join_wanted
from gleanery.operators.sparse import bag_rows, document_weights, query_vectors, tfidf_candidates
from gleanery.plans.requests import METHODS, get_documents, run_requests, validate
from gleanery.plans.workbench import Workbench
from gleanery.streaming.feed import answer_stream, read_answers

REGISTRY = {}


def registered(query):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(Workbench.of(spark, folder))

    REGISTRY[query.__name__] = run
    return query


def flat_vector(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """One row per vector entry that is not zero."""
    rows = df.select(*keys, F.posexplode(vector).alias("pos", "value"))
    value = F.round(F.col("value").cast("double"), 6)
    return rows.filter(F.col("value") != 0).withColumn("value", value)


# Sources


@registered
def doc_scan(w):
    return w.docs


@registered
def doc_scan_other_id(w):
    return w.catalog.documents("benchmark")


@registered
def doc_ids(w):
    return w.catalog.doc_ids("documents")


@registered
def doc_string_ids(w):
    return w.catalog.documents_with_string_ids("documents")


@registered
def doc_lookup(w):
    return w.catalog.content("documents", 42)


@registered
def doc_lookup_batch(w):
    assert w.corpus is not None  # laid out by id, which lookups use
    ids = w.table("customer").select(F.col("c_custkey").alias("doc_id"))
    return w.catalog.contents("documents", ids)


@registered
def doc_scan_keep_last(w):
    """Turns of a conversation share its id: the last one is its text."""
    return w.catalog.documents("turns")


@registered
def queries_tsv(w):
    return w.text_files.queries("documents")


@registered
def queries_jsonl(w):
    return w.text_files.queries("benchmark")


@registered
def qrels_spaced(w):
    return w.text_files.qrels("documents")


@registered
def qrels_tsv(w):
    return w.text_files.qrels("benchmark")


# Text


@registered
def normalised_text(w):
    return w.spread_docs.select("doc_id", normalise_text(F.col("text")).alias("normalised"))


@registered
def tokenize(w):
    tokens = word_tokens(normalise_text(F.col("text")))
    return w.spread_docs.select(
        "doc_id", F.size(tokens).alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


@registered
def whitespace_tokens(w):
    tokens = split_words(F.col("text"))
    return w.spread_docs.select(
        "doc_id", F.size(tokens).alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


@registered
def stopword_filter(w):
    tokens = content_words(F.col("text"))
    return w.spread_docs.select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@registered
def noun_lemma_pairs(w):
    return w.lemmas.table


@registered
def clean_text(w):
    cleaned = clean(w.spread_docs, "text", w.lemmas)
    return cleaned.select("doc_id", "cleaned", F.size("tokens").alias("n_tokens"))


@registered
def snippets(w):
    text = F.col("text")
    return w.docs.select(
        "doc_id", snippet(text).alias("snippet"), suffixed_snippet(text).alias("suffixed")
    )


# Sparse retrieval


@registered
def bag_of_words(w):
    return bag_rows(w.bag)


@registered
def tfidf_term_stats(w):
    return w.term_stats.withColumn("idf", F.round("idf", 6))


@registered
def tfidf_weights(w):
    weights = document_weights(w.doc_vectors)
    return weights.withColumn("weight", F.round("weight", 6))


@registered
def tfidf_query_weights(w):
    cleaned = clean(w.queries, "query", w.lemmas)
    entry = F.explode(F.arrays_zip("query_terms", "query_weights")).alias("e")
    return (
        query_vectors(cleaned, w.term_stats)
        .select("query_id", entry)
        .select(
            "query_id",
            F.col("e.query_terms").alias("term"),
            F.round("e.query_weights", 6).alias("weight"),
        )
    )


@registered
def tfidf_search(w):
    return w.given_engine.tfidf(w.queries)


@registered
def tfidf_search_postings(w):
    """The search by term blocks instead of a scan over all vectors."""
    return w.posting_engine.tfidf(w.queries, by_postings=True)


@registered
def tfidf_zero_fill_postings(w):
    parts = w.table("part")
    asked = parts.select(F.col("p_partkey").alias("query_id"), F.col("p_name").alias("query"))
    return w.posting_engine.tfidf(asked, by_postings=True).select("query_id", "rank", "doc_id", "score")


@registered
def tfidf_two_stage(w):
    return w.given_engine.tfidf(w.queries, top_n=10, candidate_k=4)


@registered
def tfidf_zero_fill(w):
    """Part names share few words or none with the corpus; zero scores fill up."""
    parts = w.table("part")
    asked = parts.select(F.col("p_partkey").alias("query_id"), F.col("p_name").alias("query"))
    return w.given_engine.tfidf(asked).select("query_id", "rank", "doc_id", "score")


# Dense retrieval


@registered
def l2_normalize(w):
    vectors = w.given_vectors.select("doc_id", unit(F.col("embedding")).alias("embedding"))
    return flat_vector(vectors, ["doc_id"], "embedding")


@registered
def document_embeddings(w):
    return flat_vector(w.embeddings, ["doc_id"], "embedding")


@registered
def query_records(w):
    records = process_queries(w.queries, w.encoder, w.lemmas)
    keys = ["query_id", "original_query", "preprocessed_text"]
    return flat_vector(records, keys, "query_embedding")


@registered
def embedding_search(w):
    return w.given_engine.embedding(w.queries)


@registered
def embedding_search_encoded(w):
    return w.engine.embedding(w.queries)


# Chunks


@registered
def chunks(w):
    return chunk_documents(w.spread_docs)


@registered
def chunk_embeddings(w):
    return flat_vector(w.chunks, ["doc_id", "chunk_no"], "embedding")


@registered
def chunk_search(w):
    return w.engine.chunk(w.queries)


@registered
def chunk_search_low_threshold(w):
    return w.engine.chunk(w.queries, threshold=0.3)


@registered
def chunk_search_grouped(w):
    """The search by groups of near vectors instead of a scan over all."""
    return w.grouped_engine.chunk(w.queries, by_groups=True)


@registered
def chunk_search_grouped_low_threshold(w):
    return w.grouped_engine.chunk(w.queries, threshold=0.3, by_groups=True)


@registered
def chunk_search_in_candidates(w):
    return w.engine.chunk_in_hybrid(w.queries, top_k_sparse=60)


# Hybrid


@registered
def hybrid_candidates(w):
    sparse, max_rows = tfidf_candidates(w.queries, w.doc_vectors, w.term_stats, w.lemmas, 50)
    wanted = sparse.select("query_id", "doc_id", F.col("rank").alias("sparse_rank"))
    return join_wanted(w.given_vectors.select("doc_id"), wanted, "doc_id", max_rows)


@registered
def hybrid_search(w):
    return w.given_engine.hybrid(w.queries)


@registered
def hybrid_search_narrow(w):
    return w.given_engine.hybrid(w.queries, top_k_sparse=50)


# Prompts

# Keys a query may ask for; the last one is not known.
KEYS = [*prompts.INSTRUCTIONS, "unknown"]


def with_instruction(w) -> DataFrame:
    place = F.pmod("query_id", F.lit(len(KEYS))).cast("int")
    keys = F.array(*[F.lit(k) for k in KEYS])
    return w.queries.withColumn("instruction_key", F.get(keys, place))


@registered
def instruction_lookup(w):
    key = F.col("instruction_key")
    return with_instruction(w).select(
        "query_id", "instruction_key", prompts.instruction(key).alias("instruction")
    )


@registered
def prompt_budget(w):
    budget = prompts.context_budget(F.col("query"), F.col("instruction_key"))
    return with_instruction(w).select("query_id", budget.alias("budget"))


@registered
def prompt_packing(w):
    hits = w.engine.chunk(w.queries, threshold=0.3)
    packed = prompts.pack_passages(with_instruction(w), hits)
    return packed.select("query_id", "rank", "doc_id", "chunk_no", "tokens", "packed")


@registered
def prompt_text(w):
    built = w.engine.prompts_from_chunks(with_instruction(w), threshold=0.3)
    return built.select("query_id", "query", "prompt")


@registered
def prompt_text_default(w):
    """At the default threshold most queries find nothing: a bare context header."""
    built = w.engine.prompts_from_chunks(with_instruction(w))
    return built.select("query_id", "prompt", F.size("retrieved_context").alias("n_retrieved"))


@registered
def prompt_context(w):
    built = w.engine.prompts_from_chunks(with_instruction(w), threshold=0.3)
    rows = built.select("query_id", F.posexplode("retrieved_context").alias("pos", "entry"))
    return rows.select("query_id", "pos", "entry.*")


@registered
def prompt_from_hybrid(w):
    built = w.given_engine.prompts_from_hybrid(with_instruction(w), top_k_sparse=50)
    return built.select(
        "query_id", "prompt", "response", F.size("retrieved_context").alias("n_retrieved")
    )


@registered
def prompt_without_hits(w):
    """Part names whose sparse candidates have no vector get the fixed reply."""
    parts = w.table("part")
    asked = parts.select(
        F.col("p_partkey").alias("query_id"),
        F.col("p_name").alias("query"),
        F.lit("default").alias("instruction_key"),
    )
    vectors = w.given_vectors.select(
        F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector")
    )
    engine = replace(w.given_engine, query_vectors=vectors)
    hits = engine.prompts_from_hybrid(asked, top_k_sparse=1)
    return hits.select(
        "query_id", "prompt", "response", F.size("retrieved_context").alias("n_retrieved")
    )


# Requests


def all_requests(w) -> DataFrame:
    """Every query with every method."""
    methods = F.array(*[F.lit(m) for m in METHODS])
    rows = w.queries.select("query_id", "query", F.posexplode(methods).alias("place", "method"))
    return rows.select(
        (F.col("query_id") * len(METHODS) + F.col("place")).alias("request_id"),
        "query",
        F.lit("documents").alias("dataset"),
        "method",
        F.lit("comparative").alias("instruction_key"),
    )


@registered
def dispatch(w):
    answers = run_requests(all_requests(w), {"documents": w.engine})
    context = F.size("retrieved_context").alias("n_retrieved")
    return answers.results.select("*", context).drop("retrieved_context")


@registered
def request_validation(w):
    item = F.col("query_id")
    flawed = w.queries.select(
        item.alias("request_id"),
        F.when(item % 3 == 0, F.lit("")).otherwise(F.col("query")).alias("query"),
        F.when(item % 5 == 0, F.lit("elsewhere")).otherwise(F.lit("documents")).alias("dataset"),
        F.when(item % 4 == 0, F.lit("bm25"))
        .when(item % 7 == 0, F.lit(None))
        .otherwise(F.lit("tfidf"))
        .alias("method"),
        F.lit(None).cast("string").alias("instruction_key"),
    )
    return validate(flawed, ["documents"]).select("request_id", "instruction_key", "error")


@registered
def document_requests(w):
    key = F.col("c_custkey")
    asked = w.table("customer").select(
        key.alias("request_id"),
        F.when(key % 7 != 0, key).alias("doc_id"),
        F.when(key % 11 == 0, F.lit(""))
        .when(key % 2 == 0, F.lit("benchmark"))
        .otherwise(F.lit("documents"))
        .alias("dataset"),
    )
    assert w.corpus is not None  # laid out by id, which lookups use
    corpora = {n: w.catalog.by_id(n) for n in ["documents", "benchmark"]}
    return get_documents(asked, corpora)


@registered
def dispatch_repeated_ids(w):
    """Every request id is used by two queries, and asked twice over with another key."""
    half = F.col("request_id") - F.col("request_id") % (2 * len(METHODS)) + F.col("request_id") % len(METHODS)
    asked = all_requests(w).filter(F.col("method").isin("tfidf", "embedding_faiss", "rag_with_basics"))
    asked = asked.withColumn("request_id", half)
    twice = asked.union(asked.withColumn("instruction_key", F.lit("default")))
    answers = run_requests(twice, {"documents": w.engine})
    context = F.size("retrieved_context").alias("n_retrieved")
    return answers.results.select("*", context).drop("retrieved_context")


def _arriving(w) -> DataFrame:
    """All methods for all queries, as rows that arrive in four files, some of them again.

    Requests of every fifth query are flawed.
    """
    item = F.floor(F.col("request_id") / len(METHODS))
    flawed = F.when(item % 5 == 0, F.lit("bm25")).otherwise(F.col("method"))
    rows = all_requests(w).withColumns({"method": flawed, "file": (item % 3).cast("int")})
    again = rows.filter(item % 4 == 0).withColumn("file", F.lit(3))
    place = f"{w.store.root}/arriving-{uuid.uuid4().hex}"
    for number in range(4):  # one after the other, so that they arrive in this order
        part = rows.union(again).filter(F.col("file") == number).drop("file")
        part.write.mode("append").parquet(place)
    schema = rows.drop("file").schema
    return w.spark.readStream.schema(schema).option("maxFilesPerTrigger", 6).parquet(place)


def _streamed(w) -> str:
    place = f"{w.store.root}/stream-{uuid.uuid4().hex}"
    stream = answer_stream(_arriving(w), {"documents": w.engine}, f"{place}/answers", f"{place}/checkpoint")
    stream.awaitTermination()
    return f"{place}/answers"


@registered
def streamed_requests(w):
    """All seven methods over several micro-batches; what arrives again is not answered again."""
    results = read_answers(w.spark, _streamed(w))
    context = F.size("retrieved_context").alias("n_retrieved")
    return results.select("*", context).drop("retrieved_context")


@registered
def streamed_rejects(w):
    return read_answers(w.spark, _streamed(w), "rejects").select("request_id", "query", "method", "error")
