"""Cosine search over document vectors."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.ranking import with_snippets
from gleanery.operators.scan import QUERY_ENTRIES, DenseQueries, measure, search_top_k


def searchable(query_vectors: DataFrame) -> DataFrame:
    """Queries that have a vector."""
    return query_vectors.filter(F.size("query_vector") > 0).select("query_id", "query_vector")


def broadcast_vectors(query_vectors: DataFrame) -> DataFrame:
    """Query vectors with a broadcast hint, if their total size is within bounds."""
    total = F.coalesce(F.sum(F.size("query_vector")), F.lit(0))
    small = query_vectors.agg(total).first()[0] <= QUERY_ENTRIES
    return F.broadcast(query_vectors) if small else query_vectors


def dense_candidates(
    query_vectors: DataFrame, embeddings: DataFrame, top_n: int = 10, digits: int | None = 6
) -> tuple[DataFrame, int | None]:
    """Ranked ``(query_id, rank, doc_id, score)`` by exact cosine over all documents."""
    queries = searchable(query_vectors)
    return search_top_k(
        queries,
        embeddings.filter(F.col("embedding").isNotNull()).select("doc_id", "embedding"),
        partial(DenseQueries, scaled=True),
        top_n,
        keep=["doc_id"],
        ties=["doc_id"],
        size=measure(queries, F.size("query_vector")),
        digits=digits,
    )


def embedding_search(
    query_vectors: DataFrame, embeddings: DataFrame, snippets: DataFrame, top_n: int = 10
) -> DataFrame:
    """Dense search: ``(query_id, rank, doc_id, score, snippet)``."""
    hits, max_rows = dense_candidates(query_vectors, embeddings, top_n)
    return with_snippets(hits, snippets, max_rows)
