"""Sparse candidates reranked by dense cosine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.vectors import pair_cosine, rounded
from gleanery.operators.dense import broadcast_vectors, searchable
from gleanery.operators.joins import BROADCAST_ROWS, join_wanted
from gleanery.operators.ranking import top_ranked


def rerank(
    candidates: DataFrame,
    query_vectors: DataFrame,
    embeddings: DataFrame,
    top_n: int = 10,
    max_candidates: int | None = None,
    digits: int | None = 6,
) -> DataFrame:
    """Order sparse candidates by the cosine of their vectors alone.

    ``candidates`` has ``(query_id, doc_id, rank)``.  One without a vector drops
    out; equal cosines keep the sparse order.
    """
    wanted = candidates.select("query_id", "doc_id", F.col("rank").alias("sparse_rank"))
    asked = searchable(query_vectors)
    if max_candidates is None or max_candidates > BROADCAST_ROWS:  # only queries that have a vector can rank theirs
        wanted = wanted.join(asked.select("query_id").distinct(), "query_id", "left_semi")
    vectors = embeddings.filter(F.col("embedding").isNotNull()).select("doc_id", "embedding")
    pairs = join_wanted(vectors, wanted, "doc_id", max_candidates)
    scored = pairs.join(broadcast_vectors(asked), "query_id").select(
        "query_id",
        "doc_id",
        "sparse_rank",
        rounded(pair_cosine(F.col("query_vector"), F.col("embedding")), digits).alias("score"),
    )
    ranked = top_ranked(scored, top_n, [F.desc("score"), F.asc("sparse_rank")])
    return ranked.select("query_id", "rank", "doc_id", "score")
