"""Word-window chunks, their vectors, and inner-product search over them.

Searches read keys and vectors; the texts of the few winners are fetched afterwards.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import split_words
from gleanery.functions.vectors import pair_dot, rounded, unit
from gleanery.operators.dense import broadcast_vectors, searchable
from gleanery.operators.encoders import Encoder
from gleanery.operators.joins import join_wanted, look_up
from gleanery.operators.ranking import best_first, top_ranked
from gleanery.operators.scan import DenseQueries, measure, search_top_k
from gleanery.sources.layout import bucket_names, without_bucket

# The order of chunks within a corpus, which settles ties.
CHUNK_KEY = ["doc_id", "chunk_no"]


def chunk_documents(docs: DataFrame, size: int = 100, overlap: int = 20) -> DataFrame:
    """Windows of ``size`` words that overlap: ``(doc_id, chunk_no, text)``."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than the chunk size")

    # All windows are cut inside the row, where the one-element array makes the words
    # a variable: exploding the starts would copy all words once per chunk.
    def windows(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words), F.lit(size - overlap))
        cut = F.transform(starts, lambda at: F.array_join(F.slice(words, at, size), " "))
        return F.when(F.size(words) > 0, cut)

    texts = F.transform(F.array(split_words(F.col("text"))), windows)[0]
    return docs.select("doc_id", F.posexplode(texts).alias("chunk_no", "text"))


def chunk_vectors(chunks: DataFrame, encoder: Encoder) -> DataFrame:
    """Chunks with their unit vectors: ``(doc_id, chunk_no, text, embedding)``."""
    encoded = encoder.encode(chunks, "text", "embedding")
    return encoded.withColumn("embedding", unit(F.col("embedding")))


def build_chunk_vectors(
    docs: DataFrame, encoder: Encoder, size: int = 100, overlap: int = 20
) -> DataFrame:
    """The chunks of documents with their unit vectors."""
    return chunk_vectors(chunk_documents(docs, size, overlap), encoder)


def unit_queries(query_vectors: DataFrame) -> DataFrame:
    return searchable(query_vectors).withColumn("query_vector", unit(F.col("query_vector")))


def chunk_search(
    query_vectors: DataFrame,
    chunks: DataFrame,
    top_k: int = 5,
    threshold: float | None = 0.7,
    digits: int | None = 6,
    texts: DataFrame | None = None,
) -> tuple[DataFrame, int | None]:
    """The best chunks of each query with all their columns, then the threshold.

    The threshold (inclusive) applies to the ``top_k`` chunks, so a query may end
    up with fewer, and several chunks of one document may be among them.  ``texts`` has
    the further columns of chunks by their key, unless ``chunks`` itself does.
    """
    queries = unit_queries(query_vectors)
    hits, max_rows = search_top_k(
        queries,
        chunks.select(*CHUNK_KEY, "embedding"),
        partial(DenseQueries, scaled=False),
        top_k,
        keep=CHUNK_KEY,
        ties=CHUNK_KEY,
        size=measure(queries, F.size("query_vector")),
        digits=digits,
    )
    if threshold is not None:
        hits = hits.filter(F.col("score") >= threshold)
    texts = chunks.drop("embedding") if texts is None else texts
    return with_chunk_columns(hits, texts, max_rows), max_rows


def with_chunk_columns(hits: DataFrame, texts: DataFrame, max_rows: int | None) -> DataFrame:
    """Attach the columns of each hit's chunk."""
    others = [c for c in without_bucket(texts).columns if c not in CHUNK_KEY]
    found = look_up(hits, texts, CHUNK_KEY, max_rows)
    return found.select("query_id", "rank", *CHUNK_KEY, *others, "score")


def chunk_search_in_candidates(
    query_vectors: DataFrame,
    candidates: DataFrame,
    chunks: DataFrame,
    top_k: int = 10,
    max_candidates: int | None = None,
    digits: int | None = 6,
    texts: DataFrame | None = None,
) -> DataFrame:
    """Exact search in the chunks of each query's candidate documents, no threshold.

    ``max_candidates`` is the number of candidate rows at most, where known.  The
    whole chunk text is the snippet.  Chunks that are clustered by ``doc_id`` stay where
    they lie; see ``chunk_search`` for ``texts``.
    """
    wanted = candidates.select("query_id", "doc_id").distinct()
    pairs = join_wanted(chunks.select(*CHUNK_KEY, "embedding"), wanted, "doc_id", max_candidates)
    queries = unit_queries(query_vectors)
    scored = pairs.join(broadcast_vectors(queries), "query_id")
    score = rounded(pair_dot(F.col("embedding"), F.col("query_vector")), digits)
    scored = scored.select("query_id", *CHUNK_KEY, score.alias("score"))
    hits = top_ranked(scored, top_k, best_first(*CHUNK_KEY))
    max_rows = None if max_candidates is None else max_candidates * top_k
    texts = chunks if texts is None else texts
    snippets = texts.select(*CHUNK_KEY, F.col("text").alias("snippet"), *bucket_names(texts))
    found = with_chunk_columns(hits, snippets, max_rows)
    return found.select("query_id", "rank", *CHUNK_KEY, "score", "snippet")
