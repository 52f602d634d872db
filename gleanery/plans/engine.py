"""The offline build of a dataset and the search methods on top of it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.chunks import (
    CHUNK_KEY,
    chunk_documents,
    chunk_search,
    chunk_search_in_candidates,
    chunk_vectors,
    unit_queries,
    with_chunk_columns,
)
from gleanery.operators.cleaning import Lemmas, noun_lemmas
from gleanery.operators.clusters import grouped_search, write_groups
from gleanery.operators.dense import embedding_search
from gleanery.operators.encoders import (
    Encoder,
    embed_cleaned_queries,
    embed_documents,
    embed_raw_queries,
)
from gleanery.operators.hybrid import rerank
from gleanery.operators.joins import BROADCAST_ROWS, rows_if_few
from gleanery.operators.postings import first_ids, postings_answers, term_blocks
from gleanery.operators.prompts import NO_CONTENT, build_prompts
from gleanery.operators.ranking import snippet_table, with_snippets, with_texts
from gleanery.operators.sparse import (
    Weighting,
    document_vectors,
    lemma_counts,
    term_statistics,
    tfidf_candidates,
    tfidf_search,
    vocabulary_of,
    word_counts,
)
from gleanery.session import materialise
from gleanery.sources.artifacts import ArtifactStore
from gleanery.sources.layout import without_bucket


def build_sparse(
    store: ArtifactStore,
    dataset: str,
    docs: DataFrame,
    lemma_table: DataFrame | None = None,
    weighting: Weighting = Weighting(),
) -> None:
    """Write ``lemmas``, ``bag``, ``term_stats`` and ``doc_vectors`` of a corpus.

    Lemmas are derived from the ``vocabulary`` of the corpus unless given.  Texts are read
    and cut into words once, for ``word_counts``, and never shuffled.
    """
    counts = store.write("word_counts", dataset, word_counts(docs))
    if lemma_table is None:
        words = store.write("vocabulary", dataset, vocabulary_of(counts))
        lemma_table = noun_lemmas(words)
    lemmas = Lemmas(store.write("lemmas", dataset, lemma_table))
    bag = store.write("bag", dataset, lemma_counts(counts, lemmas))
    stats = store.write("term_stats", dataset, term_statistics(bag, counts.count(), weighting))
    store.write_by_bucket("doc_vectors", dataset, document_vectors(bag, stats, weighting), "doc_id")


def build_postings(store: ArtifactStore, dataset: str) -> None:
    """Write ``postings`` and ``first_ids`` of a dataset whose vectors are written."""
    vectors, stats = store.read("doc_vectors", dataset), store.read("term_stats", dataset)
    store.write_by_bucket("postings", dataset, term_blocks(vectors, stats, buckets=store.buckets), "term")
    store.write("first_ids", dataset, first_ids(vectors))


def build_snippets(store: ArtifactStore, dataset: str, docs: DataFrame) -> None:
    """Write ``snippets``, so that searches need not read whole texts for them."""
    store.write_by_bucket("snippets", dataset, snippet_table(docs), "doc_id")


def build_corpus(store: ArtifactStore, dataset: str, docs: DataFrame) -> None:
    """Write ``corpus``: the texts in folders by bucket of their id, for lookups of few."""
    store.write_by_bucket("corpus", dataset, docs, "doc_id")


def build_embeddings(
    store: ArtifactStore, dataset: str, docs: DataFrame, encoder: Encoder
) -> None:
    """Write ``embeddings``, one vector per document, clustered by id."""
    store.write_clustered("embeddings", dataset, embed_documents(docs, encoder), "doc_id")


def build_chunks(
    store: ArtifactStore,
    dataset: str,
    docs: DataFrame,
    encoder: Encoder,
    size: int = 100,
    overlap: int = 20,
) -> None:
    """Write ``chunk_texts``, by bucket, and ``chunks``, their unit vectors, clustered by id."""
    texts = store.write_by_bucket("chunk_texts", dataset, chunk_documents(docs, size, overlap), "doc_id")
    vectors = chunk_vectors(without_bucket(texts), encoder).drop("text")
    store.write_clustered("chunks", dataset, vectors, "doc_id")


def build_chunk_groups(store: ArtifactStore, dataset: str) -> None:
    """Write ``chunk_groups`` and their pivots: the vectors of ``chunks`` by nearness."""
    vectors = store.read_clustered("chunks", dataset, "doc_id")
    write_groups(store, "chunk_groups", dataset, vectors, CHUNK_KEY)


@dataclass(frozen=True)
class Engine:
    """Every search method over one dataset, each for a whole table of queries.

    Queries are ``(query_id, query)``.  ``encoder`` makes query vectors; where the
    vectors of queries exist as a table, pass them as ``query_vectors`` instead.
    """

    corpus: DataFrame
    snippets: DataFrame
    lemmas: Lemmas
    term_stats: DataFrame
    doc_vectors: DataFrame
    embeddings: DataFrame
    chunks: DataFrame
    encoder: Encoder
    query_vectors: DataFrame | None = None
    weighting: Weighting = Weighting()
    chunk_texts: DataFrame | None = None
    postings: DataFrame | None = None
    first_ids: DataFrame | None = None
    chunk_groups: DataFrame | None = None
    chunk_pivots: DataFrame | None = None

    @classmethod
    def load(
        cls, store: ArtifactStore, dataset: str, encoder: Encoder, postings: bool = False, groups: bool = False
    ) -> Engine:
        """The engine over the tables that the builds of this module have written.

        ``postings`` and ``groups`` say that ``build_postings`` and ``build_chunk_groups``
        were run too.
        """
        return cls(
            store.read("corpus", dataset),
            store.read("snippets", dataset),
            Lemmas(store.read("lemmas", dataset)),
            store.read("term_stats", dataset),
            store.read("doc_vectors", dataset),
            store.read_clustered("embeddings", dataset, "doc_id"),
            store.read_clustered("chunks", dataset, "doc_id"),
            encoder,
            chunk_texts=store.read("chunk_texts", dataset),
            postings=store.read("postings", dataset) if postings else None,
            first_ids=store.read("first_ids", dataset) if postings else None,
            chunk_groups=store.read("chunk_groups", dataset) if groups else None,
            chunk_pivots=store.read("chunk_groups_pivots", dataset) if groups else None,
        )

    def raw_vectors(self, queries: DataFrame) -> DataFrame:
        if self.query_vectors is not None:
            return self.query_vectors.join(queries.select("query_id"), "query_id", "left_semi")
        return embed_raw_queries(queries, self.encoder)

    def tfidf(
        self,
        queries: DataFrame,
        top_n: int = 10,
        candidate_k: int | None = None,
        by_postings: bool = False,
    ) -> DataFrame:
        """TF-IDF search; ``by_postings`` pays for few queries, and gives the same rows."""
        if by_postings and self.postings is not None and top_n > 0:
            k = min(top_n, candidate_k) if candidate_k else top_n
            found = postings_answers(
                queries, self.doc_vectors, self.term_stats, self.postings, self.first_ids,
                self.lemmas, k, self.weighting,
            )
            return found.with_snippets(self.snippets)
        return tfidf_search(
            queries,
            self.snippets,
            self.doc_vectors,
            self.term_stats,
            self.lemmas,
            top_n,
            candidate_k,
            self.weighting,
        )

    def embedding(self, queries: DataFrame, top_n: int = 10) -> DataFrame:
        return embedding_search(self.raw_vectors(queries), self.embeddings, self.snippets, top_n)

    def chunk(
        self, queries: DataFrame, top_k: int = 5, threshold: float = 0.7, by_groups: bool = False
    ) -> DataFrame:
        """Chunk search; ``by_groups`` pays for few queries, and gives the same rows."""
        vectors = embed_cleaned_queries(queries, self.encoder, self.lemmas)
        if by_groups and self.chunk_groups is not None and top_k > 0:
            asked = materialise(unit_queries(vectors), "queries")
            hits, max_rows = grouped_search(
                asked, self.chunk_groups, self.chunk_pivots, CHUNK_KEY, top_k, threshold
            )
            return with_chunk_columns(hits, self.chunk_texts, max_rows)
        return chunk_search(vectors, self.chunks, top_k, threshold, texts=self.chunk_texts)[0]

    def hybrid_candidates(
        self, queries: DataFrame, top_n: int = 10, top_k_sparse: int = 1000
    ) -> tuple[DataFrame, int | None]:
        """Hybrid hits without snippets, and how many there are at most."""
        sparse, max_rows = tfidf_candidates(
            queries,
            self.doc_vectors,
            self.term_stats,
            self.lemmas,
            top_k_sparse,
            weighting=self.weighting,
        )
        hits = rerank(sparse, self.raw_vectors(queries), self.embeddings, top_n, max_rows)
        if max_rows is not None:
            max_rows = max_rows // top_k_sparse * min(top_n, top_k_sparse)
        if max_rows is None or max_rows > BROADCAST_ROWS:  # of many candidates few may have vectors
            hits = materialise(hits, "hybrid")
            max_rows = rows_if_few(hits)
        return hits, max_rows

    def hybrid(self, queries: DataFrame, top_n: int = 10, top_k_sparse: int = 1000) -> DataFrame:
        hits, max_rows = self.hybrid_candidates(queries, top_n, top_k_sparse)
        return with_snippets(hits, self.snippets, max_rows)

    def chunk_in_hybrid(
        self,
        queries: DataFrame,
        top_k: int = 10,
        candidate_docs: int = 50,
        top_k_sparse: int = 1000,
    ) -> DataFrame:
        """The best chunks among the documents of a hybrid search, by the raw query."""
        hits, max_rows = self.hybrid_candidates(queries, candidate_docs, top_k_sparse)
        return self.chunk_in_documents(queries, hits, max_rows, top_k)

    def chunk_in_documents(
        self, queries: DataFrame, hits: DataFrame, max_rows: int | None, top_k: int = 10
    ) -> DataFrame:
        vectors = embed_raw_queries(queries, self.encoder)
        return chunk_search_in_candidates(
            vectors, hits, self.chunks, top_k, max_rows, texts=self.chunk_texts
        )

    def prompts_from_chunks(
        self, queries: DataFrame, top_k: int = 5, threshold: float = 0.7
    ) -> DataFrame:
        """Prompts over chunk hits; ``queries`` also has ``instruction_key``."""
        return build_prompts(queries, self.chunk(queries, top_k, threshold))

    def prompts_from_hybrid(
        self, queries: DataFrame, top_k: int = 3, top_k_sparse: int = 1000
    ) -> DataFrame:
        """Prompts over whole texts of hybrid hits, or the fixed reply without hits."""
        hits, max_rows = self.hybrid_candidates(queries, top_k, top_k_sparse)
        return self.prompts_from_documents(queries, hits, max_rows)

    def prompts_from_documents(
        self, queries: DataFrame, hits: DataFrame, max_rows: int | None
    ) -> DataFrame:
        texts = with_texts(hits, self.corpus, max_rows, NO_CONTENT)
        return build_prompts(queries, texts, prompt_when_empty=False)
