"""Text to vector: the one place where a model plugs in."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import delete_punctuation, split_words, text_or_blank
from gleanery.operators.cleaning import Lemmas, clean


class Encoder(Protocol):
    """Adds a float vector ``out_col`` for the text in ``text_col``."""

    def encode(self, df: DataFrame, text_col: str, out_col: str) -> DataFrame: ...


def _as_float_lists(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype="int32") * matrix.shape[1]
    return pa.ListArray.from_arrays(offsets, matrix.astype("float32").ravel())


# Words whose cells are held at once, but for a longer text.
STEP_WORDS = 1 << 18


def _cells(words: pa.Array, dim: int) -> np.ndarray:
    """Bucket plus one of every word, negative where its sign is."""
    cells = np.empty(len(words), np.int32)
    for i, word in enumerate(words):
        digest = hashlib.md5(word.as_py().encode()).hexdigest()
        bucket = int(digest[:8], 16) % dim + 1
        cells[i] = bucket if int(digest[8], 16) < 8 else -bucket
    return cells


class HashEncoder:
    """Signed feature hashing of words, scaled to length one.

    A deterministic lexical stand-in, not a semantic model: texts are close when
    they share words.  Words are lower-cased and lose their punctuation; the first
    32 bits of a word's MD5 pick the bucket and the next hex digit the sign.
    """

    def __init__(self, dim: int = 64):
        self.dim = dim

    def words(self, text: Column) -> Column:
        return split_words(delete_punctuation(F.lower(text_or_blank(text))))

    def encode(self, df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        dim = self.dim

        @F.arrow_udf("array<float>")
        def hashed(lists: pa.Array) -> pa.Array:
            encoded = lists.flatten().dictionary_encode()
            cells = _cells(encoded.dictionary, dim)
            word = encoded.indices.to_numpy(zero_copy_only=False)
            ends = np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
            out, first = np.zeros((len(lists), dim), "float32"), 0
            while first < len(lists):  # arrays of a number for each word are made for some rows at a time
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + STEP_WORDS, "right")) - 1)
                cell = cells[word[ends[first] : ends[last]]]
                row = np.repeat(np.arange(last - first) * dim, np.diff(ends[first : last + 1]))
                sums = np.bincount(row + np.abs(cell) - 1, np.sign(cell), (last - first) * dim)
                matrix = sums.astype("float64").reshape(-1, dim)
                size = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
                out[first:last] = np.divide(matrix, size, out=matrix, where=size > 0)
                first = last
            return _as_float_lists(out)

        return df.withColumn(out_col, hashed(self.words(F.col(text_col))))


class ModelEncoder:
    """Any batch model: ``load()`` gives a function from a list of texts to a matrix.

    The model is loaded once per Python worker and sees Arrow batches of texts.
    """

    def __init__(self, load: Callable[[], Callable[[list[str]], np.ndarray]]):
        self.load = load

    def encode(self, df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        load = self.load

        @F.arrow_udf("array<float>")
        def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for batch in batches:
                yield _as_float_lists(np.asarray(model(batch.to_pylist())))

        return df.withColumn(out_col, encoded(text_or_blank(F.col(text_col))))


def embed_documents(docs: DataFrame, encoder: Encoder) -> DataFrame:
    """The document vector job: ``(doc_id, embedding)``."""
    return encoder.encode(docs.select("doc_id", "text"), "text", "embedding").drop("text")


def embed_raw_queries(queries: DataFrame, encoder: Encoder) -> DataFrame:
    """Vectors of the queries as asked: ``(query_id, query_vector)``.

    An empty query has no vector and gets no row.
    """
    asked = queries.filter(F.col("query") != "").select("query_id", "query")
    return encoder.encode(asked, "query", "query_vector").drop("query")


def embed_cleaned_queries(
    queries: DataFrame, encoder: Encoder, lemmas: Lemmas | None
) -> DataFrame:
    """Vectors of the cleaned queries; one that is blank after cleaning gets no row."""
    cleaned = clean(queries.select("query_id", "query"), "query", lemmas)
    asked = cleaned.filter(F.col("cleaned") != "").select("query_id", "cleaned")
    return encoder.encode(asked, "cleaned", "query_vector").drop("cleaned")


def process_queries(
    queries: DataFrame, encoder: Encoder, lemmas: Lemmas | None = None
) -> DataFrame:
    """The query record: original text, cleaned text and the vector of the raw text.

    An empty query has an empty cleaned text and an empty vector.
    """
    cleaned = clean(queries.select("query_id", "query"), "query", lemmas)
    vector = encoder.encode(cleaned, "query", "_vector")
    no_vector = F.array().cast("array<float>")
    return vector.select(
        "query_id",
        F.col("query").alias("original_query"),
        F.col("cleaned").alias("preprocessed_text"),
        F.when(F.col("query") != "", F.col("_vector"))
        .otherwise(no_vector)
        .alias("query_embedding"),
    )
