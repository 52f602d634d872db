"""The cleaning job: tokens, noun lemmas and the cleaned text of every row."""

from __future__ import annotations

from functools import cached_property, reduce
from operator import or_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import content_words
from gleanery.operators.joins import join_by_frequency
from gleanery.session import materialise

# Noun endings and what a singular has in their place.
NOUN_ENDINGS = {
    "s": "",
    "ses": "s",
    "ves": "f",
    "xes": "x",
    "zes": "z",
    "ches": "ch",
    "shes": "sh",
    "men": "man",
    "ies": "y",
}

# Endings of words that are no plurals, however they look.
SINGULAR_ENDINGS = ["ss", "us", "is"]

# A singular must occur in this share of the documents its plural occurs in, one in so many.
SUPPORT = 50

# Lemma pairs that may travel to every worker (two short words each).
LEMMA_PAIRS = 200_000


def vocabulary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every content word of a corpus with the number of texts it occurs in."""
    words = F.explode(F.array_distinct(content_words(F.col(text_col))))
    return docs.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n_docs"))


def noun_lemmas(words: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Singulars for the plurals of a vocabulary: ``(word, lemma, n_docs)``.

    A candidate made by an ending rule counts only on evidence: it must occur in at least
    one document for every ``support`` documents of the plural, so that a stray misspelling
    does not become the lemma of a frequent word.  Of several the shortest wins, then the
    first in the alphabet.
    """
    word = F.col("word")
    singular = reduce(or_, [word.endswith(e) for e in SINGULAR_ENDINGS])
    candidates = F.array_compact(
        F.array(
            *[
                F.when(
                    word.endswith(ending),
                    F.concat(word.substr(F.lit(1), F.length(word) - len(ending)), F.lit(singular)),
                )
                for ending, singular in NOUN_ENDINGS.items()
            ]
        )
    )
    plurals = words.filter(~singular)
    proposed = plurals.select("word", "n_docs", F.explode(candidates).alias("lemma"))
    known = words.select(F.col("word").alias("lemma"), F.col("n_docs").alias("_support"))
    return (
        proposed.join(known, "lemma")
        .filter(F.col("_support") * support >= F.col("n_docs"))
        .groupBy("word", "n_docs")
        .agg(F.min_by("lemma", F.struct(F.length("lemma"), "lemma")).alias("lemma"))
        .select("word", "lemma", "n_docs")
    )


def _swap_words(words: pa.Array, lemmas: pa.Array):
    """A function that replaces words by lemmas in whole Arrow batches of token lists."""

    @F.arrow_udf("array<string>")
    def swap(tokens: pa.Array) -> pa.Array:
        known = words.cast(tokens.values.type)
        at = pc.index_in(tokens.values, value_set=known)
        values = pc.coalesce(lemmas.cast(known.type).take(at), tokens.values)
        return type(tokens).from_arrays(tokens.offsets, values)

    return swap


class Lemmas:
    """A lemma table ``(word, lemma, n_docs)`` and, if it is small, its Arrow copy.

    A word has one lemma: of several the first in the alphabet, for whoever uses the table.
    """

    def __init__(self, table: DataFrame, max_pairs: int = LEMMA_PAIRS):
        self.table = table.groupBy("word").agg(
            F.min("lemma").alias("lemma"), F.max("n_docs").alias("n_docs")
        )
        self.max_pairs = max_pairs

    @cached_property
    def pairs(self) -> pa.Table | None:
        """All pairs, fetched once; ``None`` if there are too many to pass around."""
        head = self.table.select("word", "lemma").limit(self.max_pairs + 1).toArrow()
        return head.combine_chunks() if head.num_rows <= self.max_pairs else None


def lemmatise(df: DataFrame, tokens_col: str, lemmas: Lemmas) -> DataFrame:
    """Replace each token by its lemma, keeping the order; unknown words stay.

    A lemma table of checked size goes to the workers and no row moves.  A larger
    one is joined token by token.  Rows are treated each by itself in either case.
    """
    pairs = lemmas.pairs
    if pairs is None:
        return _lemmatise_by_join(df, tokens_col, lemmas.table)
    if pairs.num_rows == 0:
        return df
    swap = _swap_words(pairs["word"].combine_chunks(), pairs["lemma"].combine_chunks())
    return df.withColumn(tokens_col, swap(tokens_col))


def _lemmatise_by_join(df: DataFrame, tokens_col: str, lemmas: DataFrame) -> DataFrame:
    # numbered and written down: a row keeps its number however often it is read
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "lemma-rows")
    places = rows.select("_row", F.posexplode(tokens_col).alias("place", "word"))
    joined = join_by_frequency(places, lemmas, "word", "n_docs")
    lists = joined.groupBy("_row").agg(
        F.array_sort(
            F.collect_list(F.struct("place", F.coalesce("lemma", "word").alias("term")))
        )["term"].alias(tokens_col)
    )
    empty = F.array().cast("array<string>")
    whole = rows.drop(tokens_col).join(lists, "_row", "left").drop("_row")
    return whole.withColumn(tokens_col, F.coalesce(tokens_col, empty)).select(*df.columns)


def clean(df: DataFrame, text_col: str, lemmas: Lemmas | None = None) -> DataFrame:
    """Add ``tokens`` and the space-joined ``cleaned`` text to every row."""
    tokenised = df.withColumn("tokens", content_words(F.col(text_col)))
    if lemmas is not None:
        tokenised = lemmatise(tokenised, "tokens", lemmas)
    return tokenised.withColumn("cleaned", joined_tokens(F.col("tokens")))


def joined_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")
