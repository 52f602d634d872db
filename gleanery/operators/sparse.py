"""TF-IDF: the fit over a corpus and the cosine search of many queries.

Weights follow the usual conventions: raw term counts, smoothed inverse document
frequency plus one, rows scaled to length one.  With unit rows on both sides the
cosine is a plain sum over shared terms.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.text import content_words
from gleanery.operators.cleaning import Lemmas, clean
from gleanery.operators.joins import FREQUENT_KEYS, KEY_BYTES, join_by_frequency, join_skewed, look_up, rows_if_few
from gleanery.operators.ranking import with_snippets
from gleanery.operators.scan import SparseQueries, measure, search_top_k
from gleanery.session import materialise, share
from gleanery.sources.layout import bucket_column


@dataclass(frozen=True)
class Weighting:
    """``smooth`` adds one document with every term; ``sublinear`` dampens counts."""

    smooth: bool = True
    sublinear: bool = False
    unit_length: bool = True

    def idf(self, df: Column, n_docs: int) -> Column:
        extra = 1 if self.smooth else 0
        return F.log((F.lit(n_docs) + extra) / (df + extra)) + 1.0

    def weight(self, count: Column, idf: Column) -> Column:
        return (1.0 + F.log(count) if self.sublinear else count.cast("double")) * idf

    def length(self, weight: Column) -> Column:
        total = F.sqrt(F.sum(weight * weight))
        return F.when(total > 0, total).otherwise(1.0) if self.unit_length else F.lit(1.0)


COUNTED = "struct<terms: array<string>, tfs: array<bigint>>"
WEIGHTED = "struct<terms: array<string>, weights: array<double>>"


def entries_of(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of every entry of all lists, and the entries."""
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _summed(lists: pa.Array, times: np.ndarray | None) -> pa.Array:
    """The different terms of each row with the sum of their ``times`` (1 each if none)."""
    row, words = entries_of(lists)
    coded = words.dictionary_encode()
    n = max(1, len(coded.dictionary))
    code, place = np.unique(row * n + coded.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    total = np.bincount(place, times, len(code)).astype(np.int64)
    ends = np.searchsorted(code // n, np.arange(len(lists) + 1)).astype(np.int32)
    terms = coded.dictionary.take(pa.array(code % n)).cast(pa.string())
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(ends, terms), pa.ListArray.from_arrays(ends, pa.array(total))], ["terms", "tfs"]
    )


def _count_words():
    @F.arrow_udf(COUNTED)
    def count(tokens: pa.Array) -> pa.Array:
        return _summed(tokens, None)

    return count


def _count_lemmas(words: pa.Array, lemmas: pa.Array):
    @F.arrow_udf(COUNTED)
    def count(terms: pa.Array, tfs: pa.Array) -> pa.Array:
        flat = terms.flatten()
        at = pc.index_in(flat, value_set=words.cast(flat.type))
        swapped = pc.coalesce(lemmas.cast(flat.type).take(at), flat)
        ends = np.r_[0, np.cumsum(pc.list_value_length(terms).fill_null(0).to_numpy(zero_copy_only=False))]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), swapped.cast(pa.string()))
        return _summed(lists, tfs.flatten().to_numpy(zero_copy_only=False))

    return count


def word_counts(docs: DataFrame) -> DataFrame:
    """Words of each document before lemmas, counted within its row: ``(doc_id, terms, tfs)``.

    No row moves.  Rows of equal ids are counted each by itself; a document without words
    has empty lists.
    """
    counted = docs.select("doc_id", _count_words()(content_words(F.col("text"))).alias("_counted"))
    return counted.select("doc_id", "_counted.*")


def lemma_counts(counts: DataFrame, lemmas: Lemmas | None) -> DataFrame:
    """Word counts as counts of lemmas, in rows of the same form.

    A lemma table of checked size goes to the workers.  A larger one is joined word by
    word, by ids that do not repeat; no text is shuffled for that.
    """
    if lemmas is None:
        return counts
    if lemmas.pairs is not None:
        if lemmas.pairs.num_rows == 0:
            return counts
        count = _count_lemmas(*(lemmas.pairs[c].combine_chunks() for c in ("word", "lemma")))
        return counts.select("doc_id", count("terms", "tfs").alias("_counted")).select("doc_id", "_counted.*")
    rows = bag_rows(counts).withColumnRenamed("term", "word")
    known = join_by_frequency(rows, lemmas.table, "word", "n_docs")
    terms = known.groupBy("doc_id", F.coalesce("lemma", "word").alias("term")).agg(F.sum("tf").alias("tf"))
    entry = F.when(F.col("term").isNotNull(), F.struct("term", "tf"))
    lists = terms.groupBy("doc_id").agg(F.collect_list(entry).alias("_all"))
    return lists.select("doc_id", F.col("_all")["term"].alias("terms"), F.col("_all")["tf"].alias("tfs"))


def bag_of_words(docs: DataFrame, lemmas: Lemmas | None = None) -> DataFrame:
    """Terms of each document with their counts, in one row: ``(doc_id, terms, tfs)``."""
    return lemma_counts(word_counts(docs), lemmas)


def bag_rows(bag: DataFrame) -> DataFrame:
    """A bag as a table ``(doc_id, term, tf)``.

    A document without any term keeps one row with a null term.
    """
    rows = bag.select("doc_id", F.explode_outer(F.arrays_zip("terms", "tfs")).alias("_entry"))
    return rows.select(
        "doc_id", F.col("_entry.terms").alias("term"), F.coalesce("_entry.tfs", F.lit(1)).cast("bigint").alias("tf")
    )


def vocabulary_of(counts: DataFrame) -> DataFrame:
    """Every counted word with the number of documents it occurs in: ``(word, n_docs)``."""
    return counts.select(F.explode("terms").alias("word")).groupBy("word").agg(F.count("*").alias("n_docs"))


def term_statistics(
    bag: DataFrame, n_docs: int, weighting: Weighting = Weighting()
) -> DataFrame:
    """Document frequency and inverse document frequency: ``(term, df, idf)``.

    Tasks count their own documents first; their statistics are merged by term.
    """
    counted = bag.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return counted.withColumn("idf", weighting.idf(F.col("df"), n_docs))


def document_vectors(
    bag: DataFrame, stats: DataFrame, weighting: Weighting = Weighting()
) -> DataFrame:
    """One sparse row per document: ``(doc_id, terms, weights)``.

    Statistics of checked size go to the workers, and the weights are made within the row.
    Beyond it those of the most frequent terms do.  Rare terms are looked up one by one, and
    what is found is joined with the rows, whose entries stay together.
    """
    n, size = stats.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    if n <= FREQUENT_KEYS and size <= FREQUENT_KEYS * KEY_BYTES:
        weigh = _weigh(share(bag.sparkSession, stats.select("term", "idf").toArrow()), weighting)
        return bag.select("doc_id", weigh("terms", "tfs").alias("_row")).select("doc_id", "_row.*")
    least = _frequent_from(stats)
    shared = share(bag.sparkSession, stats.filter(F.col("df") >= least).select("term", "idf").toArrow())
    # rows of one key may get each other's statistics: terms tell them apart
    keyed = bag.withColumn("_key", F.xxhash64("doc_id", "terms"))
    wanted = keyed.select("_key", F.explode(_lacking(shared)("terms")).alias("term"))
    rare = stats.filter(F.col("df") < least).select("term", "idf")
    found = wanted.join(rare, "term").groupBy("_key").agg(F.collect_list(F.struct("term", "idf")).alias("_rare"))
    # a row's terms travel as one string, which is half as long as an array of them
    sizes = F.transform("terms", lambda t: F.octet_length(t)).alias("_sizes")
    whole = keyed.select("doc_id", "_key", F.array_join("terms", "").alias("_text"), sizes, "tfs")
    rows = whole.join(found, "_key", "left")
    weigh = _weigh_joined(shared, weighting)("_text", "_sizes", "tfs", F.col("_rare")["term"], F.col("_rare")["idf"])
    return rows.select("doc_id", weigh.alias("_row")).select("doc_id", "_row.*")


def _frequent_from(stats: DataFrame) -> int:
    """The least ``df`` so that the terms with it or a higher one may be broadcast."""
    sizes = stats.groupBy("df").agg(F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("size"))
    sizes = sizes.orderBy(F.desc("df")).toArrow()
    n, size = (np.cumsum(sizes[c].to_numpy()) for c in ("n", "size"))
    fit = np.flatnonzero((n <= FREQUENT_KEYS) & (size <= FREQUENT_KEYS * KEY_BYTES))
    return sizes["df"][len(fit) - 1].as_py() if len(fit) else sizes["df"][0].as_py() + 1


def _lacking(shared):
    @F.arrow_udf("array<string>")
    def lacking(terms: pa.Array) -> pa.Array:
        """The terms of each row that are not among the shared ones."""
        row, flat = entries_of(terms)
        known = shared.value["term"].combine_chunks().cast(flat.type)
        open_ = pc.invert(pc.is_in(flat, value_set=known))
        row = row[open_.to_numpy(zero_copy_only=False)]
        ends = np.searchsorted(row, np.arange(len(terms) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(ends, flat.filter(open_).cast(pa.string()))

    return lacking


def _weigh(shared, weighting: Weighting):
    """Makes weighted rows by the shared statistics."""

    @F.arrow_udf(WEIGHTED)
    def weigh(terms: pa.Array, tfs: pa.Array) -> pa.Array:
        known = shared.value.combine_chunks()
        row, flat = entries_of(terms)
        value_set = known["term"].combine_chunks().cast(flat.type)
        return _weighted(len(terms), row, flat, tfs, value_set, known["idf"].combine_chunks(), weighting)

    return weigh


def _weigh_joined(shared, weighting: Weighting):
    """The same of terms that come as one string and their sizes, also by statistics that come with the rows."""

    @F.arrow_udf(WEIGHTED)
    def weigh(texts: pa.Array, sizes: pa.Array, tfs: pa.Array, terms: pa.Array, idfs: pa.Array) -> pa.Array:
        known = shared.value.combine_chunks()
        row, size = entries_of(sizes)
        ends = np.r_[0, np.cumsum(size.to_numpy(zero_copy_only=False))].astype(np.int32)
        joined = pa.concat_arrays([texts.fill_null("").cast(pa.string())])
        _, places, letters = joined.buffers()
        at = np.frombuffer(places, np.int32)[joined.offset : joined.offset + len(joined) + 1]
        letters = pa.py_buffer(b"") if letters is None else letters.slice(at[0], at[-1] - at[0])
        flat = pa.StringArray.from_buffers(len(size), pa.py_buffer(ends), letters)
        value_set = pa.concat_arrays([known["term"].combine_chunks().cast(flat.type), terms.flatten().cast(flat.type)])
        values = pa.concat_arrays([known["idf"].combine_chunks(), idfs.flatten()])
        return _weighted(len(texts), row, flat, tfs, value_set, values, weighting)

    return weigh


def _weighted(n: int, row: np.ndarray, flat: pa.Array, tfs: pa.Array, value_set, idfs, weighting: Weighting) -> pa.Array:
    idf = idfs.take(pc.index_in(flat, value_set=value_set)).to_numpy(zero_copy_only=False)
    tf = tfs.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    weight = (1.0 + np.log(tf) if weighting.sublinear else tf) * idf
    if weighting.unit_length:
        length = np.sqrt(np.bincount(row, weight * weight, n))
        weight = weight / np.where(length > 0, length, 1.0)[row]
    ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(ends, flat.cast(pa.string())), pa.ListArray.from_arrays(ends, pa.array(weight))],
        ["terms", "weights"],
    )


def _as_rows(
    weighted: DataFrame, key: str, entry: Column, weighting: Weighting, terms: str, weights: str
) -> DataFrame:
    rows = weighted.groupBy(key).agg(
        F.collect_list(entry).alias("_entries"),
        weighting.length(F.col("weight")).alias("_length"),
    )
    return rows.select(
        key,
        F.col("_entries")["term"].alias(terms),
        F.transform("_entries", lambda e: e["weight"] / F.col("_length")).alias(weights),
    )


def document_weights(vectors: DataFrame) -> DataFrame:
    """The sparse rows as a table: ``(doc_id, term, weight)``."""
    pairs = F.explode(F.arrays_zip("terms", "weights")).alias("entry")
    return vectors.select("doc_id", pairs).select(
        "doc_id", F.col("entry.terms").alias("term"), F.col("entry.weights").alias("weight")
    )


def query_vectors(
    queries: DataFrame,
    stats: DataFrame,
    weighting: Weighting = Weighting(),
    max_terms: int | None = None,
) -> DataFrame:
    """Sparse rows of cleaned queries: ``(query_id, query_terms, query_weights)``.

    ``queries`` has ``query_id`` and ``tokens``, ``max_terms`` of them at most where
    known.  Unknown terms are dropped; a query of unknown terms only keeps an empty
    row, a blank query has none.
    """
    asked = queries.filter(F.size("tokens") > 0)
    counts = (
        asked.select("query_id", F.explode("tokens").alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count("*").alias("tf"))
    )
    known = look_up(counts, stats.select("term", "idf"), "term", max_terms)
    weighted = known.withColumn("weight", weighting.weight(F.col("tf"), F.col("idf")))
    entry = F.when(F.col("idf").isNotNull(), F.struct("term", "weight"))
    return _as_rows(weighted, "query_id", entry, weighting, "query_terms", "query_weights")


# So many queries are searched by content: equal ones once, and along what matches only.
MANY_QUERIES = 2048

# Rows of answers, snippets included, that may be broadcast to the queries that ask alike.
ANSWER_ROWS = 100_000


def tfidf_candidates(
    queries: DataFrame,
    vectors: DataFrame,
    stats: DataFrame,
    lemmas: Lemmas | None,
    top_n: int = 10,
    candidate_k: int | None = None,
    weighting: Weighting = Weighting(),
    digits: int | None = 6,
) -> tuple[DataFrame, int | None]:
    """Ranked ``(query_id, rank, doc_id, score)`` of raw queries, without snippets.

    Every document has a score, so documents without a shared term fill the list
    with zeros where fewer than ``top_n`` match.  ``candidate_k`` narrows the
    first stage of a two-stage selection, and with it the result.
    """
    found = _answers(queries, vectors, stats, lemmas, top_n, candidate_k, weighting, digits)
    return found.of_all(found.hits), found.max_rows


@dataclass(frozen=True)
class Answers:
    """Hits of queries, ``max_rows`` in all; where equal queries share theirs, ``to_all`` tells whose they are."""

    hits: DataFrame
    max_rows: int | None
    to_all: Callable[[DataFrame], DataFrame] | None = None

    def of_all(self, hits: DataFrame) -> DataFrame:
        return hits if self.to_all is None else self.to_all(hits)

    def with_snippets(self, snippets: DataFrame) -> DataFrame:
        """Hits that are shared get their snippets once."""
        max_rows = self.max_rows if self.to_all is None else rows_if_few(self.hits)
        return self.of_all(with_snippets(self.hits, snippets, max_rows))


def _answers(queries, vectors, stats, lemmas, top_n, candidate_k, weighting, digits) -> Answers:
    if candidate_k is not None and candidate_k < 0:
        raise ValueError("candidate_k must not be negative")
    k = min(top_n, candidate_k) if candidate_k else top_n
    n_queries, n_terms = measure(queries, F.size(content_words(F.col("query"))))
    look = first_part(vectors, k)
    if n_queries > MANY_QUERIES and k > 0:
        contents, to_all = by_content(queries, k)
        asked = content_vectors(contents, stats, lemmas, weighting)
        return Answers(search_contents(asked, vectors, k, digits, look), n_queries * k, to_all)
    cleaned = clean(queries.select("query_id", "query"), "query", lemmas)
    hits, max_rows = search_top_k(
        query_vectors(cleaned, stats, weighting, n_terms),
        vectors.select("doc_id", "terms", "weights"),
        SparseQueries,
        k,
        keep=["doc_id"],
        ties=["doc_id"],
        size=(n_queries, n_terms),
        digits=digits,
        first_look=look,
    )
    return Answers(hits, max_rows)


def by_content(queries: DataFrame, k: int) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The different queries as ``(query_id, query)``, and a function that gives their hits to all.

    The texts of one id are one query.  Contents are told by 128 bits, their new id.
    """
    whole = queries.groupBy("query_id").agg(F.array_sort(F.collect_list("query")).alias("_texts"))
    key = F.unhex(F.md5(F.to_json("_texts"))).alias("_content")
    members = materialise(whole.select("query_id", F.array_join("_texts", " ").alias("query"), key), "members")
    contents = members.groupBy(F.col("_content").alias("query_id")).agg(F.first("query").alias("query"))
    contents = materialise(contents, "contents")
    few = contents.count() * k <= ANSWER_ROWS

    def to_all(hits: DataFrame) -> DataFrame:
        columns = hits.columns
        hits, theirs = hits.withColumnRenamed("query_id", "_content"), members.select("query_id", "_content")
        if few:
            return theirs.join(F.broadcast(hits), "_content").select(*columns)
        return join_skewed(theirs, hits, ["_content"]).select(*columns)

    return contents, to_all


def content_vectors(contents: DataFrame, stats: DataFrame, lemmas: Lemmas | None, weighting: Weighting) -> DataFrame:
    """The written-down vectors of contents; blank ones have none."""
    _, n_terms = measure(contents, F.size(content_words(F.col("query"))))
    cleaned = clean(contents, "query", lemmas)
    return materialise(query_vectors(cleaned, stats, weighting, n_terms), "queries")


def search_contents(
    asked: DataFrame, vectors: DataFrame, k: int, digits: int | None, first_look: DataFrame | None = None
) -> DataFrame:
    """The rows of a scan by ``asked``, written down: only matching documents are scored.

    Zero scores are filled in from the first ids.
    """
    known = asked.filter(F.size("query_terms") > 0)
    hits, _ = search_top_k(
        known,
        vectors.select("doc_id", "terms", "weights"),
        partial(SparseQueries, matching=True),
        k,
        keep=["doc_id"],
        ties=["doc_id"],
        size=measure(known, F.size("query_terms")),
        digits=digits,
        first_look=first_look,
        matching=True,
    )
    hits = materialise(hits, "matches")
    return materialise(hits.unionByName(_zeros(asked, hits, vectors, k)), "hits")


def _zeros(asked: DataFrame, hits: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """What is missing from the ``k`` rows of each query: the first documents it does not match.

    Fewer than k match it, so the first 2 k documents are enough.  Rows of one id are
    numbered, so that each counts.
    """
    same = Window.partitionBy("doc_id").orderBy("doc_id")
    first = vectors.select("doc_id").orderBy(F.asc_nulls_last("doc_id")).limit(2 * k)
    first = first.withColumn("n", F.row_number().over(same))
    entry = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "n")
    all_first = first.agg(F.array_sort(F.collect_list(entry)).alias("_first")).withColumn("_one", F.lit(0))

    mine = Window.partitionBy("query_id", "doc_id").orderBy("rank")
    had = hits.withColumn("n", F.row_number().over(mine)).groupBy("query_id").agg(F.collect_list(entry).alias("_had"))
    lists = asked.select("query_id").join(had, "query_id", "left")
    short = lists.withColumn("_n", F.when(F.col("_had").isNull(), 0).otherwise(F.size("_had"))).filter(F.col("_n") < k)
    short = short.withColumn("_one", F.pmod(F.hash("query_id"), F.lit(1)))
    both = short.join(F.broadcast(materialise(all_first, "first")), "_one")
    free = F.when(F.col("_had").isNull(), F.col("_first")).otherwise(F.array_except("_first", "_had"))
    rows = both.select("query_id", "_n", F.posexplode(F.slice(free, F.lit(1), F.lit(k) - F.col("_n"))).alias("place", "e"))
    return rows.select(
        "query_id", (F.col("_n") + F.col("place") + 1).alias("rank"), F.col("e.doc_id").alias("doc_id"), F.lit(0.0).alias("score")
    )


# From so many rows per query on, and so many folders of vectors, a first look pays: it
# reads one folder in so many.
LOOK_FROM_K, LOOK_FROM_BUCKETS, LOOK_SHARE = 100, 64, 16


def first_part(vectors: DataFrame, k: int) -> DataFrame | None:
    """A few folders of vectors that are laid out by bucket, if they are many."""
    found = bucket_column(vectors)
    if not found or k < LOOK_FROM_K or found[1] < LOOK_FROM_BUCKETS:
        return None
    part = vectors.filter(F.col(found[0]) < found[1] // LOOK_SHARE)
    return part.select("doc_id", "terms", "weights")


def tfidf_search(
    queries: DataFrame,
    snippets: DataFrame,
    vectors: DataFrame,
    stats: DataFrame,
    lemmas: Lemmas | None = None,
    top_n: int = 10,
    candidate_k: int | None = None,
    weighting: Weighting = Weighting(),
) -> DataFrame:
    """TF-IDF cosine search: ``(query_id, rank, doc_id, score, snippet)``."""
    return _answers(queries, vectors, stats, lemmas, top_n, candidate_k, weighting, 6).with_snippets(snippets)
