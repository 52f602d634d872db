"""TF-IDF search by postings: exact, and without reading what cannot win.

A term's entries lie in blocks of like weight, in folders by bucket of the term.  A search
of few queries goes in four steps:

1. Of the blocks of its terms the sizes and largest weights are read, no entries.
2. The blocks that may add most are read.  The k-th best sum of a query over them is a
   floor: no full score is below the sum of a part of it.
3. A document that a query has not seen adds at most x for each of its terms if all blocks
   that may add more than x were read.  With x so small that the terms together stay below
   the floor, all other blocks are skipped.  What was read gives the candidates.
4. The candidates' vectors are read by bucket of their ids, and scored like in a scan.

A query that less than k documents match reads all its blocks, and is filled up with
documents of score 0 from the first ids of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.text import content_words
from gleanery.operators.cleaning import Lemmas, clean
from gleanery.operators.joins import FREQUENT_KEYS, rows_if_few
from gleanery.operators.scan import SparseQueries, measure, search_top_k
from gleanery.operators.sparse import (
    MANY_QUERIES,
    Answers,
    Weighting,
    by_content,
    content_vectors,
    entries_of,
    query_vectors,
    search_contents,
)
from gleanery.session import materialise, share
from gleanery.sources.layout import bucket_column, bucket_of, wanted_only

# Entries of a block, on average at most, and levels of weight: two for each halving.
BLOCK_ROWS = 4096
LEVELS = 48

# Entries that make up a slot, on average, and that a task orders by slot at once.
SLOT_ENTRIES = 500_000
PACK_ENTRIES = 4_000_000

# How many times k entries the first step reads of a query's best blocks.
FIRST_READ = 4

# Less than this a floor must be missed by: scores are rounded to six digits.
MARGIN = 2e-6

# What is left of a sum of weights, at least, before they were rounded up.
ROUNDED_UP = 1 - 2.0**-22

# Terms of different queries, all together, that are looked up by block; more pay a scan.
POSTING_TERMS = 20_000

# Ids that are kept to fill up results.
FIRST_IDS = 100_000


def term_blocks(vectors: DataFrame, stats: DataFrame, block_rows: int = BLOCK_ROWS, buckets: int = 1) -> DataFrame:
    """``(term, level, part, n, max_weight, doc_ids, weights)``: the blocks of all terms.

    A frequent term's entries of one level are split by document, so that no block holds
    much more than ``block_rows`` of them.

    Entries travel once: tasks hand them in by slot, a row for each, and a slot's blocks are
    made where it comes.  A slot has terms of one of ``buckets`` only; a frequent term's
    parts go to several.  Weights are rounded up to half their length.
    """
    total = stats.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    # so that no more than FREQUENT_KEYS terms are split, those of very many entries
    often = stats.filter(F.col("df") > max(block_rows, total // FREQUENT_KEYS))
    often = often.select("term", F.ceil(F.col("df") / block_rows).cast("long").alias("splits"))
    shared = share(vectors.sparkSession, often.toArrow())
    each = max(1, math.ceil(total / SLOT_ENTRIES / buckets))
    hashes = F.transform("terms", lambda t: F.xxhash64(t)).alias("_hashes")
    rows = vectors.select("doc_id", "terms", "weights", hashes, F.xxhash64("doc_id").alias("_spread"))
    id_type = vectors.schema["doc_id"].dataType.simpleString()
    packed = rows.mapInArrow(
        partial(_packed, shared=shared, buckets=buckets, each=each),
        f"slot long, terms array<string>, parts array<long>, ns array<long>, doc_ids array<{id_type}>, weights array<float>",
    )
    return packed.repartition(buckets * each, "slot").mapInArrow(
        _blocks,
        f"term string, level int, part long, n long, max_weight float, doc_ids array<{id_type}>, weights array<float>",
    )


def _packed(batches: Iterator[pa.RecordBatch], shared, buckets: int, each: int) -> Iterator[pa.RecordBatch]:
    """Entries by slot, and there by term and part."""
    often = shared.value.combine_chunks()
    for batch in batches:
        ends = np.r_[0, np.cumsum(pc.list_value_length(batch["terms"]).fill_null(0).to_numpy(zero_copy_only=False))]
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + PACK_ENTRIES, "right")) - 1)
            if ends[last] > ends[first]:
                yield _pack(batch.slice(first, last - first), often, buckets, each)
            first = last


def _pack(batch: pa.RecordBatch, often: pa.Table, buckets: int, each: int) -> pa.RecordBatch:
    row, flat = entries_of(batch["terms"])
    coded = flat.dictionary_encode()
    terms, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    hashes = np.empty(len(terms), np.int64)
    hashes[code] = batch["_hashes"].flatten().to_numpy(zero_copy_only=False)
    at = pc.index_in(terms, value_set=often["term"].combine_chunks().cast(terms.type))
    splits = often["splits"].combine_chunks().take(at).fill_null(1).to_numpy(zero_copy_only=False)
    part = np.mod(batch["_spread"].to_numpy(zero_copy_only=False)[row], splits[code])
    slot = np.mod(hashes, buckets)[code] + buckets * np.mod((hashes // buckets)[code] + part, each)
    order = np.lexsort((part, code, slot))  # entries of a group stay in the order of rows
    slot, code, part = slot[order], code[order], part[order]
    new_slot = np.r_[True, slot[1:] != slot[:-1]]
    groups = np.flatnonzero(new_slot | np.r_[True, (code[1:] != code[:-1]) | (part[1:] != part[:-1])])
    slots = np.flatnonzero(new_slot)
    by_group = np.r_[np.searchsorted(groups, slots), len(groups)]
    by_entry = np.r_[slots, len(slot)]
    weights = _rounded_up(batch["weights"].flatten().to_numpy(zero_copy_only=False)[order])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(slot[slots]),
            _lists(by_group, terms.take(pa.array(code[groups]))),
            _lists(by_group, pa.array(part[groups])),
            _lists(by_group, pa.array(np.diff(np.r_[groups, len(slot)]))),
            _lists(by_entry, batch["doc_id"].take(pa.array(row[order]))),
            _lists(by_entry, pa.array(weights)),
        ],
        ["slot", "terms", "parts", "ns", "doc_ids", "weights"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of some slots, all of whose entries are held."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    got = pa.Table.from_batches(held).combine_chunks()
    terms, parts, ns, doc_ids, weights = (
        pa.concat_arrays([c.flatten() for c in got[name].chunks]) for name in got.column_names[1:]
    )
    coded = terms.dictionary_encode()
    times = ns.to_numpy()
    code = np.repeat(coded.indices.to_numpy(zero_copy_only=False), times)
    part, weight = np.repeat(parts.to_numpy(), times), weights.to_numpy()
    with np.errstate(divide="ignore"):
        level = np.clip(np.floor(-2 * np.log2(weight.astype(np.float64))), 0, LEVELS).astype(np.int32)
    order = np.lexsort((part, level, code))
    code, level, part, weight = code[order], level[order], part[order], weight[order]
    changed = (code[1:] != code[:-1]) | (level[1:] != level[:-1]) | (part[1:] != part[:-1])
    starts = np.flatnonzero(np.r_[True, changed])
    ends = np.r_[starts, len(code)]
    made = pa.table(
        {
            "term": coded.dictionary.take(pa.array(code[starts])),
            "level": level[starts],
            "part": part[starts],
            "n": np.diff(ends),
            "max_weight": np.maximum.reduceat(weight, starts),
            "doc_ids": _lists(ends, doc_ids.take(pa.array(order))),
            "weights": _lists(ends, pa.array(weight)),
        }
    )
    yield from made.to_batches(max_chunksize=10_000)


def _rounded_up(weights: np.ndarray) -> np.ndarray:
    """The least numbers of half the length that are no smaller."""
    near = weights.astype(np.float32)
    return np.where(near < weights, np.nextafter(near, np.float32(np.inf)), near)


def _lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(ends.astype(np.int32), values)


def first_ids(vectors: DataFrame, n: int = FIRST_IDS) -> DataFrame:
    """The first ids of a corpus."""
    return vectors.select("doc_id").orderBy("doc_id").limit(n)


def _of_terms(postings: DataFrame, asked: DataFrame, columns: list[str]) -> DataFrame:
    """Blocks of the asked terms, joined with their queries; other folders are not read."""
    name, n = bucket_column(postings)
    # Spark prunes folders by a side that has a filter; this one lets every term pass
    few = asked.withColumn(name, bucket_of(F.col("term"), n)).filter(F.col(name) >= 0)
    keys = [name, *[c for c in ("term", "level", "part") if c in asked.columns]]
    return postings.select(name, "term", "level", "part", *columns).join(F.broadcast(few), keys).drop(name)


def postings_search(
    queries: DataFrame,
    vectors: DataFrame,
    stats: DataFrame,
    postings: DataFrame,
    first: DataFrame,
    lemmas: Lemmas | None,
    top_n: int = 10,
    weighting: Weighting = Weighting(),
    digits: int | None = 6,
) -> tuple[DataFrame, int | None]:
    """Ranked ``(query_id, rank, doc_id, score)``, the rows that a scan gives.

    ``postings`` and ``vectors`` are laid out by bucket of term and of document; ``first``
    has the first ids of the corpus.
    """
    found = postings_answers(queries, vectors, stats, postings, first, lemmas, top_n, weighting, digits)
    return found.of_all(found.hits), found.max_rows


def postings_answers(queries, vectors, stats, postings, first, lemmas, top_n, weighting, digits=6) -> Answers:
    n_queries, n_terms = measure(queries, F.size(content_words(F.col("query"))))
    if n_queries > MANY_QUERIES and top_n > 0:
        contents, to_all = by_content(queries, top_n)
        asked = content_vectors(contents, stats, lemmas, weighting)
        if measure(asked, F.size("query_terms"))[1] <= POSTING_TERMS:
            vectors = _of_candidates(vectors, asked, postings, first, top_n)
        return Answers(search_contents(asked, vectors, top_n, digits), n_queries * top_n, to_all)
    cleaned = clean(queries.select("query_id", "query"), "query", lemmas)
    asked = materialise(query_vectors(cleaned, stats, weighting, n_terms), "queries")
    vectors = _of_candidates(vectors, asked, postings, first, top_n)
    hits, max_rows = search_top_k(
        asked,
        vectors.select("doc_id", "terms", "weights"),
        SparseQueries,
        top_n,
        keep=["doc_id"],
        ties=["doc_id"],
        size=(n_queries, n_terms),
        digits=digits,
    )
    return Answers(hits, max_rows)


def _of_candidates(vectors: DataFrame, asked: DataFrame, postings: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """The vectors of the candidates, if these are few."""
    found = candidates(asked, postings, first, k)
    if found is not None and rows_if_few(found) is not None:
        return wanted_only(vectors, found, ["doc_id"])
    return vectors


def candidates(asked: DataFrame, postings: DataFrame, first: DataFrame, k: int) -> DataFrame | None:
    """``doc_id`` of all documents that may be among the best ``k`` of a query.

    ``None`` if the first ids are too few to fill up with.
    """
    pair = F.explode(F.arrays_zip("query_terms", "query_weights")).alias("e")
    terms = asked.select("query_id", pair).select(
        "query_id", F.col("e.query_terms").alias("term"), F.col("e.query_weights").alias("q")
    )
    blocks = _of_terms(postings, terms, ["n", "max_weight"])
    blocks = materialise(blocks.withColumn("gain", F.col("q") * F.col("max_weight")), "blocks")

    best = Window.partitionBy("query_id").orderBy(F.desc("gain"), "term", "level", "part")
    before = F.coalesce(F.sum("n").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = blocks.withColumn("before", before).filter(F.col("before") < FIRST_READ * k)
    floors = _floors(postings, top, k)

    needed = materialise(_needed(blocks, floors), "needed")
    entries = _of_terms(postings, needed.select("term", "level", "part").distinct(), ["doc_ids"])
    found = entries.select(F.explode("doc_ids").alias("doc_id"))
    short = asked.join(floors, "query_id", "left_anti")
    if not short.isEmpty():
        # up to k - 1 of the first 2 k ids may match a query, the others fill it up
        if 2 * k > FIRST_IDS:
            return None
        found = found.union(first.orderBy("doc_id").limit(2 * k))
    return materialise(found.distinct(), "candidates")


def _floors(postings: DataFrame, top: DataFrame, k: int) -> DataFrame:
    """``(query_id, floor)`` of the queries that have ``k`` documents in their best blocks."""
    chosen = top.select("query_id", "term", "level", "part", "q")
    read = _of_terms(postings, chosen, ["doc_ids", "weights"])
    pair = F.explode(F.arrays_zip("doc_ids", "weights")).alias("e")
    entries = read.select("query_id", "q", pair)
    sums = entries.groupBy("query_id", F.col("e.doc_ids").alias("doc_id")).agg(
        F.sum(F.col("q") * F.col("e.weights")).alias("score")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"))
    ranked = sums.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    floors = ranked.filter(F.col("rank") == k).select("query_id", (F.col("score") * ROUNDED_UP - MARGIN).alias("floor"))
    # a score that rounds to zero is no better than that of a document without a match
    return materialise(floors.filter("floor > 0"), "floors")


def _needed(blocks: DataFrame, floors: DataFrame) -> DataFrame:
    """Blocks that may add more than x, for the largest x that keeps unseen documents out.

    In the order of what the terms add at most, the least i of m add their most and each of
    the others x: the sum reaches the floor at x = (floor - their sum) / (m - i).
    """
    most = blocks.groupBy("query_id", "term").agg(F.max("gain").alias("most"))
    rising = Window.partitionBy("query_id").orderBy("most", "term")
    before = F.coalesce(F.sum("most").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    steps = most.withColumns(
        {
            "before": before,
            "place": F.row_number().over(rising),
            "terms": F.count("*").over(Window.partitionBy("query_id")),
        }
    ).join(floors, "query_id")
    x = (F.col("floor") - F.col("before")) / (F.col("terms") - F.col("place") + 1)
    limits = steps.withColumn("x", x).filter("x <= most").groupBy("query_id").agg(F.min_by("x", "place").alias("x"))
    known = blocks.join(limits, "query_id", "left")
    return known.filter(F.col("gain") > F.coalesce("x", F.lit(0.0)))
