"""Exact top-k of many queries in one pass over a table of vectors.

The vectors stay where they lie.  Each task scores its Arrow batches against all
queries and hands in no more than the best ``k`` rows per query, so the shuffle
that follows carries winners only, never one row per query and document.

Where a score of zero only means that nothing matched, tasks may hand in matching rows
alone (``matching``): their work then grows with the matches, not with all pairs.

Where very many rows per query are asked for, a first look at a part of the vectors gives
each query a floor: its k-th best score there, below which no row anywhere can win.  Tasks
then hand in what reaches the floor only.

The queries travel to the tasks by broadcast as long as their number is within
a checked bound.  Up to some multiples of it they go in slices, with one pass per
slice and still no shuffle of vectors.  Beyond that, queries and vectors are both
cut into fragments and every pair of fragments is one group of bounded size.  The
result is the same each time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gleanery.operators.ranking import ROUND_ONE_PARTS, best_first, top_ranked
from gleanery.session import input_files, materialise, share

# Scores held at once by a task, and the shape of one scoring step.
STEP_ROWS = 4096
STEP_QUERIES = 512

# Bounds of a query side that is broadcast whole: numbers in its vectors (with a
# term each, some 100 MB) and result rows that one task may hold.
QUERY_ENTRIES = 4_000_000
QUERY_RESULTS = 2_000_000

# Passes over the vectors, one per slice of queries, before both sides are fragmented.
MAX_PASSES = 16

# The least score that can win, where a first look has told it.
FLOOR = "_floor"

# Matches of queries and vectors that are summed at once.
MATCHES = 1_000_000

# Vectors per fragment when both sides are fragmented.
FRAGMENT_ROWS = 20_000


class DenseQueries:
    """Query vectors scored by inner product, or by cosine when ``scaled``."""

    def __init__(self, table: pa.Table, scaled: bool):
        self.ids = table["query_id"].combine_chunks()
        self.scaled = scaled
        self.matrix = _as_matrix(table["query_vector"].combine_chunks())
        if scaled:
            self.matrix = _unit_rows(self.matrix)

    def prepare(self, batch: pa.RecordBatch) -> np.ndarray:
        rows = _as_matrix(batch["embedding"])
        return _unit_rows(rows) if self.scaled else rows

    def scores(self, rows: np.ndarray, first: int, last: int) -> np.ndarray:
        return self.matrix[first:last] @ rows.T


class SparseQueries:
    """Weighted query terms scored against weighted document terms."""

    def __init__(self, table: pa.Table, matching: bool = False):
        self.ids = table["query_id"].combine_chunks()
        lists = table["query_terms"].combine_chunks()
        encoded = lists.flatten().dictionary_encode()
        self.terms = encoded.dictionary
        term = encoded.indices.to_numpy(zero_copy_only=False)
        query = np.repeat(np.arange(len(self.ids)), _lengths(lists))
        weight = table["query_weights"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.steps = []
        step = max(1, len(self.ids)) if matching else STEP_QUERIES
        for first in range(0, len(self.ids), step):
            # entries are in the order of queries: a step holds its own terms only
            mine = slice(*np.searchsorted(query, [first, first + step]))
            order = np.argsort(term[mine], kind="stable")
            own, start, degree = np.unique(term[mine][order], return_index=True, return_counts=True)
            self.steps.append((query[mine][order] - first, weight[mine][order], own, degree, start))

    def prepare(self, batch: pa.RecordBatch):
        lists = batch["terms"]
        at = pc.index_in(lists.flatten(), value_set=self.terms.cast(lists.type.value_type))
        known = np.flatnonzero(pc.is_valid(at).to_numpy(zero_copy_only=False))
        rows = np.repeat(np.arange(len(lists)), _lengths(lists))[known]
        terms = at.drop_null().to_numpy(zero_copy_only=False)
        weights = batch["weights"].flatten().to_numpy(zero_copy_only=False)[known]
        return len(lists), rows, terms, weights

    def scores(self, prepared, first: int, last: int) -> np.ndarray:
        n_rows, rows, terms, weights = prepared
        query, query_weight, own, degree, start = self.steps[first // STEP_QUERIES]
        size = (last - first) * n_rows
        total = np.zeros(size)
        if not len(own):
            return total.reshape(last - first, n_rows)
        place = np.minimum(np.searchsorted(own, terms), len(own) - 1)
        hit = own[place] == terms
        rows, terms, weights = rows[hit], place[hit], weights[hit]
        fan_out = degree[terms]
        cuts = np.searchsorted(np.cumsum(fan_out), np.arange(4_000_000, fan_out.sum(), 4_000_000))
        for part in np.split(np.arange(len(terms)), cuts):
            times = fan_out[part]
            source = np.repeat(part, times)
            step = np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times)
            entry = start[terms[source]] + step
            cell = query[entry] * n_rows + rows[source]
            total += np.bincount(cell, weights[source] * query_weight[entry], minlength=size)
        return total.reshape(last - first, n_rows)

    def matches(self, prepared) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(query, row, score)`` of all pairs that share a term, some rows at a time."""
        _, rows, terms, weights = prepared
        query, query_weight, _, degree, start = self.steps[0]  # every term is a query's own
        n, fan_out = len(self.ids), degree[terms]
        done = np.r_[0, np.cumsum(fan_out)]
        at = 0
        while at < len(rows):
            # entries are in the order of rows: those of a row stay together
            reach = np.searchsorted(done, done[at] + MATCHES)
            end = np.searchsorted(rows, rows[reach]) if reach < len(rows) else len(rows)
            end = max(end, np.searchsorted(rows, rows[at], "right"))
            times = fan_out[at:end]
            source = np.repeat(np.arange(at, end), times)
            step = np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times)
            entry = start[terms[source]] + step
            cell, gain = (rows[source] - rows[at]) * n + query[entry], weights[source] * query_weight[entry]
            size = (rows[end - 1] - rows[at] + 1) * n
            if size <= 4 * len(cell):
                total = np.bincount(cell, gain, size)
                cell = np.flatnonzero(total)
                total = total[cell]
            else:
                cell, place = np.unique(cell, return_inverse=True)
                total = np.bincount(place, gain, len(cell))
            yield cell % n, cell // n + rows[at], total
            at = end


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False)


def _as_matrix(lists: pa.Array) -> np.ndarray:
    if len(lists) == 0:
        return np.zeros((0, 0))
    sizes = _lengths(lists)
    if sizes.min() != sizes.max():
        raise ValueError("vectors of one table must have one length")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.astype("float64").reshape(len(lists), -1)


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def _best_cells(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` best cells of each row; ties go to the left."""
    n = scores.shape[1]
    if n <= k:
        return tuple(np.indices(scores.shape).reshape(2, -1))
    cut = np.partition(scores, n - k, axis=1)[:, n - k : n - k + 1]
    above = scores > cut
    level = scores == cut
    room = k - above.sum(axis=1, keepdims=True)
    return np.nonzero(above | (level & (np.cumsum(level, axis=1) <= room)))


@dataclass(frozen=True)
class Scan:
    """What one pass keeps: ``k`` rows per query with columns ``keep``."""

    k: int
    keep: tuple[str, ...]
    ties: tuple[str, ...]
    digits: int | None
    matching: bool = False

    def run(
        self, queries, batches: Iterator[pa.RecordBatch], floor: np.ndarray | None = None
    ) -> pa.Table | None:
        held, waiting = [], 0
        floor = np.full(len(queries.ids), -np.inf) if floor is None else floor.copy()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                for piece in self._winners(queries, batch.slice(at, STEP_ROWS), floor):
                    held.append(piece)
                    waiting += piece.num_rows
            if waiting > 2 * self.k * len(queries.ids) + 100_000:
                held = [self._best(pa.concat_tables(held))]
                waiting = held[0].num_rows
                self._raise_floor(floor, held[0])
        return self._best(pa.concat_tables(held)) if held else None

    def _winners(self, queries, batch: pa.RecordBatch, floor: np.ndarray):
        rows = pa.Table.from_batches([batch]).combine_chunks()
        rows = rows.sort_by([(tie, "ascending") for tie in self.ties])
        kept = rows.select(list(self.keep))
        prepared = queries.prepare(rows.to_batches()[0])
        if self.matching:
            for query, column, score in queries.matches(prepared):
                score = score if self.digits is None else np.round(score, self.digits)
                good = (score > 0) & (score >= floor[query])
                piece = kept.take(column[good])
                yield piece.append_column("_query", pa.array(query[good])).append_column("score", pa.array(score[good]))
            return
        for first in range(0, len(queries.ids), STEP_QUERIES):
            last = min(first + STEP_QUERIES, len(queries.ids))
            scores = queries.scores(prepared, first, last)
            if self.digits is not None:
                scores = np.round(scores, self.digits)
            scores = scores + 0.0  # no negative zeros
            query, column = _best_cells(scores, self.k)
            score = scores[query, column]
            good = score >= floor[query + first]
            piece = kept.take(column[good])
            yield piece.append_column("_query", pa.array(query[good] + first)).append_column(
                "score", pa.array(score[good])
            )

    def _best(self, table: pa.Table) -> pa.Table:
        order = [("_query", "ascending"), ("score", "descending")]
        table = table.sort_by(order + [(tie, "ascending") for tie in self.ties])
        query = table["_query"].to_numpy()
        place = np.arange(len(query)) - np.searchsorted(query, query)
        return table.filter(pa.array(place < self.k))

    def _raise_floor(self, floor: np.ndarray, best: pa.Table) -> None:
        """Once a query has ``k`` rows, nothing below its last one can still win."""
        query, score = best["_query"].to_numpy(), best["score"].to_numpy()
        count = np.bincount(query, minlength=len(floor))
        full = np.flatnonzero(count >= self.k)
        floor[full] = score[np.cumsum(count)[full] - 1]


def _answer(result: pa.Table | None, ids: pa.Array, columns: list[str]) -> list[pa.RecordBatch]:
    if result is None:
        return []
    named = result.append_column("query_id", ids.take(result["_query"].combine_chunks()))
    return named.select(columns).combine_chunks().to_batches(max_chunksize=10_000)


def one_of(n: int, *keys: str) -> Column:
    """Spread rows evenly over ``n`` numbers by a hash of unique keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def measure(queries: DataFrame, entries: Column) -> tuple[int, int]:
    """Number of queries, and of vector entries over all of them."""
    return tuple(queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(entries), F.lit(0))).first())


def search_top_k(
    queries: DataFrame,
    vectors: DataFrame,
    loader: Callable[[pa.Table], object],
    k: int,
    keep: list[str],
    ties: list[str],
    size: tuple[int, int],
    digits: int | None = 6,
    max_entries: int = QUERY_ENTRIES,
    max_results: int = QUERY_RESULTS,
    max_passes: int = MAX_PASSES,
    first_look: DataFrame | None = None,
    matching: bool = False,
) -> tuple[DataFrame, int | None]:
    """The best ``k`` rows of ``vectors`` for each query, numbered in ``rank``.

    ``loader`` turns an Arrow table of queries into a scorer; ``size`` is a checked
    upper bound of the number of queries and of the entries of their vectors, see
    ``measure``.  ``first_look`` is a part of the vectors that gives the floors; the
    result is the same without it.  With ``matching`` rows whose score is zero are left out;
    the scorer has ``matches``, and no score is negative.  Also returns how many result rows there are at most,
    or ``None`` when that is not bounded.
    """
    n_queries, n_entries = size
    if k < 1:
        vectors = vectors.limit(0)
    schema = T.StructType(
        [T.StructField("query_id", queries.schema["query_id"].dataType)]
        + [T.StructField(c, vectors.schema[c].dataType) for c in keep]
        + [T.StructField("score", T.DoubleType())]
    )
    scan = Scan(k, tuple(keep), tuple(ties), digits, matching)
    slices = max(math.ceil(n_queries * k / max_results), math.ceil(n_entries / max_entries))
    if first_look is not None and k >= 1 and slices <= max_passes:
        seen, _ = search_top_k(
            queries, first_look, loader, k, keep, ties, size, digits, max_entries, max_results, max_passes,
            matching=matching,
        )
        floors = seen.filter(F.col("rank") == k).select("query_id", F.col("score").alias(FLOOR))
        queries = queries.join(materialise(floors, "floors"), "query_id", "left")
    if slices <= 1:
        hits, max_rows = _by_broadcast(queries, vectors, loader, scan, schema), n_queries * k
    elif slices <= max_passes:
        written = materialise(queries, "queries")
        passes = [
            _by_broadcast(written.filter(one_of(slices, "query_id") == i), vectors, loader, scan, schema)
            for i in range(slices)
        ]
        hits, max_rows = reduce(DataFrame.union, passes), n_queries * k
    else:
        hits, max_rows = _by_fragments(queries, vectors, loader, scan, schema, slices), None
    # One task can sort what a few files' tasks hand in, but not those of thousands.
    many_tasks = slices > max_passes or input_files(vectors) > ROUND_ONE_PARTS
    ranked = top_ranked(hits, k, best_first(*ties), two_rounds=many_tasks)
    return ranked.select("query_id", "rank", *keep, "score"), max_rows


def _by_broadcast(queries, vectors, loader, scan, schema) -> DataFrame:
    """Every task scores its vectors against all queries."""
    columns = schema.fieldNames()
    shared = share(queries.sparkSession, queries.toArrow())

    def scan_partition(batches):
        scorer, floor = loader(shared.value), None
        if FLOOR in shared.value.column_names:
            floor = shared.value[FLOOR].fill_null(-math.inf).to_numpy()
        if len(scorer.ids):
            yield from _answer(scan.run(scorer, batches, floor), scorer.ids, columns)

    return vectors.mapInArrow(scan_partition, schema)


def _by_fragments(queries, vectors, loader, scan, schema, fragments) -> DataFrame:
    """Pair every fragment of the queries with every fragment of the vectors."""
    columns, arrow_schema = schema.fieldNames(), to_arrow_schema(schema)
    blocks = max(1, math.ceil(vectors.count() / FRAGMENT_ROWS))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("_left", one_of(fragments, "query_id")).withColumn(
        "_right", every(blocks)
    )
    right = vectors.withColumn("_right", one_of(blocks, *scan.ties)).withColumn(
        "_left", every(fragments)
    )

    def score_pair(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if mine.num_rows == 0 or theirs.num_rows == 0:
            return arrow_schema.empty_table()
        scorer = loader(mine)
        found = _answer(scan.run(scorer, theirs.to_batches()), scorer.ids, columns)
        return pa.Table.from_batches(found).cast(arrow_schema)

    pairs = left.groupBy("_left", "_right").cogroup(right.groupBy("_left", "_right"))
    return pairs.applyInArrow(score_pair, schema)
