"""Ranked lexical search by an Aho-Corasick scan of the documents.

1. The terms of all items, each between two guards, make one automaton that is broadcast.
   Items go in blocks of a bounded number of term bytes; a block reads the documents twice
   and needs no index of them.
2. The first scan counts documents, terms and, for every item term, the documents that
   hold it.  They give the weights.
3. The second scan counts the occurrences of the item terms in every text, maps them to the
   items and adds up their parts of the score.  A task keeps the best of each item only,
   and few rows are shuffled.

A text is scanned as its bytes, with a guard for whatever is no term byte; a guard is
shared by the terms on both sides.  A long text is scanned in slices that end between terms.

Defined results: a null text and one without terms are no document; a null key ranks behind
equal scores; rows of equal keys are documents of their own, and equal items are items of
their own with the same rows; an item without a term that occurs has no rows; other columns
do not take part, whatever their names; without documents or items there are no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.tables import Scratch
from gleanery.llm.tokens import ALPHANUMERIC, slices
from gleanery.operators.ranking import top_ranked

#: Bytes of text that are scanned together.
PART = 1 << 20
#: Bytes of item texts whose terms make one automaton, some fifty times as much in memory.
BLOCK_BYTES = 1 << 20
#: Pairs of a term in a document and an item that has the term, held at a time.
PAIRS = 1 << 20
GUARD = 32
# Saturation and length normalisation, as whole numbers.
UNIT, TF_SCALE, M_SCALE, M_BASE, M_LENGTH = 1_000_000_000, 1000, 20, 50, 50


@dataclass(frozen=True)
class Block:
    """Items by number, the different terms of all, and which items have each term."""

    items: list
    terms: list[bytes]
    first: np.ndarray  # term t is in items of[first[t]:first[t + 1]]
    of: np.ndarray


def _block(ids: list, texts: list[str | None]) -> Block:
    numbers, has = {}, []
    for item, tokens in _rows(pa.array(texts, pa.large_string())):
        for word in {tokens.data[a:b].tobytes() for a, b in zip(tokens.starts, tokens.ends)}:
            has.append((numbers.setdefault(word, len(numbers)), item))
    has = np.array(sorted(set(has)), np.int64).reshape(-1, 2)
    first = np.searchsorted(has[:, 0], np.arange(len(numbers) + 1))
    return Block(ids, list(numbers), first, np.ascontiguousarray(has[:, 1]))


def _rows(texts: pa.Array):
    for i in range(len(texts)):
        for _, tokens in slices(texts.slice(i, 1), PART, ALPHANUMERIC):
            yield i, tokens


class Scanner:
    """Counts the terms of a block in slices of texts."""

    def __init__(self, terms: list[bytes]):
        self.n_terms, guard = len(terms), chr(GUARD)
        self.automaton = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            self.automaton.add_word(guard + term.decode("latin-1") + guard, number)
        if terms:
            self.automaton.make_automaton()

    def counts(self, tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, term, tf)`` of the terms found, by text and term."""
        if not self.n_terms or not len(tokens):
            none = np.zeros(0, np.int64)
            return none, none, none
        # a guard around every text: text i begins i + 1 bytes later than in the slice
        size, texts = len(tokens.data), len(tokens.offsets) - 1
        plain = np.full(size + texts + 1, GUARD, np.uint8)
        shift = np.repeat(np.arange(1, texts + 1), np.diff(tokens.offsets))
        plain[np.arange(size) + shift] = np.where(tokens.inside, tokens.data, GUARD)
        found = self.automaton.iter(plain.tobytes().decode("latin-1"))
        flat = np.fromiter(chain.from_iterable(found), np.int64)
        end, term = flat[::2], flat[1::2]
        text = np.searchsorted(tokens.offsets + np.arange(texts + 1), end - 1, "right") - 1
        both, tf = np.unique(text * self.n_terms + term, return_counts=True)
        return both // self.n_terms, both % self.n_terms, tf


def _scanned(texts: pa.Array, scanner: Scanner):
    """``(first text, terms in each text, text, term, tf)`` of whole texts, slice by slice."""
    held = None
    for first, tokens in slices(texts, PART, ALPHANUMERIC):
        n = np.bincount(tokens.row, minlength=len(tokens.offsets) - 1)
        one = (first, n, *scanner.counts(tokens))
        if held is not None and held[0] == first:  # more of the same long text
            both, place = np.unique(np.r_[held[3], one[3]], return_inverse=True)
            tf = np.bincount(place, np.r_[held[4], one[4]], len(both)).astype(np.int64)
            one = (first, held[1] + n, np.zeros(len(both), np.int64), both, tf)
        elif held is not None:
            yield held
        held = one
    if held is not None:
        yield held


def _statistics(docs: DataFrame, block) -> DataFrame:
    """``(term, n)``: documents that hold a term; at -1 all documents, at -2 all terms."""

    def run(batches):
        terms = block.value.terms
        scanner, df, total = Scanner(terms), np.zeros(len(terms), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for _, n, _, term, _ in _scanned(batch.column(0), scanner):
                total += [np.count_nonzero(n), n.sum()]
                df += np.bincount(term, minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, some]), pa.array(np.r_[total, df[some]])], ["term", "n"])

    return docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def weights(df: dict[int, int], n_docs: int, n_terms: int) -> np.ndarray:
    """A term's weight, 0 where no document holds it."""
    out = np.zeros(n_terms, np.int64)
    for term, n in df.items():
        out[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
    return out


def _parts(n: np.ndarray, tf: np.ndarray, w: np.ndarray, n_docs: int, n_all: int) -> np.ndarray:
    """What a term adds to the score of a document of n terms."""
    m = 100 - M_BASE + M_LENGTH * n * n_docs // n_all
    return w * (UNIT * tf // (TF_SCALE * tf + M_SCALE * m))


class _Best:
    """The best rows of each item so far."""

    def __init__(self, items: int, top: int):
        self.top, self.items, self.floor = top, items, np.ones(items, np.int64)
        self.rows, self.size = [], 0

    def add(self, keys: pa.Array, item: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        good = np.flatnonzero(score >= self.floor[item])
        if len(good):
            self.rows.append(pa.table({"item": item[good], "score": score[good], "doc_id": keys.take(pa.array(row[good]))}))
            self.size += len(good)
        if self.size > 4 * self.top * self.items + 100_000:
            self.prune()

    def prune(self) -> pa.Table | None:
        if not self.rows:
            return None
        order = [("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")]
        table = pa.concat_tables(self.rows)
        table = table.take(pc.sort_indices(table, sort_keys=order))
        item = table["item"].to_numpy()
        at = np.arange(len(item)) - np.searchsorted(item, item)
        table = table.filter(pa.array(at < self.top)).combine_chunks()
        last = np.flatnonzero(at[at < self.top] == self.top - 1)
        self.floor[table["item"].to_numpy()[last]] = table["score"].to_numpy()[last]
        self.rows, self.size = [table], len(table)
        return table


def _scores(docs: DataFrame, block, weight: np.ndarray, n_docs: int, n_all: int, top: int) -> DataFrame:
    """``(item, doc_id, score)``: the best rows of each task."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        b = block.value
        scanner, best, items = Scanner(b.terms), _Best(len(b.items), top), len(b.items)
        for batch in batches:
            for first, n, text, term, tf in _scanned(batch.column(1), scanner):
                part = _parts(n[text], tf, weight[term], n_docs, n_all)
                fan = b.first[term + 1] - b.first[term]
                ends = np.cumsum(fan)
                begin = 0
                while begin < len(text):  # whole texts, about PAIRS pairs at a time
                    done = ends[begin - 1] if begin else 0
                    end = max(begin + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
                    end = int(np.searchsorted(text, text[end - 1], "right"))
                    own = slice(begin, end)
                    rows, doc = np.unique(text[own], return_inverse=True)
                    times = fan[own]
                    at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    item = b.of[np.repeat(b.first[term[own]], times) + at]
                    place = np.repeat(doc, times) * items + item
                    if len(rows) * items <= 4 * len(place):
                        pair = np.arange(len(rows) * items)
                    else:
                        pair, place = np.unique(place, return_inverse=True)
                    score = np.zeros(len(pair), np.int64)
                    np.add.at(score, place, np.repeat(part[own], times))
                    best.add(batch.column(0), pair % items, first + rows[pair // items], score)
                    begin = end
        table = best.prune()
        if table is not None:
            yield from table.select(["item", "doc_id", "score"]).to_batches()

    return docs.select("doc_id", "text").mapInArrow(run, f"item long, doc_id {kind}, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = 50,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item, ranked.

    Terms are runs of letters, digits and characters beyond ASCII, A to Z lower-cased.
    Documents of equal score follow their keys.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lexical")
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 8), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    asked = scratch.write(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")

    found = []
    for number in range(blocks):
        own = asked.filter(F.col("block") == number).orderBy("item_id", "text").toArrow()  # some BLOCK_BYTES
        if not len(own):
            continue
        block = spark.sparkContext.broadcast(_block(own["item_id"].to_pylist(), own["text"].to_pylist()))
        n_terms = len(block.value.terms)
        counts = dict(_statistics(docs, block).collect())  # a row for each term
        n_docs, n_all = counts.pop(-1, 0), counts.pop(-2, 0)
        if n_docs:
            weight = weights(counts, n_docs, n_terms)
            rows = scratch.write(_scores(docs, block, weight, n_docs, n_all, top), "best")
            ranked = top_ranked(rows, top, [F.desc("score"), F.asc_nulls_last("doc_id")], "item", two_rounds=True)
            names = spark.createDataFrame(
                pa.table({"item": pa.array(range(len(own)), pa.int64()), "item_id": own["item_id"].combine_chunks()})
            )
            found.append(scratch.write(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
            scratch.release(rows)
        block.destroy()
    if not found:
        kinds = [asked.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()]
        return spark.createDataFrame([], "item_id {}, rank int, doc_id {}, score long".format(*kinds))
    return reduce(DataFrame.union, found)
