"""Phrase collocation mining by best-first branch-and-bound growth.

1. Words are counted by language; those below ``min_count`` start no phrase.
2. Pairs of such words are counted by hash first, which tells the few that can reach
   ``min_count``; these are counted by their text and scored.
3. Pairs are grown to three words.  A phrase of three words scores at most
   ``f(w1 w2) / f(w1)`` and at most ``f(w2 w3) / f(w3)``, for a whole is no more frequent
   than its parts.  The frontier is expanded from the best bounds down, a block at a
   time: the phrases whose bounds reach the block's least score, and those that hold a pair
   which reaches it and may be dropped for their sake.
4. A language is settled when as many phrases as are asked for survive at or above the
   least score: whatever was not expanded scores less.  The others go on with a block
   ``GROWTH`` times as large.

Tasks know frontiers by bit sets of a fixed size.  A foreign phrase that passes one is
counted in vain and goes in the join with the true table.

Defined results: a null text counts as empty and a null language as ``und``; repeated rows
count each time; ties are ordered as the contract of ``mine`` says; texts of any length are
read in slices; columns other than text and language do not take part, whatever their
names; an empty table, or one without a frequent phrase, gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.tables import Scratch
from gleanery.llm.tokens import byte_table, hashed, slices
from gleanery.llm.words import mix

UNKNOWN = "und"
#: Bytes of text that are counted together.
PART = 1 << 21
#: Pairs in a language's first block, as a multiple of the phrases asked for, and the
#: growth of the block from round to round.
FIRST_BLOCK, GROWTH = 2, 8
#: Bit sets have some 16 bits for each entry, up to 16 MB.
MOST_BITS = 1 << 27
ONE = 1_000_000

WORD = ~byte_table([(0x20, 0x20), (0x09, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"]])
BREAKS = byte_table([(0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"]])

COUNTED, PREFIX, SUFFIX, HELD = range(4)


class _Bits:
    """A set of 64-bit hashes with flags: never a false no."""

    def __init__(self, spark, rows: DataFrame, flags: Column | None = None, width: int = 1):
        """``rows`` has a column ``h``; ``flags`` lists the flags of a row, below ``width``."""
        n = rows.count()
        self.slots = 1 << 16
        while self.slots < 16 * n and self.slots * width < MOST_BITS:
            self.slots *= 2
        self.width = width
        bits = np.zeros(self.slots * width // 8, np.uint8)
        if n:
            flags = F.array(F.lit(0)) if flags is None else flags
            slot = F.col("h").bitwiseAND(F.lit(self.slots - 1))
            at = rows.select(slot.alias("slot"), F.explode(flags).alias("flag")).select(
                (F.col("slot") * width + F.col("flag") + 1).alias("at")  # buckets count from 1
            )
            buckets = at.select(
                F.bitmap_bucket_number("at").alias("b"), F.bitmap_bit_position("at").alias("p")
            ).groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits"))
            for b, found in buckets.collect():  # 4 KB each, up to 16 MB
                first = (b - 1) * 4096
                own = np.frombuffer(found, np.uint8)[: len(bits) - first]
                bits[first : first + len(own)] = own
        self.broadcast = spark.sparkContext.broadcast(bits)

    def test(self, hashes: np.ndarray, flag: int = 0) -> np.ndarray:
        at = (hashes & np.uint64(self.slots - 1)).astype(np.int64) * self.width + flag
        return (self.broadcast.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def release(self) -> None:
        self.broadcast.destroy()


class _Slice:
    """Words of some texts with numbers, hashes by language, and where phrases begin."""

    def __init__(self, tokens, first: int, languages: pa.Array, codes: np.ndarray):
        self.ids, self.words = tokens.codes()
        self.languages = languages
        self.language = codes[first + tokens.row]
        own = hashed(self.words)
        of = hashed(languages) * np.uint64(0x9E3779B97F4A7C15)
        self.hashes = mix(own[self.ids] + of[self.language]) if len(self.ids) else own
        self.piece, self.fresh = tokens.piece, tokens.fresh

    def starts(self, length: int) -> np.ndarray:
        """Where ``length`` words of one piece begin, the last of which is new."""
        last = np.arange(length - 1, len(self.ids))
        return last[(self.piece[last] == self.piece[last - length + 1]) & (last >= self.fresh)] - length + 1

    def phrases(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the phrases that begin there."""
        out = self.hashes[at]
        for d in range(1, length):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + self.hashes[at + d])
        return out

    def counted(self, at: np.ndarray, length: int, hashes: np.ndarray) -> pa.RecordBatch:
        """Different phrases among those that begin there, and how often each does.

        Phrases are told apart by the numbers of their words, not by hash.
        """
        v, code = max(1, len(self.words)), self.language[at]
        for d in range(length):
            code = np.unique(code, return_inverse=True)[1] * v + self.ids[at + d]
        _, one, counts = np.unique(code, return_index=True, return_counts=True)
        words = [self.words.take(pa.array(self.ids[at[one] + d])) for d in range(length)]
        phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if length > 1 else words[0]
        return pa.RecordBatch.from_arrays(
            [self.languages.take(pa.array(self.language[at[one]])).cast(pa.string()), phrase.cast(pa.string()),
             pa.array(hashes[one].view(np.int64)), pa.array(counts, pa.int64())],
            ["lang", "phrase", "h", "n"],
        )


def _sliced(batches, length: int):
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        languages, codes = coded.dictionary, coded.indices.to_numpy()
        for first, tokens in slices(batch.column(1), PART, WORD, BREAKS, overlap=length - 1):
            if len(tokens) > tokens.fresh:
                yield _Slice(tokens, first, languages, codes)


PHRASES = "lang string, phrase string, h long, n long"


def _words(docs: DataFrame) -> DataFrame:
    def run(batches):
        for s in _sliced(batches, 1):
            at = s.starts(1)
            yield s.counted(at, 1, s.hashes[at])

    return docs.mapInArrow(run, PHRASES)


def _pair_hashes(docs: DataFrame, frequent: _Bits) -> DataFrame:
    def run(batches):
        for s in _sliced(batches, 2):
            at = s.starts(2)
            known = frequent.test(s.hashes)
            hashes, n = np.unique(s.phrases(at[known[at] & known[at + 1]], 2), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])

    return docs.mapInArrow(run, "h long, n long")


def _pairs(docs: DataFrame, able: _Bits) -> DataFrame:
    def run(batches):
        for s in _sliced(batches, 2):
            at = s.starts(2)
            hashes = s.phrases(at, 2)
            hit = able.test(hashes)
            yield s.counted(at[hit], 2, hashes[hit])

    return docs.mapInArrow(run, PHRASES)


def _triples(docs: DataFrame, frontier: _Bits) -> DataFrame:
    def run(batches):
        for s in _sliced(batches, 3):
            at = s.starts(3)
            one, two = s.phrases(at, 2), s.phrases(at + 1, 2)
            hit = (frontier.test(one, PREFIX) & frontier.test(two, SUFFIX)) | (
                frontier.test(one, COUNTED) & frontier.test(two, COUNTED)
                & (frontier.test(one, HELD) | frontier.test(two, HELD))
            )
            yield s.counted(at[hit], 3, one[hit])

    return docs.mapInArrow(run, PHRASES)


def _frequent(counted: DataFrame, min_count: int) -> DataFrame:
    """``(lang, phrase, h, a)`` of the phrases that occur often enough."""
    summed = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("a"), F.first("h").alias("h"))
    return summed.filter(F.col("a") >= min_count)


def _ratio(a: str, *under: str) -> Column:
    """The floor of a million times ``a`` (squared for two columns under it), exactly."""
    over, below = F.lit(ONE).cast("decimal(7,0)"), F.lit(1).cast("decimal(1,0)")
    for column in under:
        over = over * F.col(a).cast("decimal(15,0)")
        below = below * F.col(column).cast("decimal(15,0)")
    return F.call_function("div", over, below)


def _with_counts(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the counts ``l`` and ``r`` of both words, the score, and the bounds of growth."""
    split = F.split("phrase", " ")
    pairs = pairs.withColumns({"first": split[0], "second": split[1]})
    left = words.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = words.select("lang", F.col("phrase").alias("second"), F.col("a").alias("r"))
    pairs = pairs.join(left, ["lang", "first"]).join(right, ["lang", "second"])
    return pairs.select(
        "lang", "phrase", "h", "a", "l", "r", _ratio("a", "l", "r").alias("score"),
        _ratio("a", "l").alias("as_prefix"), _ratio("a", "r").alias("as_suffix"),
    )


def _least_scores(pairs: DataFrame, block: int) -> DataFrame:
    """``(lang, least)``: the score that ``block`` pairs reach, or 0 where there are fewer.

    There are no more than a million and one scores, so a language is counted by score.
    """
    counts = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))
    best_first = Window.partitionBy("lang").orderBy(F.desc("score"))
    reached = counts.withColumn("so_far", F.sum("n").over(best_first))
    enough = F.max(F.when(F.col("so_far") >= block, F.col("score")))
    return reached.groupBy("lang").agg(F.coalesce(enough, F.lit(0)).alias("least"))


def _expanded(scratch: Scratch, docs: DataFrame, pairs: DataFrame, least: DataFrame, rules: tuple[int, int]) -> DataFrame:
    """All phrases of two and three words that survive and reach their language's least score."""
    min_count, inside = rules
    open_ = pairs.join(least, "lang")
    flags = F.array_compact(
        F.array(
            F.lit(COUNTED),
            F.when(F.col("as_prefix") >= F.col("least"), F.lit(PREFIX)),
            F.when(F.col("as_suffix") >= F.col("least"), F.lit(SUFFIX)),
            F.when(F.col("score") >= F.col("least"), F.lit(HELD)),
        )
    )
    frontier = _Bits(docs.sparkSession, open_.select("h", "as_prefix", "as_suffix", "score", "least"), flags, 4)
    triples = scratch.write(_frequent(_triples(docs, frontier), min_count).drop("h"), "triples")
    frontier.release()

    words = F.split("phrase", " ")
    triples = triples.withColumns(
        {"head": F.concat_ws(" ", words[0], words[1]), "tail": F.concat_ws(" ", words[1], words[2])}
    )
    heads = open_.select("lang", "least", F.col("phrase").alias("head"), F.col("a").alias("f_head"), F.col("l").alias("f_first"))
    tails = open_.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("f_tail"), F.col("r").alias("f_last"))
    triples = scratch.write(triples.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]), "grown")

    one, two = _ratio("a", "f_first", "f_tail"), _ratio("a", "f_head", "f_last")
    grown = triples.withColumns({"one": one, "two": two}).withColumn("early", F.col("one") <= F.col("two"))
    grown = grown.select(
        "lang", "phrase", "a", F.when(F.col("early"), F.col("f_first")).otherwise(F.col("f_head")).alias("l"),
        F.when(F.col("early"), F.col("f_tail")).otherwise(F.col("f_last")).alias("r"),
        F.least("one", "two").alias("score"), "least",
    )
    covers = [
        triples.filter(F.col("a") * 100 >= F.col(f"f_{part}") * inside).select("lang", F.col(part).alias("phrase"))
        for part in ("head", "tail")
    ]
    covered = covers[0].union(covers[1]).distinct()
    short = open_.join(covered, ["lang", "phrase"], "left_anti")
    both = short.select("lang", "phrase", "a", "l", "r", "score", "least").unionByName(grown)
    return both.filter("score >= least").drop("least")


def mine(
    docs: DataFrame,
    language: str = "lang",
    text: str = "text",
    min_count: int = 10,
    inside: int = 50,
    top: int = 2000,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    A phrase of two or three words occurs ``a >= min_count`` times.  Its score is the
    least, over the cuts into a first part of ``l`` and a rest of ``r`` occurrences, of a
    million times ``a * a / (l * r)``, rounded down; of equal cuts the first counts.  A
    phrase is dropped if a longer one around it has ``inside`` per cent of its occurrences.
    Best score first, then the largest ``a``, then the phrase by its bytes; ``n`` is the
    number of words of the language.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "collocations")
    named = F.coalesce(F.col(language).cast("string"), F.lit(UNKNOWN)).alias("lang")
    docs = docs.select(named, F.coalesce(F.col(text), F.lit("")).alias("text"))

    counted = scratch.write(
        _words(docs).groupBy("lang", "phrase").agg(F.sum("n").alias("a"), F.first("h").alias("h")), "words"
    )
    totals = counted.groupBy("lang").agg(F.sum("a").alias("n"))
    words = scratch.write(counted.filter(F.col("a") >= min_count), "frequent")
    totals = scratch.write(totals, "totals")
    scratch.release(counted)

    frequent = _Bits(spark, words)
    able = _pair_hashes(docs, frequent).groupBy("h").agg(F.sum("n").alias("n"))
    able = scratch.write(able.filter(F.col("n") >= min_count).select("h"), "able")
    frequent.release()
    scratch.release()
    bits = _Bits(spark, able)
    pairs = scratch.write(_frequent(_pairs(docs, bits), min_count), "pairs")
    bits.release()
    pairs = scratch.write(_with_counts(pairs, words), "scored")
    scratch.release()

    block, found, settled = FIRST_BLOCK * top, [], None
    while True:
        least = _least_scores(pairs, block)
        if settled is not None:
            least = least.join(settled, "lang", "left_anti")
        least = scratch.write(least, "least")
        if least.isEmpty():
            break
        part = scratch.write(_expanded(scratch, docs, pairs, least, (min_count, inside)), "survivors")
        enough = part.groupBy("lang").agg(F.count("*").alias("n")).filter(F.col("n") >= top).select("lang")
        done = enough.union(least.filter("least = 0").select("lang")).distinct()
        done = scratch.write(done, "settled")
        found.append(part.join(done, "lang"))
        settled = done if settled is None else settled.union(done)
        block *= GROWTH
        scratch.release()

    columns = ["lang", "phrase", "a", "l", "r", "score"]
    if not found:
        found = [pairs.select(columns)]  # none
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = reduce(DataFrame.union, [f.select(columns) for f in found]).withColumn("rank", F.row_number().over(order))
    return best.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
