"""Substring deduplication by relative Lempel-Ziv parsing of texts against each other.

1. Every window of ``window`` words has an anchor: its run of ``seed`` words with the
   smallest hash.  Equal windows have equal anchors, so only windows whose anchor occurs
   twice or more can repeat; all other words are literals of the parse.
2. The windows of these anchors are the reference, dealt to blocks that index them by hash.
   A batch of documents sends each block its different windows once, with their places, and
   a block answers where another batch has them.  Frequent windows are thus aggregated
   before the shuffle.
3. Every text is parsed greedily: a factor begins at a window that has a reference, in
   another batch or elsewhere in its own, and grows word by word as long as the next window
   has its reference at the next place.  Where it breaks off, the windows over the border
   are looked up one by one and begin factors of their own.  A factor has ``window`` words
   or more, and factors that overlap or touch are one duplicate span.

Windows are compared by a 64-bit hash; seeds only choose candidates.

Defined results: a null text has no words; with fewer than ``window`` words nothing is a
duplicate; rows of equal keys are documents of their own, equal rows repeat each other;
a word keeps its case; columns other than key and text do not take part.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.tables import Scratch
from gleanery.llm.words import Words, parts, runs

#: Windows that a block holds on average.
BLOCK = 1 << 17
#: Bytes of text whose windows are sent together.
BATCH = 1 << 21
SPANS = "array<struct<start: long, length: long>>"


def _windows(texts: pa.Array, window: int, seed: int):
    """Words, hash and place of the anchor of every window start, and which are whole.

    Anchor places count words of the part; a window is whole within one text only.
    """
    words = Words(texts)
    hashes = words.hashes()
    of = runs(hashes, window)
    seeds = runs(hashes, seed)
    row = np.repeat(np.arange(len(texts)), np.diff(words.first))
    if not len(of):
        empty = np.zeros(0, np.int64)
        return words, of, empty, np.zeros(0, bool), row, seeds
    at = np.empty(len(of), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(seeds, window - seed + 1)
    for i in range(0, len(of), 1 << 16):
        at[i : i + (1 << 16)] = view[i : i + (1 << 16)].argmin(axis=1)
    at += np.arange(len(of))
    return words, of, at, row[: len(of)] == row[window - 1 :], row, seeds


def _anchors(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """``(k, h)`` for every anchor of every text; ``k`` names rows of equal key and text."""

    def run(batches):
        for batch in batches:
            done = 0
            for part in parts(batch.column(1)):
                _, _, at, whole, row, seeds = _windows(part, window, seed)
                place = np.unique(at[whole])
                keys = batch.column(0).slice(done, len(part)).take(pa.array(row[place]))
                yield pa.RecordBatch.from_arrays([keys, pa.array(seeds[place].view(np.int64))], ["k", "h"])
                done += len(part)

    return docs.select("k", "text").mapInArrow(run, "k long, h long")


def _packed(rising: np.ndarray) -> bytes:
    """Rising numbers as the steps between them, two bytes each where that is enough."""
    steps = np.diff(rising.astype(np.int64), prepend=0)
    return steps.astype(np.uint16 if steps.max(initial=0) < 1 << 16 else np.uint32).tobytes()


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    steps = np.frombuffer(packed, np.uint16 if len(packed) == 2 * n else np.uint32)
    return np.cumsum(steps, dtype=np.int64)


class _Out:
    """Rows of the second look at the texts: finished documents, open ones, and messages."""

    NAMES = ["kind", "batch", "doc_id", "text", "n_words", "block", "windows", "places"]

    def __init__(self, kind: pa.DataType):
        self.types = [pa.string(), pa.int64(), kind, pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def rows(self, kind, n, batch=None, doc_id=None, text=None, n_words=None, block=None, windows=None, places=None):
        given = [[kind] * n, [batch] * n, doc_id, text, n_words, block, windows, places]
        arrays = [
            pa.nulls(n, t) if g is None else g.cast(t) if isinstance(g, pa.Array) else pa.array(g, t)
            for g, t in zip(given, self.types)
        ]
        return pa.RecordBatch.from_arrays(arrays, self.NAMES)


def _messages(docs: DataFrame, window: int, seed: int, blocks: int) -> DataFrame:
    """Finished documents without a repeated anchor; else open ones, and their windows."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            out = _Out(batch.schema.field("doc_id").type)
            ids, texts, anchors = batch.column(0), batch.column(1), batch.column(2)
            known = anchors.is_valid()
            easy = known.to_numpy(zero_copy_only=False) == False  # noqa: E712
            if easy.any():
                some = pa.array(easy)
                rest = texts.filter(some)
                n = np.concatenate([np.diff(Words(p).first) for p in parts(rest)])
                yield out.rows("done", len(rest), doc_id=ids.filter(some), text=rest, n_words=n)
            ids, texts, anchors = ids.filter(known), texts.filter(known), anchors.filter(known)
            done = 0
            for part in parts(texts, BATCH):
                mine = slice(done, done + len(part))
                words, of, at, whole, row, seeds = _windows(part, window, seed)
                wanted = np.unique(anchors[mine].flatten().to_numpy().view(np.uint64))
                place = np.searchsorted(wanted, seeds[at])
                hit = whole & (wanted[np.minimum(place, len(wanted) - 1)] == seeds[at])
                places = np.flatnonzero(hit)
                found, first = np.unique(of[places], return_index=True)
                places = places[first]
                block = (found % np.uint64(blocks)).astype(np.int64)
                order = np.lexsort((places, block))
                found, places, block = found[order], places[order], block[order]
                to, first = np.unique(block, return_index=True)
                cuts = list(zip([*first], [*first[1:], len(found)]))
                windows, at = [found[a:b].tobytes() for a, b in cuts], [_packed(places[a:b]) for a, b in cuts]
                yield out.rows("window", len(to), number, block=to, windows=windows, places=at)
                # the number of a text in its batch stands for a block
                yield out.rows(
                    "open", len(part), number, doc_id=ids[mine], text=part, n_words=np.diff(words.first),
                    block=np.arange(len(part)),
                )
                number, done = number + 1, done + len(part)

    return docs.select("doc_id", "text", "anchors").mapInArrow(
        run,
        f"kind string, batch long, doc_id {kind}, text string, n_words long, block long, windows binary, places binary",
    )


ANSWERS = "batch long, own binary, batches binary, which binary, places binary"


def _references(key, table):
    """For each batch, where another batch has its windows of this block.

    The reference of a window is its first batch, and for that batch its second.  A batch is
    told its own places, different other batches, which of these, and the places there.
    """
    packed, batch = table["windows"].to_pylist(), table["batch"].to_numpy()
    hashes = np.concatenate([np.frombuffer(p, np.uint64) for p in packed])
    places = np.concatenate([_unpacked(p, len(w) // 8) for p, w in zip(table["places"].to_pylist(), packed)])
    sender = np.repeat(np.arange(len(packed)), [len(p) // 8 for p in packed])
    order = np.lexsort((batch[sender], hashes))
    same = hashes[order][1:] == hashes[order][:-1]
    head = np.flatnonzero(np.r_[True, ~same])  # the first batch of each window
    size = np.diff(np.r_[head, len(order)])
    first = np.repeat(head, size)
    other = np.where(np.arange(len(order)) == first, first + 1, first)
    twice = np.repeat(size > 1, size)
    asks, answers = order[twice], order[other[twice]]
    by_sender = np.lexsort((places[asks], sender[asks]))
    asks, answers = asks[by_sender], answers[by_sender]
    cuts = np.searchsorted(sender[asks], np.arange(len(packed) + 1))
    told = {"batch": [], "own": [], "batches": [], "which": [], "places": []}
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            others, which = np.unique(batch[sender[answers[a:b]]], return_inverse=True)
            told["batch"].append(batch[i])
            told["own"].append(_packed(places[asks[a:b]]))
            told["batches"].append(others.tobytes())
            told["which"].append(which.astype(np.uint16 if len(others) < 1 << 16 else np.uint32).tobytes())
            told["places"].append(places[answers[a:b]].astype(np.uint32).tobytes())
    kinds = {name: pa.int64() if name == "batch" else pa.binary() for name in told}
    return pa.table({name: pa.array(told[name], kinds[name]) for name in told})


def _told(answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(own place, batch, place there)`` of all answers to a batch."""
    out = [[np.zeros(0, np.int64)] for _ in range(3)]
    columns = [answers[c].to_pylist() for c in ("own", "batches", "which", "places")]
    for own, batches, which, places in zip(*columns):
        n = len(places) // 4
        index = np.frombuffer(which, np.uint16 if len(which) == 2 * n else np.uint32)
        out[0].append(_unpacked(own, n))
        out[1].append(np.frombuffer(batches, np.int64)[index])
        out[2].append(np.frombuffer(places, np.uint32).astype(np.int64))
    return tuple(np.concatenate(x) for x in out)


def _own_references(of: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each window start another start of the same window in this batch, or -1.

    It is the first one, and for that the second.
    """
    order = np.argsort(of[starts], kind="stable")
    values = of[starts][order]
    head = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(order) else order
    size = np.diff(np.r_[head, len(order)])
    first = np.repeat(head, size)
    other = np.where(np.arange(len(order)) == first, first + 1, first)
    twice = np.repeat(size > 1, size)
    out = np.full(len(starts), -1, np.int64)
    out[order[twice]] = starts[order[other[twice]]]
    return out


def _factors(starts: np.ndarray, batch: np.ndarray, place: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Factors ``(start, length, batch, place)`` of a text from the references of its windows.

    A factor grows while the next window refers to the next place of the same batch.
    """
    if not len(starts):
        return []
    breaks = np.flatnonzero((np.diff(starts) != 1) | (np.diff(batch) != 0) | (np.diff(place) != 1)) + 1
    first, last = np.r_[0, breaks], np.r_[breaks - 1, len(starts) - 1]
    length = starts[last] - starts[first] + window
    return list(zip(starts[first].tolist(), length.tolist(), batch[first].tolist(), place[first].tolist()))


def _spans(factors: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Spans ``(start, length)`` of the factors, those that overlap or touch as one."""
    spans = []
    for start, length, _, _ in factors:
        if spans and start <= spans[-1][0] + spans[-1][1]:
            spans[-1] = (spans[-1][0], start + length - spans[-1][0])
        else:
            spans.append((start, length))
    return spans


def _parse(window: int, with_text: bool):
    def parse(key, docs, answers):
        docs = docs.sort_by("block")  # as the batch was when its windows were sent
        texts = docs["text"].combine_chunks() if len(docs) else pa.array([], pa.string())
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        words = Words(texts)
        of = runs(words.hashes(), window)
        row = np.repeat(np.arange(len(texts)), np.diff(words.first))
        whole = row[: len(of)] == row[window - 1 :] if len(of) else np.zeros(0, bool)
        starts = np.flatnonzero(whole)
        # a reference in another batch goes before one in this; it is told for the first
        # of equal windows, which the others refer to
        place, batch = _own_references(of, starts), np.full(len(starts), -1, np.int64)
        own, there, at = _told(answers)
        told = np.searchsorted(starts, own)
        place[told], batch[told] = at, there
        known = place >= 0
        repeated, place, batch = starts[known], place[known], batch[known]
        out = {"doc_id": docs["doc_id"], "n_words": [], "spans": [], "n_removed": [], "kept": [], "kept_words": []}
        for i, text in enumerate(texts.to_pylist()):
            first, last = words.first[i], words.first[i + 1]
            a, b = np.searchsorted(repeated, [first, last])
            spans = _spans(_factors(repeated[a:b] - first, batch[a:b], place[a:b], window))
            gone = np.zeros(last - first, bool)
            for start, length in spans:
                gone[start : start + length] = True
            raw = (text or "").encode("utf-8")
            out["n_words"].append(int(last - first))
            out["spans"].append([{"start": s, "length": n} for s, n in spans])
            out["n_removed"].append(int(gone.sum()))
            out["kept_words"].append(b" ".join(compress(raw.split(), ~gone)).decode("utf-8"))
            out["kept"].append(_cut(raw, words, first, gone) if with_text else None)
        return pa.table(
            {
                "doc_id": out["doc_id"],
                "n_words": pa.array(out["n_words"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "spans": pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                "kept_words": pa.array(out["kept_words"], pa.string()),
                "kept": pa.array(out["kept"], pa.string()),
            }
        )

    return parse


def _cut(raw: bytes, words: Words, first: int, gone: np.ndarray) -> str:
    """The text without the words of its spans and the white space after them."""
    if not gone.any():
        return raw.decode("utf-8")
    base = words.starts[first] - (len(raw) - len(raw.lstrip(b" \t\n\x0b\x0c\r")))
    starts = np.r_[words.starts[first : first + len(gone)] - base, len(raw)]
    edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
    kept, at = [], 0
    for a, b in zip(edges[::2], edges[1::2]):
        kept.append(raw[at : starts[a]])
        at = starts[b]
    return b"".join([*kept, raw[at:]]).decode("utf-8")


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = 35,
    seed: int = 8,
    with_text: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept_words`` and, if asked for, ``kept``.

    ``spans`` are in words; ``kept_words`` joins the kept words by one space, ``kept`` is
    the text with the spans cut out and its other white space as it was.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    whole = F.coalesce(F.col(text), F.lit("")).alias("text")
    docs = docs.select(F.col(key).alias("doc_id"), whole).withColumn("k", F.xxhash64("doc_id", "text"))
    anchors = scratch.write(_anchors(docs, window, seed), "anchors")
    # written down, so that both sides of the join are shuffled and a hot anchor can be split
    repeated = anchors.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    repeated = scratch.write(repeated, "repeated")
    hits = anchors.join(repeated, "h").groupBy("k").agg(F.collect_set("h").alias("anchors"))
    hits = scratch.write(hits, "hits")
    scratch.release(anchors)

    # a seed is the anchor of a few windows: what they may come to fixes the blocks
    n = hits.agg(F.sum(F.size("anchors"))).first()[0] or 0
    blocks = max(1, -(-n * (window - seed + 1) // 2 // BLOCK))
    told = _messages(docs.join(hits, "k", "left"), window, seed, blocks)
    path = scratch.write(told, "told", partition_by="kind")
    del told
    scratch.release(repeated, hits, settle=True)
    sent = path.filter("kind = 'window'").select("block", "batch", "windows", "places")
    answers = sent.groupBy("block").applyInArrow(_references, ANSWERS)
    open_ = path.filter("kind = 'open'").select("batch", "doc_id", "text", "block")
    id_type = open_.schema["doc_id"].dataType.simpleString()
    parsed = open_.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        _parse(window, with_text),
        f"doc_id {id_type}, n_words long, n_removed long, spans {SPANS}, kept_words string, kept string",
    )
    done = path.filter("kind = 'done'").select(
        "doc_id",
        "n_words",
        F.lit(0).cast("long").alias("n_removed"),
        F.array().cast(SPANS).alias("spans"),
        F.array_join(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+", -1), ""), " ").alias("kept_words"),
        F.col("text").alias("kept") if with_text else F.lit(None).cast("string").alias("kept"),
    )
    out = done.union(parsed)
    return out if with_text else out.drop("kept")
