"""Packing of token sequences into windows by Karmarkar-Karp multiway differencing.

A document's full windows are cut off first.  What is left is cut into pieces of at most
``piece`` tokens; the pieces of a bounded group of documents go into as many windows as
their sum asks for.  Partial partitions are merged, those of the largest imbalance first,
large sums of the one on small sums of the other, which ends in near-equal windows.  When
a window exceeds the capacity, the group is packed anew with one window more.

Documents are packed where they are read: nothing is shuffled, a group is bounded in its
tokens and its pieces, and a repeated task packs the same rows in the same way.

Defined results: a null text counts as empty and consists of the closing id alone; repeated
rows and rows of null keys are packed each for itself; other columns than key and text do not
take part; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

PIECES = (
    "doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
#: Characters of a text that are encoded in one call.
CALL = 1 << 18
#: A word of letters after a space that follows no space: every pre-token ends before it.
SAFE = re.compile(r"(?<=\S) (?=[^\W\d_])")


def difference(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each size, by Karmarkar-Karp differencing over ``windows`` sums."""
    n = len(sizes)
    heap, merges = [], []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size  # sums fall from the first slot on
        heap.append((-size, i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, large = heapq.heappop(heap)
        _, b, small = heapq.heappop(heap)
        sums = large + small[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), n + len(merges), sums))
        merges.append((a, b, order))
    slots = {n + len(merges) - 1: np.arange(windows)} if merges else {0: np.arange(windows)}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        own = slots.pop(n + k)
        before = np.empty(windows, np.int64)
        before[order] = own  # the window of each slot before sorting
        slots[a], slots[b] = before, before[::-1]
    return np.array([slots[i][0] for i in range(n)], np.int64)


def balanced(sizes: list[int], capacity: int) -> np.ndarray:
    """Windows of at most ``capacity``, as few as differencing manages."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        place = difference(sizes, windows)
        if np.bincount(place, sizes, windows).max(initial=0) <= capacity:
            return place
        windows += 1


class Encoder:
    """Ids as the byte-level tokenizer file gives them, special strings included."""

    def __init__(self, definition: bytes, pattern: str):
        import tiktoken

        model = json.loads(definition)
        letters = _letters()
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in model["model"]["vocab"].items()
            if token not in special
        }
        self.encoding = tiktoken.Encoding(
            "packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special
        )

    def __call__(self, text: str) -> np.ndarray:
        """Long texts go in parts, cut where a pre-token ends whatever stands around."""
        parts, first = [], 0
        while len(text) - first > 2 * CALL:
            cut = SAFE.search(text, first + CALL)
            if cut is None:
                break
            parts.append(text[first : cut.start()])
            first = cut.start()
        parts.append(text[first:])
        ids = [self.encoding.encode(p, allowed_special="all") for p in parts]
        return np.array([i for part in ids for i in part], "<u4")


def _letters() -> dict[str, int]:
    from gleanery.llm.bytepairs import LETTERS

    return {c: b for b, c in enumerate(LETTERS)}


@lru_cache(maxsize=2)
def encoder(definition: bytes, pattern: str) -> Encoder:
    return Encoder(definition, pattern)


class Packer:
    """Collects pieces and gives each its sequence."""

    def __init__(self, first_sequence: int, capacity: int, piece: int, group_tokens: int, group_pieces: int):
        self.capacity, self.piece = capacity, piece
        self.group_tokens, self.group_pieces = group_tokens, group_pieces
        self.sequence = first_sequence
        self.ready, self.open, self.size = [], [], 0

    def add(self, key, ids: np.ndarray) -> None:
        total, full = len(ids), len(ids) - len(ids) % self.capacity
        cuts = [*range(0, full, self.capacity), *range(full, total, self.piece), total]
        for a, b in zip(cuts, cuts[1:]):
            row = (key, a, b - a, zlib.crc32(ids[a:b].tobytes()), total)
            if a < full:
                self.ready.append((*row, self.sequence, 0))
                self.sequence += 1
            else:
                self.open.append(row)
                self.size += b - a
        if self.size >= self.group_tokens or len(self.open) >= self.group_pieces:
            self.close()

    def close(self) -> None:
        place = balanced([row[2] for row in self.open], self.capacity)
        used = {}
        for row, window in zip(self.open, place):
            offset = used.get(window, 0)
            self.ready.append((*row, self.sequence + int(window), offset))
            used[window] = offset + row[2]
        self.sequence += int(place.max(initial=-1)) + 1
        self.open, self.size = [], 0

    def take(self) -> list[tuple]:
        rows, self.ready = self.ready, []
        return rows


def pack(
    docs: DataFrame,
    definition: bytes,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 1024,
    piece: int = 128,
    group_tokens: int = 1 << 19,
    group_pieces: int = 1 << 13,
    end_id: int = 0,
) -> DataFrame:
    """One row per piece with its place; ``end_id`` closes every document."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        encode = encoder(shared.value, pattern)
        packer = Packer(TaskContext.get().partitionId() << 40, capacity, piece, group_tokens, group_pieces)

        def rows(found):
            columns = list(zip(*found))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], key_type), *[pa.array(c, pa.int64()) for c in columns[1:]]], NAMES
            )

        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for k, t in zip(batch.column(0), batch.column(1)):
                packer.add(k.as_py(), np.append(encode(t.as_py() or ""), np.uint32(end_id)))
                if len(packer.ready) >= 1 << 14:
                    yield rows(packer.take())
        packer.close()
        if packer.ready:
            yield rows(packer.take())

    return docs.select(key, text).mapInArrow(run, PIECES.format(key=kind))


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
