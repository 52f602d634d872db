"""Token counts of whole texts with overlap resynchronisation for huge ones.

A huge text is encoded in overlapping chunks with character offsets.  Two neighbouring
chunks are spliced at a position where both begin a word: the splitting into words reads
forward only, so from a common beginning of a word both go on alike, as far as the
earlier chunk's cut end is not involved.  Without such a position the overlap doubles.

In texts that need no chunks every run of ASCII white space is such a position, for no
token reaches over it.  So the words between are encoded once each and remembered.

Defined results: a null text counts as empty and has no tokens; repeated rows are counted
alike; columns named like a result are replaced.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK, OVERLAP = 1 << 15, 256
#: Characters that are encoded in one call of the library, and words that are remembered.
CALL, REMEMBERED = 1 << 20, 1_000_000
#: Words that are encoded in one call.
TOGETHER = 512


class Counter:
    """A tokenizer of words with ends, from the bytes of its file."""

    def __init__(self, definition: bytes, word_end: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = i in added or token.endswith(word_end)
        self.known: dict[bytes, int] = {}
        # a special string counts in its own case only, so text near one keeps its case
        self.special = {t.content[:2].encode("utf-8") for t in added.values()}
        self.lowers = self.tokenizer.normalizer is not None and all(
            self.tokenizer.normalizer.normalize_str(c) == c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        )

    def counts(self, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
        out, group, size = [0] * len(texts), [], 0
        for i, text in enumerate(texts):
            if len(text) > 2 * chunk:
                out[i] = sum(len(ids) for ids in self.spliced(text, chunk, overlap))
                continue
            group.append(i)
            size += len(text)
            if size >= CALL:
                self._whole(texts, group, out)
                group, size = [], 0
        self._whole(texts, group, out)
        return out

    def _whole(self, texts, group, out):
        split = [self._words(texts[i].encode("utf-8")) for i in group]
        if len(self.known) > REMEMBERED:
            self.known = {}
        unseen = list(set().union(*split) - self.known.keys())
        for i in range(0, len(unseen), TOGETHER):
            self._learn(unseen[i : i + TOGETHER])
        for i, pieces in zip(group, split):
            out[i] = sum(map(self.known.__getitem__, pieces))

    def _words(self, text: bytes) -> list[bytes]:
        """Words in lower case, as the normaliser has them; special strings keep theirs."""
        lower = self.lowers and not any(s in text for s in self.special)
        return (text.lower() if lower else text).split()

    def _learn(self, unseen: list[bytes]):
        """Counts of new words, encoded as one text; offsets tell whose a token is."""
        words = [w.decode("utf-8") for w in unseen]
        starts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
        offsets = self.tokenizer.encode(" ".join(words), add_special_tokens=False).offsets
        owner = np.searchsorted(starts, np.array([o[0] for o in offsets], np.int64), "right") - 1
        self.known.update(zip(unseen, np.bincount(owner, minlength=len(words)).tolist()))

    def _encode(self, text: str, first: int, last: int):
        """Ids, beginnings of words and their absolute offsets of one chunk."""
        encoding = self.tokenizer.encode(text[first:last], add_special_tokens=False)
        ids = np.array(encoding.ids, np.int64)
        starts = np.array([o[0] for o in encoding.offsets], np.int64) + first
        stops = np.array([o[1] for o in encoding.offsets], np.int64) + first
        begins = np.r_[True, self.ends[ids[:-1]]] if len(ids) else np.zeros(0, bool)
        return ids, starts, stops, begins

    def spliced(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        """Yields the ids of ``text`` in parts, equal to those of one whole encoding."""
        first, last = 0, min(chunk, len(text))
        here = self._encode(text, first, last)
        done = 0  # tokens of this chunk that belong to an earlier part
        while last < len(text):
            reach, place = overlap, None
            while place is None:
                start, end = max(first, last - reach), min(len(text), last + max(chunk, reach))
                there = self._encode(text, start, end)
                place = self._common(here, there, done, last)
                if place is None and start == first:
                    # the whole chunk has no stable position: encode both as one
                    here, last, place = self._encode(text, first, end), end, ()
                reach *= 2
            if place:
                yield here[0][done : place[0]]
                here, first, last, done = there, start, end, place[1]
        yield here[0][done:]

    def _common(self, here, there, done, cut):
        """The last word beginning that both chunks share, away from either cut.

        In the earlier chunk the word, and one more after it, must be whole before the cut;
        in the later chunk it must not be the first word, which may have lost its start.
        """
        at_here, at_there = np.flatnonzero(here[3]), np.flatnonzero(there[3])[1:]
        at_here = at_here[(at_here > done) & (here[2][at_here] < cut)][:-2]
        if not len(at_here) or not len(at_there):
            return None
        common, a, b = np.intersect1d(here[1][at_here], there[1][at_there], return_indices=True)
        if not len(common):
            return None
        return int(at_here[a[-1]]), int(at_there[b[-1]])


@lru_cache(maxsize=2)
def counter(definition: bytes) -> Counter:
    return Counter(definition)


def count_tokens(docs: DataFrame, definition: bytes, text: str = "text", limit: int = 2048) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit``; ``definition`` holds a tokenizer file."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    @F.arrow_udf("long")
    def tokens(texts: pa.Array) -> pa.Array:
        repeated = texts.dictionary_encode()
        n = counter(shared.value).counts(repeated.dictionary.to_pylist())
        return pa.array(n, pa.int64()).take(repeated.indices)

    whole = F.coalesce(F.col(text), F.lit(""))
    counted = docs.drop("n_bytes", "n_tokens", "over_limit").withColumn("n_tokens", tokens(whole))
    return counted.withColumns(
        {"n_bytes": F.octet_length(whole).cast("long"), "over_limit": F.col("n_tokens") > limit}
    )
