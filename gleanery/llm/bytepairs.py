"""Byte-level BPE encoding and decoding through a sentencepiece model made of the ranks.

Every byte is mapped to a printable character; the pieces of the model are the mapped
tokens, scored by their negative rank, with identity normalisation.  Texts are split into
pre-tokens, each is encoded by itself, and ids are decoded by the inverse mapping.

Defined results: a null text counts as empty and has no ids; repeated rows are encoded
alike; columns named like a result are replaced.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pre-tokens that are encoded together, and how many a worker remembers.
SLICE, REMEMBERED = 1 << 18, 400_000


def byte_letters() -> str:
    """256 different characters, none of them white space or a control character."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in printable else chr(next(rest)) for b in range(256))


LETTERS = byte_letters()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised BPE model whose ids are the ranks, with the unknown piece after them."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    by_rank = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    for token, rank in by_rank:
        piece = model.pieces.add()
        piece.piece, piece.score = "".join(LETTERS[b] for b in token), -float(rank)
        piece.type = pb.ModelProto.SentencePiece.NORMAL
    unknown = model.pieces.add()
    unknown.piece, unknown.score, unknown.type = "<unk>", 0.0, pb.ModelProto.SentencePiece.UNKNOWN
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(by_rank)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes and decodes with a serialised model; remembers pre-tokens it has seen."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        # white space as Unicode has it, not as Python does
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.letters = {b: c for b, c in enumerate(LETTERS)}
        back = {c: b for b, c in self.letters.items()}
        tokens = [
            bytes(back[c] for c in self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size() - 1)
        ]
        self.vocabulary = {t: i for i, t in enumerate(tokens)}
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.r_[0, np.cumsum(self.sizes)[:-1]]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.forget()

    def forget(self):
        self.known: dict[str, int] = {}
        self.at: list[int] = [0]
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, unseen: list[str]):
        """Ids of new pre-tokens; one that is a token itself is that token."""
        as_bytes = [t.encode("utf-8") for t in unseen]
        found = [[self.vocabulary[b]] if b in self.vocabulary else None for b in as_bytes]
        open_ = [i for i, ids in enumerate(found) if ids is None]
        mapped = [as_bytes[i].decode("latin-1").translate(self.letters) for i in open_]
        for i, ids in zip(open_, self.pieces.encode(mapped, num_threads=1) if mapped else []):
            found[i] = ids
        self.known.update(zip(unseen, range(len(self.known), len(self.known) + len(unseen))))
        ends = np.cumsum([len(ids) for ids in found]) + self.at[-1]
        self.at.extend(ends.tolist())
        self.ids = np.concatenate([self.ids, np.array([i for ids in found for i in ids], np.uint32)])

    def _encode(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens, and how many each has."""
        if len(self.known) > REMEMBERED:
            self.forget()
        unseen = list(set(tokens) - self.known.keys())
        if unseen:
            self._learn(unseen)
        index = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        at = np.array(self.at, np.int64)
        first, n = at[index], at[index + 1] - at[index]
        total = np.cumsum(n)
        place = np.arange(total[-1] if len(total) else 0) + np.repeat(first - (total - n), n)
        return self.ids[place], n

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out, group, tokens, sizes = [b""] * len(texts), [], [], []

        def flush():
            ids, n = self._encode(tokens)
            ends = np.r_[0, np.cumsum(n)][np.cumsum(sizes, dtype=np.int64)]
            for i, a, b in zip(group, np.r_[0, ends[:-1]], ends):
                out[i] = ids[a:b].tobytes()
            group.clear(), tokens.clear(), sizes.clear()

        for i, text in enumerate(texts):
            if len(text) > 1 << 20:  # in slices, so that its pre-tokens are never all in memory
                matches = (m.group() for m in self.split.finditer(text))
                parts = iter(lambda: list(islice(matches, SLICE)), [])
                out[i] = b"".join(self._encode(part)[0].tobytes() for part in parts)
                continue
            found = self.split.findall(text)
            group.append(i), tokens.extend(found), sizes.append(len(found))
            if len(tokens) >= SLICE:
                flush()
        if group:
            flush()
        return out

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4")
        out = []
        for i in range(0, len(ids), SLICE):
            part = ids[i : i + SLICE]
            n = self.sizes[part]
            place = np.arange(n.sum()) + np.repeat(self.starts[part] - (np.cumsum(n) - n), n)
            out.append(self.bytes[place].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def codec(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


class BytePairs:
    """Column functions over one vocabulary; the model, bounded by it, goes to every worker."""

    def __init__(self, spark, ranks: dict[bytes, int], pattern: str):
        self.model = spark.sparkContext.broadcast(sentencepiece_model(ranks))
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """Packed ids, four bytes each."""
        model, pattern = self.model, self.pattern

        @F.arrow_udf("binary")
        def ids(texts: pa.Array) -> pa.Array:
            return pa.array(codec(model.value, pattern).encode(texts.to_pylist()), pa.binary())

        return ids(F.coalesce(text, F.lit("")))

    def decode(self, packed: Column) -> Column:
        """The bytes that packed ids stand for; null for null."""
        model, pattern = self.model, self.pattern

        @F.arrow_udf("binary")
        def decoded(packed: pa.Array) -> pa.Array:
            known = codec(model.value, pattern)
            return pa.array([None if p is None else known.decode(p) for p in packed.to_pylist()], pa.binary())

        return decoded(packed)

    def round_trip(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Adds ``ids`` (packed) and ``decoded``, the bytes decoded from these ids."""
        model, pattern = self.model, self.pattern

        @F.arrow_udf("struct<ids: binary, decoded: binary>")
        def both(texts: pa.Array) -> pa.Array:
            known = codec(model.value, pattern)
            ids = known.encode(texts.to_pylist())
            return pa.StructArray.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(map(known.decode, ids), pa.binary())], ["ids", "decoded"]
            )

        coded = docs.drop("ids", "decoded").withColumn("_coded", both(F.coalesce(F.col(text), F.lit(""))))
        return coded.withColumns({"ids": F.col("_coded.ids"), "decoded": F.col("_coded.decoded")}).drop("_coded")
