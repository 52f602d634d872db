import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.llm import bytepairs, counting, packing

ODD = ["", " ", "'s're'LL", "a\x1cb\x85c\xa0d", "\x0b\x0c tab\t", "é ́x Σας", "日本語 テキスト", "😀👍🏽 1234", "<|endoftext|> <|ENDOFTEXT|>x",
       "<|startoftext|>", "x" * 500, "\n\n  x  \n", "a​b", "Don't stop, World!"]


def read(name):
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def mixed(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(ODD + ["the", "ing", "Word ", ", "]) for _ in range(draw.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def words():
    return counting.Counter(read("word_bpe_49k.json")), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_counts_equal_the_library(words):
    counter, library = words
    texts = ODD + mixed(300, 1)
    assert counter.counts(texts) == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("chunk, overlap", [(60, 4), (200, 16), (1000, 64)])
def test_spliced_chunks_equal_the_whole(words, chunk, overlap):
    counter, library = words
    for text in ["".join(mixed(60, seed)) for seed in range(8)] + ["y" * 3000, ""]:
        parts = [int(i) for part in counter.spliced(text, chunk, overlap) for i in part]
        assert parts == library.encode(text, add_special_tokens=False).ids


def test_count_tokens_of_a_table(spark, words):
    rows = [(1, "two words", 7), (1, "two words", 7), (2, None, None), (None, "", 0), (3, "word " * 3000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    found = counting.count_tokens(docs, read("word_bpe_49k.json")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == Counter(
        {(1, 9, 2, False): 2, (2, 0, 0, False): 1, (None, 0, 0, False): 1, (3, 15000, 3000, True): 1}
    )
    assert counting.count_tokens(docs.limit(0), read("word_bpe_49k.json")).count() == 0


def test_byte_pairs_equal_tiktoken(spark):
    ranks = bytepairs.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ODD + mixed(300, 2) + [None]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    pairs = bytepairs.BytePairs(spark, ranks, public_tokenizers.PATTERN)
    for r in pairs.round_trip(docs).collect():
        text = texts[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
    assert pairs.round_trip(docs.limit(0)).count() == 0
    again = docs.select(pairs.decode(pairs.encode(F.col("text"))).alias("b"), F.coalesce("text", F.lit("")).alias("t"))
    assert again.filter("cast(b as string) <> t").count() == 0


def test_long_texts_in_slices(monkeypatch):
    ranks = bytepairs.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    codec = bytepairs.Codec(bytepairs.sentencepiece_model(ranks), public_tokenizers.PATTERN)
    text = "".join(mixed(3000, 3))
    whole = codec.encode([text])
    monkeypatch.setattr(bytepairs, "SLICE", 100)
    assert len(text) > 1 << 18 and codec.encode([text + text * 4])[0][: len(whole[0]) - 400] == whole[0][:-400]
    monkeypatch.setattr(bytepairs, "REMEMBERED", 50)
    assert codec.encode([text]) == whole


def test_differencing_balances():
    draw = random.Random(4)
    for windows in (1, 2, 5, 16):
        sizes = [draw.randrange(1, 129) for _ in range(40 * windows)]
        place = packing.difference(sizes, windows)
        sums = np.bincount(place, sizes, windows)
        assert sums.sum() == sum(sizes) and sums.max() - sums.min() <= 8
    assert packing.balanced([700, 700, 700], 1024).tolist() in ([0, 1, 2], [2, 1, 0], [0, 2, 1], [1, 0, 2], [1, 2, 0], [2, 0, 1])


def test_packing(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = mixed(400, 5) + [None, "", "long words " * 4000] + ODD
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, start string")
    rows = packing.pack(docs.repartition(3), read("byte_bpe_50k.json"), public_tokenizers.PATTERN).toPandas()
    for i, text in enumerate(texts):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        mine = rows[rows.doc_id == i].sort_values("start")
        assert mine.length.sum() == len(ids) and (mine.doc_tokens == len(ids)).all()
        assert (mine.start.to_numpy() == np.r_[0, mine.length.cumsum()[:-1]]).all()
        for start, length, crc in zip(mine.start, mine.length, mine.ids_crc32):
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
    rows = rows.sort_values(["sequence_id", "offset"])
    assert (rows.offset == rows.groupby("sequence_id").length.cumsum() - rows.length).all()
    used = rows.groupby("sequence_id").length.sum()
    assert used.max() <= 1024 and len(used) <= -(-used.sum() // 1024) + 3 * 2
    assert packing.pack(docs.limit(0), read("byte_bpe_50k.json"), public_tokenizers.PATTERN).count() == 0


def test_long_texts_are_cut_where_tokens_end(monkeypatch):
    encode = packing.Encoder(read("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    text = "".join(mixed(500, 6))
    whole = hashlib.sha256(encode(text).tobytes()).digest()
    monkeypatch.setattr(packing, "CALL", 50)
    assert hashlib.sha256(encode(text).tobytes()).digest() == whole


def test_tiny_texts_make_bounded_groups(spark, monkeypatch):
    """Null texts and rows without an id are pieces of one token; groups are cut by pieces."""
    sizes = []
    whole = packing.balanced
    monkeypatch.setattr(packing, "balanced", lambda s, c: sizes.append(len(s)) or whole(s, c))
    packer = packing.Packer(0, 1024, 128, 1 << 19, 1 << 13)
    for i in range(50_000):
        packer.add(i, np.zeros(1, "<u4"))
    packer.close()
    assert max(sizes) <= 1 << 13
    docs = spark.range(120_000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.lit(None).cast("string").alias("text"))
    found = packing.pack(docs, read("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    by_sequence = found.groupBy("sequence_id").agg(
        F.sum("length").alias("used"), F.max(F.col("offset") + F.col("length")).alias("end"), F.countDistinct("offset").alias("places")
    )
    assert by_sequence.filter("used > 1024 or used <> end or used <> places").count() == 0
    assert found.count() == 120_000 and by_sequence.count() < 120_000 / 1024 * 1.2


def test_packing_of_repeated_rows_and_an_empty_table(spark):
    rows = [(1, "same text"), (1, "same text"), (None, "same text")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, length long")
    found = packing.pack(docs, read("byte_bpe_50k.json"), public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), r.start, r.length == r.doc_tokens) for r in found) == [("1", 0, True), ("1", 0, True), ("None", 0, True)]
    assert packing.pack(docs.limit(0), read("byte_bpe_50k.json"), public_tokenizers.PATTERN).count() == 0
