"""Postings travel once, and what is laid out by few buckets does not travel at all."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.operators import postings, sparse
from gleanery.operators.sparse import bag_of_words, document_vectors, document_weights, term_statistics
from gleanery.plans.engine import build_postings
from gleanery.sources.artifacts import ArtifactStore
from gleanery.sources.layout import write_by_bucket

WORDS = ["red", "äpfel", "pear", "wine", "pie", "grün", "cheese", "東京"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows = [(i % 90, " ".join(rng.choices(WORDS, k=rng.randint(0, 6)) + [f"x{chr(97 + i % 26)}é"])) for i in range(100)]
    return spark.createDataFrame([*rows, (None, "red pie"), (7, ""), (8, None)], "doc_id LONG, text STRING").repartition(3)


@pytest.fixture(scope="module")
def model(corpus):
    bag = bag_of_words(corpus)
    return bag, term_statistics(bag, 103)


def entries(df):
    return Counter((r["doc_id"], r["term"], float(np.float32(r["weight"]))) for r in df.collect())


@pytest.mark.parametrize("slot, pack, buckets", [(500_000, 4_000_000, 2), (20, 30, 4), (1, 1, 3)])
def test_blocks_are_made_in_one_shuffle(model, monkeypatch, slot, pack, buckets):
    bag, stats = model
    vectors = document_vectors(bag, stats)
    monkeypatch.setattr(postings, "SLOT_ENTRIES", slot)
    monkeypatch.setattr(postings, "PACK_ENTRIES", pack)
    blocks = postings.term_blocks(vectors, stats, 8, buckets)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "collect_list" not in plan  # no sorting of single entries
    got = blocks.collect()
    assert len({(r["term"], r["level"], r["part"]) for r in got}) == len(got)
    assert max(r["part"] for r in got) > 0 and all(r["n"] == len(r["doc_ids"]) == len(r["weights"]) for r in got)
    pairs = blocks.select("term", F.explode(F.arrays_zip("doc_ids", "weights")).alias("e"))
    pairs = pairs.select("term", F.col("e.doc_ids").alias("doc_id"), F.col("e.weights").alias("weight"))
    want = [(r["doc_id"], r["term"], r["weight"]) for r in document_weights(vectors).collect()]
    assert Counter((d, t) for d, t, _ in want) == Counter((r["doc_id"], r["term"]) for r in pairs.collect())
    up = Counter((d, t, float(postings._rounded_up(np.array([w]))[0])) for d, t, w in want)
    assert up == entries(pairs)
    assert all(w <= postings._rounded_up(np.array([w]))[0] <= w * (1 + 2.0**-23) for *_, w in want)


def test_rows_of_few_buckets_are_written_where_they_are(spark, tmp_path):
    rows = spark.range(0, 400, 1, 4).select(F.col("id").alias("doc_id"), F.spark_partition_id().alias("part"))
    table = write_by_bucket(rows, f"{tmp_path}/few", "doc_id", 8)
    files = table.groupBy(F.input_file_name()).agg(F.count_distinct("part").alias("n"), F.count_distinct("bucket_8").alias("b"))
    assert {(r["n"], r["b"]) for r in files.collect()} == {(1, 1)}
    assert sorted(r["doc_id"] for r in table.collect()) == list(range(400))
    many = write_by_bucket(rows, f"{tmp_path}/many", "doc_id", 65)
    assert many.select("bucket_65").distinct().count() == many.select(F.input_file_name()).distinct().count()


def test_postings_keep_to_their_buckets(spark, model, tmp_path, monkeypatch):
    bag, stats = model
    monkeypatch.setattr(postings, "SLOT_ENTRIES", 10)
    store = ArtifactStore(spark, str(tmp_path), buckets=4)
    store.write("term_stats", "x", stats)
    store.write_by_bucket("doc_vectors", "x", document_vectors(bag, stats), "doc_id")
    build_postings(store, "x")
    blocks = store.read("postings", "x")
    assert blocks.agg(F.sum("n")).first()[0] == stats.agg(F.sum("df")).first()[0]
    slots = 4 * max(1, -(-stats.agg(F.sum("df")).first()[0] // 40))
    assert blocks.select(F.input_file_name()).distinct().count() <= slots  # not a file for each bucket and task


@pytest.mark.parametrize("keys", [0, 3])
def test_terms_that_travel_as_one_string(model, monkeypatch, keys):
    bag, stats = model
    want = Counter((r["doc_id"], tuple(r["terms"]), tuple(r["weights"])) for r in document_vectors(bag, stats).collect())
    monkeypatch.setattr(sparse, "FREQUENT_KEYS", keys)
    rare = document_vectors(bag, stats)
    assert "array_join" in rare._jdf.queryExecution().executedPlan().toString()
    assert Counter((r["doc_id"], tuple(r["terms"]), tuple(r["weights"])) for r in rare.collect()) == want
