"""The offline half over a folder of fixture tables, built once per session."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.cleaning import Lemmas
from gleanery.operators.encoders import HashEncoder
from gleanery.plans.engine import (
    Engine,
    build_chunk_groups,
    build_chunks,
    build_embeddings,
    build_postings,
    build_snippets,
    build_sparse,
)
from gleanery.session import shared_folder
from gleanery.sources.artifacts import ArtifactStore
from gleanery.sources.catalog import Catalog, DatasetSpec, read_spread
from gleanery.sources.layout import without_bucket

_OPEN: dict[tuple[str, str], Workbench] = {}


class Workbench:
    """Two datasets, the query set, and lazily the tables built from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        root = f"{shared_folder(spark)}/workbench-{uuid.uuid4().hex}"
        self.text_folder = f"{root}/text"
        self.catalog = Catalog(
            spark,
            [
                DatasetSpec(
                    "documents",
                    f"{folder}/documents.parquet",
                    queries_path=f"{self.text_folder}/queries.txt",
                    qrels_path=f"{self.text_folder}/qrels.txt",
                ),
                DatasetSpec(
                    "benchmark",
                    f"{folder}/benchmark.parquet",
                    id_column="item_id",
                    queries_path=f"{self.text_folder}/queries.jsonl",
                    queries_format="jsonl",
                    qrels_path=f"{self.text_folder}/test.tsv",
                    qrels_format="tsv",
                ),
                DatasetSpec(
                    "turns", f"{folder}/conversations.parquet", id_column="conv_id", order_column="turn"
                ),
            ],
        )
        self.encoder = HashEncoder()
        self.store = ArtifactStore(spark, root, buckets=16)

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Workbench:
        key = (spark.sparkContext.applicationId, folder)
        if key not in _OPEN:
            _OPEN[key] = cls(spark, folder)
        return _OPEN[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def docs(self) -> DataFrame:
        return self.catalog.documents("documents")

    @property
    def spread_docs(self) -> DataFrame:
        """Once the corpus is laid out its files are many: no text is shuffled to spread it."""
        if "corpus" in vars(self):
            return without_bucket(self.corpus)
        return self.catalog.documents("documents", spread=True)

    @cached_property
    def queries(self) -> DataFrame:
        asked = self.table("benchmark")
        return asked.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))

    @cached_property
    def given_vectors(self) -> DataFrame:
        vectors = read_spread(self.spark, f"{self.folder}/embeddings.parquet")
        return vectors.select(F.col("vec_id").alias("doc_id"), "embedding")

    @cached_property
    def given_query_vectors(self) -> DataFrame:
        vectors = self.table("embeddings").select(
            F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")
        )
        return vectors.join(self.queries.select("query_id"), "query_id", "left_semi")

    @cached_property
    def sparse(self) -> ArtifactStore:
        build_sparse(self.store, "documents", self.spread_docs)
        return self.store

    @cached_property
    def snippets(self) -> DataFrame:
        build_snippets(self.store, "documents", self.docs)
        return self.store.read("snippets", "documents")

    @cached_property
    def corpus(self) -> DataFrame:
        return self.catalog.lay_out("documents", self.store)

    @cached_property
    def text_files(self) -> Catalog:
        """The catalog, once query and judgement files of its datasets are written.

        Each set has proper lines, lines to skip, and lines that repeat an id further down.
        """
        number, text = F.col("item_id"), F.trim(F.regexp_replace("text", r"[\x00-\x20]+", " "))
        asked = self.table("benchmark").select(number, text.alias("text"))
        judged = self.table("labels").select("doc_id", "quality", "toxic")

        def lines(source, *made):
            """One line for each expression and row that has it, those of an expression together."""
            line = F.posexplode(F.array(*made)).alias("pass", "value")
            return source.select(line, F.monotonically_increasing_id().alias("row")).filter("value is not null")

        def written(name, rows):
            rows.repartitionByRange(4, "pass", "row").sortWithinPartitions("pass", "row").select(
                "value"
            ).write.text(f"{self.text_folder}/{name}")

        written("queries.txt", lines(
            asked,
            F.concat_ws("\t", number, text),
            F.when(number % 5 == 0, F.concat(F.lit("no tab in line "), number)),
            F.when(number % 3 == 0, F.concat(F.lit("  "), number, F.lit("\tagain\t"), number, F.lit("  "))),
        ))
        keyed = F.struct(number.alias("_id"), text.alias("text"), F.lit(1).alias("more"))
        written("queries.jsonl", lines(
            asked,
            F.to_json(keyed),
            F.when(number % 4 == 0, F.concat(F.lit('{"_id": '), number, F.lit(", bad"))),
            F.when(number % 4 == 1, F.concat(F.lit('{"_id": '), number, F.lit("}"))),
            F.when(number % 3 == 0, F.concat(F.lit('{"_id": "'), number, F.lit('", "text": "again"}'))),
        ))
        topic, doc = (F.col("doc_id") % 7).cast("string"), F.col("doc_id").cast("string")
        written("qrels.txt", lines(
            judged,
            F.concat_ws(" ", topic, F.lit("Q0"), doc, "quality"),
            F.when(F.col("doc_id") % 5 == 0, F.concat_ws(" ", topic, F.lit("Q0"), doc, F.lit("high"))),
            F.when(F.col("doc_id") % 5 == 1, F.concat_ws(" ", topic, F.lit(""), F.lit("Q0"), F.concat(F.lit("d"), doc), F.lit("9"))),
            F.when(F.col("doc_id") % 3 == 0, F.concat_ws(" ", topic, F.lit("Q0"), doc, F.lit("4"), F.lit("more"))),
        ))
        rows = judged.select(
            F.concat_ws("\t", topic, doc, "toxic").alias("value"),
            F.when(F.col("doc_id") % 5 == 0, F.concat_ws("\t", topic, doc)).alias("short"),
            F.when(F.col("doc_id") % 3 == 0, F.concat_ws("\t", topic, doc, F.lit("-2"))).alias("again"),
        )
        # every file begins with a header
        told = lines(rows, F.col("value"), F.col("short"), F.col("again"))
        told = told.repartitionByRange(4, "pass", "row").withColumn("file", F.spark_partition_id())
        header = self.spark.range(4).select(
            F.col("id").cast("int").alias("file"), F.lit(-1).alias("pass"), F.lit(0).cast("long").alias("row"),
            F.lit("query-id\tcorpus-id\t7").alias("value"),
        )
        every = told.select("file", "pass", "row", "value").union(header)
        every = every.repartitionByRange(4, "file").sortWithinPartitions("file", "pass", "row")
        every.select("value").write.text(f"{self.text_folder}/test.tsv")
        return self.catalog

    @cached_property
    def chunks(self) -> DataFrame:
        build_chunks(self.store, "documents", self.spread_docs, self.encoder)
        return self.store.read_clustered("chunks", "documents", "doc_id")

    @cached_property
    def chunk_texts(self) -> DataFrame:
        assert self.chunks is not None  # written together
        return self.store.read("chunk_texts", "documents")

    @cached_property
    def embeddings(self) -> DataFrame:
        build_embeddings(self.store, "documents", self.spread_docs, self.encoder)
        return self.store.read_clustered("embeddings", "documents", "doc_id")

    @cached_property
    def lemmas(self) -> Lemmas:
        return Lemmas(self.sparse.read("lemmas", "documents"))

    @cached_property
    def bag(self) -> DataFrame:
        return self.sparse.read("bag", "documents")

    @cached_property
    def term_stats(self) -> DataFrame:
        return self.sparse.read("term_stats", "documents")

    @cached_property
    def doc_vectors(self) -> DataFrame:
        return self.sparse.read("doc_vectors", "documents")

    @cached_property
    def chunk_groups(self) -> DataFrame:
        assert self.chunks is not None  # written before
        build_chunk_groups(self.store, "documents")
        return self.store.read("chunk_groups", "documents")

    @cached_property
    def postings(self) -> DataFrame:
        build_postings(self.sparse, "documents")
        return self.store.read("postings", "documents")

    @cached_property
    def first_ids(self) -> DataFrame:
        assert self.postings is not None  # written together
        return self.store.read("first_ids", "documents")

    @cached_property
    def given_engine(self) -> Engine:
        """Document and query vectors as they are in the tables."""
        return Engine(
            self.corpus,
            self.snippets,
            self.lemmas,
            self.term_stats,
            self.doc_vectors,
            self.given_vectors,
            self.chunks,
            self.encoder,
            self.given_query_vectors,
            chunk_texts=self.chunk_texts,
        )

    @cached_property
    def engine(self) -> Engine:
        """All vectors made by the encoder, as for requests of any text."""
        return Engine(
            self.corpus,
            self.snippets,
            self.lemmas,
            self.term_stats,
            self.doc_vectors,
            self.embeddings,
            self.chunks,
            self.encoder,
            chunk_texts=self.chunk_texts,
        )

    @cached_property
    def grouped_engine(self) -> Engine:
        """The same, with chunk vectors by nearness."""
        groups = self.chunk_groups
        pivots = self.store.read("chunk_groups_pivots", "documents")
        return replace(self.engine, chunk_groups=groups, chunk_pivots=pivots)

    @cached_property
    def posting_engine(self) -> Engine:
        """Given vectors, with term blocks."""
        return replace(self.given_engine, postings=self.postings, first_ids=self.first_ids)
