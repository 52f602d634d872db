"""Corpora, query sets and judgements by dataset name, and lookups in the corpora."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.joins import rows_if_few
from gleanery.session import input_files, materialise
from gleanery.sources.artifacts import ArtifactStore
from gleanery.sources.layout import bucket_column, bucket_of, wanted_only, without_bucket
from gleanery.sources.textfiles import (
    read_qrels_spaced,
    read_qrels_tsv,
    read_queries_jsonl,
    read_queries_tsv,
)

# The formats of query and judgement files.
QUERY_READERS = {"tsv": read_queries_tsv, "jsonl": read_queries_jsonl}
QREL_READERS = {"spaced": read_qrels_spaced, "tsv": read_qrels_tsv}


class UnknownDataset(KeyError):
    """The catalog has no dataset of this name."""


@dataclass(frozen=True)
class DatasetSpec:
    """Where a dataset lies, and what the columns of its corpus are called.

    Where ids may repeat, the last row of an id wins: the one of the largest value in
    ``order_column``, or with ``last_wins`` the one that comes last in the files.
    """

    name: str
    path: str
    id_column: str = "doc_id"
    text_column: str = "text"
    order_column: str | None = None
    last_wins: bool = False
    queries_path: str | None = None
    queries_format: str = "tsv"
    qrels_path: str | None = None
    qrels_format: str = "spaced"


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet; spread a table of fewer files than cores over all cores.

    Tokenising is costly per row, so a corpus in a few big row groups would leave
    cores idle.  A corpus of many files is read as it lies, without a shuffle.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if input_files(df) < cores else df


class Catalog:
    def __init__(self, spark: SparkSession, specs: list[DatasetSpec]):
        self.spark = spark
        self.specs = {s.name: s for s in specs}
        self.laid_out: dict[str, DataFrame] = {}

    def spec(self, dataset: str) -> DatasetSpec:
        if dataset not in self.specs:
            raise UnknownDataset(dataset)
        return self.specs[dataset]

    def documents(self, dataset: str, spread: bool = False) -> DataFrame:
        """The corpus as ``(doc_id, text)``."""
        spec = self.spec(dataset)
        df = read_spread(self.spark, spec.path) if spread else self.spark.read.parquet(spec.path)
        doc_id, text = F.col(spec.id_column), F.col(spec.text_column)
        if spec.order_column is not None or spec.last_wins:
            df = keep_last(df, spec.id_column, spec.order_column)
        return df.select(doc_id.alias("doc_id"), text.alias("text"))

    def queries(self, dataset: str) -> DataFrame:
        """The query set of a dataset as ``(query_id, query)``."""
        spec = self.spec(dataset)
        return QUERY_READERS[spec.queries_format](self.spark, _given(spec, "queries_path"))

    def qrels(self, dataset: str) -> DataFrame:
        """The judgements of a dataset as ``(query_id, doc_id, relevance)``."""
        spec = self.spec(dataset)
        return QREL_READERS[spec.qrels_format](self.spark, _given(spec, "qrels_path"))

    def lay_out(self, dataset: str, store: ArtifactStore) -> DataFrame:
        """Writes a corpus by bucket of its ids; lookups of few ids then read few files."""
        self.laid_out[dataset] = store.write_by_bucket("corpus", dataset, self.documents(dataset), "doc_id")
        return self.laid_out[dataset]

    def by_id(self, dataset: str) -> DataFrame:
        """The corpus as lookups read it: laid out by id, if that was done."""
        return self.laid_out[dataset] if dataset in self.laid_out else self.documents(dataset)

    def doc_ids(self, dataset: str) -> DataFrame:
        """All ids of a corpus; the texts are not read."""
        return self.documents(dataset).select("doc_id")

    def documents_with_string_ids(self, dataset: str) -> DataFrame:
        return self.documents(dataset).select(F.col("doc_id").cast("string"), "text")

    def content(self, dataset: str, doc_id) -> DataFrame:
        """The text of one document: one row, or none; the id reaches the file scan."""
        corpus = self.by_id(dataset)
        found = bucket_column(corpus)
        if found:
            own = F.lit(doc_id).cast(corpus.schema["doc_id"].dataType)
            corpus = corpus.filter(F.col(found[0]) == bucket_of(own, found[1]))
        return without_bucket(corpus).filter(F.col("doc_id") == F.lit(doc_id)).limit(1)

    def contents(self, dataset: str, ids: DataFrame) -> DataFrame:
        """Texts of many ids as ``(doc_id, text)``; unknown ids are left out.

        Few ids are broadcast to the corpus.  More are shuffled; without repetitions
        no id can be hot.
        """
        wanted = ids.select("doc_id").distinct()
        if rows_if_few(wanted) is not None:
            return wanted_only(self.by_id(dataset), wanted, ["doc_id"])
        return self.documents(dataset).join(wanted, "doc_id", "left_semi")


def _given(spec: DatasetSpec, field: str) -> str:
    path = getattr(spec, field)
    if path is None:
        raise ValueError(f"dataset {spec.name!r} has no {field}")
    return path


def keep_last(df: DataFrame, id_column: str, order_column: str | None) -> DataFrame:
    """Of the rows of each id the last one, of a table that is read from files.

    Which rows win is settled on ids, order and the rows' addresses alone.  The rows that
    lose are taken out by their address: as long as they are few enough to broadcast, no
    other column is shuffled.  Of equal places in the order the later address wins.
    """
    address = df.metadataColumn("_metadata")
    at = F.struct(address["file_path"].alias("file"), address["row_index"].alias("row"))
    order = [F.col(order_column)] if order_column else []
    head = df.select(F.col(id_column).alias("id"), F.struct(*order, at.alias("at")).alias("place"))
    last = head.groupBy("id").agg(F.max("place").alias("last"), F.count("*").alias("n")).filter("n > 1")
    same = head["id"].eqNullSafe(last["id"])
    losers = head.join(last, same).filter("place < last").select("place.at.file", "place.at.row")
    losers = materialise(losers, "not-last")
    if rows_if_few(losers) is not None:
        losers = F.broadcast(losers)
    placed = df.select("*", at.alias("_at"))
    lost = (F.col("_at.file") == losers["file"]) & (F.col("_at.row") == losers["row"])
    return placed.join(losers, lost, "left_anti").drop("_at")
