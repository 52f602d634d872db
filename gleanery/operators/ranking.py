"""Ranking shared by all retrieval operators, and the texts of the winners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.text import snippet
from gleanery.operators.joins import look_up
from gleanery.sources.layout import bucket_names

# Parts of a query that are ranked by themselves before the whole query is.
ROUND_ONE_PARTS = 32


def top_ranked(
    df: DataFrame, k: int, order: list[Column], by: str = "query_id", two_rounds: bool = False
) -> DataFrame:
    """The first ``k`` rows of each query in ``order``, numbered in ``rank``.

    Every map task may hand in ``k`` rows per query.  Where there are many tasks
    (``two_rounds``) these are first ranked within parts of a query, so that no
    task sorts them all.
    """
    if two_rounds:
        parts = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(ROUND_ONE_PARTS)))
        within = Window.partitionBy(by, "_part").orderBy(*order)
        df = parts.withColumn("_rank", F.row_number().over(within)).filter(F.col("_rank") <= k)
        df = df.drop("_part", "_rank")
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def best_first(*ties: str) -> list[Column]:
    """Highest score first; equal scores in the order of ``ties``."""
    return [F.desc("score"), *[F.asc(t) for t in ties]]


def snippet_table(corpus: DataFrame) -> DataFrame:
    """The snippet of every document: ``(doc_id, snippet)``."""
    return corpus.select("doc_id", snippet(F.col("text")).alias("snippet"))


def with_snippets(hits: DataFrame, snippets: DataFrame, max_rows: int | None) -> DataFrame:
    """Attach the snippet of each hit; a hit without a document gets an empty one."""
    return look_up(hits, snippets, "doc_id", max_rows).withColumn(
        "snippet", F.coalesce("snippet", F.lit(""))
    )


def with_texts(hits: DataFrame, corpus: DataFrame, max_rows: int | None, default: str) -> DataFrame:
    """Attach the whole text of each hit, or ``default`` where there is no document."""
    texts = corpus.select("doc_id", "text", *bucket_names(corpus))
    return look_up(hits, texts, "doc_id", max_rows).withColumn(
        "text", F.coalesce("text", F.lit(default))
    )
