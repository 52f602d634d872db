"""Exact inner-product search over unit vectors that reads only the groups that can win.

Vectors lie in folders by the pivot nearest to them.  With the angle t between a query and a
pivot, and the largest angle r between the pivot and a vector of its group, no vector of
the group is nearer to the query than t - r.  A look into the groups nearest to the queries
gives each query a floor, its k-th best score or the threshold; groups whose bound is below
the floors of all queries are not read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gleanery.operators.scan import DenseQueries, _as_matrix, measure, search_top_k
from gleanery.session import materialise, share
from gleanery.sources.artifacts import ArtifactStore

# Pivots of a table, at most: their vectors travel to every task.
PIVOTS = 256

# What float vectors and rounded scores may be off by.
SLACK = 1e-5


def write_groups(
    store: ArtifactStore, table: str, dataset: str, vectors: DataFrame, keys: list[str], pivots: int = PIVOTS
) -> None:
    """Writes ``table``, the vectors in folders by group, and ``<table>_pivots``.

    The pivots are vectors of the table, drawn by a hash of their ``keys``.  Their table has
    ``(grp, pivot, n, least)``: the size of a group and its least product with the pivot.
    """
    drawn = vectors.select("embedding").orderBy(F.xxhash64(*keys), *keys).limit(pivots).toArrow()
    matrix = _as_matrix(drawn["embedding"].combine_chunks())
    shared = share(vectors.sparkSession, matrix)

    @F.arrow_udf("struct<grp: int, near: double>")
    def nearest(rows: pa.Array) -> pa.Array:
        products = _as_matrix(rows) @ shared.value.T if len(rows) else np.zeros((0, 1))
        at = products.argmax(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(at, pa.int32()), pa.array(products[np.arange(len(at)), at])], ["grp", "near"]
        )

    placed = vectors.select(*keys, "embedding", nearest("embedding").alias("_at")).select(*keys, "embedding", "_at.*")
    # a large group is dealt to several tasks, each with a file of its own
    dealt = placed.hint("rebalance", F.col("grp"))
    dealt.write.mode("overwrite").partitionBy("grp").parquet(store.path(table, dataset))
    sizes = store.read(table, dataset).groupBy("grp").agg(F.count("*").alias("n"), F.min("near").alias("least"))
    kind = T.StructType().add("grp", T.IntegerType()).add("pivot", T.ArrayType(T.DoubleType()))
    rows = pa.table({"grp": pa.array(range(len(matrix)), pa.int32()), "pivot": pa.array(matrix.tolist())})
    known = vectors.sparkSession.createDataFrame(rows.cast(to_arrow_schema(kind)), kind)
    store.write(f"{table}_pivots", dataset, known.join(sizes, "grp"))


def group_bounds(queries: DataFrame, pivots: DataFrame) -> DataFrame:
    """``(query_id, grp, n, near, bound)``: the largest score that a group can give a query."""
    known = pivots.orderBy("grp").toArrow()  # PIVOTS at most
    groups, sizes = known["grp"].combine_chunks(), known["n"].combine_chunks()
    radius = np.arccos(np.clip(known["least"].to_numpy(), -1, 1))
    shared = share(queries.sparkSession, _as_matrix(known["pivot"].combine_chunks()))
    kind = queries.schema["query_id"].dataType.simpleString()

    def bounds(batches):
        for batch in batches:
            if not batch.num_rows or not len(groups):
                continue
            products = _as_matrix(batch.column(1)) @ shared.value.T
            angle = np.arccos(np.clip(products, -1, 1))
            bound = np.cos(np.maximum(angle - radius, 0)) + SLACK
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(n), len(groups)))),
                    pa.chunked_array([groups] * n).combine_chunks(),
                    pa.chunked_array([sizes] * n).combine_chunks(),
                    pa.array(products.ravel()),
                    pa.array(bound.ravel()),
                ],
                ["query_id", "grp", "n", "near", "bound"],
            )

    schema = f"query_id {kind}, grp int, n long, near double, bound double"
    return queries.select("query_id", "query_vector").mapInArrow(bounds, schema)


def grouped_search(
    queries: DataFrame,
    vectors: DataFrame,
    pivots: DataFrame,
    keys: list[str],
    top_k: int,
    threshold: float | None = None,
    digits: int | None = 6,
) -> tuple[DataFrame, int | None]:
    """The best rows of each query that reach the threshold, as a scan of all gives them.

    ``queries`` has unit vectors; ``vectors`` and ``pivots`` were written by ``write_groups``.
    """
    search = partial(
        search_top_k,
        loader=partial(DenseQueries, scaled=False),
        k=top_k,
        keep=keys,
        ties=keys,
        size=measure(queries, F.size("query_vector")),
        digits=digits,
    )

    def of_groups(groups: list[int]) -> DataFrame:
        return vectors.filter(F.col("grp").isin(groups)).select(*keys, "embedding")

    bounds = materialise(group_bounds(queries, pivots), "bounds")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("near"), "grp")
    before = F.coalesce(F.sum("n").over(nearest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = bounds.withColumn("before", before).filter(F.col("before") < top_k).select("grp").distinct()
    seen, _ = search(queries, of_groups([r["grp"] for r in first.collect()]))
    floors = seen.filter(F.col("rank") == top_k).select("query_id", F.col("score").alias("kth"))
    floor = F.coalesce(F.greatest("kth", F.lit(threshold).cast("double")), F.lit(-2.0))
    able = bounds.join(floors, "query_id", "left").filter(F.col("bound") >= floor)
    hits, max_rows = search(queries, of_groups([r["grp"] for r in able.select("grp").distinct().collect()]))
    if threshold is not None:
        hits = hits.filter(F.col("score") >= threshold)
    return hits, max_rows
