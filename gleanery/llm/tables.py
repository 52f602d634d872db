"""Intermediate tables of one operator in the shared folder, and components of links."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.session import delete_folder, leave_folder, shared_folder


SETTLE = 1.5


class Scratch:
    """Writes intermediate tables and deletes those that are not needed any more.

    A written table cuts lineage, survives lost executors and is read column by column.
    The folder goes with the scope it was opened in, if there is one.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self.n = 0
        leave_folder(spark, self.folder)

    def write(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{name}-{self.n}"
        df.write.parquet(path, partitionBy=partition_by)
        table = self.spark.read.schema(df.schema).parquet(path)
        table.scratch_path = path
        return table

    def release(self, *tables: DataFrame, settle: bool = False) -> None:
        """Deletes tables, and lets Spark delete the shuffle files of finished queries.

        Spark's cleaner removes them once the driver's garbage is collected, which by
        itself happens long after they have filled the disks.  What Python has dropped is
        reported to the JVM within ``SETTLE`` seconds only; ``settle`` waits for that, and
        collects twice, as what one collection frees may hold the last reference to a shuffle.
        """
        gc.collect()
        for _ in range(2 if settle else 0):
            time.sleep(SETTLE)
            self.spark._jvm.System.gc()
        if not settle:
            self.spark._jvm.System.gc()
        for table in tables:
            delete_folder(self.spark, table.scratch_path)


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node that has a link ``(a, b)``; the smallest node
    names its component.

    Alternates two rounds until nothing changes: every node ties its larger neighbours to
    its smallest one, then its smaller neighbours.  A node with many links is aggregated
    before the shuffle, and the joins on it can be split.
    """
    links = scratch.write(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(),
        "links",
    )
    state = None
    while True:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        done = links
        links = scratch.write(small.filter("u != v").distinct(), "links")
        scratch.release(done)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
