"""The tables of the offline half, one set per dataset, as Parquet.

Layout: ``<root>/<table>/dataset=<name>/``.  Writing replaces one dataset's table
and leaves the others; reading prunes to the one folder.  A table may be laid out by a key,
see ``layout``; the number of buckets is part of its folder's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanery.sources.layout import COMPRESSION, read_clustered, write_by_bucket, write_clustered


class ArtifactStore:
    """``buckets`` is the number of files or folders of tables laid out by a key."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def path(self, table: str, dataset: str) -> str:
        return f"{self.root}/{table}/dataset={dataset}"

    def write(self, table: str, dataset: str, df: DataFrame) -> DataFrame:
        """Write one table and return it as read back from there."""
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(self.path(table, dataset))
        return self.read(table, dataset)

    def read(self, table: str, dataset: str) -> DataFrame:
        """Raises when the table was never written."""
        return self.spark.read.parquet(self.path(table, dataset))

    def write_by_bucket(self, table: str, dataset: str, df: DataFrame, key: str) -> DataFrame:
        """Write one table in folders by bucket of ``key``; ``read`` finds the folders."""
        return write_by_bucket(df, self.path(table, dataset), key, self.buckets)

    def write_clustered(self, table: str, dataset: str, df: DataFrame, key: str) -> DataFrame:
        """Write one table bucketed and sorted by ``key``, which joins on it where it lies."""
        return write_clustered(df, self._clustered(table, dataset), key, self.buckets)

    def read_clustered(self, table: str, dataset: str, key: str) -> DataFrame:
        return read_clustered(self.spark, self._clustered(table, dataset), key, self.buckets)

    def _clustered(self, table: str, dataset: str) -> str:
        return f"{self.path(table, dataset)}/clustered_{self.buckets}"
