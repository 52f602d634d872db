"""Tables laid out by key, so that a reader of few keys reads few files.

By bucket: one folder for each value of ``bucket_<n>``, a hash of the key modulo n.  The
column's name tells n, so that whoever joins such a table can give its own rows the same
column; Spark then prunes folders by the keys it finds (dynamic partition pruning).

Clustered: a bucketed, sorted Spark table, which joins and groups by its key where it lies.
"""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = re.compile(r"bucket_(\d+)")

#: Rows that a bucket holds where its number is left open, and the most buckets there are.
ROWS_PER_BUCKET = 20_000
MAX_BUCKETS = 8192

#: Up to so many buckets no row is shuffled: tasks write a file of their own for each bucket.
OWN_FILES = 32

#: Of words, texts and weights it leaves about two thirds of what the default does.
COMPRESSION = "zstd"


def bucket_count(rows: int) -> int:
    return max(1, min(MAX_BUCKETS, math.ceil(rows / ROWS_PER_BUCKET)))


def bucket_column(table: DataFrame) -> tuple[str, int] | None:
    """Name of the bucket column and number of buckets, if the table has them."""
    for name in table.columns:
        if found := BUCKET.fullmatch(name):
            return name, int(found[1])
    return None


def bucket_names(table: DataFrame) -> list[str]:
    """The bucket column, if there is one, to select beside other columns."""
    found = bucket_column(table)
    return [found[0]] if found else []


def bucket_of(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def without_bucket(table: DataFrame) -> DataFrame:
    found = bucket_column(table)
    return table.drop(found[0]) if found else table


def write_by_bucket(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Writes ``df`` in folders by bucket of ``key``, sorted by it within a file.

    Rows of few buckets are written where they are; of many, a bucket of many rows is dealt
    to several tasks.  Either way each task has a file of its own for a bucket.
    """
    name = f"bucket_{buckets}"
    dealt = df.withColumn(name, bucket_of(F.col(key), buckets))
    if buckets > OWN_FILES:
        dealt = dealt.hint("rebalance", F.col(name))
    writer = dealt.sortWithinPartitions(name, key).write.mode("overwrite").option("compression", COMPRESSION)
    writer.partitionBy(name).parquet(path)
    return read_by_bucket(df.sparkSession, path, df.schema, buckets)


def read_by_bucket(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> DataFrame:
    return spark.read.schema(T.StructType(list(schema.fields)).add(f"bucket_{buckets}", T.IntegerType())).parquet(path)


def wanted_only(table: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``table`` with one of the few ``wanted`` keys, which are broadcast.

    Of a table in buckets only those of the wanted keys are read.
    """
    wanted, on = wanted.select(*keys), keys
    found = bucket_column(table)
    if found:
        name, n = found
        own = F.col(keys[0]).cast(table.schema[keys[0]].dataType)
        # Spark prunes folders by a side that has a filter; this one lets every key pass
        wanted = wanted.withColumn(name, bucket_of(own, n)).filter(F.col(name) >= 0)
        on = [name, *keys]
    return without_bucket(table.join(F.broadcast(wanted), on, "left_semi"))


def _table_name(path: str) -> str:
    return "clustered_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_clustered(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Writes ``df`` as a table of ``buckets`` sorted files by ``key``."""
    spark, name = df.sparkSession, _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sorted_ = df.repartition(buckets, key).sortWithinPartitions(key)
    writer = sorted_.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("compression", COMPRESSION).option("path", path).saveAsTable(name)
    return spark.table(name)


def read_clustered(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A clustered table that another session may have written; raises if there is none."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)
