"""Joins that stay balanced when one key holds a large part of the rows.

Each join here broadcasts only what has a proven bound: either a row count that
was checked, or a set whose size follows from arithmetic (at most ``n`` keys can
each own ``1/n`` of the rows).  What lies beyond the bound is shuffled, and no
row is dropped on either way.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import materialise
from gleanery.sources.layout import wanted_only, without_bucket

# Rows of a narrow side (ids, ranks, words) that may be broadcast, some 64 MB.
BROADCAST_ROWS = 1_000_000

# Keys that may be broadcast as frequent, and their average length if they are all
# the keys there are: 250,000 x (64 + a few numbers) bytes is about 25 MB.
FREQUENT_KEYS = 250_000
KEY_BYTES = 64

# A key with at least this many rows is hot; 10,000 such keys at most are salted,
# each over this many copies of its row on the other side.
HOT_ROWS = 10_000
HOT_KEYS = 10_000
SALTS = 64

# Rows of a table of vectors that may be broadcast because their keys are hot.
HOT_TABLE_ROWS = 20_000


def rows_if_few(df: DataFrame) -> int | None:
    """The number of rows, or ``None`` if they are too many to broadcast."""
    n = df.limit(BROADCAST_ROWS + 1).count()
    return n if n <= BROADCAST_ROWS else None


def join_by_frequency(
    facts: DataFrame,
    words: DataFrame,
    key: str,
    frequency: str,
    how: str = "left",
    max_keys: int = FREQUENT_KEYS,
) -> DataFrame:
    """Join ``facts`` with ``words`` (one row per ``key``) under word-like skew.

    ``words[frequency]`` counts the rows a key has in ``facts``.  The frequent
    keys are broadcast: at most ``max_keys`` can have that many rows, and with each
    key repeated in so many rows, all of them together are no longer than the same
    number of average keys.  Only rows of the many rare keys are shuffled, and none
    of those keys can be hot.
    """
    total, keys, key_bytes = words.agg(
        F.coalesce(F.sum(frequency), F.lit(0)),
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.octet_length(key)), F.lit(0)),
    ).first()
    all_fit = keys <= max_keys and key_bytes <= max_keys * KEY_BYTES
    at_least = 0 if all_fit else math.ceil(total / max_keys) + 1
    is_frequent = F.coalesce(F.col(frequency), F.lit(0)) >= at_least  # unknown counts as rare
    frequent = words.filter(is_frequent).withColumn("_frequent", F.lit(True))
    rare = words.filter(~is_frequent)
    joined = facts.join(F.broadcast(frequent), key, "left")
    if rare.isEmpty():
        result = joined
    else:
        # rows without a key match nothing and would all be shuffled to one task
        done = F.col("_frequent").isNotNull() | F.col(key).isNull()
        found = joined.filter(done)
        open_rows = joined.filter(~done).select(*facts.columns)
        rest = open_rows.join(rare.withColumn("_frequent", F.lit(True)), key, "left")
        result = found.unionByName(rest)
    if how == "inner":
        result = result.filter(F.col("_frequent"))
    return result.drop("_frequent")


def join_wanted(
    table: DataFrame, wanted: DataFrame, key: str, max_rows: int | None
) -> DataFrame:
    """Inner join of a big ``table`` with ``wanted`` rows, ``max_rows`` at most.

    Within the bound the table is filtered where it lies.  Beyond it the wanted rows go
    to the table's rows: a table that is clustered by ``key`` is not shuffled.
    """
    table = without_bucket(table)
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        return table.join(F.broadcast(wanted), key)
    return _located_join(wanted, table, key)


def look_up(
    rows: DataFrame, table: DataFrame, key: str | list[str], max_rows: int | None
) -> DataFrame:
    """Left join of ``rows`` with a big ``table`` that has one row per ``key``.

    For few rows a table in buckets is read in the buckets of their keys only.  Of many
    rows with few keys the table's rows of these keys are shuffled, and no others.
    """
    keys = [key] if isinstance(key, str) else key
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        return rows.join(wanted_only(table, rows, keys), keys, "left")
    wanted = materialise(rows.select(*keys).distinct(), "wanted")
    if rows_if_few(wanted) is not None:
        table = wanted_only(table, wanted, keys)
    return _salted_join(rows, without_bucket(table), keys, "left")


def join_skewed(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of two shuffled sides; rows of a hot key are spread over copies of its table rows."""
    return _salted_join(rows, table, keys, "inner")


def _hot_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of very many rows, ``HOT_KEYS`` at most."""
    counts = rows.groupBy(*keys).count()
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    hot_from = max(HOT_ROWS, math.ceil(total / HOT_KEYS))
    return counts.filter(F.col("count") >= hot_from).select(*keys)


def _located_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join that moves ``rows`` to the table.

    Table rows of a hot key go to its rows instead, if they are few; else they are salted.
    """
    hot = _hot_keys(rows, [key])
    if hot.isEmpty():
        return rows.join(table, key)
    hot = F.broadcast(hot)
    theirs = table.join(hot, key, "left_semi")
    if len(theirs.select(key).take(HOT_TABLE_ROWS + 1)) > HOT_TABLE_ROWS:
        return _salted_join(rows, table, [key], "inner")
    of_hot = rows.join(hot, key, "left_semi").join(F.broadcast(theirs), key)
    return rows.join(hot, key, "left_anti").join(table, key).unionByName(of_hot)


def _salted_join(rows: DataFrame, table: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Shuffle join; a key that is hot in ``rows`` meets salted copies of its table rows."""
    hot = F.broadcast(_hot_keys(rows, keys).withColumn("_copies", F.lit(SALTS)))
    others = [c for c in rows.columns if c not in keys]
    # rows that consist of their key are all alike and cannot be told apart by a salt
    salt = F.pmod(F.xxhash64(*others), F.col("_copies")) if others else F.lit(0)
    salted_rows = rows.join(hot, keys, "left").withColumn(
        "_salt", F.coalesce(salt, F.lit(0)).cast("int")
    )
    salted_table = table.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))
    )
    joined = salted_rows.drop("_copies").join(salted_table.drop("_copies"), [*keys, "_salt"], how)
    return joined.drop("_salt")
