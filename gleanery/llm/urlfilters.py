"""URL filters as a temporal list join.

List entries are dated additions and removals of a key: a domain, which covers its
subdomains, or a host with the beginning of a path.  They become validity intervals; an
as-of join evaluates every capture against the intervals open on its fetch day.  Captures
are evaluated once per distinct URL and day, so that a hot host or repeated captures are
aggregated first, and one key has at most one entry per day.

Defined results: a null URL, one without a host, or a null day matches nothing; an
addition and a removal of one key on one day leave it listed; additions of a listed key
and removals of an unlisted one change nothing; repeated captures get equal results; with
an empty list nothing is blocked; columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADDRESS = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?(/[^?#]*)?"
RESULTS = ["host", "n_active", "lists", "matched", "blocked"]


def host_of(url: Column) -> Column:
    """Lower-case host, null where there is none."""
    host = F.regexp_extract(F.lower(url), ADDRESS, 1)
    return F.when(host != "", F.regexp_replace(host, r"\.$", ""))


def keys_of(url: Column) -> Column:
    """Every key that may cover a URL: the host, its parent domains, and the host with each
    beginning of the path that ends before a slash, longest beginning last."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    path = F.regexp_extract(F.lower(url), ADDRESS, 2)
    steps = F.array_remove(F.split(path, "/", -1), "")
    paths = F.when(
        F.size(steps) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(steps)),
            lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host_of(url).isNotNull(), F.array_distinct(F.concat(domains, paths)))


def intervals(entries: DataFrame) -> DataFrame:
    """``(list, key, valid_from, valid_to)`` of ``(list, key, day, listed)``; open ends are null."""
    daily = entries.filter("key is not null and day is not null").groupBy("list", "key", "day").agg(
        F.max(F.coalesce("listed", F.lit(False))).alias("listed")
    )
    order = Window.partitionBy("list", "key").orderBy("day")
    ended = daily.withColumn("valid_to", F.lead("day").over(order))
    return ended.filter("listed").select("list", "key", F.col("day").alias("valid_from"), "valid_to")


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """Adds the host, how many entries are active, their lists and keys, and ``blocked``."""
    seen = captures.select(F.col(url).alias("_url"), F.col(day).alias("_day"))
    once = seen.filter("_url is not null and _day is not null").distinct()
    keyed = once.withColumn("key", F.explode(keys_of(F.col("_url"))))
    active = keyed.join(intervals(entries), "key").filter(
        (F.col("valid_from") <= F.col("_day")) & (F.col("valid_to").isNull() | (F.col("_day") < F.col("valid_to")))
    )
    found = active.groupBy("_url", "_day").agg(
        F.count("*").alias("n_active"),
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
        F.array_join(F.array_sort(F.collect_set("key")), " ").alias("matched"),
    )
    left = captures.drop(*[c for c in RESULTS if c not in (url, day)])
    joined = left.join(found, (left[url] == found["_url"]) & (left[day] == found["_day"]), "left")
    return joined.drop("_url", "_day").withColumns(
        {
            "host": host_of(F.col(url)),
            "n_active": F.coalesce("n_active", F.lit(0)),
            "lists": F.coalesce("lists", F.lit("")),
            "matched": F.coalesce("matched", F.lit("")),
            "blocked": F.coalesce(F.col("n_active") > 0, F.lit(False)),
        }
    )
