from pyspark.sql import functions as F

from gleanery.operators import joins


def rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_join_by_frequency_is_a_plain_join_whatever_is_frequent(spark):
    facts = spark.createDataFrame(
        [(i, "hot" if i % 3 else f"w{i}") for i in range(60)] + [(99, "unknown"), (98, None)],
        "doc_id LONG, term STRING",
    )
    long_word = "l" * 100
    facts = facts.union(spark.createDataFrame([(97, long_word)], facts.schema))
    counted = facts.filter("term <> 'unknown'").groupBy("term").agg(F.count("*").alias("df"))
    words = counted.withColumn("idf", F.length("term") * 1.0)
    want = rows(facts.join(words, "term", "left"), "doc_id", "term", "idf")
    for max_keys in [1000, 5, 1]:
        got = joins.join_by_frequency(facts, words, "term", "df", max_keys=max_keys)
        assert rows(got, "doc_id", "term", "idf") == want
    inner = joins.join_by_frequency(facts, words, "term", "df", how="inner", max_keys=5)
    assert rows(inner, "doc_id", "term", "idf") == rows(
        facts.join(words, "term"), "doc_id", "term", "idf"
    )
    assert set(inner.columns) == {"doc_id", "term", "df", "idf"}


def test_salted_join_equals_the_broadcast_one(spark, monkeypatch):
    hits = spark.createDataFrame(
        [(q, 0 if q % 3 else q, q / 7) for q in range(90)], "query_id LONG, doc_id LONG, score DOUBLE"
    )
    table = spark.createDataFrame([(i, f"text {i}") for i in range(0, 80, 2)], "doc_id LONG, text STRING")
    columns = ["query_id", "doc_id", "score", "text"]
    want = rows(hits.join(table, "doc_id", "left"), *columns)
    found = rows(hits.join(table, "doc_id"), *columns)
    assert rows(joins.look_up(hits, table, "doc_id", 90), *columns) == want
    assert rows(joins.join_wanted(table, hits, "doc_id", 90), *columns) == found
    for hot_rows in [10_000, 10]:
        monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
        assert rows(joins.look_up(hits, table, "doc_id", None), *columns) == want
        assert rows(joins.join_wanted(table, hits, "doc_id", None), *columns) == found


def test_hot_key_is_spread_over_several_partitions(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    monkeypatch.setattr(joins, "SALTS", 8)
    hits = spark.range(2000).select(F.col("id").alias("query_id"), F.lit(5).cast("long").alias("doc_id"))
    table = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.look_up(hits, table, "doc_id", None)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 2000 and len(sizes) > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_look_up_of_key_columns_only(spark):
    from gleanery.operators.joins import look_up

    rows = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    table = spark.createDataFrame([(1, "a"), (3, "b")], "k long, v string")
    for bound in (10, None):
        got = sorted(look_up(rows, table, "k", bound).collect(), key=str)
        assert [r["v"] for r in got] == ["a", "a", None, None]
