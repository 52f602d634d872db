import json

import pytest
from pyspark.sql import functions as F

from gleanery.session import shared_folder
from gleanery.sources.artifacts import ArtifactStore
from gleanery.sources.catalog import Catalog, DatasetSpec, UnknownDataset
from gleanery.sources.textfiles import (
    read_qrels_spaced,
    read_qrels_tsv,
    read_queries_jsonl,
    read_queries_tsv,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_tsv_queries(spark, tmp_path):
    path = write(
        tmp_path / "queries.txt",
        "3\twhat causes tides",
        "no tab here",
        "  4\ta\tb  ",
        "5\t",
        "3\tsecond wins",
    )
    assert rows(read_queries_tsv(spark, path)) == [("3", "second wins"), ("4", "a\tb")]


def test_last_line_wins_across_splits(spark, tmp_path, setting):
    setting("spark.sql.files.maxPartitionBytes", "2000")
    setting("spark.sql.files.openCostInBytes", "0")
    lines = [f"{i % 50}\tquery {i} " + "x" * 40 for i in range(1000)]
    path = write(tmp_path / "queries.txt", *lines)
    assert spark.read.text(path).rdd.getNumPartitions() > 3
    got = dict(rows(read_queries_tsv(spark, path)))
    assert got == {str(i % 50): f"query {i} " + "x" * 40 for i in range(950, 1000)}


def test_jsonl_queries(spark, tmp_path):
    path = write(
        tmp_path / "queries.jsonl",
        json.dumps({"_id": 7, "text": "a", "more": [1]}),
        "{bad",
        json.dumps({"_id": 8}),
        json.dumps({"_id": "9", "text": "é"}),
        "12",
        json.dumps({"_id": "7", "text": "later"}),
        json.dumps({"_id": "10", "text": None}),
        "{'_id': 11, 'text': 'single quotes'}",
    )
    assert set(rows(read_queries_jsonl(spark, path))) == {("7", "later"), ("9", "é"), ("10", None)}


def test_spaced_qrels(spark, tmp_path):
    path = write(
        tmp_path / "qrels.txt",
        "3 Q0 d1 4",
        "3 Q0 d2 x",
        "3  Q0 d3 1",
        "3 Q0 d4",
        "3 Q0 d1 2",
        "4 Q0 d1 1.5",
        "5 Q0 d9 -1 extra",
    )
    assert rows(read_qrels_spaced(spark, path)) == [("3", "d1", 2), ("5", "d9", -1)]


def test_tab_qrels_drop_only_the_header(spark, tmp_path, setting):
    setting("spark.sql.files.maxPartitionBytes", "500")
    setting("spark.sql.files.openCostInBytes", "0")
    lines = ["query-id\tcorpus-id\t1"] + [f"{i}\td{i}\t{i % 3}" for i in range(400)]
    path = write(tmp_path / "test.tsv", *lines, "1\td9", "2\t'q\"uote\t2")
    got = rows(read_qrels_tsv(spark, path))
    assert len(got) == 401 and ("2", "'q\"uote", 2) in got
    assert not any(q == "query-id" for q, _, _ in got)


def test_catalog(spark, tmp_path):
    spark.createDataFrame([(0, "zero"), (1, "one")], "_id LONG, text STRING").write.parquet(
        str(tmp_path / "a")
    )
    spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, "two", 1)], "id LONG, text STRING, line LONG"
    ).write.parquet(str(tmp_path / "b"))
    catalog = Catalog(
        spark,
        [
            DatasetSpec("a", str(tmp_path / "a"), id_column="_id"),
            DatasetSpec("b", str(tmp_path / "b"), id_column="id", order_column="line"),
        ],
    )
    assert rows(catalog.documents("a")) == [(0, "zero"), (1, "one")]
    assert rows(catalog.documents("a", spread=True)) == [(0, "zero"), (1, "one")]
    assert rows(catalog.documents("b")) == [(1, "new"), (2, "two")]
    assert rows(catalog.documents_with_string_ids("a")) == [("0", "zero"), ("1", "one")]
    assert rows(catalog.doc_ids("a")) == [(0,), (1,)]
    assert rows(catalog.content("a", 1)) == [(1, "one")] and rows(catalog.content("a", 5)) == []
    ids = spark.createDataFrame([(1,), (1,), (7,)], "doc_id LONG")
    assert rows(catalog.contents("a", ids)) == [(1, "one")]
    assert rows(catalog.contents("a", ids.limit(0))) == []
    with pytest.raises(UnknownDataset):
        catalog.documents("c")


def test_query_sets_and_judgements_by_dataset(spark, tmp_path):
    catalog = Catalog(
        spark,
        [
            DatasetSpec(
                "a", "a", queries_path=write(tmp_path / "q.txt", "1\tone", "skip"), qrels_path=write(tmp_path / "r.txt", "1 Q0 d 3")
            ),
            DatasetSpec(
                "b", "b", queries_path=write(tmp_path / "q.jsonl", '{"_id": 2, "text": "two"}'), queries_format="jsonl",
                qrels_path=write(tmp_path / "r.tsv", "q\td\t1", "2\te\t1"), qrels_format="tsv",
            ),
            DatasetSpec("c", "c"),
        ],
    )
    assert rows(catalog.queries("a")) == [("1", "one")] and rows(catalog.qrels("a")) == [("1", "d", 3)]
    assert rows(catalog.queries("b")) == [("2", "two")] and rows(catalog.qrels("b")) == [("2", "e", 1)]
    for read in (catalog.queries, catalog.qrels):
        with pytest.raises(ValueError):
            read("c")
        with pytest.raises(UnknownDataset):
            read("d")


def test_files_of_a_folder_follow_by_name(spark, tmp_path, setting):
    setting("spark.sql.files.maxPartitionBytes", "300")
    setting("spark.sql.files.openCostInBytes", "0")
    for name in ("b", "a", "c"):
        write(tmp_path / f"{name}.txt", *[f"{i}\t{name} {i}" for i in range(0, 60, 1 + "abc".index(name))])
    got = dict(rows(read_queries_tsv(spark, str(tmp_path))))
    assert all(got[str(i)] == f"{'c' if i % 3 == 0 else 'b' if i % 2 == 0 else 'a'} {i}" for i in range(60))
    for name in ("x", "y"):
        (tmp_path / "q").mkdir(exist_ok=True)
        write(tmp_path / "q" / f"{name}.tsv", "head\thead\t1", *[f"{name}{i}\td\t1" for i in range(90)])
    judged = rows(read_qrels_tsv(spark, str(tmp_path / "q")))
    assert len(judged) == 180 and not any(q == "head" for q, _, _ in judged)


def test_scans_prune_and_push_down(spark, tmp_path):
    spark.range(10).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).write.parquet(
        str(tmp_path / "d")
    )
    catalog = Catalog(spark, [DatasetSpec("d", str(tmp_path / "d"))])
    ids_plan = catalog.doc_ids("d")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in ids_plan
    one_plan = catalog.content("d", 3)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,3)" in one_plan


def test_artifacts(spark, tmp_path):
    store = ArtifactStore(spark, str(tmp_path))
    store.write("t", "a", spark.range(3))
    store.write("t", "b", spark.range(5))
    store.write("t", "a", spark.range(4))
    assert store.read("t", "a").count() == 4 and store.read("t", "b").count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read("missing", "a")


def test_shared_folder_is_the_one_named_in_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        assert shared_folder(spark) == named
    else:
        assert shared_folder(spark) == shared_folder(spark)
