import os
from collections import Counter

import pytest
from pyspark.sql import functions

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, differences
from gleanery.llm import queries
from gleanery.llm.tables import Scratch, components
from test_similar import brute as brute_components
from test_substrings import brute as brute_substrings

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no fixture tables")


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.SQL) <= set(entry.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert differences(df, connect(FOLDER), queries.SQL[name]) == ""


@needs_tables
def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, scratch, tables = docs.columns, Scratch(spark, "test"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(scratch.write(stage(spark, tables[-1], FOLDER), name))
    docs, spoken, clean, single, cut, packed = tables
    assert all(t.columns == columns for t in tables[:-1])
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    assert {r.doc_id for r in single.collect()} == {c for _, _, c in brute_components(rows)}
    rows = [(r.doc_id, r.text) for r in single.collect()]
    kept = {(r.doc_id): (r.text or "").split() for r in cut.collect()}
    removed = {i: (n, gone) for i, n, gone, _ in brute_substrings(rows, 35)}
    assert {i: len(w) for i, w in kept.items()} == {i: n - gone for i, (n, gone) in removed.items() if gone < n}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stays = {r.doc_id for r in clean.collect()}
    words = {r.doc_id: len(r.text.split()) for r in spoken.collect()}
    assert all((i in stays) == (labels[i] == 1) for i in words if i in labels and words[i] >= 20)
    assert {r.doc_id for r in packed.collect()} == set(kept)


@needs_tables
def test_texts_of_no_learnt_language_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet(FOLDER.replace("sf0.001", "sf0.01") + "/documents.parquet")
    odd = [
        "zxqv kjwq pfft xkcd wqz vbnm hjkl qzx trwq plmk xxvz " * 5, "asdkjh qwlekj zmxncb poiqwe lkjasd mnzbxc",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
    ]
    more = spark.createDataFrame([(-1 - i, t, None, "odd", len(t)) for i, t in enumerate(odd)], docs.schema)
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(more), FOLDER)
    assert kept.filter("doc_id < 0").collect() == []
    assert docs.filter(docs.text.rlike(r"\p{L}")).join(kept, "doc_id", "left_anti").select("text").collect() == []


def test_stages_take_empty_tables_and_edge_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)]
    for docs in (spark.createDataFrame([], schema), spark.createDataFrame(rows, schema)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0


def prose(seed, n=60):
    return " ".join(f"w{seed}x{i}" for i in range(n))


def test_null_and_repeated_ids_lose_no_text(spark):
    near = prose(1)[: prose(1).rindex(" ")]
    rows = [(None, prose(5), "a"), (None, prose(6), "b"), (None, prose(6), "c"), (2, near, "d"), (1, prose(1), "e"),
            (2, prose(2), "f"), (2, prose(3), "g"), (None, prose(2), "h"), (None, "", "i"), (None, None, "j")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], schema).repartition(3)
    got = corpus_pipeline.join_similar(spark, docs, FOLDER).collect()
    assert {r.source for r in got} - {"b", "c"} == {"a", "e", "f", "g", "i", "j"}
    assert sum(r.source in "bc" for r in got) == 1 and len(got) == 7


def test_repeats_of_rows_without_own_ids(spark):
    rows = [(i, prose(s, 50) + " " + prose(9, 40), str(s)) for s, i in enumerate([None, None, 7, 7, 7])]
    rows.append((7, prose(9, 40), "only repeats"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], schema)
    got = corpus_pipeline.remove_repeats(spark, docs, FOLDER).collect()
    want = sorted((str(i), s, prose(int(s), 50)) for i, _, s in rows[:5])
    assert sorted((str(r.doc_id), r.source, r.text.strip()) for r in got) == want


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 1), (9, 8), (8, 7), (7, 6), (6, 5), (20, 20), (5, 30), (30, 40)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in components(Scratch(spark, "test"), df).collect()}
    assert found == {1: 1, 2: 1, 3: 1, **{n: 5 for n in (5, 6, 7, 8, 9, 30, 40)}}
    assert Counter(components(Scratch(spark, "test"), df.limit(0)).collect()) == Counter()


CLASHING = ["score", "lang_pred", "typical", "cleaned", "kept", "n_words", "_row", "_kept", "_found", "row", "key", "file", "place", "_in"]


def test_further_columns_pass_whatever_they_are_called(spark):
    base = spark.createDataFrame(
        [(i, prose(i, 40) + "." + " äöü" * 5, "en", "s", 3) for i in range(6)] + [(9, prose(1, 40) + "." + " äöü" * 5, "de", "s", 3)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs = base.select("*", *[functions.concat_ws("-", functions.lit(c), "doc_id").alias(c) for c in CLASHING])
    path = f"{Scratch(spark, 'test').folder}/clashing"
    docs.write.parquet(path)
    for given in (docs, spark.read.parquet(path)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, given, FOLDER)
            assert got.columns == docs.columns, name
            for r in got.collect():
                assert all(r[c] == f"{c}-{r.doc_id}" for c in CLASHING), name
        assert stage(spark, given, FOLDER).count() > 0


def test_without_labels_every_text_with_a_letter_stays(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, "some words", None, "s", 1), (2, "123", None, "s", 1), (3, None, None, "s", 1)], schema)
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, docs, FOLDER).collect()] == [1]


def test_long_texts_pass_whole(spark):
    words = " ".join(f"word{i}" for i in range(200_000))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, words + ".", "en", "s", 1), (2, prose(3, 50) + ".", "en", "s", 1)], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    assert {r.doc_id: r.text for r in docs.collect()}[1] == words + "."


@needs_tables
def test_a_run_leaves_its_result_only(spark):
    from gleanery.session import shared_folder

    place = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(place))
    result = corpus_pipeline.run(spark, FOLDER)
    assert result.count() > 0
    (new,) = set(os.listdir(place)) - before
    assert [n.split("-")[0] for n in os.listdir(f"{place}/{new}")] == ["packing"]
