"""Tables laid out by key: what is read and what moves."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanery.operators import clusters, joins, postings, scan
from gleanery.operators.chunks import chunk_search, chunk_search_in_candidates, unit_queries
from gleanery.operators.hybrid import rerank
from gleanery.operators.joins import look_up
from gleanery.operators.ranking import with_texts
from gleanery.operators.sparse import Weighting, document_vectors, first_part, term_statistics, tfidf_candidates
from gleanery.plans.requests import get_documents
from gleanery.sources.artifacts import ArtifactStore
from gleanery.sources.catalog import Catalog, DatasetSpec, keep_last
from gleanery.sources.layout import (
    _table_name,
    bucket_column,
    bucket_count,
    read_clustered,
    without_bucket,
    write_clustered,
)
from test_search import queries_of


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted(map(str, (df.select(*columns) if columns else df).collect()))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return ArtifactStore(spark, str(tmp_path_factory.mktemp("layout")), buckets=8)


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))


@pytest.fixture(scope="module")
def laid_out(store, corpus):
    return store.write_by_bucket("corpus", "c", corpus, "doc_id")


def test_bucket_tables_read_back_whole(store, corpus, laid_out):
    assert bucket_column(laid_out) == ("bucket_8", 8) == bucket_column(store.read("corpus", "c"))
    assert rows(without_bucket(laid_out)) == rows(corpus) == rows(without_bucket(store.read("corpus", "c")))
    assert bucket_count(0) == 1 and bucket_count(10**12) == 8192


@pytest.mark.parametrize("kind", ["long", "int"])
def test_lookups_prune_folders_by_the_wanted_ids(spark, laid_out, corpus, kind):
    hits = spark.createDataFrame([(1, 5), (2, 5), (3, 77), (4, 999)], f"query_id long, doc_id {kind}")
    for table in (laid_out, corpus):
        got = look_up(hits, table, "doc_id", 10)
        assert rows(got, "query_id", "text") == rows(hits.join(corpus, "doc_id", "left"), "query_id", "text")
    assert "dynamicpruning" in plan(look_up(hits, laid_out, "doc_id", 10))
    texts = with_texts(hits, laid_out, 10, "none")
    assert "dynamicpruning" in plan(texts) and "none" in rows(texts, "text")[0]
    assert rows(look_up(hits, laid_out, "doc_id", None), "query_id", "text") == rows(got, "query_id", "text")


def test_document_requests_prune(spark, laid_out):
    asked = spark.createDataFrame([(1, "5", "c"), (2, "x", "c"), (3, "77", "c")], "request_id long, doc_id string, dataset string")
    got = get_documents(asked, {"c": laid_out})
    assert "dynamicpruning" in plan(got)
    assert {r["request_id"]: r["content"] for r in got.collect()} == {1: "text 5", 2: None, 3: "text 77"}


def test_catalog_lookups_use_the_layout(spark, store, corpus, tmp_path):
    corpus.write.parquet(str(tmp_path / "docs"))
    catalog = Catalog(spark, [DatasetSpec("docs", str(tmp_path / "docs"))])
    ids = spark.createDataFrame([(3,), (3,), (500,)], "doc_id long")
    plain = rows(catalog.contents("docs", ids)), rows(catalog.content("docs", 7))
    catalog.lay_out("docs", store)
    assert (rows(catalog.contents("docs", ids)), rows(catalog.content("docs", 7))) == plain
    assert "dynamicpruning" in plan(catalog.contents("docs", ids))
    # one id: its folder is known before the query runs
    text = plan(catalog.content("docs", 7))
    assert "PartitionFilters: [isnotnull(bucket_8" in text and "dynamicpruning" not in text
    assert catalog.content("docs", 7).columns == catalog.contents("docs", ids).columns == ["doc_id", "text"]


# Clustered tables


@pytest.fixture(scope="module")
def vectors(spark):
    draw = random.Random(5)
    made = [(i, [draw.uniform(-1, 1) for _ in range(8)]) for i in range(400)]
    return spark.createDataFrame(made, "doc_id long, embedding array<float>")


def test_clustered_tables_join_where_they_lie(spark, vectors, tmp_path, setting, monkeypatch):
    path = str(tmp_path / "vectors")
    table = write_clustered(vectors, path, "doc_id", 4)
    assert rows(read_clustered(spark, path, "doc_id", 4)) == rows(vectors)
    spark.sql(f"DROP TABLE {_table_name(path)}")
    table = read_clustered(spark, path, "doc_id", 4)  # as another session finds it
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    candidates = spark.range(4000).select(
        (F.col("id") % 20).alias("query_id"), (F.col("id") % 410).alias("doc_id"), F.col("id").cast("int").alias("rank")
    )
    asked = vectors.filter("doc_id < 20").select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    want = rows(rerank(candidates, asked, vectors, 5, 10**9))
    got = rerank(candidates, asked, table, 5, None)
    lines = plan(got).splitlines()
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    join = max(i for i in range(at) if "SortMergeJoin [doc_id" in lines[i])
    # between the join and the vectors' files nothing moves
    assert join < at and not any("Exchange" in line for line in lines[at - 3 : at])
    assert rows(got) == want
    monkeypatch.setattr(joins, "HOT_ROWS", 3)
    for most in (20_000, 2):
        monkeypatch.setattr(joins, "HOT_TABLE_ROWS", most)
        assert rows(rerank(candidates, asked, table, 5, None)) == want


# Chunks: texts after the search


def test_chunk_searches_read_texts_of_winners_only(spark, store, vectors):
    chunks = vectors.select("doc_id", F.lit(0).alias("chunk_no"), F.concat(F.lit("t"), "doc_id").alias("text"), "embedding")
    texts = store.write_by_bucket("chunk_texts", "c", chunks.drop("embedding"), "doc_id")
    chunks.drop("text").write.mode("overwrite").parquet(store.path("chunk_vectors", "c"))
    narrow = spark.read.parquet(store.path("chunk_vectors", "c"))
    asked = vectors.filter("doc_id < 7").select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    want, _ = chunk_search(asked, chunks, 4, 0.2)
    got, _ = chunk_search(asked, narrow, 4, 0.2, texts=texts)
    assert got.columns == want.columns == ["query_id", "rank", "doc_id", "chunk_no", "text", "score"]
    assert rows(got) == rows(want) and "dynamicpruning" in plan(got)
    chosen = spark.createDataFrame([(q, d) for q in range(7) for d in range(q, 60, 3)], "query_id long, doc_id long")
    for bound in (1000, None):
        inside = chunk_search_in_candidates(asked, chosen, narrow, 3, bound, texts=texts)
        assert rows(inside) == rows(chunk_search_in_candidates(asked, chosen, chunks, 3, bound))


# Postings


def word(i):
    """Digits would be cleaned away."""
    return "zq" + chr(97 + i // 26) + chr(97 + i % 26)


def asking(*numbers):
    return " ".join(map(word, numbers))


def model(spark, n=400, seed=1):
    draw = random.Random(seed)
    texts = [" ".join(word(int(draw.paretovariate(0.7)) % 300) for _ in range(draw.randrange(30))) for _ in range(n)]
    bags = [(i, sorted(c := Counter(t.split())), [c[w] for w in sorted(c)]) for i, t in enumerate(texts)]
    bag = spark.createDataFrame(bags, "doc_id long, terms array<string>, tfs array<long>")
    stats = term_statistics(bag, n)
    return bag, stats, document_vectors(bag, stats)


ASKED = [
    asking(1, 2, 17), asking(299), "unknown", asking(1, 1, 1), asking(40, 41, 42, 43, 44, 3), "",
    asking(250, 260) + " unknown",
]


@pytest.mark.parametrize("k, block_rows", [(1, 8), (5, 8), (5, 4096), (60, 16), (500, 16)])
def test_postings_give_the_rows_of_a_scan(spark, store, k, block_rows):
    _, stats, vectors = model(spark)
    blocks = store.write_by_bucket("postings", f"p{block_rows}", postings.term_blocks(vectors, stats, block_rows), "term")
    by_id = store.write_by_bucket("vectors", "p", vectors, "doc_id")
    asked = queries_of(spark, *ASKED)
    want, _ = tfidf_candidates(asked, vectors, stats, None, k)
    got, _ = postings.postings_search(asked, by_id, stats, blocks, postings.first_ids(vectors), None, k)
    assert rows(got) == rows(want) and (k < 500 or want.filter("score > 0").count() > 100)


def test_postings_skip_blocks_and_folders(spark, store):
    _, stats, vectors = model(spark, 2000)
    blocks = store.write_by_bucket("postings", "skip", postings.term_blocks(vectors, stats, 32), "term")
    schema = "query_id long, query_terms array<string>, query_weights array<double>"
    one = spark.createDataFrame([(1, [word(1)], [1.0])], schema)
    matching = blocks.filter(F.col("term") == word(1)).agg(F.sum("n")).first()[0]
    assert 3 <= postings.candidates(one, blocks, postings.first_ids(vectors), 3).count() < matching / 4
    asked = spark.createDataFrame([(1, [word(250), word(1)], [0.95, 0.31])], schema)
    matching = blocks.filter(F.col("term").isin(word(1), word(250))).agg(F.sum("n")).first()[0]
    assert 3 <= postings.candidates(asked, blocks, postings.first_ids(vectors), 3).count() < matching
    read = postings._of_terms(store.read("postings", "skip"), asked.select("query_id", F.explode("query_terms").alias("term")), ["n"])
    assert "dynamicpruning" in plan(read) and "doc_ids" not in plan(read)


def test_blocks_hold_like_weights(spark):
    _, stats, vectors = model(spark)
    for r in postings.term_blocks(vectors, stats, 16).collect():
        assert r["n"] == len(r["doc_ids"]) == len(r["weights"]) and r["max_weight"] == max(r["weights"])
        assert r["level"] == postings.LEVELS or all(2.0 ** (-(r["level"] + 1) / 2) <= w + 1e-12 for w in r["weights"])


# Floors


def test_a_first_look_spares_rows_and_changes_none(spark, store, monkeypatch, setting):
    _, stats, vectors = model(spark, 3000)
    asked = queries_of(spark, asking(1, 2, 17), asking(3, 4, 5), asking(1, 6))
    many = ArtifactStore(spark, store.root, buckets=64)
    by_id = many.write_by_bucket("vectors", "floor", vectors, "doc_id")
    setting("spark.sql.files.maxPartitionBytes", "20000")
    setting("spark.sql.files.openCostInBytes", "20000")
    assert first_part(by_id, 100) is not None and first_part(by_id, 99) is None and first_part(vectors, 100) is None
    monkeypatch.setattr("gleanery.operators.sparse.LOOK_FROM_K", 5)
    want, _ = tfidf_candidates(asked, vectors, stats, None, 5)
    emitted = []
    whole = scan.top_ranked
    monkeypatch.setattr(scan, "top_ranked", lambda df, *a, **k: emitted.append(df) or whole(df, *a, **k))
    got, _ = tfidf_candidates(asked, by_id, stats, None, 5)
    assert rows(got) == rows(want)
    look, with_floor = emitted[-2:]
    monkeypatch.setattr("gleanery.operators.sparse.first_part", lambda *_: None)
    again, _ = tfidf_candidates(asked, by_id, stats, None, 5)
    assert rows(again) == rows(want)
    assert look.count() < with_floor.count() < emitted[-1].count() / 2


# Groups


@pytest.fixture(scope="module")
def grouped(spark, store):
    draw = random.Random(9)
    made = []
    for i in range(1200):
        centre = [math.cos(i % 12 + j) for j in range(6)]
        vector = [c + draw.uniform(-0.15, 0.15) for c in centre] if i % 100 else [0.0] * 6
        size = math.sqrt(sum(x * x for x in vector)) or 1.0
        made.append((i, i % 3, [x / size for x in vector]))
    table = spark.createDataFrame(made, "doc_id long, chunk_no int, embedding array<float>")
    clusters.write_groups(store, "groups", "g", table, ["doc_id", "chunk_no"], pivots=24)
    return table, store.read("groups", "g"), store.read("groups_pivots", "g")


@pytest.mark.parametrize("k, threshold", [(1, None), (5, 0.7), (30, 0.99), (2000, None), (10, 1.1)])
def test_groups_give_the_rows_of_a_scan(spark, grouped, k, threshold):
    table, groups, pivots = grouped
    asked = unit_queries(table.filter("doc_id % 97 = 3").select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector")))
    want, _ = chunk_search(asked, table.withColumn("text", F.lit("")), k, threshold)
    got, _ = clusters.grouped_search(asked, groups, pivots, ["doc_id", "chunk_no"], k, threshold)
    assert rows(got, "query_id", "rank", "doc_id", "chunk_no", "score") == rows(want, "query_id", "rank", "doc_id", "chunk_no", "score")


def test_bounds_hold_and_groups_are_skipped(spark, grouped, monkeypatch):
    table, groups, pivots = grouped
    asked = unit_queries(table.filter("doc_id = 5").select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector")))
    bounds = {r["grp"]: r["bound"] for r in clusters.group_bounds(asked, pivots).collect()}
    query = asked.first()["query_vector"]
    for r in groups.collect():
        assert sum(a * b for a, b in zip(query, r["embedding"])) <= bounds[r["grp"]]
    read = []
    whole = clusters.search_top_k
    monkeypatch.setattr(clusters, "search_top_k", lambda q, v, **k: read.append(v) or whole(q, v, **k))
    hits, _ = clusters.grouped_search(asked, groups, pivots, ["doc_id", "chunk_no"], 3)
    assert hits.count() == 3 and read[-1].count() < table.count() / 2
    assert "PartitionFilters: [grp" in plan(read[-1])


# Repeated ids


def test_keep_last_moves_no_text(spark, tmp_path):
    made = [(i % 7 if i % 7 else None, f"text {i}", i // 20) for i in range(60)]
    table = spark.createDataFrame(made, "id long, text string, line long")
    table.coalesce(1).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    by_line, by_place = keep_last(table, "id", "line"), keep_last(table, "id", None)
    want = {}
    for key, text, line in made:  # of equal lines the later row
        want[key] = max(want.get(key, (-1, -1, "")), (line, made.index((key, text, line)), text))
    assert {r["id"]: r["text"] for r in by_line.collect()} == {k: v[2] for k, v in want.items()}
    assert {r["id"]: r["text"] for r in by_place.collect()} == {k: t for k, t, _ in made}
    assert len(by_line.collect()) == 7
    assert not any("Exchange" in line and "text" in line for line in plan(by_line).splitlines())


def test_weights_where_terms_are_too_many_to_broadcast(spark, monkeypatch):
    bag, stats, vectors = model(spark, 100)
    monkeypatch.setattr("gleanery.operators.sparse.FREQUENT_KEYS", 0)
    joined = document_vectors(bag, stats, Weighting())
    flat = lambda df: {(r["doc_id"], t): w for r in df.collect() for t, w in zip(r["terms"], r["weights"])}
    one, two = flat(vectors), flat(joined)
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-12 for k in one)
    assert joined.count() == 100


def test_only_rare_terms_travel_for_their_weights(spark, tmp_path, monkeypatch):
    bag, stats, vectors = model(spark, 100)
    n = stats.count()
    monkeypatch.setattr("gleanery.operators.sparse.FREQUENT_KEYS", n - 1)
    same = bag.union(bag.filter("doc_id < 5")).union(bag.filter("doc_id = 7").selectExpr("null", "terms", "tfs"))
    same.write.parquet(str(tmp_path / "bag"))
    same = spark.read.parquet(str(tmp_path / "bag"))
    joined = document_vectors(same, stats, Weighting())
    assert "collect_list(struct(term, term" in plan(joined) and "explode_outer" not in plan(joined)
    rows = lambda df: sorted(
        (str(r["doc_id"]), sorted((t, round(w, 9)) for t, w in zip(r["terms"], r["weights"]))) for r in df.collect()
    )
    want = vectors.union(vectors.filter("doc_id < 5")).union(
        vectors.filter("doc_id = 7").selectExpr("null", "terms", "weights")
    )
    assert rows(joined) == rows(want)
    assert joined.count() == 106  # rows of equal ids stay rows of their own
