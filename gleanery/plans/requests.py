"""Tables of search and document requests, answered as batch jobs."""

from __future__ import annotations

from functools import cached_property, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions.text import suffixed_snippet
from gleanery.operators.joins import join_skewed, look_up, rows_if_few
from gleanery.operators.prompts import NO_CONTENT, build_prompts
from gleanery.operators.ranking import with_snippets, with_texts
from gleanery.plans.engine import Engine
from gleanery.session import materialise
from gleanery.sources.layout import bucket_names

# The method names a request may carry.
METHODS = [
    "tfidf",
    "embedding_brute_force",
    "embedding_faiss",
    "hybrid",
    "rag_with_faiss",
    "faiss_with_basics",
    "rag_with_basics",
]

# Error texts of rejected requests.
MISSING_FIELDS = "Missing query, dataset, or method"
MISSING_DOCUMENT_FIELDS = "Missing doc_id or dataset"
DOCUMENT_NOT_FOUND = "Document not found"


class Answers(NamedTuple):
    results: DataFrame
    rejects: DataFrame


def _absent(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def validate(requests: DataFrame, datasets: list[str]) -> DataFrame:
    """Add ``error``: null for a good request, else why it is rejected."""
    absent = _absent("query") | _absent("dataset") | _absent("method")
    error = (
        F.when(absent, F.lit(MISSING_FIELDS))
        .when(~F.col("method").isin(METHODS), F.concat(F.lit("Invalid method: "), "method"))
        .when(~F.col("dataset").isin(datasets), F.concat(F.lit("Unknown dataset: "), "dataset"))
    )
    key = F.coalesce("instruction_key", F.lit("default"))
    return requests.withColumn("instruction_key", key).withColumn("error", error)


# How many of its hybrid hits a method looks at, and which methods share chunk hits.
HYBRID_DEPTH = {"hybrid": 10, "faiss_with_basics": 50, "rag_with_basics": 3}
CHUNK_METHODS = ["embedding_faiss", "rag_with_faiss"]
PROMPT_METHODS = ["rag_with_faiss", "rag_with_basics"]


class _Dataset:
    """The good requests of one dataset, and the searches their methods share.

    Several methods start from the same search.  It runs once for the queries of
    all of them, and the few hits are written down for each method to pick its own.
    """

    def __init__(self, engine: Engine, requests: DataFrame, methods: list[str]):
        self.engine = engine
        self.requests = requests
        self.methods = methods

    def queries(self, *methods: str) -> DataFrame:
        """Every different query once, however many requests ask it, under whatever key."""
        mine = self.requests.filter(F.col("method").isin(list(methods)))
        return mine.select("query_id", "query").distinct()

    def prompts(self, method: str, hits: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Every query once for each of its instruction keys, and the hits of each of these."""
        mine = self.requests.filter(F.col("method") == method)
        asked = mine.select("query_id", "prompt_id", "query", "instruction_key").distinct()
        theirs = hits.join(asked.select("query_id", "prompt_id"), "query_id").drop("query_id")
        return (
            asked.drop("query_id").withColumnRenamed("prompt_id", "query_id"),
            theirs.withColumnRenamed("prompt_id", "query_id"),
        )

    @cached_property
    def hybrid(self) -> tuple[DataFrame, int | None]:
        present = [m for m in HYBRID_DEPTH if m in self.methods]
        depth = max(HYBRID_DEPTH[m] for m in present)
        hits, max_rows = self.engine.hybrid_candidates(self.queries(*present), depth)
        return materialise(hits, "hybrid-hits"), max_rows

    @cached_property
    def chunks(self) -> DataFrame:
        return materialise(self.engine.chunk(self.queries(*CHUNK_METHODS)), "chunk-hits")

    def hits_of(self, method: str, shared: DataFrame) -> DataFrame:
        return shared.join(self.queries(method).select("query_id"), "query_id", "left_semi")

    def answer(self, method: str) -> DataFrame:
        engine, queries = self.engine, self.queries(method)
        if method == "tfidf":
            return engine.tfidf(queries)
        if method == "embedding_brute_force":
            return engine.embedding(queries)
        if method in CHUNK_METHODS:
            hits = self.hits_of(method, self.chunks)
            if method == "rag_with_faiss":
                return build_prompts(*self.prompts(method, hits)).drop("query")
            short = suffixed_snippet(F.col("text")).alias("snippet")
            return hits.select("query_id", "rank", "doc_id", "score", short)
        shared, max_rows = self.hybrid
        hits = self.hits_of(method, shared.filter(F.col("rank") <= HYBRID_DEPTH[method]))
        if method == "hybrid":
            return with_snippets(hits, engine.snippets, max_rows)
        if method == "faiss_with_basics":
            return engine.chunk_in_documents(queries, hits, max_rows).drop("chunk_no")
        texts = with_texts(hits, engine.corpus, max_rows, NO_CONTENT)
        return build_prompts(*self.prompts(method, texts), prompt_when_empty=False).drop("query")


def run_requests(requests: DataFrame, engines: dict[str, Engine]) -> Answers:
    """Answer ``(request_id, query, dataset, method, instruction_key)`` rows.

    Requests are split by dataset and method, and each method runs once for all
    its queries.  Search methods give one row per hit, prompt methods one row per
    request; a result row repeats the query, dataset and method it answers.
    Requests are independent: searches know queries by their text, not by request ids,
    which may repeat, nor by instruction keys, which only prompts differ by.  Results have
    the columns of ``result_schema`` whatever methods are asked for.
    """
    checked = validate(requests, list(engines))
    good = checked.filter(F.col("error").isNull()).drop("error")
    content = F.to_json(F.struct("instruction_key", "query"))  # neither is null
    good = good.withColumns({"query_id": F.sha2("query", 256), "prompt_id": F.sha2(content, 256)})
    rejects = checked.filter(F.col("error").isNotNull())
    # One row per dataset and method at most, however many requests there are.
    present = sorted(map(tuple, good.select("dataset", "method").distinct().collect()))
    id_types = {e.corpus.schema["doc_id"].dataType for e in engines.values()}
    id_type = id_types.pop() if len(id_types) == 1 else T.StringType()
    schema = result_schema(requests.schema["request_id"].dataType, id_type)
    parts, few = [], rows_if_few(good) is not None
    for dataset in sorted({d for d, _ in present}):
        methods = [m for d, m in present if d == dataset]
        mine = good.filter(F.col("dataset") == dataset)
        work = _Dataset(engines[dataset], mine, methods)
        for method in methods:
            answer = work.answer(method)
            echo = mine.filter(F.col("method") == method)
            key = "prompt_id" if method in PROMPT_METHODS else "query_id"
            echo = echo.select("request_id", "query", "dataset", "method", F.col(key).alias("query_id"))
            # a query that very many requests ask is one key: it is not shuffled, or salted
            own = answer.join(F.broadcast(echo), "query_id") if few else join_skewed(echo, answer, ["query_id"])
            parts.append(_in_schema(own, schema))
    if not parts:
        return Answers(requests.sparkSession.createDataFrame([], schema), rejects)
    return Answers(reduce(DataFrame.unionByName, parts), rejects)


def result_schema(request_type: T.DataType, id_type: T.DataType) -> T.StructType:
    """Columns of results; ids are strings where datasets of different id types meet."""
    context = (
        T.StructType()
        .add("doc_id", id_type)
        .add("chunk_no", T.IntegerType())
        .add("text", T.StringType())
        .add("score", T.DoubleType())
    )
    return (
        T.StructType()
        .add("request_id", request_type)
        .add("query", T.StringType())
        .add("dataset", T.StringType())
        .add("method", T.StringType())
        .add("rank", T.IntegerType())
        .add("doc_id", id_type)
        .add("score", T.DoubleType())
        .add("snippet", T.StringType())
        .add("prompt", T.StringType())
        .add("response", T.StringType())
        .add("retrieved_context", T.ArrayType(context))
    )


def _in_schema(answer: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, null where a method does not give them."""
    return answer.select(
        *[
            (F.col(f.name) if f.name in answer.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def get_documents(requests: DataFrame, corpora: dict[str, DataFrame]) -> DataFrame:
    """Contents for ``(request_id, doc_id, dataset)`` rows, with ``error`` where none."""
    missing = F.col("doc_id").isNull() | _absent("dataset")
    missing = missing | (F.col("doc_id").cast("string") == "")
    no_content = F.lit(None).cast("string").alias("content")
    max_rows = rows_if_few(requests)
    known = requests.filter(~missing)
    answered = known.filter(~F.col("dataset").isin(list(corpora))).select("*", no_content)
    asked = known.filter(F.col("dataset").isin(list(corpora))).select("dataset").distinct()
    for dataset in sorted(r["dataset"] for r in asked.collect()):  # at most all corpora
        corpus = corpora[dataset]
        contents = corpus.select(
            F.col("doc_id").alias("_id"), F.col("text").alias("content"), *bucket_names(corpus)
        )
        # an id that its corpus cannot have finds nothing, and fails no other request
        own = F.col("doc_id").cast("string").try_cast(corpus.schema["doc_id"].dataType)
        part = known.filter(F.col("dataset") == dataset).withColumn("_id", own)
        part = look_up(part, contents, "_id", max_rows).drop("_id")
        answered = answered.unionByName(part)
    not_found = F.when(F.col("content").isNull(), F.lit(DOCUMENT_NOT_FOUND))
    bad = requests.filter(missing).select("*", no_content)
    return answered.withColumn("error", not_found).unionByName(
        bad.withColumn("error", F.lit(MISSING_DOCUMENT_FIELDS))
    )
