"""Retrieved passages packed into token-budgeted prompts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.text import word_count

# The instruction that opens a prompt, by key.
INSTRUCTIONS = {
    "default": "You are a helpful assistant. Based on the provided context, answer the question. If the context does not contain enough information, state that the documents did not contain the answer. Summarize the relevant points from the context to form your answer.",
    "comparative": "You are a highly analytical assistant. Your primary goal is to compare and contrast concepts from the provided context. Structure your answer to clearly highlight the similarities and differences.",
    "bullet_points": "You are a concise assistant. Your task is to answer the question by extracting key information from the context and presenting it as a bulleted list. Keep each point brief and to the point.",
    "beginner_friendly": "You are a friendly and patient teacher. Explain the answer to the user's question in simple, easy-to-understand terms. Use analogies if they help clarify complex topics from the context.",
}

# The prompt limit, the tokens kept in reserve, and two set phrases.
MAX_TOKENS = 512
RESERVED_TOKENS = 50
NO_CONTENT = "Content not found."
NOTHING_FOUND = "Could not find any relevant documents to generate an answer."

CONTEXT_TYPE = "array<struct<doc_id:{id},chunk_no:int,text:string,score:double>>"


def instruction(key: Column) -> Column:
    """The instruction of a key; an unknown or missing key means the default one."""
    texts = F.create_map(*[F.lit(part) for pair in INSTRUCTIONS.items() for part in pair])
    return F.coalesce(F.try_element_at(texts, key), F.lit(INSTRUCTIONS["default"]))


def passage(doc_id: Column, text: Column) -> Column:
    """How one retrieved text appears in the prompt."""
    shown_id = F.coalesce(doc_id.cast("string"), F.lit("N/A"))
    return F.concat(
        F.lit("Document (ID: "), shown_id, F.lit("): "), F.coalesce(text, F.lit(""))
    )


def context_budget(
    question: Column,
    key: Column,
    max_tokens: int = MAX_TOKENS,
    token_count: Callable[[Column], Column] = word_count,
) -> Column:
    """Tokens left for passages once instruction, question and reserve are charged."""
    frame = F.concat(instruction(key), F.lit("\n\nQuestion: "), question, F.lit("\nAnswer:"))
    return F.lit(max_tokens - RESERVED_TOKENS) - token_count(frame)


def pack_passages(
    queries: DataFrame,
    retrieved: DataFrame,
    max_tokens: int = MAX_TOKENS,
    token_count: Callable[[Column], Column] = word_count,
) -> DataFrame:
    """Mark the retrieved rows that fit: adds ``passage``, ``tokens`` and ``packed``.

    ``queries`` has ``(query_id, query, instruction_key)`` and ``retrieved`` has
    ``(query_id, rank, doc_id, text, score)``.  Passages go in by descending score
    until the first one that does not fit; none after it is tried.
    """
    budgets = queries.select(
        "query_id",
        context_budget(F.col("query"), F.col("instruction_key"), max_tokens, token_count).alias(
            "budget"
        ),
    )
    charged = retrieved.withColumn("passage", passage(F.col("doc_id"), F.col("text")))
    charged = charged.withColumn("tokens", token_count(F.col("passage")))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("rank"))
    up_to_here = by_score.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        charged.join(budgets, "query_id")
        .withColumn("_used", F.sum("tokens").over(up_to_here))
        .withColumn("packed", F.col("_used") <= F.col("budget"))
        .drop("_used")
    )


def build_prompts(
    queries: DataFrame,
    retrieved: DataFrame,
    prompt_when_empty: bool = True,
    max_tokens: int = MAX_TOKENS,
    token_count: Callable[[Column], Column] = word_count,
) -> DataFrame:
    """One row per query: ``(query_id, query, prompt, response, retrieved_context)``.

    The context lists every retrieved row, also those that did not fit, with the number of
    its chunk where chunks were retrieved.  A query
    with nothing retrieved gets a prompt with a bare context header, or, without
    ``prompt_when_empty``, a fixed response and no prompt.  A query's rows are the
    few that a top-k search left it, so gathering them is bounded by that ``k``.
    """
    id_type = retrieved.schema["doc_id"].dataType.simpleString()
    context_type = CONTEXT_TYPE.format(id=id_type)
    packed = pack_passages(queries, retrieved, max_tokens, token_count)
    chunk = F.col("chunk_no") if "chunk_no" in retrieved.columns else F.lit(None).cast("int").alias("chunk_no")
    entry = F.struct(
        F.negate("score").alias("_down"), "rank", "doc_id", chunk, "text", "score", "passage", "packed"
    )
    gathered = packed.groupBy("query_id").agg(F.array_sort(F.collect_list(entry)).alias("_all"))
    joined = queries.join(gathered, "query_id", "left").withColumn(
        "_all", F.coalesce("_all", F.array().cast(gathered.schema["_all"].dataType))
    )
    parts = F.transform(F.filter("_all", lambda e: e["packed"]), lambda e: e["passage"])
    in_order = F.array_sort(
        F.transform(
            "_all", lambda e: F.struct(e["rank"], e["doc_id"], e["chunk_no"], e["text"], e["score"])
        )
    )
    context = F.transform(
        in_order, lambda e: F.struct(e["doc_id"], e["chunk_no"], e["text"], e["score"])
    ).cast(context_type)
    prompt = F.concat(
        instruction(F.col("instruction_key")),
        F.lit("\n\n"),
        F.array_join(F.concat(F.array(F.lit("Context:")), parts), "\n\n"),
        F.lit("\n\nQuestion: "),
        F.col("query"),
        F.lit("\nAnswer:"),
    )
    if prompt_when_empty:
        response = F.lit(None).cast("string")
    else:
        nothing = F.size("_all") == 0
        prompt = F.when(~nothing, prompt)
        response = F.when(nothing, F.lit(NOTHING_FOUND))
    return joined.select(
        "query_id",
        "query",
        prompt.alias("prompt"),
        response.alias("response"),
        context.alias("retrieved_context"),
    )
