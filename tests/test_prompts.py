import random

from pyspark.sql import functions as F

from gleanery.operators.prompts import (
    INSTRUCTIONS,
    NO_CONTENT,
    NOTHING_FOUND,
    build_prompts,
    context_budget,
    instruction,
    pack_passages,
)
from gleanery.operators.ranking import with_texts

RETRIEVED = "query_id LONG, rank INT, doc_id LONG, text STRING, score DOUBLE"


def asked(spark, *rows):
    return spark.createDataFrame(rows, "query_id LONG, query STRING, instruction_key STRING")


def test_instructions(spark):
    rows = asked(spark, (1, "q", "comparative"), (2, "q", "nonsense"), (3, "q", None))
    got = {r[0]: r[1] for r in rows.select("query_id", instruction(F.col("instruction_key"))).collect()}
    assert got == {1: INSTRUCTIONS["comparative"], 2: INSTRUCTIONS["default"], 3: INSTRUCTIONS["default"]}


def greedy(passages, budget):
    """The packing loop in plain Python: stop at the first that does not fit."""
    taken, used = [], 0
    for place, tokens in passages:
        if used + tokens > budget:
            break
        taken.append(place)
        used += tokens
    return taken


def test_packing_equals_the_greedy_loop(spark):
    rng = random.Random(3)
    queries, hits, want = [], [], {}
    for q in range(60):
        query = "what " * rng.randint(1, 30)
        base = len((INSTRUCTIONS["bullet_points"] + "\n\nQuestion: " + query + "\nAnswer:").split())
        queries.append((q, query, "bullet_points"))
        rows = []
        for rank in range(1, rng.randint(1, 9)):
            text, score = "w " * rng.randint(0, 200), rng.choice([0.1, 0.5, 0.5, 0.9])
            hits.append((q, rank, rank * 10, text, score))
            rows.append((-score, rank, len(f"Document (ID: {rank * 10}): {text}".split())))
        want[q] = greedy([(rank, n) for _, rank, n in sorted(rows)], 512 - base - 50)
    packed = pack_passages(asked(spark, *queries), spark.createDataFrame(hits, RETRIEVED))
    got = {q: [] for q in want}
    for r in packed.filter("packed").orderBy("query_id", F.desc("score"), "rank").collect():
        got[r["query_id"]].append(r["rank"])
    assert got == want
    assert any(len(v) < 3 for v in want.values()) and any(len(v) > 3 for v in want.values())


def test_negative_budget_packs_nothing(spark):
    queries = asked(spark, (1, "why " * 600, "default"))
    hits = spark.createDataFrame([(1, 1, 5, "", 0.9)], RETRIEVED)
    assert queries.select(context_budget(F.col("query"), F.col("instruction_key"))).first()[0] < 0
    row = build_prompts(queries, hits).first()
    assert "Document" not in row["prompt"]
    assert [tuple(e) for e in row["retrieved_context"]] == [(5, None, "", 0.9)]


def test_own_token_counter(spark):
    queries = asked(spark, (1, "q", "default"))
    hits = spark.createDataFrame([(1, 1, 5, "x" * 30, 0.9), (1, 2, 6, "y", 0.8)], RETRIEVED)
    size = len(INSTRUCTIONS["default"] + "\n\nQuestion: q\nAnswer:")
    row = build_prompts(queries, hits, max_tokens=size + 50 + 40, token_count=F.length).first()
    assert "Document" not in row["prompt"]  # the first does not fit, so the second is not tried
    row = build_prompts(queries, hits, max_tokens=size + 50 + 50, token_count=F.length).first()
    assert "(ID: 5)" in row["prompt"] and "(ID: 6)" not in row["prompt"]


def test_prompt_text(spark):
    queries = asked(spark, (1, "why?", "default"), (2, "how?", None))
    hits = spark.createDataFrame([(1, 1, None, None, 0.5), (1, 2, 7, "later but better", 0.9)], RETRIEVED)
    got = {r["query_id"]: r for r in build_prompts(queries, hits).collect()}
    assert got[1]["prompt"] == (
        INSTRUCTIONS["default"]
        + "\n\nContext:\n\nDocument (ID: 7): later but better\n\nDocument (ID: N/A): "
        + "\n\nQuestion: why?\nAnswer:"
    )
    assert [tuple(e) for e in got[1]["retrieved_context"]] == [
        (None, None, None, 0.5),
        (7, None, "later but better", 0.9),
    ]
    assert got[2]["prompt"] == INSTRUCTIONS["default"] + "\n\nContext:\n\nQuestion: how?\nAnswer:"
    assert got[2]["retrieved_context"] == [] and got[2]["response"] is None
    fixed = {r["query_id"]: r for r in build_prompts(queries, hits, prompt_when_empty=False).collect()}
    assert fixed[2]["prompt"] is None and fixed[2]["response"] == NOTHING_FOUND
    assert fixed[1]["prompt"] == got[1]["prompt"] and fixed[1]["response"] is None


def test_missing_texts_get_the_fixed_phrase(spark):
    hits = spark.createDataFrame([(1, 1, 5, 0.9), (1, 2, 6, 0.8)], "query_id LONG, rank INT, doc_id LONG, score DOUBLE")
    corpus = spark.createDataFrame([(5, "five")], "doc_id LONG, text STRING")
    for bound in [2, None]:
        got = {r["doc_id"]: r["text"] for r in with_texts(hits, corpus, bound, NO_CONTENT).collect()}
        assert got == {5: "five", 6: NO_CONTENT}
