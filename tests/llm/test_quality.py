import random
import re
from collections import Counter

import pytest

from gleanery.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, kept string"
CLEAN = "The first sentence of this page has enough words to be read by itself.\n" \
        "A second line follows it, and it says something else about another thing altogether."
CASES = [
    (1, CLEAN, "x"), (1, CLEAN, "x"), (2, None, None), (3, "", ""), (None, "\n \t\n", None),
    (4, "word " * 40, "y"), (5, CLEAN + "\nAll rights reserved.", "z"),
    (6, "\n".join(["Home | News | Sport | Other | Login | Help"] * 1 + ["one | two | three | four | five"] * 6), "n"),
    (7, CLEAN + "\n" + CLEAN, "r"), (8, "Wörter über Größe. " * 3000, "long"), (9, "a b c d e f g h " * 2, "w"),
]


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    at = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(at),
    )


@pytest.fixture(scope="module")
def judged(spark):
    return quality.judge(spark.createDataFrame(CASES, SCHEMA)).collect()


def test_base_counts_equal_brute_force(judged):
    texts = sorted((t or "") for _, t, _ in CASES)
    found = sorted(
        (r.text or "", r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in judged
    )
    assert found == [(t, *base(t)) for t in texts]


def test_verdicts(judged):
    kept = {r.doc_id: r.kept for r in judged}
    assert kept == {1: True, 2: False, 3: False, None: False, 4: False, 5: True, 6: False, 7: False, 8: False, 9: False}
    by_id = {r.doc_id: r for r in judged}
    assert by_id[1].cleaned == CLEAN and by_id[5].cleaned == CLEAN and by_id[5].lost_words == 3
    assert len(judged) == len(CASES)  # repeated rows stay, the clashing column is replaced


def test_long_clean_line_stays_and_long_repeating_lines_go(spark):
    draw = random.Random(1)
    weights = [1 / (i + 10) for i in range(9000)]
    prose = draw.choices([f"word{i}" for i in range(9000)], weights, k=40000)
    few = draw.choices([f"word{i}" for i in range(60)], k=3000)
    passage = prose[:700]
    assert len(set(prose)) < 0.4 * len(prose)
    rows = [(1, " ".join(prose)), (2, "\n".join(" ".join(prose[i : i + 50]) for i in range(0, len(prose), 50))),
            (3, "\n".join([" ".join(prose[:20000]), " ".join(few)])), (4, "\n".join([" ".join(prose), " ".join(passage * 5)]))]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[2].kept and got[1].lost_words == 0 and got[1].cleaned == rows[0][1]
    assert got[3].lost_words == 3000 and got[4].lost_words == 3500


def test_empty_table_and_filter_on_the_verdict(spark):
    rows = quality.judge(spark.createDataFrame([], SCHEMA))
    assert rows.filter("kept").count() == 0 and "cleaned" in rows.columns


def test_no_python_in_the_plan(spark):
    plan = quality.judge(spark.createDataFrame(CASES, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_fixed_values():
    """What the SQL twin takes from the code, or repeats, asserted literally."""
    assert quality.SYMBOLS == "#*$%&|<>"
    assert quality.CLOSED == r"""[.!?…:;"'”’»)\]]\z"""
    assert quality.BOILERPLATE == (
        "(?i)all rights reserved|licensed under|released under|terms of (use|service)|"
        "privacy policy|accept cookies|uses cookies|enable javascript|click here to|subscribe to our"
    ).replace("released under|", "released under the|")
    rules = quality.LineRules()
    assert (rules.block_words, rules.run_words, rules.rerun_share, rules.distinct_share) == (500, 8, 15, 40)


def test_sql_judges_long_lines_alike(spark):
    import duckdb

    from gleanery.llm.queries import SQL

    draw = random.Random(2)
    few = [f"w{i}" for i in range(150)]
    rows = [
        (1, " ".join(draw.choice(few) for _ in range(3000)) + "."),
        (2, " ".join(f"v{i // 6}x{i % 6}" for i in range(1500)) + "."),
        (3, " ".join(f"u{i % 240}" for i in range(1200)) + "."),
        (4, " ".join(draw.choice(few[:30]) for _ in range(900)) + "."),
        (5, " ".join(f"a{i % 600}" for i in range(2400)) + "."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_repeat_words, r.base_failed, r.kept) for r in quality.judge(docs).collect()}
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    answer = db.execute("SELECT doc_id, n_words, n_repeat_words, base_failed, kept FROM (" + SQL["op9_quality_rules"] + ")")
    assert {r[0]: r[1:] for r in answer.fetchall()} == got
