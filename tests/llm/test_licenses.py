import random
import re
from collections import Counter

from gleanery.llm import licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, labels string, h long, k long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text):
    """Base columns by the definition."""
    w = words(text)
    places = [
        (i, t.label) for t in licenses.BASE for i in range(len(w)) if w[i : i + len(t.text.split())] == t.text.split()
    ]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    return licenses.scan(docs, **options).collect()


def base(r):
    return r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)


def test_base_equals_brute_force(spark, monkeypatch):
    draw = random.Random(3)
    pool = "mit license apache general public GPL License, é".split()
    rows = [(i, " ".join(draw.choice(pool) for _ in range(draw.randrange(60)))) for i in range(200)]
    for size in (licenses.PART, 64):
        monkeypatch.setattr(licenses, "PART", size)
        got = found(spark, rows)
        assert Counter(base(r) for r in got) == Counter((i, brute(t)) for i, t in rows)


def test_notices_with_changes_are_found_and_prose_is_not(spark):
    mit = next(t.text for t in licenses.NOTICES if t.label == "mit").split()
    bsd = next(t.text for t in licenses.NOTICES if t.label == "bsd")
    changed = mit[:20] + ["well"] + mit[20:50] + mit[52:]
    half = mit[: len(mit) // 2]
    rows = [(1, "Intro. " + " ".join(changed) + " outro"), (2, " ".join(half)), (3, bsd.upper() + " Licensed under CC-BY-NC 4.0"),
            (4, "cc by 4 nc 0 apache license version 3"), (5, " ".join(reversed(mit))), (6, " ".join(changed) + " filler " * 500 + bsd)]
    got = {r.doc_id: (r.labels, r.base_labels) for r in found(spark, rows)}
    assert got == {1: ("mit", ""), 2: ("", ""), 3: ("bsd,cc-by-nc-4.0", ""), 4: ("apache", "apache"), 5: ("", ""), 6: ("bsd,mit", "")}
    scores = {r.doc_id: r.score for r in found(spark, rows)}
    assert scores[2] == 0 and scores[3] == 1 and 0.9 < scores[1] < 1


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    rows = [(i, "the mit license " * (i % 4) + " ".join(f"w{j}" for j in range(i))) for i in range(40)]
    want = Counter(map(tuple, found(spark, rows)))
    monkeypatch.setattr(licenses, "BROADCAST_GRAMS", 0)
    monkeypatch.setattr(licenses, "BROADCAST_TEXTS", 0)
    assert Counter(map(tuple, found(spark, rows))) == want


def test_edge_rows(spark):
    long_text = "filler " * 300_000 + "mit license " * 1000
    rows = [(None, None), (None, "MIT License"), (1, ""), (1, "mit license"), (1, "mit license"), (2, "mit\x00licensé"), (3, long_text)]
    got = found(spark, rows)
    assert Counter(base(r) for r in got) == Counter((i, brute(t)) for i, t in rows)
    assert found(spark, []) == []
