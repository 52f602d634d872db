import random
import re
from collections import Counter
from itertools import pairwise

import pytest

from gleanery.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count=10, inside=50, top=2000):
    counts = {}
    for text, lang in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                f.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        size = sum(n for p, n in f.items() if len(p) == 1)
        able = {p: n for p, n in f.items() if n >= min_count and len(p) > 1}
        gone = {q for p, n in able.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * n >= inside * f[q]}
        scored = []
        for p, a in able.items():
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, size, -score))
    return Counter(out)


def texts(seed, n=400):
    draw = random.Random(seed)
    fixed = [[f"f{draw.randrange(40)}" for _ in range(draw.randrange(2, 5))] for _ in range(30)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randrange(30)):
            parts += draw.choice(fixed) if draw.random() < 0.5 else [f"W{int(draw.paretovariate(0.8))}é"]
            parts[-1] += draw.choice(["", "", "", ",", "\n", ". "])
        rows.append((draw.choice([" ", "\t "]).join(parts), draw.choice(["en", "en", "de", None, "und"])))
    return rows


def found(spark, rows, **options):
    docs = spark.createDataFrame([(t, c, 1, 2, "n") for t, c in rows], "text string, lang string, a long, score long, n string")
    return Counter(map(tuple, collocations.mine(docs.repartition(4), **options).collect()))


@pytest.mark.parametrize("seed, options", [(1, {}), (3, {"top": 2, "min_count": 5, "inside": 90})])
def test_equals_brute_force(spark, seed, options, monkeypatch):
    """Small blocks make languages settle in different rounds."""
    monkeypatch.setattr(collocations, "PART", 300)
    monkeypatch.setattr(collocations, "GROWTH", 4)
    rows = texts(seed)
    want = brute(rows, **options)
    assert want and found(spark, rows, **options) == want


def test_ties_and_the_tied_end_of_the_list(spark):
    rows = [(f"a{i} b{i}, " * 12, "en") for i in range(30)] + [("x y z. " * 12 + "x y. " * 12, "en")]
    assert found(spark, rows, top=7) == brute(rows, top=7)


def test_edge_rows(spark):
    rows = [(None, None), ("", "en"), ("one two " * 5, None), ("one two " * 5, "und"), ("a\x00b c. " * 20, "fr"), ("z " * 30_000, "en")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == Counter()
    assert found(spark, [("rare words only", "en")]) == Counter()


def test_scores_are_exact_beyond_64_bits(spark):
    pairs = [(10**13 - 1, 10**13 + 7, 10**13 + 9), (3, 7, 10), (10**15 - 1, 10**15 - 1, 10**15 - 1)]
    df = spark.createDataFrame(pairs, "a long, l long, r long").select("*", collocations._ratio("a", "l", "r").alias("s"))
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in df.collect())
