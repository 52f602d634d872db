import hashlib
import random
from collections import Counter

import pytest

from gleanery.llm import substrings


def brute(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    counts = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, texts):
        gone = {j for i in range(len(w) - window + 1) if counts[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def passages(seed, n=300):
    draw = random.Random(seed)
    shared = [[f"s{draw.randrange(50)}" for _ in range(draw.randrange(20, 90))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(draw.randrange(5)):
            words += [f"w{draw.randrange(3000)}é" for _ in range(draw.randrange(40))]
            if draw.random() < 0.4:
                passage = draw.choice(shared)
                a = draw.randrange(10)
                words += passage[a : a + draw.randrange(10, 80)]
        rows.append((i, draw.choice([" ", "\n", " \t "]).join(words)))
    return rows


def found(spark, rows, window):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, k long").repartition(5)
    result = substrings.remove_repeats(docs, window=window, with_text=True).collect()
    for r in result:
        assert r.kept.encode().split() == r.kept_words.encode().split()
        assert sum(s.length for s in r.spans) >= r.n_removed and (window <= s.length for s in r.spans)
    return Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_words.encode()).hexdigest()) for r in result)


@pytest.mark.parametrize("seed, window", [(1, 35), (2, 12)])
def test_equals_brute_force(spark, seed, window, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", 64)
    rows = passages(seed)
    assert found(spark, rows, window) == brute(rows, window)


def test_edge_rows(spark):
    repeat = "again " * 100
    rows = [(1, None), (1, ""), (2, " \n\t"), (3, repeat), (None, "x " * 34), (None, "y " * 35), (4, "z " * 36),
            (5, " ".join(map(str, range(40)))), (5, " ".join(map(str, range(40)))), (6, "long " + " ".join(map(str, range(50000))))]
    assert found(spark, rows, 35) == brute(rows, 35)
    assert found(spark, [], 35) == Counter()
    assert found(spark, rows[:3], 35) == brute(rows[:3], 35)
