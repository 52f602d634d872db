import math
import random
import re
from collections import Counter

import pytest

from gleanery.llm import lexical

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [t.translate(LOWER) for t in found]


def brute(docs, items, top=50):
    counted = [(key, Counter(terms(text))) for key, text in docs]
    counted = [(key, tf) for key, tf in counted if tf]
    n_docs, n_all = len(counted), sum(sum(tf.values()) for _, tf in counted)
    df = Counter(t for _, tf in counted for t in tf)
    out = []
    for item, text in items:
        rows = []
        for key, tf in counted:
            m = 100 - 50 + 50 * sum(tf.values()) * n_docs // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in set(terms(text)) if tf[t]
            )
            if score > 0:
                rows.append((-score, key is None, key or 0, key))
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(sorted(rows)[:top], 1)]
    return Counter(out)


def found(spark, docs, items, **options):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score long, item long").repartition(4)
    items = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, block long")
    return Counter(map(tuple, lexical.search(docs, items, **options).collect()))


def sample(seed, n=300):
    draw = random.Random(seed)

    def text(words):
        return draw.choice([" ", "--", "\n"]).join(draw.choice(["T{}", "t{}", "é{}"]).format(int(draw.paretovariate(0.6)) % 400) for _ in range(words))

    return [(i, text(draw.randrange(40))) for i in range(n)], [(i, text(draw.randrange(12))) for i in range(25)]


@pytest.mark.parametrize("part, block, pairs", [(1 << 20, 1 << 20, 1 << 20), (100, 200, 16)])
def test_equals_brute_force(spark, part, block, pairs, monkeypatch):
    """Small bounds cut texts, items and sums into several steps."""
    for name, value in (("PART", part), ("BLOCK_BYTES", block), ("PAIRS", pairs)):
        monkeypatch.setattr(lexical, name, value)
    docs, items = sample(1)
    assert found(spark, docs, items, top=7) == brute(docs, items, top=7)


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words here") for i in range(200)] + [(500, "other")]
    assert found(spark, docs, [(1, "words")]) == brute(docs, [(1, "words")])


def test_edge_rows(spark):
    docs = [(None, "red fox"), (1, None), (2, ""), (3, "red"), (3, "red"), (4, "Red " * 50_000 + "FOX"), (5, ".;"), (6, "réd\x00fox")]
    items = [(1, "red fox RED"), (2, None), (3, ""), (4, "absent"), (None, "fox"), (1, "réd")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, docs[1:3], items) == Counter()


def test_a_task_keeps_the_best_only(spark, monkeypatch):
    docs = [(i, "common " * (1 + i % 7) + f"w{i % 50}") for i in range(5000)]
    items = [(0, "common"), (1, "w3 common")]
    assert found(spark, docs, items, top=3) == brute(docs, items, top=3)
