import random
import re
from collections import Counter

import numpy as np
import pytest

from gleanery.llm import similar

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, k=5):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            root = find(n)
            least[root] = min(i, least.get(root, i))
    return Counter(
        (i, len(s), least.get(find(n)) if s else i) for n, ((i, _), s) in enumerate(zip(rows, sets))
    )


def near_copies(seed, n=260):
    """Chains and stars of edited copies around bases, passages in common, exact copies."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [draw.choice(vocabulary) for _ in range(30)]
    rows, bases = [], [[draw.choice(vocabulary) for _ in range(draw.choice([8, 40, 146]))] for _ in range(6)]
    for i in range(n):
        words = list(draw.choice(bases)) if draw.random() < 0.8 else [draw.choice(vocabulary) for _ in range(60)]
        for _ in range(draw.choice([0, 1, 2, 3, 4, 6])):
            at = draw.randrange(len(words))
            words[at : at + 1] = draw.choice([[], ["the"], [draw.choice(vocabulary)], [words[at].upper()]])
        if draw.random() < 0.3:
            words = words + passage
        if draw.random() < 0.2:
            bases.append(list(words))
        rows.append((i, " ".join(words)))
    return rows


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n long").repartition(4)
    return Counter(tuple(r) for r in similar.jaccard_components(docs, **options).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    assert found(spark, rows) == brute(rows)


def test_no_hubs_and_no_broadcast(spark, monkeypatch):
    """All that the hubs would find is left to the exact completion; ids by a shuffle."""
    monkeypatch.setattr(similar, "MORE_HUBS", 1)
    monkeypatch.setattr(similar, "MORE_PICKS", 1)
    monkeypatch.setattr(similar, "BROADCAST_IDS", 0)
    rows = near_copies(3)
    assert found(spark, rows) == brute(rows)


def test_few_phrases_make_no_pairs_by_the_square(spark, monkeypatch):
    """Unlike texts out of the same frequent phrases: hardly a pair is fetched and compared."""
    draw = random.Random(4)
    phrases = [" ".join(f"p{i}w{j}" for j in range(12)) for i in range(60)]
    rows = [(i, " ".join(draw.sample(phrases, 10))) for i in range(1000)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(20)]
    compared, across = [], similar._across

    def counted(*args):
        pairs = across(*args)
        compared.append(pairs.count())
        return pairs

    monkeypatch.setattr(similar, "_across", counted)
    assert found(spark, rows) == brute(rows)
    assert compared[0] <= len(rows) / 10


def test_parity_never_exceeds_the_difference(spark):
    draw = np.random.default_rng(5)
    pool = draw.integers(0, 1 << 63, 900, dtype=np.uint64)
    for _ in range(300):
        a, b = (draw.choice(pool, draw.integers(0, 800), replace=False) for _ in "ab")
        differ = int(np.bitwise_count((similar._parity(a) ^ similar._parity(b)).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(a, b)) and (differ - len(np.setxor1d(a, b))) % 2 == 0


def test_edge_rows(spark):
    long_text = " ".join(f"x{i}" for i in range(30000))
    rows = [(5, "a b"), (3, "A B"), (5, "a b"), (7, None), (8, ""), (9, " \n"), (None, "a b"), (None, "q r s t u v"),
            (10, "one"), (11, long_text), (12, long_text + " end"), (13, "a b c d e"), (13, "other text of five words")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == Counter()
