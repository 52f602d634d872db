import hashlib

import re

import pytest
import xxhash

from gleanery.llm import fingerprints as fp

MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def elements(text, k=6, s=2, pad=4):
    """Closed syncmers by definition."""
    tokens = re.findall("[^\x20\x09-\x0d]{1,32}", text)
    if not tokens:
        return []
    t = [""] * pad + tokens + [""] * pad
    inner = []
    for i in range(len(t) - s + 1):
        h = 42
        for w in t[i : i + s]:
            h = xxhash.xxh64(w.encode(), seed=h).intdigest()
        inner.append(signed(h))
    at = []
    for i in range(len(t) - k + 1):
        run = inner[i : i + k - s + 1]
        if i < pad or min(run[0], run[-1]) <= min(run[1:-1]):
            at.append(i)
    out = []
    for n, i in enumerate(at):
        h = 42
        for d in range(0, k - s + 1, s):
            h = xxhash.xxh64((inner[i + d] & MASK).to_bytes(8, "little"), seed=h).intdigest()
        out.append((h & 0xFFFFFFFF) * 16 + min(15, at[n + 1] - i if n + 1 < len(at) else 0))
    return out


ROWS = [(i, f"word{i % 7} " + " ".join(f"w{(i * 31 + j * j) % 97}é" for j in range(i % 90))) for i in range(700)]
ROWS += [(700, None), (701, ""), (702, "  \n"), (703, "x"), (704, ROWS[50][1]), (705, "long " * 20000)]


def likeness(a, b):
    a, b = set(a), set(b)
    return 1.0 if not a | b else 2 * len(a & b) / (len(a) + len(b))


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in ROWS], "doc_id long, text string, fingerprint string")
    found = {r.doc_id: r for r in fp.compare_with_next(docs.repartition(5)).collect()}
    order = sorted(ROWS, reverse=True, key=lambda r: r[0])
    assert len(found) == len(ROWS)
    for n, (i, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        r, own = found[i], elements(text)
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{x:09X}" for x in own)
        assert r.edited_fingerprint == "".join(f"{x:09X}" for x in elements(edited))
        assert abs(r.near_edited - likeness(own, elements(edited))) < 1e-12
        assert abs(r.near_next - likeness(own, elements(after))) < 1e-12


def test_repeated_and_null_keys_and_few_rows(spark):
    for rows in ([(5, "a b c d e f g h")], [(None, "one text"), (None, "two texts")], [(1, "b"), (1, "b"), (1, "a"), (None, "z")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = fp.compare_with_next(docs).collect()
        assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
    assert fp.compare_with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("kind", ["string", "date", "double"])
def test_keys_of_any_type(spark, kind):
    rows = [(i, f"word{i} " + " ".join(f"w{(i * 7 + j) % 50}" for j in range(i % 40))) for i in range(900)]
    cast = {"string": "concat('a', lpad(id, 5, '0'))", "date": "date_add(date'2000-01-01', cast(id as int))", "double": "id / 7d"}
    docs = spark.createDataFrame(rows + [(None, "no key")], "id long, text string")
    whole = {r.n: r for r in fp.compare_with_next(docs.withColumnRenamed("id", "doc_id")).withColumnRenamed("doc_id", "n").collect()}
    made = docs.selectExpr(f"{cast[kind]} as doc_id", "text", "id")
    names = {r.doc_id: r.id for r in made.collect()}
    for r in fp.compare_with_next(made.drop("id")).collect():
        assert tuple(r)[1:] == tuple(whole[names[r.doc_id]])[1:]


def test_text_form_reads_back(spark):
    df = fp.with_elements(spark.createDataFrame([("some words in a row for a print",)], "t string"), "t", "e")
    row = df.select("e", fp.from_text(fp.as_text(df.e)).alias("back")).first()
    assert row.e == row.back and row.e
