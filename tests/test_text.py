from pyspark.sql import functions as F

from gleanery.functions import text as t
from gleanery.functions.vectors import pair_cosine, pair_dot, rounded, unit
from gleanery.operators import cleaning
from gleanery.operators.cleaning import Lemmas, clean, noun_lemmas, vocabulary
from gleanery.operators.sparse import bag_of_words, bag_rows


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, text STRING")
    rows = df.select("i", expression(F.col("text")).alias("out")).collect()
    return [r["out"] for r in sorted(rows)]


def test_punctuation_is_deleted_not_spaced(spark):
    given = ["don't", "a-b", "x…y", string_of_all()]
    assert column(spark, given, t.delete_punctuation) == ["dont", "ab", "x…y", ""]


def string_of_all():
    return "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def test_normalising_in_one_pass_equals_the_single_steps(spark):
    given = ["A1-b٣C", None, "É’s 42%", string_of_all() + "ok"]
    steps = lambda c: t.delete_digits(t.delete_punctuation(F.lower(t.text_or_blank(c))))
    want = ["abc", "", "é’s ", "ok"]
    assert column(spark, given, t.normalise_text) == want
    assert column(spark, given, steps) == want


def test_white_space_of_every_kind_separates(spark):
    given = ["a b c\x1dd\x85e\tf　", "", None, "  "]
    assert column(spark, given, t.split_words) == [list("abcdef"), [], [], []]


def test_contractions_and_quotes_are_cut(spark):
    given = ["i cannot go", "gonna—wanna", "scannot cannots", "“quoted”", "gimme lemme gotta"]
    assert column(spark, given, t.word_tokens) == [
        ["i", "can", "not", "go"],
        ["gon", "na", "—", "wan", "na"],
        ["scannot", "cannots"],
        ["“", "quoted", "”"],
        ["gim", "me", "lem", "me", "got", "ta"],
    ]


def test_stop_words_go_but_apostrophe_forms_stay_without_apostrophe(spark):
    given = ["The cat isn't on THE mat", "cannot"]
    assert column(spark, given, t.content_words) == [["cat", "isnt", "mat"], []]
    assert len(set(t.STOP_WORDS)) == 179


def test_snippets(spark):
    long, exact = "é" * 151, "y" * 150
    assert column(spark, [long, exact, None], t.snippet) == ["é" * 150 + "...", exact, ""]
    assert column(spark, [exact, None], t.suffixed_snippet) == [exact + "...", "..."]


def test_lemmas_need_the_singular_in_the_vocabulary(spark):
    docs = spark.createDataFrame(
        [
            (1, "cats cat buses bus ladies lady"),
            (2, "wolves wolf women woman boxes box"),
            (3, "dogs glass churches church asses as ass"),
        ],
        "doc_id LONG, text STRING",
    )
    found = {r["word"]: r["lemma"] for r in noun_lemmas(vocabulary(docs)).collect()}
    assert found == {
        "cats": "cat",
        "buses": "bus",
        "ladies": "lady",
        "wolves": "wolf",
        "women": "woman",
        "boxes": "box",
        "churches": "church",
        "asses": "ass",
    }


def test_lemmas_need_evidence(spark):
    """A stray misspelling is no lemma of a frequent word, and some endings never strip."""
    rows = [(i, "class focus basis notes") for i in range(60)] + [(98, "note"), (99, "clas focu basi")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    words = vocabulary(docs)
    assert noun_lemmas(words).collect() == []
    assert [(r["word"], r["lemma"]) for r in noun_lemmas(words, support=60).collect()] == [("notes", "note")]
    more = docs.union(spark.createDataFrame([(100, "note")], docs.schema))
    assert [(r["word"], r["lemma"]) for r in noun_lemmas(vocabulary(more)).collect()] == [("notes", "note")]


def test_a_word_has_one_lemma_everywhere(spark):
    """The bag and the cleaned text agree on a table with two lemmas for a word."""
    pairs = spark.createDataFrame([("cars", "car", 1), ("cars", "auto", 1)], "word STRING, lemma STRING, n_docs LONG")
    docs = spark.createDataFrame([(1, "red cars")], "doc_id LONG, text STRING")
    for n in (10, 0):
        lemmas = Lemmas(pairs, max_pairs=n)
        bag = sorted(r["term"] for r in bag_rows(bag_of_words(docs, lemmas)).collect())
        assert bag == sorted(clean(docs, "text", lemmas).first()["tokens"]) == ["auto", "red"]


def test_fixed_values():
    """What the SQL twins take from the code, asserted literally."""
    assert cleaning.NOUN_ENDINGS == {
        "s": "", "ses": "s", "ves": "f", "xes": "x", "zes": "z", "ches": "ch", "shes": "sh", "men": "man", "ies": "y",
    }
    assert cleaning.SINGULAR_ENDINGS == ["ss", "us", "is"] and cleaning.SUPPORT == 50
    assert t.PUNCTUATION == "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" and t.SNIPPET_LENGTH == 150
    assert len(t.STOP_WORDS) == 179 and {"the", "of", "does"} <= set(t.STOP_WORDS)


def test_stop_words_go_before_lemmas(spark):
    # "does" is a stop word; its would-be lemma is never reached.
    docs = spark.createDataFrame([(1, "does doe does haves have")], "doc_id LONG, text STRING")
    pairs = spark.createDataFrame([("does", "doe", 1)], "word STRING, lemma STRING, n_docs LONG")
    row = clean(docs, "text", Lemmas(pairs)).first()
    assert row["cleaned"] == "doe haves" and row["tokens"] == ["doe", "haves"]


def test_lemmas_by_join_equal_lemmas_by_dictionary(spark):
    docs = spark.createDataFrame(
        [(1, "cats chase dogs cats"), (2, ""), (3, None), (4, "nothing known")],
        "doc_id LONG, text STRING",
    )
    pairs = spark.createDataFrame(
        [("cats", "cat", 1), ("dogs", "dog", 1)], "word STRING, lemma STRING, n_docs LONG"
    )
    small = clean(docs, "text", Lemmas(pairs)).select("doc_id", "tokens", "cleaned")
    large = clean(docs, "text", Lemmas(pairs, max_pairs=1)).select("doc_id", "tokens", "cleaned")
    want = [
        (1, ["cat", "chase", "dog", "cat"], "cat chase dog cat"),
        (2, [], ""),
        (3, [], ""),
        (4, ["nothing", "known"], "nothing known"),
    ]
    assert sorted(map(tuple, small.collect())) == want
    assert sorted(map(tuple, large.collect())) == want


def test_no_lemmas_at_all(spark):
    docs = spark.createDataFrame([(1, "cats")], "doc_id LONG, text STRING")
    empty = spark.createDataFrame([], "word STRING, lemma STRING, n_docs LONG")
    assert clean(docs, "text", Lemmas(empty)).first()["cleaned"] == "cats"
    assert cleaning.NOUN_ENDINGS["men"] == "man"


def test_vector_columns(spark):
    df = spark.createDataFrame(
        [([3.0, 4.0], [6.0, 8.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, 0.0], [-1e-9, 1.0])],
        "a ARRAY<FLOAT>, b ARRAY<FLOAT>",
    )
    score = rounded(pair_cosine(F.col("a"), F.col("b")), 6).alias("score")
    product = pair_dot(F.col("a"), F.col("b")).alias("dot")
    rows = df.select(unit(F.col("a")).alias("u"), score, product).collect()
    assert [r["dot"] for r in rows][:2] == [50.0, 0.0]
    assert rows[0]["u"] == [0.6000000238418579, 0.800000011920929]
    assert rows[1]["u"] == [0.0, 0.0]
    assert [str(r["score"]) for r in rows] == ["1.0", "0.0", "0.0"]


def test_both_lemma_paths_treat_rows_by_themselves(spark):
    rows = [(1, "red cars"), (1, "blue cars"), (None, "cars bikes"), (None, "cars"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = spark.createDataFrame(
        [("cars", "car", None), ("cars", "caro", 3), ("bikes", "bike", None)],
        "word string, lemma string, n_docs long",
    )
    got = [
        sorted(r["cleaned"] for r in clean(docs, "text", Lemmas(pairs, max_pairs=n)).collect())
        for n in (10, 0)
    ]
    assert got[0] == got[1] == ["", "blue car", "car", "car bike", "red car"]
