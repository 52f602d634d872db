"""A training corpus from the documents table, stage by stage.

Each stage takes what its predecessor kept; its result is written as Parquet and read
again.  Rows are those of ``documents`` with all their columns, whatever further columns
there are and whatever they are called; the last stage gives pieces of sequences.  Of an
empty table every stage keeps nothing.  Texts of any length are taken whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import language, packing, quality, similar, substrings
from gleanery.llm.tables import Scratch
from gleanery.session import Scope


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents typical of a learnt language; ``lang`` stays as given, it is only learnt from.

    A text that is null or has no letter goes.  Where no row has a label there is nothing
    to tell languages by, and all texts with a letter stay.  Repeated rows stay or go
    together; a null ``doc_id`` or ``lang`` is not learnt from but judged like any other.
    """
    model = language.learn(docs, "doc_id", "text", "lang", language.third("doc_id") != 1)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    rows = docs.select(_whole(docs).alias("row"), "text")
    found = language.identify(rows, model, typical=True)
    return found.filter((F.col("lang_pred") != language.UNDETERMINED) & F.col("typical")).select("row.*")


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their failed lines.

    A null or empty text goes; repeated rows are judged each for itself.
    """
    judged = quality.judge(docs.select(_whole(docs).alias("row"), "text")).filter("kept")
    return _with_text(docs, judged, "row", "cleaned")


def join_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar rows the one of the smallest ``doc_id``, nulls last.

    Rows are documents of their own, also where they share a ``doc_id`` or have none; of
    equal ids the row that comes first in the files stays.  Null and empty texts are
    similar to nothing and stay.
    """
    kept = Scratch(spark, "similar-kept")
    rows = _rows(spark, docs, "similar-rows")
    key = F.struct(F.col("row.doc_id").isNull().alias("missing"), "row.doc_id", "file", "place").alias("key")
    with Scope():
        classes = similar.jaccard_components(rows.select(key, "row.text"), "key")
        least = classes.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        least = kept.write(least.select("doc_id.file", "doc_id.place"), "kept")
    kept.release()
    return rows.join(least, ["file", "place"], "left_semi").select("row.*")


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages; those with no words left go.

    So do null and empty texts.  Of repeated rows every word goes that a repeated window
    covers, in each of them.
    """
    rows = _rows(spark, docs, "substrings-rows")
    others = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "text"]
    key = F.struct(F.struct(*others).alias("row"), "file", "place").alias("key")
    parsed = substrings.remove_repeats(rows.select(key, "row.text"), "key", with_text=True)
    return _with_text(docs, parsed.filter("n_removed < n_words"), "doc_id.row", "kept")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their places.

    A null text counts as empty; repeated rows and rows without an id are packed each.
    """
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        definition = file.read()
    return packing.pack(docs, definition, public_tokenizers.PATTERN)


def _whole(docs: DataFrame) -> Column:
    """All columns of a row as one, so that no name of theirs meets another."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def _rows(spark: SparkSession, docs: DataFrame, label: str) -> DataFrame:
    """``(file, place, row)``: rows with a key of their own, the same at every look.

    The key is the row's address in the files that ``docs`` is read from; a table that is
    not read from files is written down first.
    """
    try:
        return _addressed(docs)
    except AnalysisException:
        return _addressed(Scratch(spark, label).write(docs, "rows"))


def _addressed(docs: DataFrame) -> DataFrame:
    address = docs.metadataColumn("_metadata")
    return docs.select(
        F.xxhash64(address["file_path"]).alias("file"), address["row_index"].alias("place"), _whole(docs).alias("row")
    )


def _with_text(docs: DataFrame, rows: DataFrame, row: str, text: str) -> DataFrame:
    """The columns of documents out of the struct ``row``, with another text and its length."""
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast("long")}
    return rows.select(*[new.get(c, F.col(f"{row}.`{c}`")).alias(c) for c in docs.columns])


STAGES = [
    ("language", identify_language),
    ("quality", clean_lines),
    ("similar", join_similar),
    ("substrings", remove_repeats),
    ("packing", pack_sequences),
]

#: Language identification and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; of what they write, only the result is left."""
    docs, done = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        with Scope():
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.release()
        if done is not None:
            scratch.release(done)
        done = docs
    return docs
