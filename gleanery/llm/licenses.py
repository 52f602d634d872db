"""License scans by diagonal voting.

1. All rolling word k-grams of every text are hashed and joined in Spark with the positions
   of the same k-grams in the templates.  A hit votes for its diagonal: the place in the
   text minus the place in the template.
2. Votes are counted by text, template and diagonal.  Inserted and lost words move the
   diagonal, so neighbouring diagonals merge, up to ``shift`` words apart.
3. Spans are verified on the words themselves: the share of the template's words that
   stand in the text on one of the span's diagonals.  A short template must stand there
   whole, on one diagonal; each such place of a base phrase counts.

A template table that is too long to broadcast is joined by a shuffle.  Votes of one text
and template are bounded by that text's words.  A long text is hashed in slices.

Defined results: a null or empty text has no words, no labels and score 0; rows of equal
keys are documents of their own, equal rows get equal results; a null key is kept; other
columns do not take part, whatever their names; an empty table gives no rows.  Overlapping
places count each.  The score is the largest verified share of any label's template.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.tables import Scratch
from gleanery.llm.tokens import ALPHANUMERIC, Tokens, _buffers, slices
from gleanery.llm.words import runs

#: Bytes of text that are turned into arrays at a time.
PART = 1 << 20
#: Template positions, and texts and spans to verify, that are broadcast at most.
BROADCAST_GRAMS, BROADCAST_TEXTS, BROADCAST_SPANS = 500_000, 100_000, 500_000
#: A template of fewer words is a phrase: it must be found whole.
PHRASE = 10
SHORT, LONG = 2, 5


@dataclass(frozen=True)
class Template:
    """A text to look for, and the label of a document that has it."""

    label: str
    text: str
    base: bool = False


# The base phrases and their labels.
BASE = [
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
]
# Notices by which works state their license, as their licenses give them.
NOTICES = [
    Template("apache-2.0", "Apache License, Version 2.0"),
    Template("gpl-2.0", "General Public License, version 2"),
    Template("gpl-3.0", "General Public License, version 3"),
    Template("cc-by-4.0", "CC BY 4.0"),
    Template("cc-by-sa-4.0", "CC BY-SA 4.0"),
    Template("cc-by-nc-4.0", "CC BY-NC 4.0"),
    Template("cc0-1.0", "CC0 1.0"),
    Template("mpl-2.0", "Mozilla Public License, version 2.0"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software.",
    ),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied.",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
    ),
]


@dataclass(frozen=True)
class Voting:
    """Limits of the vote; shares are per cent.

    A span is looked at when the merged diagonals have ``votes_share`` of the template's
    k-grams, and stands when ``words_share`` of its words are verified.
    """

    shift: int = 10
    votes_share: int = 10
    words_share: int = 80


def _size(n_words: int) -> int:
    return LONG if n_words >= PHRASE else min(n_words, SHORT)


class _Templates:
    def __init__(self, templates: list[Template]):
        texts = pa.array([t.text for t in templates], pa.large_string())
        offsets, data = _buffers(texts)
        tokens = Tokens(data, offsets, ALPHANUMERIC, None)
        ids, self.vocabulary = tokens.codes()
        hashes = tokens.hashes()
        self.templates, self.words, self.grams = templates, [], []
        for i in range(len(templates)):
            mine = tokens.row == i
            if not mine.any():
                raise ValueError(f"a template without words: {templates[i].label}")
            self.words.append(ids[mine])
            own = runs(hashes[mine], _size(mine.sum())).view(np.int64)
            self.grams += [(int(h), i, at) for at, h in enumerate(own)]
        self.sizes = sorted({_size(len(w)) for w in self.words})

    def positions(self, spark: SparkSession) -> DataFrame:
        table = spark.createDataFrame(self.grams, "h long, template int, at int")
        return F.broadcast(table) if len(self.grams) <= BROADCAST_GRAMS else table

    def sizes_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, len(w), len(w) - _size(len(w)) + 1) for i, w in enumerate(self.words)]
        return F.broadcast(spark.createDataFrame(rows, "template int, words int, grams int"))


def _grams(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """For every text a row with its number of words, and rows with its k-gram hashes.

    ``first`` is the place of the first k-gram of a row.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            id_type, n = batch.schema.field("doc_id").type, np.zeros(len(batch), np.int64)
            for done, tokens in slices(batch.column(2), PART, ALPHANUMERIC, overlap=max(sizes) - 1):
                row, fresh, rows = tokens.row, tokens.fresh, len(tokens.offsets) - 1
                n[done : done + rows] += np.bincount(row[fresh:], minlength=rows)
                hashes = tokens.hashes()
                for size in sizes:
                    all_runs, last = runs(hashes, size), np.arange(size - 1, len(tokens))
                    own = (row[last] == row[last - size + 1]) & (last >= fresh) if len(last) else np.zeros(0, bool)
                    counts = np.bincount(row[last][own], minlength=rows)
                    first = np.full(rows, tokens.place + max(0, fresh - size + 1), np.int64)
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(all_runs[own].view(np.int64))
                    )
                    full = np.flatnonzero(counts)
                    take, numbers = pa.array(full), rid + done + full
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(numbers), batch.column(0).take(pa.array(done + full)), pa.nulls(len(full), id_type),
                         pa.nulls(len(full), pa.int64()), pa.array(first[full]), lists.take(take)],
                        ["rid", "k", "doc_id", "n_words", "first", "grams"],
                    )
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid + np.arange(len(batch))), batch.column(0), batch.column(1), pa.array(n),
                 pa.nulls(len(batch), pa.int64()), pa.nulls(len(batch), pa.list_(pa.int64()))],
                ["rid", "k", "doc_id", "n_words", "first", "grams"],
            )
            rid += len(batch)

    return docs.select("k", "doc_id", "text").mapInArrow(
        run, f"rid long, k long, doc_id {kind}, n_words long, first long, grams array<long>"
    )


def _spans(votes: DataFrame, sizes: DataFrame, voting: Voting) -> DataFrame:
    """``(k, template, diagonals)``: merged diagonals with enough votes.

    A phrase is a span for each diagonal that has all its k-grams.
    """
    voted = votes.groupBy("rid", "k", "template", "diagonal").agg(F.count("*").alias("votes"))
    voted = voted.join(sizes, "template")
    phrase = F.col("words") < PHRASE
    voted = voted.filter(~phrase | (F.col("votes") == F.col("grams")))
    order = Window.partitionBy("rid", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    starts = (phrase | gap.isNull() | (gap > voting.shift)).cast("long")
    merged = voted.withColumn("starts", starts).withColumn("span", F.sum("starts").over(order))
    merged = merged.groupBy("rid", "k", "template", "span").agg(
        F.sum("votes").alias("votes"), F.sort_array(F.collect_list("diagonal")).alias("diagonals"),
        F.first("words").alias("words"), F.first("grams").alias("grams"),
    )
    merged = merged.filter((F.col("words") < PHRASE) | (F.col("votes") * 100 >= F.col("grams") * voting.votes_share))
    # equal rows have the same key k and the same spans
    return merged.select("k", "template", "diagonals").distinct()


def _verified(texts: DataFrame, templates: _Templates, voting: Voting) -> DataFrame:
    """``(k, template, first, last, share)`` of the spans whose words stand in the text."""
    least = [1.0 if len(w) < PHRASE else voting.words_share / 100 for w in templates.words]

    def run(batches):
        for batch in batches:
            for k, text, spans in zip(batch.column(0), batch.column(1), batch.column(2)):
                ids = []
                for _, tokens in slices(pa.array([text.as_py()], pa.large_string()), PART, ALPHANUMERIC):
                    codes, words = tokens.codes()
                    known = pc.index_in(words, templates.vocabulary).fill_null(-1).to_numpy()
                    ids.append(known[codes])
                ids, out = np.concatenate(ids), []
                for span in spans.as_py():
                    words = templates.words[span["template"]]
                    found, low, high = np.zeros(len(words), bool), len(ids), -1
                    for d in span["diagonals"]:
                        a, b = max(0, -d), min(len(words), len(ids) - d)
                        same = np.flatnonzero(ids[d + a : d + b] == words[a:b]) + a
                        found[same] = True
                        if len(same):
                            low, high = min(low, d + int(same[0])), max(high, d + int(same[-1]))
                    share = float(found.mean())
                    if share >= least[span["template"]]:
                        out.append((span["template"], low, high, share))
                if out:
                    template, low, high, share = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k.as_py()] * len(out), pa.int64()), pa.array(template, pa.int32()),
                         pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(share)],
                        ["k", "template", "first", "last", "share"],
                    )

    return texts.select("k", "text", "spans").mapInArrow(
        run, "k long, template int, first long, last long, share double"
    )


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: list[Template] = [*BASE, *NOTICES],
    voting: Voting = Voting(),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score``.

    The words after ``n_words`` tell the places of base phrases; labels are sorted and
    joined by commas.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "licenses")
    known = _Templates(templates)
    whole = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(F.col(key).alias("doc_id"), whole.alias("text"))
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"))
    rolled = _grams(docs, known.sizes).select(
        "rid", "k", "doc_id", "n_words", "first", F.posexplode_outer("grams").alias("pos", "h")
    )
    hits = rolled.join(known.positions(spark), "h", "left").filter("template is not null or n_words is not null")
    diagonal = (F.col("first") + F.col("pos") - F.col("at")).alias("diagonal")
    hits = hits.select("rid", "k", "doc_id", "n_words", "template", diagonal)
    hits = scratch.write(hits, "hits")

    sizes = known.sizes_table(spark)
    spans = _spans(hits.filter("template is not null"), sizes, voting)
    spans = spans.groupBy("k").agg(F.collect_list(F.struct("template", "diagonals")).alias("spans"))
    spans = scratch.write(spans, "spans")
    n, total = spans.agg(F.count("*"), F.sum(F.aggregate("spans", F.lit(0), lambda a, x: a + F.size(x["diagonals"])))).first()
    if n <= BROADCAST_TEXTS and (total or 0) <= BROADCAST_SPANS:
        candidates = docs.join(F.broadcast(spans), "k")
    else:
        candidates = docs.join(spans, "k")
    verified = _verified(candidates.select("k", "text", "spans"), known, voting).distinct()

    named = spark.createDataFrame([(i, t.label, t.base) for i, t in enumerate(templates)], "template int, label string, base boolean")
    base = F.col("base")
    found = verified.join(F.broadcast(named), "template").groupBy("k").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"),
        F.max("share").alias("score"),
    )
    found = scratch.write(found, "found")
    facts = hits.filter("n_words is not null").select("k", "doc_id", "n_words").join(found, "k", "left")

    def listed(labels):
        return F.coalesce(F.array_join(F.sort_array(labels), ","), F.lit("")).alias(labels)

    return facts.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        listed("base_labels"), listed("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
