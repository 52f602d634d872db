"""Quality rules, line first: lines are judged and removed one by one, and a document
goes when too much of it went with its lines.  DataFrame expressions only.

Defined results: a null text counts as empty; a document without words fails the base
rules; any further columns of the input stay, columns named like a result are replaced;
repeated rows are judged row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Phrases that mark a line as boilerplate.
BOILERPLATE = (
    "(?i)all rights reserved|licensed under|released under the|terms of (use|service)|"
    "privacy policy|accept cookies|uses cookies|enable javascript|click here to|subscribe to our"
)
CLOSED = r"""[.!?…:;"'”’»)\]]\z"""


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules; shares are per cent.

    A line fails when it is boilerplate, has no letter, is a fragment below
    ``fragment_words`` words without closing punctuation, is a row of ``|`` entries,
    consists of symbols or of shouted words, or repeats few words over and over.

    The share of distinct words falls as any text grows, so a line of more than
    ``block_words`` words that is below ``distinct_share`` fails only if its blocks of so
    many words are below it too, taken together, or if ``rerun_share`` of its runs of
    ``run_words`` words occurred in it before.
    """

    fragment_words: int = 3
    symbol_share: int = 5
    menu_share: int = 4
    shout_share: int = 30
    long_line_words: int = 20
    distinct_share: int = 40
    block_words: int = 500
    run_words: int = 8
    rerun_share: int = 15
    max_lost_share: int = 40


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS, -1), "")


def _count(text: Column, what: str) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(what), F.lit("")))) / len(what)


def _symbols(text: Column, symbols: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, symbols, ""))


def _judged(line: Column, rules: LineRules) -> Column:
    """Number of words of a line, its own words, and whether it fails."""
    own = words(line)
    return F.struct(line.alias("line"), own.alias("own"), F.size(own).alias("n"))


def _fails(x: Column, rules: LineRules) -> Column:
    line, n, chars = x["line"], x["n"], F.char_length(x["line"])
    menu, symbols = _symbols(line, "|"), _symbols(line, "#*$%&<>")
    return (n > 0) & (
        ~line.rlike(r"\p{L}")
        | line.rlike(BOILERPLATE)
        | ((n < rules.fragment_words) & ~F.trim(line).rlike(CLOSED))
        | ((menu >= 2) & (menu * 100 >= chars * rules.menu_share))
        | ((symbols >= 2) & (symbols * 100 >= chars * rules.symbol_share))
        | ((_count(line, "!!") >= 3) & (_count(line, "!!") * 100 >= n * rules.shout_share))
        | (
            (n >= rules.long_line_words)
            & (F.size(F.array_distinct(x["own"])) * 100 < n * rules.distinct_share)
            & ((n <= rules.block_words) | _repeats(x["own"], n, rules))
        )
    )


def _repeats(own: Column, n: Column, rules: LineRules) -> Column:
    """Whether a long line repeats words within its blocks, or runs of words anywhere."""
    size, run = rules.block_words, rules.run_words
    starts = F.sequence(F.lit(1), n, F.lit(size))
    distinct = F.aggregate(
        starts, F.lit(0), lambda a, i: a + F.size(F.array_distinct(F.slice(own, i, size)))
    )
    runs = F.transform(F.sequence(F.lit(1), n - run + 1), lambda i: F.xxhash64(F.slice(own, i, run)))
    again = n - run + 1 - F.size(F.array_distinct(runs))
    return (distinct * 100 < n * rules.distinct_share) | (again * 100 >= (n - run + 1) * rules.rerun_share)


def _repeated(all_words: Column, window: int) -> list[tuple[str, Column]]:
    """Steps that count the words in windows of ``window`` words found twice or more.

    Windows are compared by a 64-bit hash within their text.  Only texts that hold a
    repeated window sort their windows; the sort brings equal ones side by side.
    """
    n = F.size(all_words)
    hashes = F.when(
        n >= window,
        F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.xxhash64(F.slice(all_words, i, window))),
    ).otherwise(F.array().cast("array<bigint>"))
    h, s, p = F.col("_hashes"), F.col("_sorted"), F.col("_at")
    ordered = F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
    )
    twice = F.transform(
        s,
        lambda x, k: F.when(
            ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.get(s, k + 1)["h"] == x["h"]), x["i"]
        ),
    )
    gaps = F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window))))
    covered = F.aggregate(gaps, F.lit(0), lambda a, x: a + x)
    return [
        ("_hashes", hashes),
        ("_sorted", ordered),
        ("_at", F.sort_array(F.array_compact(twice))),
        ("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")),
    ]


def judge(
    docs: DataFrame,
    text: str = "text",
    rules: LineRules = LineRules(),
    min_words: int = 20,
    window: int = 8,
    max_repeat_share: int = 30,
) -> DataFrame:
    """Adds the counts, ``base_failed``, ``lost_words``, ``cleaned`` and ``kept``.

    ``cleaned`` is the text without its failed lines; ``kept`` says that the base rules
    hold and at most ``max_lost_share`` per cent of the words went with their lines.
    """
    results = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "lost_words", "cleaned", "kept",
    ]
    whole = F.coalesce(F.col(f"_in.{text}"), F.lit(""))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in")).withColumns(
        {"_text": whole, "_words": words(whole)}
    )
    w, lines = F.col("_words"), F.split(F.col("_text"), "\n", -1)
    for name, step in _repeated(w, window):
        out = out.withColumn(name, step)
    out = out.withColumn(
        "_lines", F.transform(lines, lambda x: _judged(x, rules))
    ).withColumn("_bad", F.filter(F.col("_lines"), lambda x: _fails(x, rules)))
    worded = F.transform(F.filter(F.col("_lines"), lambda x: x["n"] > 0), lambda x: x["line"])
    out = out.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.char_length(F.array_join(w, "")).cast("long"),
            "n_symbols": _symbols(F.col("_text"), SYMBOLS).cast("long"),
            "n_dup_lines": (F.size(worded) - F.size(F.array_distinct(worded))).cast("long"),
            "lost_words": F.aggregate(F.col("_bad"), F.lit(0), lambda a, x: a + x["n"]).cast("long"),
            # without a failed line the text is passed on as it is
            "cleaned": F.when(F.size("_bad") == 0, F.col("_text")).otherwise(
                F.array_join(
                    F.transform(
                        F.filter(F.col("_lines"), lambda x: ~_fails(x, rules)), lambda x: x["line"]
                    ),
                    "\n",
                )
            ),
        }
    )
    n = F.col("n_words")
    out = out.withColumn(
        "base_failed", (n < min_words) | (F.col("n_repeat_words") * 100 > n * max_repeat_share)
    ).withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost_words") * 100 <= n * rules.max_lost_share)
    )
    carried = [F.col(f"_in.`{c}`").alias(c) for c in docs.columns if c not in results]
    # through a generator, below which the optimizer copies no filter on a result: a filter
    # on ``kept`` would repeat all that it is made of, many times over
    return out.select(F.inline(F.array(F.struct(*carried, *results))))
