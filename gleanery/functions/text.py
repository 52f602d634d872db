"""Text normalisation and tokenising as column expressions.

Everything here runs inside the JVM on whole texts.  The order of the cleaning
steps matters: lower-case, delete punctuation, delete digits, tokenise, drop
stop words; lemmas (a join) come after, see ``operators.cleaning``.
"""

from __future__ import annotations

import string
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 32 ASCII punctuation characters, deleted rather than spaced.
PUNCTUATION = string.punctuation

# The usual 179-word English stop list.  The apostrophe forms can
# never match, because punctuation is gone by then; they stay for completeness.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Unicode white space: Java's \s is ASCII-only, so the class is spelled out.
WHITE_SPACE = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]+"

# Typographic quotes that the word tokeniser makes tokens of their own.
QUOTES = "«“‘„»”’"

# Contractions the word tokeniser cuts in two.
CONTRACTIONS = ["can not", "gim me", "gon na", "got ta", "lem me", "wan na"]

# What gets spaces around it: a quote, or each half of a contraction.
_HALVES = "|".join("({})({})".format(*pair.split()) for pair in CONTRACTIONS)
_CUT = rf"([{QUOTES}])|(?U:\b)(?:{_HALVES})(?U:\b)"
_CUT_WITH = " $1$2$4$6$8$10$12 $3$5$7$9$11$13 "

# Punctuation and digits in one character class, deleted in one pass.
_PUNCTUATION_OR_DIGITS = r"[!-/:-@\[-`{-~\p{Nd}]+"

SNIPPET_LENGTH = 150


def text_or_blank(text: Column) -> Column:
    """A missing text counts as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def delete_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def delete_digits(text: Column) -> Column:
    """Delete digits of every script, not only ASCII ones."""
    return F.regexp_replace(text, r"\p{Nd}+", "")


def normalise_text(text: Column) -> Column:
    """Lower-case without punctuation and digits."""
    return F.regexp_replace(F.lower(text_or_blank(text)), _PUNCTUATION_OR_DIGITS, "")


def _spaced(text: Column) -> Column:
    """Set quotes and the halves of contractions apart.

    Few texts have any, and looking for plain words is much cheaper than the pattern.
    """
    signs = [*QUOTES, *[pair.replace(" ", "") for pair in CONTRACTIONS]]
    has_any = reduce(or_, [F.contains(text, F.lit(sign)) for sign in signs])
    return F.when(has_any, F.regexp_replace(text, _CUT, _CUT_WITH)).otherwise(text)


def _pieces(normalised: Column) -> Column:
    # The one-element array makes the text a variable, computed once and read often.
    spaced = F.transform(F.array(normalised), _spaced)[0]
    return F.split(spaced, WHITE_SPACE)


def split_words(text: Column) -> Column:
    """White-space tokens; a missing text has none."""
    return F.filter(F.split(text_or_blank(text), WHITE_SPACE), lambda w: w != "")


def word_tokens(normalised: Column) -> Column:
    """Tokens of a normalised text: white space, typographic quotes, contractions."""
    return F.filter(_pieces(normalised), lambda w: w != "")


def drop_stop_words(tokens: Column) -> Column:
    """Tokens that are neither stop words nor empty."""
    return F.filter(tokens, lambda w: ~w.isin([*STOP_WORDS, ""]))


def content_words(text: Column) -> Column:
    """Normalised, tokenised and free of stop words; not yet lemmatised."""
    return drop_stop_words(_pieces(normalise_text(text)))


def snippet(text: Column) -> Column:
    """First 150 characters, with ``...`` only when something was cut off."""
    text = text_or_blank(text)
    return F.when(
        F.length(text) > SNIPPET_LENGTH,
        F.concat(F.substring(text, 1, SNIPPET_LENGTH), F.lit("...")),
    ).otherwise(text)


def suffixed_snippet(text: Column) -> Column:
    """First 150 characters, always followed by ``...``."""
    return F.concat(F.substring(text_or_blank(text), 1, SNIPPET_LENGTH), F.lit("..."))


def word_count(text: Column) -> Column:
    """Default token counter of the prompt operators: white-space words."""
    return F.size(split_words(text))
