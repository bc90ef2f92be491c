"""Tokenising and title-casing as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PUNCTUATION = r"\p{Punct}+"  # ASCII punctuation only
_WHITESPACE = r"(?U)[\s\x1c-\x1f]+"  # any Unicode white space, and the ASCII separators

# The English stop-word list the results depend on.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them their
    theirs themselves what which who whom this that that'll these those am is are was were be
    been being have has had having do does did doing a an the and but if or because as until
    while of at by for with about against between into through during before after above below
    to from up down in out on off over under again further then once here there when where why
    how all any both each few more most other some such no nor not only own same so than too
    very s t can will just don don't should should've now d ll m o re ve y ain aren aren't couldn
    couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn
    mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't
    won won't wouldn wouldn't
    """.split()
)


def words(text: Column) -> Column:
    """Array of the words of a text: ASCII punctuation is deleted, whitespace separates.

    A text that starts or ends with whitespace gives an empty word there; see ``is_word``.
    """
    return F.split(F.regexp_replace(text, _PUNCTUATION, ""), _WHITESPACE)


def is_word(word: Column, stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS) -> Column:
    """Not empty and, ignoring case, not a stop word."""
    kept = word != ""
    return kept & ~F.lower(word).isin(*stop_words) if stop_words else kept


def title(text: Column) -> Column:
    """Upper-case each letter that follows a non-letter and lower-case the rest.

    Unlike ``initcap`` this starts a new word after hyphens, apostrophes and digits too.
    """
    pieces = F.split(text, r"(?<=\P{L})")
    return F.array_join(
        F.transform(
            pieces,
            lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 2**31 - 1))),
        ),
        "",
    )
