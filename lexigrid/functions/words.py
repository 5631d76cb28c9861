"""Column builders for lines, words and the rules that say which words count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates lines and words, and the letters of the
# Roman-numeral rule.
LINE_BREAK = r"\r\n|\n|\r"
NOT_LOWER_LETTERS = "[^a-z]+"
NOT_LETTERS = "[^A-Za-z]+"
ROMAN_LETTERS = "ivx"
MIN_COUNTED_LENGTH = 3

# "insensitive":       lower-case the line, then split.
# "lower_after_split": split on non-letters of either case, then lower each word.
# "capitals_separate": leave the line alone; capitals act as separators.
CASE_MODES = ("insensitive", "lower_after_split", "capitals_separate")


def java_trim(text: Column) -> Column:
    """Strip every character up to U+0020 from both ends, not spaces alone."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def line_array(text: Column) -> Column:
    """The lines of a text, as a text file with that content would have them.

    A final line break ends the last line and starts no new one; an empty text
    has no lines.
    """
    last_break_cut = (
        F.when(text == "", None)
        .when(text.endswith("\r\n"), F.substring(text, F.lit(1), F.length(text) - 2))
        .when(text.endswith("\n") | text.endswith("\r"), F.substring(text, F.lit(1), F.length(text) - 1))
        .otherwise(text)
    )
    return F.coalesce(F.split(last_break_cut, LINE_BREAK), F.array().cast("array<string>"))


def words(text: Column, case_mode: str = "insensitive") -> Column:
    """All words of a text in order, as an array.

    Array positions are word positions: nothing is filtered here, so words that
    do not count still take up distance. An empty string can appear first or
    last; no rule ever counts it.
    """
    if case_mode == "insensitive":
        return F.split(F.lower(text), NOT_LOWER_LETTERS)
    if case_mode == "lower_after_split":
        return F.transform(F.split(text, NOT_LETTERS), F.lower)
    if case_mode == "capitals_separate":
        return F.split(text, NOT_LOWER_LETTERS)
    raise ValueError(f"case_mode must be one of {CASE_MODES}, not {case_mode!r}")


def is_roman(word: Column) -> Column:
    """True for words made of i, v and x alone (leaves `mix`, `lxx`, `civ`)."""
    return F.ltrim(word, F.lit(ROMAN_LETTERS)) == ""


def is_countable_token(word: Column) -> Column:
    """Does a word from `words` count? At least three letters, not Roman.

    `words` yields letters only, so the alphabet needs no second check here.
    Both tests are plain string kernels, cheaper than a pattern per word.
    """
    return (F.length(word) >= MIN_COUNTED_LENGTH) & ~is_roman(word)


def is_countable(word: Column) -> Column:
    """`is_countable_token` for strings of any origin, such as a user's list."""
    return word.rlike("^[a-z]+$") & is_countable_token(word)
