"""Tokenizers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These patterns define which tokens count, so they must not change.
WORD = r"[\p{L}0-9](?:[\p{L}0-9'-]*[\p{L}0-9])?"
RAW_DELIMITERS = "[ \t\n\r\f]+"
RAW_WORD = "[^ \t\n\r\f]+"
OUTSIDE_ALPHABET = r"[^\p{L}0-9\s'-]"
ISOLATED_MARKS = r"(?<=\s)['-]+|['-]+(?=\s)"
LEADING_MARKS = r"(^|\s)['-]+"
TRAILING_MARKS = r"[-']+(\s|$)"
# White space as Python's str.strip sees it, which is wider than Spark's trim.
EDGE_SPACE = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"


def words(line: Column) -> Column:
    """Lower-cased words of ``line``, in order.

    A word starts and ends with a letter or an ASCII digit and may hold ``'``
    and ``-`` inside. One pattern gives what the four replacements of
    :func:`normalized` followed by a split give, without the passes between.
    Character classes only, no repeated group: matching stays iterative, so one
    very long word cannot exhaust the thread's stack.
    """
    return F.regexp_extract_all(F.lower(line), F.lit(WORD), 0)


def raw_words(line: Column) -> Column:
    """Whitespace-separated tokens of ``line`` as they stand."""
    return F.array_remove(F.split(line, RAW_DELIMITERS), "")


def stripped(line: Column) -> Column:
    """``line`` without white space at either end."""
    return F.regexp_replace(line, EDGE_SPACE, "")


def lower_case(line: Column) -> Column:
    return F.lower(line)


def drop_outside_alphabet(line: Column) -> Column:
    """Blank out all but letters, ASCII digits, whitespace, ``'`` and ``-``."""
    return F.regexp_replace(line, OUTSIDE_ALPHABET, " ")


def drop_isolated_marks(line: Column) -> Column:
    """Blank out runs of ``'`` and ``-`` that touch whitespace."""
    return F.regexp_replace(line, ISOLATED_MARKS, " ")


def drop_leading_marks(line: Column) -> Column:
    """Blank out runs of ``'`` and ``-`` in front of a word."""
    return F.regexp_replace(line, LEADING_MARKS, " ")


def drop_trailing_marks(line: Column) -> Column:
    """Blank out runs of ``'`` and ``-`` behind a word."""
    return F.regexp_replace(line, TRAILING_MARKS, " ")


def split_on_space(line: Column) -> Column:
    """Non-empty pieces of ``line`` between whitespace."""
    return F.array_remove(F.split(line, r"\s+"), "")


def normalized(line: Column) -> Column:
    """``line`` after all cleaning steps, its words joined by single spaces."""
    for step in (
        lower_case,
        drop_outside_alphabet,
        drop_isolated_marks,
        drop_leading_marks,
        drop_trailing_marks,
        split_on_space,
    ):
        line = step(line)
    return F.array_join(line, " ")
