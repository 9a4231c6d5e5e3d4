"""n-gram keys as column expressions over an array of words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ","


def starts(words: Column, n: int) -> Column:
    """1-based start positions of the n-grams in ``words``; null if there is none.

    The length test is part of the expression because ``sequence`` counts
    downwards when its end lies before its start.
    """
    size = F.size(words)
    return F.when(size >= n, F.sequence(F.lit(1), size - (n - 1)))


def gram(words: Column, start: Column, n: int) -> Column:
    """The ``n`` words from ``start`` on, joined by a comma."""
    return F.array_join(F.slice(words, start, n), SEPARATOR)


def head(words: Column, start: Column) -> Column:
    """First word of the n-gram at ``start``, typed as never null.

    A join on a column that may be null adds a null test to one side, which
    pushed down would run the tokenizer twice and keep the two sides of a
    self-join from sharing their shuffle.
    """
    return F.coalesce(F.get(words, start - 1), F.lit(""))


def tail(words: Column, start: Column, n: int) -> Column:
    """Words 2..n of the n-gram at ``start``, joined by a comma."""
    return gram(words, start + 1, n - 1)
