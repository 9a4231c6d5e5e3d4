"""Most and least frequent words; ``limit`` after ``orderBy`` runs as a distributed top-k.

Words of equal counts are ordered by ``key``: the word itself, or ``place`` after
:func:`last_counts`, where the order of the lines is to decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.checks import at_least


def most_frequent(counts: DataFrame, k: int = 10, key: str = "word") -> DataFrame:
    """The ``k`` rows with the highest ``n``; ties in descending key order."""
    at_least("k", k, 1)
    known = counts.where(F.col("n").isNotNull())
    return known.orderBy(F.desc("n"), F.desc(key)).limit(k)


def least_frequent(counts: DataFrame, k: int = 10, key: str = "word") -> DataFrame:
    """The ``k`` rows with the lowest ``n``; ties in ascending key order."""
    at_least("k", k, 1)
    known = counts.where(F.col("n").isNotNull())
    return known.orderBy(F.asc("n"), F.asc(key)).limit(k)


def last_counts(counts: DataFrame) -> DataFrame:
    """``(word, n, place)`` from ``(word, n, place)``: the last count of each word, at its first place.

    For count files that repeat words. Counts that are no numbers are passed over. There is
    no global sort: each task keeps one row a word, and so does the shuffle.
    """
    known = counts.where(F.col("n").isNotNull())
    return known.groupBy("word").agg(F.max_by("n", "place").alias("n"), F.min("place").alias("place"))
