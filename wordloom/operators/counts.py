"""Counts of words and n-grams.

Every count is a ``groupBy`` on the counted key, which Spark runs as a partial
aggregate in each task, a shuffle of one row per key and task, and a final
aggregate. A word that makes up a third of the input therefore reaches its
reducer as one row per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import grams, runs, tokens
from wordloom.functions.checks import window_size
from wordloom.operators.expand import explode_words, ngrams


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, n)``."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def merged(*tables: DataFrame, key: str = "word") -> DataFrame:
    """``(key, n)``: count tables of several corpora added up."""
    return reduce(DataFrame.union, [t.select(key, "n") for t in tables]).groupBy(key).agg(
        F.sum("n").alias("n")
    )


def added(known: DataFrame, more: DataFrame, key: str = "word") -> DataFrame:
    """``(key, n)``: the counts ``more`` of a further run added to ``known``.

    Each holds a key once. With ``known`` in buckets (:mod:`wordloom.sources.buckets`) only
    ``more`` is shuffled, to the buckets, however large the older table is.
    """
    further = more.select(key, F.col("n").alias("_more"))
    total = F.coalesce("n", F.lit(0)) + F.coalesce("_more", F.lit(0))
    return known.join(further, key, "full_outer").select(key, total.alias("n"))


def word_counts(texts: DataFrame, column: str = "line") -> DataFrame:
    """``(word, n)``. No word crosses a line end, so whole texts need no splitting."""
    return count_by(explode_words(texts, column), "word")


def total_count(texts: DataFrame, column: str = "line") -> DataFrame:
    """``("word", n)`` with the number of whitespace-separated tokens; no row for none."""
    total = total_with_lines(texts, column).where(F.col("n") > 0)
    return total.select(F.lit("word").alias("key"), "n")


def total_with_lines(texts: DataFrame, column: str = "line") -> DataFrame:
    """``(n, lines)`` with the number of whitespace-separated tokens and of rows that are not null."""
    size = F.regexp_count(column, F.lit(tokens.RAW_WORD)).cast("bigint")
    known = texts.where(F.col(column).isNotNull())
    return known.agg(F.sum(size).alias("n"), F.count("*").alias("lines"))


def ngram_counts(lines: DataFrame, n: int, column: str = "line") -> DataFrame:
    """``(gram, n)`` for the n-grams of every line."""
    return count_by(ngrams(lines, n, column), "gram")


def pair_counts(lines: DataFrame, column: str = "line") -> DataFrame:
    """``(gram, n)`` for every ordered pair of adjacent words."""
    return ngram_counts(lines, 2, column)


def head_tail_counts(lines: DataFrame, n: int, column: str = "line") -> DataFrame:
    """``(head, tail, n)``: the n-gram counts in the form stripes are built from.

    They are counted as n-grams and split afterwards: one text takes fewer bytes in the
    shuffle than two.
    """
    window_size(n)
    gram = F.col("gram")
    # Typed as never null, see wordloom.functions.grams.head.
    head = F.coalesce(F.substring_index(gram, grams.SEPARATOR, 1), F.lit(""))
    tail = F.coalesce(F.substring_index(gram, grams.SEPARATOR, 1 - n), F.lit(""))
    return ngram_counts(lines, n, column).select(head.alias("head"), tail.alias("tail"), "n")


def word_counts_by_row(texts: DataFrame, *keys: str, column: str = "line") -> DataFrame:
    """``(*keys, word, n)``: the words of each row of ``texts``, counted inside it.

    Nothing is shuffled, so rows that share their keys are counted each by itself.
    """
    found = texts.select(*keys, tokens.words(F.col(column)).alias("words"))
    held = found.select(*keys, F.explode_outer(runs.counted(F.col("words"))).alias("c"))
    return held.where(F.col("c").isNotNull()).select(*keys, F.col("c.item").alias("word"), "c.n")
