"""Totals of a text collection and of a count table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.expand import windows
from wordloom.operators.ranking import least_frequent, most_frequent


def gram_totals(lines: DataFrame, n: int, column: str = "line") -> DataFrame:
    """``(lines, grams, distinct_grams)``: lines, their n-grams and different ones among these.

    ``n = 1`` is for words. One pass over the lines and one shuffle, of rows that hold a digest
    of 128 bits in place of an n-gram; marks of the lines are counted on the same way. Among
    10^15 different n-grams two share a digest with a probability of about 10^-9.

    Words are counted in each task first. Longer n-grams are moved as they are found: few of
    them come twice in a task, so that a first count of a large split or row group fills the
    task's memory and is spilled, to take few rows off the shuffle.
    """
    found = windows(lines, column, n, marks=True)
    words = F.slice("words", F.col("start"), n)
    # Where marks are not counted first, those of different lines go to different places.
    place = F.lit(None) if n == 1 else F.xxhash64("words")
    digests = found.select(
        # Two functions of the words: the second goes on from the hash of a constant.
        F.when(F.col("start").isNotNull(), F.xxhash64(words)).alias("a"),
        F.when(F.col("start").isNotNull(), F.xxhash64(F.lit(1), words)).otherwise(place).alias("b"),
    )
    if n > 1:
        digests = digests.repartition("a", "b")
    by_digest = digests.groupBy("a", "b").agg(F.count("*").alias("n"))
    mark = F.col("a").isNull()
    totals = by_digest.agg(
        F.sum(F.when(mark, F.col("n"))).alias("lines"),
        F.sum(F.when(~mark, F.col("n"))).alias("grams"),
        F.count("a").alias("distinct_grams"),
    )
    return totals.select(*[F.coalesce(c, F.lit(0)).alias(c) for c in totals.columns])


def corpus_totals(counts: DataFrame, column: str = "n") -> DataFrame:
    """``(words, tokens)``; a row whose count is no number adds to ``words`` only."""
    return counts.agg(
        F.count("*").alias("words"),
        F.coalesce(F.sum(F.col(column).try_cast("bigint")), F.lit(0)).alias("tokens"),
    )


def corpus_report(counts: DataFrame, k: int = 10, key: str = "word") -> DataFrame:
    """``(section, place, word, n)``: totals, the ``k`` most and the ``k`` least frequent words.

    The sections ``words`` and ``tokens`` have one row each, without a word. The sections
    start from the same counts, whose shuffle the engine reuses, so the corpus is read and
    counted once; each section then keeps a few rows a task.
    """

    def section(name: str, rows: DataFrame, *order: Column) -> DataFrame:
        # Over the k rows that the ranking has left.
        place = F.row_number().over(Window.orderBy(*order)).cast("bigint")
        return rows.select(F.lit(name).alias("section"), place.alias("place"), F.col(key).alias("word"), "n")

    totals = corpus_totals(counts).select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("section"), F.col(name).cast("bigint").alias("n"))
                    for name in ("words", "tokens")
                ]
            )
        ).alias("t")
    )
    totals = totals.select("t.section", F.lit(1).cast("bigint").alias("place"), F.lit(None).cast("string").alias("word"), "t.n")
    parts = [
        totals,
        section("most frequent", most_frequent(counts, k, key), F.desc("n"), F.desc(key)),
        section("least frequent", least_frequent(counts, k, key), F.asc("n"), F.asc(key)),
    ]
    return reduce(DataFrame.union, parts)
