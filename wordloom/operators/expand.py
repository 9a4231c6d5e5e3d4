"""One line in, many rows out.

``explode_outer`` followed by a null test is used in place of ``explode``: for
``explode`` the optimizer adds a test that the array is not empty below the
generator, and that test would run the tokenizer a second time. Windows are
generated as positions and cut out of the word array row by row, so the n-grams
of a line never exist side by side in memory and the whole expansion stays in
one generated loop up to the partial aggregate.

With ``marks``, every line that is not null gives one further row, in which the word, the
start or the gram is null and the head is empty: counted like any other, these rows give
the number of lines in the pass that counts the words, at one more row a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import grams, tokens
from wordloom.functions.checks import at_least, window_size


def explode_words(texts: DataFrame, column: str, *keep: str, marks: bool = False) -> DataFrame:
    """``(*keep, word)``, one row per word. Works on lines and on whole texts."""
    words = tokens.words(F.col(column))
    if marks:
        rows = F.concat(F.array(F.lit(None).cast("string")), words)
        return texts.where(F.col(column).isNotNull()).select(*keep, F.explode(rows).alias("word"))
    return texts.select(*keep, F.explode_outer(words).alias("word")).where(
        F.col("word").isNotNull()
    )


def explode_positions(texts: DataFrame, column: str, *keep: str) -> DataFrame:
    """``(*keep, pos, word)`` with ``pos`` counted from 0."""
    words = tokens.words(F.col(column))
    return (
        texts.select(*keep, F.posexplode_outer(words).alias("pos", "word"))
        .where(F.col("word").isNotNull())
        .withColumn("pos", F.col("pos").cast("bigint"))
    )


def windows(lines: DataFrame, column: str, n: int, *keep: str, marks: bool = False) -> DataFrame:
    """``(*keep, words, start)`` for every window of ``n`` words of every line.

    Without ``marks``, a line without a window keeps one row with a null ``start``.
    """
    at_least("window", n, 1)
    words = lines.select(*keep, tokens.words(F.col(column)).alias("words"))
    starts = grams.starts(F.col("words"), n)
    if marks:
        starts = F.concat(
            F.array(F.lit(None).cast("int")), F.coalesce(starts, F.array().cast("array<int>"))
        )
        words = lines.where(F.col(column).isNotNull()).select(
            *keep, tokens.words(F.col(column)).alias("words")
        )
        return words.select(*keep, "words", F.explode(starts).alias("start"))
    return words.select(*keep, "words", F.explode_outer(starts).alias("start"))


def _windows(lines: DataFrame, column: str, n: int, keep: tuple[str, ...], marks: bool) -> DataFrame:
    window_size(n)
    found = windows(lines, column, n, *keep, marks=marks)
    return found if marks else found.where(F.col("start").isNotNull())


def ngrams(
    lines: DataFrame, n: int, column: str = "line", *keep: str, marks: bool = False
) -> DataFrame:
    """``(*keep, gram)``; a gram never crosses a line end."""
    found = _windows(lines, column, n, keep, marks)
    return found.select(*keep, grams.gram(F.col("words"), F.col("start"), n).alias("gram"))


def head_tails(
    lines: DataFrame, n: int, column: str = "line", *keep: str, marks: bool = False
) -> DataFrame:
    """``(*keep, head, tail)``: first word of an n-gram and the words behind it."""
    found = _windows(lines, column, n, keep, marks)
    return found.select(
        *keep,
        grams.head(F.col("words"), F.col("start")).alias("head"),
        grams.tail(F.col("words"), F.col("start"), n).alias("tail"),
    )
