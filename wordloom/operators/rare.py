"""n-gram counts that are moved by the rare words of the n-grams.

Counted by its text, an n-gram goes to a place of its own, with all its words: a corpus is
shuffled some ``n`` times. Here an n-gram goes where the least hash of its rare words says.
Neighbours share that word more often than not: a run of them is moved as one text, their
piece of the line, and cut into n-grams where they are counted.

Pieces are not counted in part before they are moved. A word is rare if it is not among the
``FREQUENT`` most frequent ones, so a place has few of all n-grams, however often a line is
repeated. n-grams without a rare word, among them those of lines that are repeated over and
over, stay with others of their task, wherever that is, and their counts there are added up
in a second, small shuffle. Equal n-grams have equal words, so they are all counted in one of
the two ways; which one changes the cost, never the counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from wordloom.functions import grams, tokens
from wordloom.functions.checks import window_size
from wordloom.operators.counts import count_by, merged
from wordloom.operators.expand import explode_words
from wordloom.operators.ranking import most_frequent

FREQUENT = 1024
# The share of the lines whose words are counted for that.
SHARE = 0.1
_PLACE_BITS = 31


def frequent_hashes(
    texts: DataFrame, column: str = "line", size: int = FREQUENT, share: float = SHARE
) -> list[int]:
    """Hashes of the ``size`` most frequent words in a ``share`` of ``texts``, lines or whole.

    A pass of its own, when called; ``size`` rows come to the driver.
    """
    return [row["word"] for row in frequent_words(texts, column, size, share)]


def frequent_words(texts: DataFrame, column: str, size: int, share: float) -> list[Row]:
    """``(word, n)`` of those words, by their hashes; ``n`` is that in the share."""
    hashes = explode_words(texts.sample(share, 0), column).select(F.hash("word").alias("word"))
    return most_frequent(count_by(hashes, "word"), size).collect()


def _marks(words: Column, frequent: Sequence[int]) -> Column:
    """For each word its hash and, in the low bits, its place in the line; null for a frequent word."""

    def mark(word: Column, place: Column) -> Column:
        high = F.shiftleft(F.hash(word).cast("bigint"), _PLACE_BITS)
        return F.when(~F.hash(word).isin(*frequent), high.bitwiseOR(place.cast("bigint")))

    return F.transform(words, mark)


def ngram_counts(
    lines: DataFrame, n: int, frequent: Sequence[int], column: str = "line"
) -> DataFrame:
    """``(gram, n)`` as :func:`wordloom.operators.counts.ngram_counts`, moved in pieces.

    A piece holds some ``n / 2`` n-grams, so there are more partitions than for other
    shuffles by half as much.
    """
    window_size(n)
    # Arrays pass through a generator, or the lambda would compute them anew.
    words = lines.select(F.explode_outer(F.array(tokens.words(F.col(column)))).alias("words"))
    marked = words.select("words", F.explode_outer(F.array(_marks(F.col("words"), frequent))).alias("marks"))
    windows = marked.select(
        "words", "marks", F.explode_outer(grams.starts(F.col("words"), n)).alias("start")
    ).where(F.col("start").isNotNull())

    start, last = F.col("start"), F.size("words") - (n - 1)

    def least(at: Column) -> Column:
        """The least mark of the n-gram at ``at``: one word in one place, so of at most ``n`` n-grams."""
        return F.least(*[F.get("marks", at + (i - 1)) for i in range(n)])

    def parted(at: Column) -> Column:
        return ~least(at).eqNullSafe(least(start))

    size = F.lit(n)
    for i in reversed(range(1, n)):
        size = F.when((start + i > last) | parted(start + i), i).otherwise(size)
    key = F.shiftright(least(start), _PLACE_BITS)
    # A run of n-grams without a mark ends as others do, after n of them at the latest.
    first = (start == 1) | parted(start - 1) | (least(start).isNull() & (start % n == 1))
    size = F.when(least(start).isNull(), F.least(size, n - (start - 1) % n)).otherwise(size)
    pieces = windows.where(first).select(
        "words", "start", key.alias("key"), F.when(key.isNull(), F.spark_partition_id()).alias("task"), size.alias("n")
    )
    pieces = pieces.select(
        "key", "task", "n", F.array_join(F.slice("words", start, F.col("n") + (n - 1)), grams.SEPARATOR).alias("piece")
    )
    # The ends of the n-grams in a piece; those without a rare word are told by their sign. A test
    # of the key would be moved below the shuffle, and the lines read once for each of its outcomes.
    ends = F.sequence(F.lit(n), F.col("n") + (n - 1))
    signed = F.when(F.col("key").isNull(), F.sequence(F.lit(-n), 1 - n - F.col("n"))).otherwise(ends)
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")) * -(-n // 2)
    placed = pieces.repartition(partitions, "key", "task").select("key", "task", "piece", F.explode(signed).alias("end"))

    def counted(rows: DataFrame) -> DataFrame:
        # The function of pyspark takes no column as the number of words.
        upto = F.call_function("substring_index", F.col("piece"), F.lit(grams.SEPARATOR), F.abs("end"))
        gram = F.substring_index(upto, grams.SEPARATOR, -n).alias("gram")
        return count_by(rows.select("key", "task", gram), "key", "task", "gram").select("gram", "n")

    apart = merged(counted(placed.where(F.col("end") < 0)), key="gram")
    # Typed as never null, as counts are.
    apart = apart.select("gram", F.coalesce("n", F.lit(0)).alias("n"))
    return counted(placed.where(F.col("end") > 0)).union(apart)


def combined_counts(
    lines: DataFrame, n: int, frequent: Sequence[int], column: str = "line"
) -> DataFrame:
    """``(gram, n)`` as :func:`ngram_counts`, from lines that are counted before they are moved.

    Lines of ``n`` words or more are counted as arrays of their words, one shuffle of the corpus.
    The different ones are cut into pieces, which are moved to the place that the key names, once
    for all copies of their line. So no n-gram is counted by the task that reads a row group, and
    repeated lines put no load on a place: an n-gram without a rare word is a piece of its own.
    """
    window_size(n)
    words = lines.select(F.explode_outer(F.array(tokens.words(F.col(column)))).alias("words"))
    copies = count_by(words.where(F.size("words") >= n), "words")
    marked = copies.select("words", "n", F.explode_outer(F.array(_marks(F.col("words"), frequent))).alias("marks"))
    # For each n-gram its least mark: one word in one place, so of at most n n-grams. As an array, since
    # n marks of each of n n-grams are too much for generated code.
    least = F.transform(grams.starts(F.col("words"), n), lambda i: F.array_min(F.slice("marks", i, n)))
    keyed = marked.select("words", "n", F.explode_outer(F.array(least)).alias("least"))
    found = keyed.select("words", "n", "least", F.explode_outer(F.sequence(F.lit(1), F.size("least"))).alias("start"))
    start = F.col("start")
    own = F.get("least", start - 1)

    def parted(at: Column) -> Column:
        """Whether the n-gram at ``at`` begins another piece than that at ``start``, or there is none."""
        return F.coalesce(F.get("least", at - 1) != own, F.lit(True))

    size = F.lit(n)
    for i in reversed(range(1, n)):
        size = F.when(parted(start + i), i).otherwise(size)
    key = F.coalesce(F.shiftright(own, _PLACE_BITS), F.hash(F.slice("words", start, n)).cast("bigint"))
    pieces = found.where((start == 1) | parted(start - 1)).select("words", "start", key.alias("key"), size.alias("size"), "n")
    # A piece holds some n / 2 n-grams, so there are more places than partitions of other shuffles.
    places = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")) * -(-n // 2)
    moved = pieces.select(
        F.pmod("key", F.lit(places)).cast("int").alias("place"),
        "size",
        "n",
        F.array_join(F.slice("words", start, F.col("size") + (n - 1)), grams.SEPARATOR).alias("piece"),
    ).repartitionById(places, "place")
    ends = F.sequence(F.lit(n), F.col("size") + (n - 1))
    placed = moved.select("place", "n", "piece", F.explode(ends).alias("end"))
    # The function of pyspark takes no column as the number of words.
    upto = F.call_function("substring_index", F.col("piece"), F.lit(grams.SEPARATOR), F.col("end"))
    gram = F.substring_index(upto, grams.SEPARATOR, -n).alias("gram")
    summed = placed.select("place", "n", gram).groupBy("place", "gram").agg(F.sum("n").alias("n"))
    # Typed as never null, as counts are.
    return summed.select("gram", F.coalesce("n", F.lit(0)).alias("n"))
