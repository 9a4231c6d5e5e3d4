"""Stripes whose n-grams are moved once, to the place of their head.

Counted by its text, an n-gram is moved to be counted and moved again to be packed, and a first count
in the task that finds it is spilled as a whole where a row group is large. Here an n-gram goes to the
place of its head as it is found; it is counted there, and packed there.

The n-grams of a head that would fill more than ``PLACE_BYTES`` are dealt over several places by a
hash, and these alone are moved a second time, to be packed by part. Which heads are spread changes
the cost, never the rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import grams
from wordloom.functions.checks import window_size
from wordloom.operators import stripes
from wordloom.operators.expand import windows
from wordloom.operators.rare import FREQUENT, SHARE, frequent_words

PLACE_BYTES = 256 * 1024 * 1024
# What a word of an n-gram takes, its comma included; a guess that changes the cost only.
WORD_BYTES = 8
# Up to so many partitions the writer of a shuffle keeps no rows in memory, and so spills none.
UNSORTED = 200


def places(spark: SparkSession) -> int:
    """Number of places: the session's, or fewer, where tasks get four times as large at most."""
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return asked if asked > 4 * UNSORTED else min(asked, UNSORTED)


def _spread(sizes: Mapping[int, float], place_bytes: int) -> dict[int, int]:
    found = {head: int(-(-size // place_bytes)) for head, size in sizes.items()}
    return {head: k for head, k in found.items() if k > 1}


def spread_heads(
    texts: DataFrame,
    n: int,
    column: str = "line",
    size: int = FREQUENT,
    share: float = SHARE,
    place_bytes: int = PLACE_BYTES,
) -> dict[int, int]:
    """``hash -> places`` of the heads whose ``n``-grams fill several places, by a ``share`` of ``texts``.

    A pass of its own, when called; ``size`` rows come to the driver.
    """
    counted = frequent_words(texts, column, size, share)
    return _spread({r["word"]: r["n"] / share * n * WORD_BYTES for r in counted}, place_bytes)


def _place(head: Column, tail: Column, spread: Mapping[int, int], n_places: int) -> Column:
    """The place of an entry; equal entries have one place."""
    if not spread:
        return F.pmod(F.hash(head), F.lit(n_places)).alias("place")
    known = F.create_map(*[F.lit(x) for pair in spread.items() for x in pair])
    dealt = F.when(_apart(head, spread), F.pmod(F.hash(tail), F.element_at(known, F.hash(head))))
    return F.pmod(F.hash(head, dealt), F.lit(n_places)).alias("place")


def _apart(head: Column, spread: Mapping[int, int]) -> Column:
    return F.hash(head).isin(*spread) if spread else F.lit(False)


def head_counts(
    lines: DataFrame, n: int, spread: Mapping[int, int], column: str = "line"
) -> DataFrame:
    """``(place, head, tail, n, apart)``: :func:`wordloom.operators.counts.head_tail_counts` by place.

    ``apart`` tells the heads that lie in several places.
    """
    window_size(n)
    found = windows(lines, column, n).where(F.col("start").isNotNull())
    words, start = F.col("words"), F.col("start")
    gram = grams.gram(words, start, n)
    n_places = places(lines.sparkSession)
    moved = found.select(
        _place(grams.head(words, start), gram, spread, n_places), gram.alias("gram")
    ).repartitionById(n_places, "place")
    # Typed as never null, see wordloom.functions.grams.head.
    head = F.coalesce(F.substring_index("gram", grams.SEPARATOR, 1), F.lit(""))
    tail = F.coalesce(F.substring_index("gram", grams.SEPARATOR, 1 - n), F.lit(""))
    # An aggregate, or a test of it would be moved below the shuffle, and the lines read once for each outcome.
    apart = F.bool_or(_apart(head, spread)).alias("apart")
    counted = moved.groupBy("place", "gram").agg(F.count("*").alias("n"), apart)
    return counted.select("place", head.alias("head"), tail.alias("tail"), "n", "apart")


def stripe_texts(
    entries: DataFrame, spread: Mapping[int, int], part_bytes: int = stripes.PART_BYTES
) -> DataFrame:
    """As :func:`wordloom.operators.stripes.stripe_texts`, from entries by place."""
    rows = stripes.with_parts(entries, part_bytes, "place", "apart")
    here = rows.where(~F.col("apart")) if spread else rows
    packed = stripes.pack_texts(here, "place", "head", "part").select("head", "part", "stripe")
    if not spread:
        return packed
    return packed.union(stripes.pack_texts(rows.where(F.col("apart")), "head", "part"))


def merged(
    *tables: DataFrame, part_bytes: int = stripes.PART_BYTES, place_bytes: int = PLACE_BYTES
) -> DataFrame:
    """``(head, part, stripe)``: stripe tables of several corpora added up.

    Equal tails of a head are added, whatever parts they lie in, and the parts are laid out
    anew from the sums, so the result is that of one count over all of the corpora. Stripes are
    moved as texts, to the place of their head; only those of heads that fill several places are
    taken apart before. Such heads, at most one for each ``place_bytes`` of the tables, come to the
    driver when called.
    """
    texts = reduce(DataFrame.union, [t.select("head", "stripe") for t in tables])
    sizes = texts.groupBy(F.hash("head").alias("head")).agg(F.sum(F.octet_length("stripe")).alias("bytes"))
    large = {r["head"]: r["bytes"] for r in sizes.where(F.col("bytes") > place_bytes).collect()}
    spread = _spread(large, place_bytes)
    pieces = texts
    if spread:
        whole = F.when(~_apart(F.col("head"), spread), F.array("stripe"))
        parted = F.explode(F.coalesce(whole, F.split("stripe", ", ", -1)))
        pieces = texts.select("head", parted.alias("stripe"))
    n_places = places(texts.sparkSession)
    place = _place(F.col("head"), F.substring_index("stripe", ":", 1), spread, n_places)
    moved = pieces.select(place, "head", "stripe").repartitionById(n_places, "place")
    # No tail holds a colon or a space and no row a tail twice.
    held = moved.select("place", "head", F.explode(F.str_to_map("stripe", F.lit(", "), F.lit(":"))).alias("tail", "count"))
    count = F.coalesce("count", "tail").cast("bigint")
    entries = held.where(F.col("tail") != "").select("place", "head", "tail", count.alias("n"))
    apart = F.bool_or(_apart(F.col("head"), spread)).alias("apart")
    summed = entries.groupBy("place", "head", "tail").agg(F.sum("n").alias("n"), apart)
    return stripe_texts(summed, spread, part_bytes)
