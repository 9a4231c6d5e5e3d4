"""Stripes: for each first word, what follows it and how often.

The long form ``(head, tail, n)`` of :func:`~wordloom.operators.counts.head_tail_counts`
is the primary result. Packing it into one value per head comes after counting,
so each tail is packed once.

The stripe of a frequent head grows with the corpus and would at some size
neither fit a task nor a row. Such a head is laid out over several rows, told
apart by ``part``; together they hold the whole stripe. The bytes of each stripe
are summed first, and the tails of a head above ``part_bytes`` are dealt out by a
hash, so a row holds about ``part_bytes`` whatever the corpus: the limit is a
layout parameter and depends on nothing else.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import grams, stripes, tokens
from wordloom.functions.checks import at_least, window_size

PART_BYTES = 4 * 1024 * 1024

# Runs of equal lines, and of lines with equal text up to the first comma. Possessive, so that
# matching stays iterative however long a run is.
SAME_LINES = r"([^\n]+\n)\1*+"
SAME_HEADS = r"([^,\n]+,)[^\n]*+\n(?:\1[^\n]*+\n)*+"


def _hash_part(tail: Column, parts: Column) -> Column:
    """A part number that any SQL engine with md5 can recompute."""
    digest = F.conv(F.substring(F.md5(tail.cast("binary")), 1, 8), 16, 10)
    return F.pmod(digest.cast("bigint"), parts)


def with_parts(entries: DataFrame, part_bytes: int = PART_BYTES, *keep: str) -> DataFrame:
    """``(head, tail, n, part, first, *keep)``; ``part`` is 0 unless the stripe exceeds ``part_bytes``.

    ``first`` is 1 in one part of each head and 0 in its others: in the only one, or in that of
    the tail with the smallest hash.

    The large heads are found from the counts, whose shuffle is reused. There is at most one
    for each ``part_bytes`` of the stripes, so they are gathered in one row, of which the planner
    knows before it runs that it is small: it broadcasts them, and the entries are not
    shuffled for the join. Where broadcasts are switched off both sides are, and adaptive
    execution splits the entries of a head that is too large for one task.

    Heads are matched by a 64-bit hash. Should two share one, their bytes add up
    and they are split finer than needed; the stripes stay whole.
    """
    at_least("part_bytes", part_bytes, 1)
    entry_bytes = stripes.entry_bytes(F.col("tail"), F.col("n"))
    sizes = entries.groupBy(F.xxhash64("head").alias("hash")).agg(
        F.sum(entry_bytes).alias("bytes"), F.min(F.xxhash64("tail")).alias("least")
    )
    found = sizes.where(F.col("bytes") > part_bytes).select(
        F.struct("hash", F.ceil(F.col("bytes") / part_bytes).alias("parts"), "least").alias("large")
    )
    large = found.agg(F.collect_list("large").alias("large")).select(F.inline("large"))
    part = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(
        _hash_part(F.col("tail"), F.col("parts"))
    )
    first = F.col("parts").isNull() | (F.xxhash64("tail") == F.col("least"))
    return (
        entries.withColumn("hash", F.xxhash64("head"))
        .join(large, "hash", "left")
        .select("head", "tail", "n", part.cast("bigint").alias("part"), first.cast("int").alias("first"), *keep)
    )


def pack_texts(rows: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, stripe)``: ``t1:n1, t2:n2`` from all rows ``(*keys, tail, n)`` of equal keys."""
    entries = F.collect_list(stripes.entry(F.col("tail"), F.col("n")))
    return rows.groupBy(*keys).agg(stripes.as_text(entries).alias("stripe"))


def stripe_texts(entries: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``(head, part, stripe)`` with the stripe as ``t1:n1, t2:n2`` in tail order."""
    return pack_texts(with_parts(entries, part_bytes), "head", "part")


def measured_texts(entries: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """As :func:`stripe_texts`, with ``n``, the sum of the counts in the row, and ``first``."""
    packed = F.collect_list(stripes.entry(F.col("tail"), F.col("n")))
    return with_parts(entries, part_bytes).groupBy("head", "part").agg(
        stripes.as_text(packed).alias("stripe"), F.sum("n").alias("n"), F.max("first").alias("first")
    )


def entries_of(texts: DataFrame) -> DataFrame:
    """``(head, tail, n)`` from ``(head, part, stripe)``; the inverse of :func:`stripe_texts`."""
    held = texts.select("head", F.explode(stripes.parsed(F.col("stripe"))).alias("e"))
    return held.select("head", "e.tail", "e.n")


def merged(*tables: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``(head, part, stripe)``: stripe tables of several corpora added up.

    Equal tails of a head are added, whatever parts they lie in, and the parts are laid out
    anew from the sums, so the result is that of one count over all of the corpora. A stripe
    is only ever taken apart row by row.
    """
    entries = reduce(DataFrame.union, [entries_of(t) for t in tables])
    return stripe_texts(entries.groupBy("head", "tail").agg(F.sum("n").alias("n")), part_bytes)


def stripe_maps(entries: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``(head, part, stripe)`` with the stripe as ``map<tail, n>``."""
    found = F.sort_array(F.collect_list(F.struct("tail", "n")))
    rows = with_parts(entries, part_bytes)
    return rows.groupBy("head", "part").agg(stripes.as_map(found).alias("stripe"))


def line_stripes(lines: DataFrame, n: int, *keys: str, column: str = "line") -> DataFrame:
    """``(*keys, head, stripe)``: the stripes of each single line.

    A line is counted inside its row: its n-grams are sorted as texts and joined, one a line, and
    patterns find the runs of equal ones and those of one head. No word holds a comma, a colon or a
    line end, so the n-grams of a head stand side by side, in the order of their tails.
    Nothing is shuffled. A stripe is bounded by its line.
    """
    window_size(n)
    words = lines.select(*keys, tokens.words(F.col(column)).alias("words"))
    # The words pass through a generator, or the lambda would tokenize anew each time.
    held = words.select(*keys, F.explode_outer(F.array("words")).alias("words"))
    found = F.transform(
        grams.starts(F.col("words"), n), lambda i: grams.gram(F.col("words"), i, n)
    )

    def entry(run: Column) -> Column:
        gram = F.substring_index(run, "\n", 1)
        count = (F.octet_length(run) / (F.octet_length(gram) + 1)).cast("bigint")
        return F.concat(gram, F.lit(":"), count.cast("string"), F.lit("\n"))

    joined = F.concat(F.array_join(F.sort_array(found), "\n"), F.lit("\n"))
    entries = F.transform(F.regexp_extract_all(joined, F.lit(SAME_LINES), 0), entry)
    groups = F.regexp_extract_all(F.array_join(entries, ""), F.lit(SAME_HEADS), 0)
    rows = held.select(*keys, F.explode_outer(groups).alias("group"))
    head = F.substring_index("group", grams.SEPARATOR, 1)
    behind = F.length(head) + 2
    stripe = F.replace(
        F.substring("group", behind, F.length("group") - behind),
        F.concat(F.lit("\n"), head, F.lit(grams.SEPARATOR)),
        F.lit(", "),
    )
    return rows.where(F.col("group").isNotNull()).select(
        *keys, head.alias("head"), stripe.alias("stripe")
    )
