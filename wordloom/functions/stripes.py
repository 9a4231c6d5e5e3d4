"""Entries of a stripe and its views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stands between tail and count until the entries are joined. It sorts below
# every character a token can hold, so entries sort exactly as their tails do.
_MARK = "\x01"


def entry(tail: Column, n: Column) -> Column:
    """One ``(tail, n)`` as text, in the form :func:`as_text` expects."""
    return F.concat(tail, F.lit(_MARK), n.cast("string"))


def as_text(entries: Column) -> Column:
    """``t1:n1, t2:n2`` in tail order from an array of :func:`entry`."""
    joined = F.array_join(F.sort_array(entries), ", ")
    return F.replace(joined, F.lit(_MARK), F.lit(":"))


def parsed(stripe: Column) -> Column:
    """``array<struct<tail, n>>`` from a text as :func:`as_text` makes it; a count that is none fails.

    No tail holds a colon or a space, so the text has one reading.
    """
    pieces = F.filter(F.split(stripe, ", ", -1), lambda e: e != "")
    return F.transform(
        pieces,
        lambda e: F.struct(
            F.substring_index(e, ":", 1).alias("tail"),
            F.substring_index(e, ":", -1).cast("bigint").alias("n"),
        ),
    )


def as_map(entries: Column) -> Column:
    """``map<tail, n>`` from an array of ``struct<tail, n>``."""
    return F.map_from_entries(entries)


def entry_bytes(tail: Column, n: Column) -> Column:
    """UTF-8 bytes one entry takes in :func:`as_text`, separators included."""
    return F.octet_length(tail) + F.length(n.cast("string")) + 3
