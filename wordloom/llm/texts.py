"""Column expressions over whole texts that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A word is a run of characters other than the six ASCII spaces.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def spaced_words(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("bigint")


def text_key(text: Column) -> Column:
    """A 64-bit hash, never null, that tells apart rows of one id with different texts."""
    return F.xxhash64(text)


def outside(spans: Column, size: Column) -> Column:
    """The gaps ``struct<start, n>`` that merged, sorted ``spans`` leave in ``size`` positions.

    Positions count from 0; a span is ``struct<start, stop>`` without its stop.
    """
    nothing = F.array().cast("array<struct<start:int,stop:int>>")
    found = F.coalesce(spans, nothing)
    starts = F.concat(F.array(F.lit(0)), F.transform(found, lambda s: s["stop"].cast("int")))
    stops = F.concat(F.transform(found, lambda s: s["start"].cast("int")), F.array(size.cast("int")))
    return F.transform(
        F.arrays_zip(starts.alias("start"), stops.alias("stop")),
        lambda g: F.struct(g["start"].alias("start"), (g["stop"] - g["start"]).alias("n")),
    )


def kept_pieces(pieces: Column, spans: Column) -> Column:
    """``pieces`` without those at the positions of ``spans``; linear in the pieces."""
    gaps = outside(spans, F.size(pieces))
    return F.flatten(F.transform(gaps, lambda g: F.slice(pieces, g["start"] + 1, g["n"])))


def unused(columns: Sequence[str], name: str) -> str:
    """``name``, or a longer one where a table has a column of that name already."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def replacing(table: DataFrame, *outputs: str) -> DataFrame:
    """``table`` without the columns whose place output columns of the same name take."""
    names = {name.lower() for name in outputs}
    return table.drop(*[c for c in table.columns if c.lower() in names])


def bounded_sample(table: DataFrame, rows: int, *columns: str) -> DataFrame:
    """The ``rows`` rows of ``table`` with the smallest hashes of ``columns``, or all of fewer.

    The hash lets about four times as many through as are wanted, so few rows are sorted,
    however large the table and however many its tasks. Rows of equal hashes are chosen by
    ``columns``, so the sample is the same in every run.
    """
    n = table.count()
    if n <= rows:
        return table
    scale = 1 << 40
    share = min(scale, -(-4 * rows * scale // n))
    at = F.pmod(F.xxhash64(*columns), F.lit(scale))
    return table.where(at < share).orderBy(at, *columns).limit(rows)
