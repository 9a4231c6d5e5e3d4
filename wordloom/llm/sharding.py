"""Sharding by a keyed permutation of global row numbers.

Rows are numbered 0 to N-1 in the order of their ids. A Feistel network permutes the
numbers of a power-of-four domain that is at least N and below 4N, or 1; a number that
leaves the range is put through it again until it comes back (cycle walking), which
makes a permutation of 0 to N-1. Row ``n`` with permuted number ``p`` stands in shard
``p mod shards`` at slot ``p div shards``: shards differ by one row at most, slots have no
gaps, and where a row goes, or which row stands where, is arithmetic on its number
and the key, without a table.

Numbering is distributed: rows are sorted by ranges of id, numbered inside each range,
and the sizes of the ranges in front are added.

Defined cases: null ids come first; rows that share an id are ordered by a hash of the
text, and equal rows are interchangeable. A table without rows gives none. Other columns
are passed through, but one with the name of an output column is replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.checks import at_least
from wordloom.llm.shipping import send_code
from wordloom.llm.texts import replacing, text_key, unused
from wordloom.sources.scratch import written

SHARDS = 8
KEY = "shards"
ROUNDS = 6
PRIME = (1 << 31) - 1  # products of two numbers below it fit 64 bits
_LOCAL_BITS = 33  # of monotonically_increasing_id: the row inside its partition


def round_keys(key: str, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Three numbers below ``PRIME`` for each round, from a hash of ``key``; the first is odd."""
    keys = []
    for i in range(rounds):
        digest = hashlib.sha256(f"{key}:{i}".encode()).digest()
        a, b, c = (int.from_bytes(digest[k : k + 8], "big") % PRIME for k in (0, 8, 16))
        keys.append((a | 1, b, c))
    return keys


def half_of(rows: int) -> int:
    """The smallest power of two whose square is at least ``rows``."""
    half = 1
    while half * half < rows:
        half *= 2
    return half


def permuted(
    numbers: np.ndarray, rows: int, key: str = KEY, inverse: bool = False
) -> np.ndarray:
    """The permutation of ``0 .. rows-1`` that belongs to ``key``, or its inverse, at ``numbers``.

    Row ``n`` goes to ``permuted([n])``; what stands at slot ``s`` of shard ``k`` is row
    ``permuted([s * shards + k], inverse=True)``.
    """
    half = half_of(rows)
    if half > PRIME:
        raise ValueError(f"{rows} rows are more than {PRIME**2}")
    keys = round_keys(key)

    def mixed(part: np.ndarray, a: int, b: int, c: int) -> np.ndarray:
        line = (part * a + b) % PRIME
        return (line * line + c) % PRIME % half

    out = np.array(numbers, np.int64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] // half, out[walking] % half
        for round_key in keys[::-1] if inverse else keys:
            if inverse:
                left, right = right ^ mixed(left, *round_key), left
            else:
                left, right = right, left ^ mixed(right, *round_key)
        out[walking] = left * half + right
        walking = walking[out[walking] >= rows]
    return out


def numbered(rows: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """``rows`` with their number in ``order``, from 0, in a table written for it."""
    local = unused(rows.columns, "local")
    sort = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(sort.withColumn(local, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(local, _LOCAL_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row a task
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(ahead), F.lit(0))
    as_base = unused(rows.columns, "base")
    bases = written(sizes.select(F.struct("part", base.alias("rows")).alias(as_base)), "bases")
    inside = F.col(local).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    joined = placed.join(bases, part == F.col(as_base)["part"])
    return joined.withColumn(name, inside + F.col(as_base)["rows"]).drop(local, as_base)


def shard_rows(
    docs: DataFrame,
    shards: int = SHARDS,
    key: str = KEY,
    doc_id: str = "doc_id",
    text: str = "text",
    shard_as: str = "shard",
    slot_as: str = "slot",
) -> DataFrame:
    """``docs`` with the shard and the slot of each row."""
    at_least("shards", shards, 1)
    send_code(docs.sparkSession)
    docs = replacing(docs, shard_as, slot_as)
    number = unused(docs.columns, "row_number")
    placed = numbered(docs, [F.col(doc_id), text_key(F.col(text))], number)
    rows = placed.count()

    @F.pandas_udf("bigint")
    def permute(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), rows, key))

    at = permute(F.col(number))
    placed = placed.withColumn(number, at)
    return placed.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        (F.col(number) % shards).cast("int").alias(shard_as),
        F.floor(F.col(number) / shards).cast("bigint").alias(slot_as),
    )
