"""Counting equal elements inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once.

    Inside a lambda the optimizer would put the whole expression in the place of a
    column and compute it again for each element; a lambda variable stays one.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def run_starts(items: Column, same: Callable[[Column, Column], Column]) -> Column:
    """1-based positions at which a run of neighbours that are the ``same`` begins."""
    positions = F.sequence(F.lit(1), F.size(items))
    return F.filter(
        F.when(F.size(items) > 0, positions),
        lambda i: (i == 1) | ~same(F.get(items, i - 1), F.get(items, i - 2)),
    )


def runs(starts: Column, size: Column) -> Column:
    """``struct<start, n>`` of each run from its start and the number of all elements."""
    nexts = F.concat(F.slice(starts, 2, F.size(starts)), F.array(size + 1))
    return F.transform(
        F.arrays_zip(starts.alias("start"), nexts.alias("next")),
        lambda r: F.struct(r["start"].alias("start"), (r["next"] - r["start"]).alias("n")),
    )


def counted(items: Column) -> Column:
    """``struct<item, n>`` of the distinct ``items`` in ascending order; null for null or none.

    One sort, then passes that are linear in the array.
    """

    def of_sorted(found: Column) -> Column:
        starts = run_starts(found, lambda a, b: a == b)
        return bound(
            starts,
            lambda s: F.transform(
                runs(s, F.size(found)),
                lambda r: F.struct(
                    F.get(found, r["start"] - 1).alias("item"), r["n"].cast("bigint").alias("n")
                ),
            ),
        )

    return bound(F.sort_array(items), of_sorted)
