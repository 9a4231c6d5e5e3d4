"""Covered positions, merged key by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merged(ranges: DataFrame, keys: Sequence[str], union: str | None = None) -> DataFrame:
    """``(*keys, spans, covered)`` from rows ``(*keys, start, stop)``; ``stop`` is not covered.

    Ranges that overlap or touch become one ``struct<start, stop>`` of the sorted
    array ``spans``; ``covered`` is the number of positions in them. ``union``
    names a column whose distinct values are returned as an array as well. Equal ranges are
    made one, then there is one shuffle, on the keys. What is collected for a key is what is
    left after merging, so repeated and overlapping ranges add nothing.
    """
    # Equal ranges of many equal rows are one before those of a key meet.
    ranges = ranges.select(*keys, "start", "stop", *[union] * (union is not None)).distinct()
    order = Window.partitionBy(*keys).orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(reached.isNull() | (F.col("start") > reached), 1).otherwise(0)
    islands = ranges.withColumn("_opened", opened).withColumn(
        "_island", F.sum("_opened").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    of_island = [F.min("start").alias("start"), F.max("stop").alias("stop")]
    of_key = [
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"),
        F.sum(F.col("stop") - F.col("start")).cast("bigint").alias("covered"),
    ]
    if union is not None:
        of_island.append(F.collect_set(union).alias(union))
        of_key.append(F.array_distinct(F.flatten(F.collect_set(union))).alias(union))
    return islands.groupBy(*keys, "_island").agg(*of_island).groupBy(*keys).agg(*of_key)
