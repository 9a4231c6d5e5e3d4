"""Connected components of a link table, by alternating large-star and small-star rounds.

Published as "Connected Components in MapReduce and Beyond" (Kiveris et al., 2014):
every round is two joins and two grouped minima, so no component is ever held in
one place, and the rounds needed grow with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.sources.scratch import written


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    """A fingerprint of the set of edges: two numbers, whatever their amount."""
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that is linked to a smaller one of its component.

    ``links`` is ``(u, v)``, two integers, in either order; loops and repeated
    links do no harm. ``root`` is the smallest node reachable. Roots themselves and
    nodes without a link are not listed. Each round is written to the shared
    folder, so a lost executor costs that round only.
    """
    larger, smaller = F.greatest("u", "v"), F.least("u", "v")
    proper = links.where(F.col("u") != F.col("v"))
    edges = written(proper.select(larger.alias("u"), smaller.alias("v")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m"))
        nearest = nearest.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(nearest, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.where(F.col("u") != F.col("v")).union(least).distinct()
        edges = written(small, "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
