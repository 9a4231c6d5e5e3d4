"""Lines with their place in a set of files, without a sort and without reading a file as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_places(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file, place, line)`` for every line of the files at ``path``.

    ``place`` is ``struct<file, block, row>``: the path, the offset at which the split begins that
    holds the line, and a number that grows within the split. Places compare as the lines
    stand, files in the order of their paths. They hold within one query: how a file is
    split, and so ``block`` and ``row``, depends on the session's settings.
    """
    paths = [path] if isinstance(path, str) else list(path)
    scan = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )
    return scan.select("file", F.struct("file", "block", "row").alias("place"), "line")
