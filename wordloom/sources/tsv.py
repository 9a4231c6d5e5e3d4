"""Tab-separated files of keys and a value, sorted by key inside each file."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.checks import at_least
from wordloom.functions.tokens import stripped
from wordloom.sources.positions import read_places


def write_tsv(
    table: DataFrame,
    path: str,
    *columns: str,
    files: int | None = None,
    last: Callable[[DataFrame], DataFrame] | None = None,
    compression: str | None = None,
) -> None:
    """Write ``columns`` as tab-separated lines; fail if ``path`` exists.

    The last column is the value, those in front of it are the key, by which the
    lines of a file are sorted. With ``files`` the rows are hashed by the key into
    that many files, less those no key falls into. Without it the rows stay in the
    partitions they were counted in, which saves a shuffle of the whole result;
    adaptive execution has then already merged the small ones. ``last`` is applied to the
    rows in the tasks that write them. ``compression`` is that of Spark's text files, which are
    read as plain ones are.
    """
    keys = columns[:-1]
    if files is not None:
        at_least("files", files, 1)
        # Not on the bare columns: the table may be partitioned by them already,
        # Spark would then drop this step, and the number of files with it.
        table = table.repartition(files, F.xxhash64(*keys))
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in columns])
    table = table.sortWithinPartitions(*keys)
    if last is not None:
        table = last(table)
    table.select(line.alias("value")).write.mode("errorifexists").text(path, compression=compression)


def read_counts(spark: SparkSession, path: str | Sequence[str], places: bool = False) -> DataFrame:
    """``(word, n)`` from lines with exactly two fields; with ``places`` also ``place``.

    ``n`` is null where the second field is not a whole number; the row stays,
    because such a word still counts towards the vocabulary. A word that a file repeats
    has a row for each of its lines; see :func:`wordloom.operators.ranking.last_counts`.
    """
    lines = read_places(spark, path) if places else spark.read.text(path).withColumnRenamed("value", "line")
    kept = ["place"] if places else []
    fields = lines.select(F.split(stripped(F.col("line")), "\t", -1).alias("f"), *kept)
    return fields.where(F.size("f") == 2).select(
        F.get("f", F.lit(0)).alias("word"),
        F.get("f", F.lit(1)).try_cast("bigint").alias("n"),
        *kept,
    )


def read_stripes(spark: SparkSession, path: str) -> DataFrame:
    """``(head, part, stripe)`` as written; every stripe file holds all three."""
    fields = spark.read.text(path).select(F.split("value", "\t", 3).alias("f"))
    return fields.select(
        F.get("f", F.lit(0)).alias("head"),
        F.get("f", F.lit(1)).cast("bigint").alias("part"),
        F.get("f", F.lit(2)).alias("stripe"),
    )
