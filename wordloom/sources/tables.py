"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


SPLIT_BYTES = 16 * 1024 * 1024


def small_splits(spark: SparkSession, most: int = SPLIT_BYTES) -> None:
    """Lower ``spark.sql.files.maxPartitionBytes`` of the session to ``most``.

    A word of a text becomes an n-gram, so what a task counts is many times what it reads, and
    almost all of it is different: with the splits of 128 MB that tables are read in by
    default, the first aggregate of n-grams does not fit a task and is spilled as a whole.

    What a file counts at least (``spark.sql.files.openCostInBytes``) is lowered by as much, or
    fewer small files than before would share a task.
    """
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    name, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    now = as_bytes(spark.conf.get(name))
    if now > most:
        spark.conf.set(name, str(most))
        spark.conf.set(cost, str(as_bytes(spark.conf.get(cost)) * most // now))


def read_table(
    spark: SparkSession, path: str, *columns: str, partitions: int | None = None
) -> DataFrame:
    """The named columns of a Parquet table; only these are read from the files.

    With ``partitions`` the rows are dealt out over so many tasks, which shuffles
    them. That is for tables whose files hold one row group each, which only one
    task can read however large it is; others are read in parallel as they are.
    """
    scan = spark.read.parquet(path).select(*columns)
    return scan if partitions is None else scan.repartition(partitions)
