"""Count tables in buckets: the hash of a key tells the file that holds it.

A join on the key with such a table shuffles the other side only, to the buckets, so a count
table of a large corpus takes up a further run at the cost of that run.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from wordloom.functions.checks import at_least

BUCKETS = 64


def _name(*parts: object) -> str:
    return "buckets_" + hashlib.md5(repr(parts).encode()).hexdigest()


def write_buckets(table: DataFrame, path: str, key: str = "word", buckets: int = BUCKETS) -> DataFrame:
    """Write ``table`` to the new folder ``path`` and return it as :func:`read_buckets` does.

    Rows that lie in as many partitions by ``key`` already, as those of
    :func:`wordloom.operators.counts.added`, are written from there.
    """
    at_least("buckets", buckets, 1)
    spark = table.sparkSession
    name = _name("write", path)
    (
        table.repartition(buckets, key)
        .write.format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .mode("errorifexists")
        .saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # of the name only: the files are the caller's
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    return read_buckets(spark, path, columns, key, buckets)


def read_buckets(
    spark: SparkSession, path: str, columns: str = "word string, n bigint", key: str = "word", buckets: int = BUCKETS
) -> DataFrame:
    """The table at ``path``, written with the same ``key`` and number of ``buckets``.

    The session keeps the name under which the planner knows the buckets.
    """
    at_least("buckets", buckets, 1)
    name, place = _name(path, columns, key, buckets), path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
