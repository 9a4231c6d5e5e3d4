"""Line records, from text files or from a text column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_END = r"\r\n|\r|\n"


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row ``(line)`` per line of the files under ``path``.

    Spark packs small files into shared read tasks
    (``spark.sql.files.maxPartitionBytes``, ``spark.sql.files.openCostInBytes``).
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths).withColumnRenamed("value", "line")


def lines_of(texts: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row ``(*keep, line_no, line)`` per line of ``column``.

    A line ends at LF, CR or CRLF. A text that ends with a line end has no
    empty line behind it, and an empty or null text has no line.
    """
    parts = texts.select(*keep, F.split(column, LINE_END, -1).alias("_parts"))
    last = F.element_at("_parts", -1)
    size = F.size("_parts") - F.when(last == "", 1).otherwise(0)
    return (
        parts.select(*keep, F.posexplode_outer(F.slice("_parts", 1, size)).alias("line_no", "line"))
        .where(F.col("line").isNotNull())
        .withColumn("line_no", F.col("line_no").cast("bigint"))
    )
