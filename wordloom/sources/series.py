"""Files that hold two series of whole numbers, one blank line between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.tokens import stripped
from wordloom.sources.positions import read_places
from wordloom.sources.scratch import written


def read_two_series(
    spark: SparkSession, path: str | Sequence[str], names: tuple[str, str]
) -> DataFrame:
    """``(file, series, place, value)`` for every numeric line of the files at ``path``.

    ``place`` orders the values of a series as they stand in the file.

    Lines up to the first blank one belong to ``names[0]``, all later ones to
    ``names[1]``; lines that are not digits only are ignored. A file without a
    blank line, or with an empty series, fails the call; a file of no bytes gives
    no rows, as everywhere in Spark.

    The first blank line and the first and last number of each file are grouped minima and
    maxima over places, written to the shared folder; then each line is compared with the
    blank one of its file. A file is read in splits like any text, and its lines need not
    meet in one task.
    """
    lines = read_places(spark, path).select(
        "file", "place", stripped(F.col("line")).alias("value")
    )
    number = F.col("value").rlike("^[0-9]+$")
    marks = lines.groupBy("file").agg(
        F.min(F.when(F.col("value") == "", F.col("place"))).alias("cut"),
        F.min(F.when(number, F.col("place"))).alias("first"),
        F.max(F.when(number, F.col("place"))).alias("last"),
    )
    complete = (F.col("first") < F.col("cut")) & (F.col("cut") < F.col("last"))
    said = F.concat_ws(" ", F.lit("no blank line or an empty series in"), F.col("file"))
    cuts = marks.select(
        "file", F.when(complete, F.col("cut")).otherwise(F.raise_error(said)).alias("cut")
    )
    found = lines.where(number).join(written(cuts, "series-cuts"), "file")
    series = F.when(F.col("place") < F.col("cut"), F.lit(names[0])).otherwise(F.lit(names[1]))
    value = F.col("value").cast("bigint")
    return found.select("file", series.alias("series"), "place", value.alias("value"))
