"""Summaries over job runs and over measured series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.units import format_bytes, format_mean_bytes, format_millis


def run_recap(
    runs: DataFrame,
    byte_means: Sequence[str] = (),
    means: Sequence[str] = (),
    last: Sequence[str] = (),
) -> DataFrame:
    """One row per job from ``runs(job, run, succeeded, duration_ms, ...)``.

    ``run`` orders the runs of a job. Durations and the measures in
    ``byte_means`` and ``means`` are averaged over the successful runs and cut
    to whole numbers; measures in ``last`` keep the value of the last
    successful run. A job that never succeeded shows zeros.
    """
    ok = F.col("succeeded")
    good = F.count(F.when(ok, 1))

    def total(name: str):
        return F.coalesce(F.sum(F.when(ok, F.col(name))), F.lit(0))

    def mean(name: str):
        return F.when(F.col("successful_runs") == 0, F.lit(0).cast("bigint")).otherwise(
            F.expr(f"`{name}` div successful_runs")
        )

    summed = ["duration_ms", *byte_means, *means]
    grouped = runs.groupBy("job").agg(
        good.alias("successful_runs"),
        F.count("*").alias("total_attempts"),
        *[total(name).alias(name) for name in summed],
        *[
            F.coalesce(
                F.max_by(F.when(ok, F.col(name)), F.when(ok, F.col("run"))), F.lit(0)
            ).alias(name)
            for name in last
        ],
    )
    return grouped.select(
        "job",
        "successful_runs",
        "total_attempts",
        (F.col("total_attempts") - F.col("successful_runs")).alias("failed_runs"),
        format_millis(F.col("duration_ms")).alias("total_time"),
        format_millis(mean("duration_ms")).alias("average_time"),
        *[format_bytes(mean(name)).alias(f"avg_{name}") for name in byte_means],
        *[mean(name).alias(f"avg_{name}") for name in means],
        *last,
    )


def series_means(values: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, mean, shown)`` from ``values(*keys, value)`` with whole-number values.

    The sum is exact, so the mean does not depend on how the rows are split.
    """
    mean = F.sum("value").cast("double") / F.count("value")
    return (
        values.groupBy(*keys)
        .agg(mean.alias("mean"))
        .withColumn("shown", format_mean_bytes(F.col("mean")))
    )
