"""Whole counting jobs: text files in, key-sorted TSV files and run statistics out.

    spark-submit --py-files wordloom.zip wordloom/plans/jobs.py ngram_pairs IN OUT --window 3
    spark-submit --py-files wordloom.zip wordloom/plans/jobs.py ngram_pairs OUT/output_run_0 OUT --run 2 --add OUT/output_run_1

The second form adds up the outputs of earlier runs.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.checks import at_least, window_size
from wordloom.operators import counts, expand, stripes
from wordloom.sources.lines import read_lines
from wordloom.sources.tsv import read_counts, read_stripes, write_tsv


# What a job measures of each row it writes, beside the columns it writes.
MEASURES = ("lines", "emitted", "groups")


@dataclass(frozen=True)
class Job:
    """How to build a result with ``MEASURES``, and which of its columns to write.

    ``build`` takes lines and a window. Rows with a null in the last column only carry measures.
    ``add`` adds up outputs of the job that have been read by ``read``.
    """

    build: Callable[[DataFrame, int], DataFrame]
    columns: tuple[str, ...]
    read: Callable[[SparkSession, str], DataFrame]
    add: Callable[..., DataFrame]


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """Counts of ``rows`` with marks; the row of the marks has the number of lines."""
    found = counts.count_by(rows, key)
    mark = F.col(key).isNull()
    return found.select(
        key,
        F.when(~mark, F.col("n")).alias("n"),
        F.when(mark, F.col("n")).alias("lines"),
        F.when(~mark, F.col("n")).alias("emitted"),
        F.when(~mark, F.lit(1)).alias("groups"),
    )


def _total(lines: DataFrame) -> DataFrame:
    found = counts.total_with_lines(lines)
    some = F.when(F.col("n") > 0, F.col("n"))
    return found.select(
        F.lit("word").alias("key"),
        some.alias("n"),
        "lines",
        some.alias("emitted"),
        F.when(F.col("n") > 0, F.lit(1)).alias("groups"),
    )


def _stripes(lines: DataFrame, n: int, part_bytes: int = stripes.PART_BYTES) -> DataFrame:
    entries = counts.count_by(expand.head_tails(lines, n, marks=True), "head", "tail")
    mark = F.col("head") == ""
    return stripes.measured_texts(entries, part_bytes).select(
        "head",
        "part",
        F.when(~mark, F.col("stripe")).alias("stripe"),
        F.when(mark, F.col("n")).alias("lines"),
        F.when(~mark, F.col("n")).alias("emitted"),
        F.when(~mark, F.col("first")).alias("groups"),
    )


STRIPE = ("head", "part", "stripe")


def _read_keyed(key: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, path: read_counts(spark, path).withColumnRenamed("word", key)


def _count_job(key: str, rows: Callable[[DataFrame, int], DataFrame]) -> Job:
    return Job(
        lambda lines, n: _counted(rows(lines, n), key),
        (key, "n"),
        _read_keyed(key),
        lambda *tables: counts.merged(*tables, key=key),
    )


def _stripe_job(build: Callable[[DataFrame, int], DataFrame]) -> Job:
    return Job(build, STRIPE, read_stripes, stripes.merged)


JOBS = {
    "word_count": _count_job("word", lambda lines, n: expand.explode_words(lines, "line", marks=True)),
    "total_word_count": Job(
        lambda lines, n: _total(lines),
        ("key", "n"),
        _read_keyed("key"),
        lambda *tables: counts.merged(*tables, key="key"),
    ),
    "cooccurrence_pairs": _count_job("gram", lambda lines, n: expand.ngrams(lines, 2, marks=True)),
    "cooccurrence_stripes": _stripe_job(lambda lines, n: _stripes(lines, 2)),
    "ngram_pairs": _count_job("gram", lambda lines, n: expand.ngrams(lines, n, marks=True)),
    "ngram_stripes": _stripe_job(lambda lines, n: _stripes(lines, n)),
}

RUN_SCHEMA = (
    "job string, run bigint, duration_ms bigint, window int, files int, output string, "
    "lines_read bigint, items_counted bigint, groups_written bigint"
)


def _checked(name: str, run: int, files: int | None) -> Job:
    if name not in JOBS:
        raise ValueError(f"unknown job {name!r}, expected one of {', '.join(JOBS)}")
    at_least("run", run, 0)
    if files is not None:
        at_least("files", files, 1)
    return JOBS[name]


def run_job(
    spark: SparkSession,
    name: str,
    input_path: str,
    output_path: str,
    window: int = 2,
    files: int | None = None,
    run: int = 0,
    stats_path: str | None = None,
) -> DataFrame:
    """Run a job and return a row of statistics; a job that fails raises.

    The output goes to ``output_path/output_run_<run>``, which must not exist.
    ``files`` sets the number of output files; by default Spark keeps the
    partitions of the count. ``stats_path`` is a Parquet table the row is appended
    to.

    The statistics are sums over the rows of the result, taken in the tasks that write
    them, so the input is read once and the output is not read again. The engine adds
    what a writing task reports once for each part of the result, as it commits its file
    once, however often the task or an earlier one has run. ``items_counted`` are the
    words or n-grams that were counted, ``groups_written`` the different ones (of stripes, the
    heads).
    """
    job = _checked(name, run, files)
    window_size(window)
    output = f"{output_path.rstrip('/')}/output_run_{run}"
    table = job.build(read_lines(spark, input_path), window)
    measured = Observation()
    sums = [F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES]

    def last(rows: DataFrame) -> DataFrame:
        return rows.observe(measured, *sums).where(F.col(job.columns[-1]).isNotNull())

    start = time.monotonic()
    write_tsv(table, output, *job.columns, files=files, last=last)
    millis = int((time.monotonic() - start) * 1000)
    found = measured.get
    row = Row(
        job=name,
        run=run,
        duration_ms=millis,
        window=window,
        files=files,
        output=output,
        lines_read=found["lines"],
        items_counted=found["emitted"],
        groups_written=found["groups"],
    )
    stats = spark.createDataFrame([row], RUN_SCHEMA)
    if stats_path is not None:
        stats.write.mode("append").parquet(stats_path)
    return stats


def add_runs(
    spark: SparkSession,
    name: str,
    outputs: Sequence[str],
    output_path: str,
    files: int | None = None,
    run: int = 0,
) -> str:
    """Add up ``outputs`` of runs of one job and return the path of the sums.

    They are what one run over all of the inputs would have written, to
    ``output_path/output_run_<run>``, without reading any input again.
    """
    job = _checked(name, run, files)
    if not outputs:
        raise ValueError("no outputs to add up")
    output = f"{output_path.rstrip('/')}/output_run_{run}"
    total = job.add(*[job.read(spark, path) for path in outputs])
    write_tsv(total, output, *job.columns, files=files)
    return output


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Count words, pairs or n-grams of text files.")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("input", help="the folder of texts; with --add the output of a run")
    parser.add_argument("output")
    parser.add_argument("--window", type=int, default=2)
    parser.add_argument("--files", type=int)
    parser.add_argument("--run", type=int, default=0)
    parser.add_argument("--stats")
    parser.add_argument("--add", nargs="+", help="outputs of further runs to add to that of the first")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(given.job).getOrCreate()
    if given.add:
        outputs = [given.input, *given.add]
        print(add_runs(spark, given.job, outputs, given.output, given.files, given.run))
        return
    run_job(
        spark,
        given.job,
        given.input,
        given.output,
        given.window,
        given.files,
        given.run,
        given.stats,
    ).show(truncate=False)


if __name__ == "__main__":
    main()
