"""Time the headline queries; prints one JSON line.

Every query runs to completion into a sink that drops the rows. The reported
time of a query is the median of ``BENCH_REPEATS`` runs (default 3) after the
session has been warmed up; the value is the sum over the queries. The order is
rotated from one repeat to the next, so that no query gains from its place.

The tables of the bench are files of one row group, which only one task can read. Their rows
are dealt out over ``BENCH_PARTITIONS`` tasks (default two a core; 0 for the registered form,
which moves nothing before counting) with the parameter that every text query has.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from functools import partial

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordloom.plans import catalog  # noqa: E402

HEADLINE = (
    "word_count",
    "total_word_count",
    "corpus_totals",
    "top_words",
    "cooccurrence_pairs",
    "cooccurrence_stripes",
    "ngram_pairs_3",
    "ngram_pairs_5",
    "ngram_pairs_10",
    "ngram_stripes_3",
    "ngram_stripes_5",
    "ngram_stripes_10",
    "line_stripes",
    "word_count_by_document",
    "gram_totals_1",
    "bottom_words",
    "tokens",
    "normalized_lines",
    "cooccurrence_stripes_in_parts",
    "ngram_stripes_3_in_parts",
    "run_recap",
    "tsv_round_trip",
    "stripes_tsv_round_trip",
    "word_count_from_files",
    "corpus_report",
    "gram_totals_10",
    "stripes_merged",
    "word_count_two_runs",
    "file_last_counts",
    "two_series_round_trip",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    dealt = int(os.environ.get("BENCH_PARTITIONS", 2 * int(cpus))) or None
    texts = {n: partial(q, partitions=dealt) for n, q in catalog.text_queries().items()}
    queries = catalog.queries() | texts

    def seconds(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("word_count", "cooccurrence_stripes"):
        seconds(name)
    taken: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for repeat in range(repeats):
        shift = repeat * len(HEADLINE) // repeats
        for name in HEADLINE[shift:] + HEADLINE[:shift]:
            taken[name].append(seconds(name))
    times = {name: round(statistics.median(runs), 3) for name, runs in taken.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
