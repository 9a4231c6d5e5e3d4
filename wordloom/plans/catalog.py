"""The registered queries: ``name -> callable(spark, table_folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.tokens import normalized
from wordloom.operators import codes, counts, expand, placed, profile, ranking, rare, recap, stripes
from wordloom.sources.buckets import write_buckets
from wordloom.sources.lines import lines_of, read_lines
from wordloom.sources.scratch import scratch_path
from wordloom.sources.series import read_two_series
from wordloom.sources.tables import read_table, small_splits
from wordloom.sources.tsv import read_counts, read_stripes, write_tsv

Query = Callable[[SparkSession, str], DataFrame]

# Small enough that frequent heads of the test tables fill several parts.
SMALL_PART_BYTES = 16 * 1024
COUNT_BUCKETS = 16
# n-grams of so many words hardly repeat: they are not counted before they are moved.
LONG = 5


def _texts(spark, folder, *keep, table="documents", column="text", partitions=None):
    path = f"{folder}/{table}.parquet"
    return read_table(spark, path, *keep, column, partitions=partitions)


def _lines(spark, folder, *keep, table="documents", column="text", partitions=None):
    small_splits(spark)
    texts = _texts(spark, folder, *keep, table=table, column=column, partitions=partitions)
    return lines_of(texts, column, *keep)


def line_records(spark, folder, partitions=None):
    return _lines(spark, folder, "doc_id", partitions=partitions)


def normalized_lines(spark, folder, partitions=None):
    lines = _lines(spark, folder, "doc_id", partitions=partitions)
    return lines.select("doc_id", "line_no", normalized(F.col("line")).alias("normalized"))


def tokens(spark, folder, partitions=None):
    return expand.explode_positions(
        _lines(spark, folder, "doc_id", partitions=partitions), "line", "doc_id", "line_no"
    )


def word_count(spark, folder, table="documents", column="text", partitions=None):
    texts = _texts(spark, folder, table=table, column=column, partitions=partitions)
    return counts.word_counts(texts, column)


def total_word_count(spark, folder, table="documents", column="text", partitions=None):
    texts = _texts(spark, folder, table=table, column=column, partitions=partitions)
    return counts.total_count(texts, column)


def ngram_pairs(spark, folder, n, table="documents", column="text", partitions=None):
    lines = _lines(spark, folder, table=table, column=column, partitions=partitions)
    return counts.ngram_counts(lines, n)


def coded_ngram_pairs(spark, folder, n, partitions=None):
    """As :func:`ngram_pairs`, counted by coded keys; the dictionary is made when called."""
    lines = _lines(spark, folder, partitions=partitions)
    return codes.ngram_counts(lines, n, codes.dictionary_of(lines))


def rare_ngram_pairs(spark, folder, n, partitions=None):
    """As :func:`ngram_pairs`, moved by rare words; the frequent ones are found when called."""
    frequent = rare.frequent_hashes(_texts(spark, folder), "text")
    return rare.ngram_counts(_lines(spark, folder, partitions=partitions), n, frequent)


def combined_ngram_pairs(spark, folder, n, partitions=None):
    """As :func:`rare_ngram_pairs`, from lines that are counted before they are moved."""
    frequent = rare.frequent_hashes(_texts(spark, folder), "text")
    return rare.combined_counts(_lines(spark, folder, partitions=partitions), n, frequent)


def cooccurrence_pairs(spark, folder, partitions=None):
    return counts.pair_counts(_lines(spark, folder, partitions=partitions))


def ngram_head_tail(spark, folder, n, partitions=None):
    lines = _lines(spark, folder, "doc_id", partitions=partitions)
    return expand.head_tails(lines, n, "line", "doc_id", "line_no")


def head_tail_counts(spark, folder, n, table="documents", column="text", partitions=None):
    lines = _lines(spark, folder, table=table, column=column, partitions=partitions)
    return counts.head_tail_counts(lines, n)


def ngram_stripes(
    spark,
    folder,
    n,
    part_bytes=stripes.PART_BYTES,
    table="documents",
    column="text",
    partitions=None,
):
    if n < LONG:
        entries = head_tail_counts(spark, folder, n, table, column, partitions)
        return stripes.stripe_texts(entries, part_bytes)
    spread = placed.spread_heads(_texts(spark, folder, table=table, column=column), n, column)
    lines = _lines(spark, folder, table=table, column=column, partitions=partitions)
    return placed.stripe_texts(placed.head_counts(lines, n, spread), spread, part_bytes)


def _halves(spark, folder, partitions):
    """The texts of documents with an even and with an odd id."""
    texts = _texts(spark, folder, "doc_id", partitions=partitions)
    return [texts.where(F.pmod("doc_id", F.lit(2)) == half) for half in (0, 1)]


def stripes_merged(spark, folder, n=2, partitions=None):
    """Stripe files of the two halves of the documents, written, read and added up.

    Writes files when called, as :func:`tsv_round_trip`; frequent heads fill several parts.
    """
    small_splits(spark)
    spread = placed.spread_heads(_texts(spark, folder), n, "text")
    tables = []
    for texts in _halves(spark, folder, partitions):
        path = scratch_path(spark, "stripes")
        entries = placed.head_counts(lines_of(texts, "text"), n, spread)
        packed = placed.stripe_texts(entries, spread, SMALL_PART_BYTES)
        write_tsv(packed, path, "head", "part", "stripe", compression="gzip")
        tables.append(read_stripes(spark, path))
    return placed.merged(*tables, part_bytes=SMALL_PART_BYTES)


def word_count_two_runs(spark, folder, partitions=None):
    """Counts of one half of the documents in buckets, those of the other added to them.

    Writes files when called, as :func:`tsv_round_trip`.
    """
    older, newer = (counts.word_counts(t, "text") for t in _halves(spark, folder, partitions))
    known = write_buckets(older, scratch_path(spark, "count-buckets"), "word", COUNT_BUCKETS)
    return counts.added(known, newer)


def stripe_maps(spark, folder, partitions=None):
    """The map view of stripes, laid out again as one row an entry."""
    maps = stripes.stripe_maps(
        head_tail_counts(spark, folder, 2, partitions=partitions), SMALL_PART_BYTES
    )
    return maps.select("head", "part", F.explode("stripe").alias("tail", "n"))


def line_stripes(spark, folder, n=2, partitions=None):
    lines = _lines(spark, folder, "doc_id", partitions=partitions)
    return stripes.line_stripes(lines, n, "doc_id", "line_no")


def word_count_by_document(spark, folder, partitions=None):
    texts = _texts(spark, folder, "doc_id", partitions=partitions)
    return counts.word_counts_by_row(texts, "doc_id", column="text")


def gram_totals(spark, folder, n, partitions=None):
    return profile.gram_totals(_lines(spark, folder, partitions=partitions), n)


def corpus_totals(spark, folder, partitions=None):
    return profile.corpus_totals(word_count(spark, folder, partitions=partitions))


def top_words(spark, folder, partitions=None):
    return ranking.most_frequent(word_count(spark, folder, partitions=partitions))


def bottom_words(spark, folder, partitions=None):
    return ranking.least_frequent(word_count(spark, folder, partitions=partitions))


def corpus_report(spark, folder, partitions=None):
    return profile.corpus_report(word_count(spark, folder, partitions=partitions))


def tsv_round_trip(spark, folder, partitions=None):
    """Writes files when called, as a round trip through files must; the rows come from them."""
    path = scratch_path(spark, "word-count")
    write_tsv(word_count(spark, folder, partitions=partitions), path, "word", "n", files=2)
    return read_counts(spark, path)


def stripes_tsv_round_trip(spark, folder, partitions=None):
    """Writes files when called, as :func:`tsv_round_trip`; frequent heads fill several parts."""
    path = scratch_path(spark, "stripes")
    found = ngram_stripes(spark, folder, 2, SMALL_PART_BYTES, partitions=partitions)
    write_tsv(found, path, "head", "part", "stripe", files=2)
    return read_stripes(spark, path)


def word_count_from_files(spark, folder, partitions=None):
    """Writes files when called, as :func:`tsv_round_trip`."""
    path = scratch_path(spark, "lines")
    lines = _lines(spark, folder, partitions=partitions)
    lines.select("line").write.mode("errorifexists").text(path)
    return counts.word_counts(read_lines(spark, path))


def _count_files(spark, folder, partitions):
    """A written count table in which the counts that 7 divides are no numbers.

    Writes files when called, as :func:`tsv_round_trip`.
    """
    path = scratch_path(spark, "counts")
    n = F.col("n").cast("string")
    spoilt = F.when(F.col("n") % 7 == 0, F.concat(F.lit("n="), n)).otherwise(n)
    found = word_count(spark, folder, partitions=partitions)
    write_tsv(found.select("word", spoilt.alias("n")), path, "word", "n")
    return read_counts(spark, path)


def file_totals(spark, folder, partitions=None):
    return profile.corpus_totals(_count_files(spark, folder, partitions))


def file_top_words(spark, folder, partitions=None):
    return ranking.most_frequent(_count_files(spark, folder, partitions))


def file_bottom_words(spark, folder, partitions=None):
    return ranking.least_frequent(_count_files(spark, folder, partitions))


def file_last_counts(spark, folder, partitions=None):
    """Count files of the two halves of the documents, in this order: most words stand in both.

    Counts that 7 divides are no numbers. Writes files when called, as :func:`tsv_round_trip`.
    """
    base = scratch_path(spark, "counts")
    paths = [f"{base}/run_0", f"{base}/run_1"]
    n = F.col("n").cast("string")
    spoilt = F.when(F.col("n") % 7 == 0, F.concat(F.lit("n="), n)).otherwise(n)
    for texts, path in zip(_halves(spark, folder, partitions), paths):
        write_tsv(counts.word_counts(texts, "text").select("word", spoilt.alias("n")), path, "word", "n")
    return ranking.last_counts(read_counts(spark, paths, places=True)).select("word", "n")


def two_series_round_trip(spark, folder):
    """``events`` as files of two series, one of each type and day: events of even ids, then of odd.

    Writes files when called, as :func:`tsv_round_trip`. A line that is no number begins each.
    """
    events = read_table(spark, f"{folder}/events.parquet", "event_id", "event_type", "ts", "value")
    named = events.select(
        F.concat_ws("_", "event_type", F.date_format("ts", "yyyyMM")).alias("name"),
        F.pmod("event_id", F.lit(2)).alias("half"),
        "event_id",
        F.floor(F.col("value") * 1000).cast("string").alias("line"),
    )
    both = F.array(
        F.struct(F.lit(-1).cast("bigint").alias("half"), F.lit("samples").alias("line")),
        F.struct(F.lit(0).cast("bigint").alias("half"), F.lit("").alias("line")),
    )
    halves = named.groupBy("name").agg(F.count_distinct("half").alias("halves")).where("halves = 2")
    frame = halves.select("name", F.explode(both).alias("b")).select(
        "name", "b.half", F.lit(None).cast("bigint").alias("event_id"), "b.line"
    )
    numbers = named.join(halves, "name", "left_semi")
    path = scratch_path(spark, "series")
    (
        numbers.unionByName(frame)
        # Not on the bare column: both sides lie by it already, Spark would then drop this step,
        # and a name whose rows adaptive execution splits in the join would fill several files.
        .repartition(F.xxhash64("name"))
        .sortWithinPartitions("name", "half", F.asc_nulls_last("event_id"))
        .select("name", "line")
        .write.partitionBy("name")
        .mode("errorifexists")
        .text(path)
    )
    found = read_two_series(spark, f"{path}/*", ("even", "odd"))
    name = F.regexp_extract("file", "/name=([^/]*)/", 1)
    return found.select(name.alias("name"), "series", "value")


def run_recap(spark, folder):
    """``events`` as job runs: the type is the job, values above 100 are failed runs."""
    events = read_table(
        spark, f"{folder}/events.parquet", "event_id", "event_type", "user_id", "value"
    )
    measure = F.floor(F.col("value") * 1000)
    runs = events.select(
        F.col("event_type").alias("job"),
        F.col("event_id").alias("run"),
        (F.col("value") <= 100).alias("succeeded"),
        measure.alias("duration_ms"),
        (measure * F.col("user_id")).alias("map_output_bytes"),
        F.col("user_id").alias("spilled_records"),
        measure.alias("reduce_output_records"),
    )
    return recap.run_recap(
        runs,
        byte_means=["map_output_bytes"],
        means=["spilled_records"],
        last=["reduce_output_records"],
    )


def series_means(spark, folder):
    """``events`` as measured series: one per type."""
    events = read_table(spark, f"{folder}/events.parquet", "event_type", "value")
    values = events.select(
        F.col("event_type").alias("series"), F.floor(F.col("value") * 1000).alias("value")
    )
    return recap.series_means(values, "series")


def text_queries() -> dict[str, Query]:
    """The queries over texts; each takes ``partitions``, for tables that only one task can read."""
    texts: dict[str, Query] = {
        "word_count": word_count,
        "line_records": line_records,
        "normalized_lines": normalized_lines,
        "tokens": tokens,
        "total_word_count": total_word_count,
        "corpus_totals": corpus_totals,
        "top_words": top_words,
        "bottom_words": bottom_words,
        "cooccurrence_pairs": cooccurrence_pairs,
        "cooccurrence_entries": partial(head_tail_counts, n=2),
        "cooccurrence_stripes": partial(ngram_stripes, n=2),
        "cooccurrence_stripes_in_parts": partial(
            ngram_stripes, n=2, part_bytes=SMALL_PART_BYTES
        ),
        "cooccurrence_stripes_conversations": partial(
            ngram_stripes, n=2, table="conversations"
        ),
        "stripe_maps": stripe_maps,
        "stripes_merged": stripes_merged,
        "ngram_stripes_3_merged": partial(stripes_merged, n=3),
        "word_count_two_runs": word_count_two_runs,
        "corpus_report": corpus_report,
        "line_stripes": line_stripes,
        "line_stripes_3": partial(line_stripes, n=3),
        "word_count_by_document": word_count_by_document,
        "gram_totals_1": partial(gram_totals, n=1),
        "gram_totals_3": partial(gram_totals, n=3),
        "gram_totals_10": partial(gram_totals, n=10),
        "tsv_round_trip": tsv_round_trip,
        "stripes_tsv_round_trip": stripes_tsv_round_trip,
        "word_count_from_files": word_count_from_files,
        "file_totals": file_totals,
        "file_top_words": file_top_words,
        "file_bottom_words": file_bottom_words,
        "file_last_counts": file_last_counts,
        "word_count_pages": partial(word_count, table="pages", column="html"),
        "word_count_conversations": partial(word_count, table="conversations"),
        "word_count_benchmark": partial(word_count, table="benchmark"),
        "total_word_count_pages": partial(total_word_count, table="pages", column="html"),
        "ngram_pairs_3_conversations": partial(ngram_pairs, n=3, table="conversations"),
        "ngram_stripes_3_pages": partial(ngram_stripes, n=3, table="pages", column="html"),
    }
    for n in (2, 3):
        texts[f"ngram_pairs_{n}"] = partial(ngram_pairs, n=n)
    texts["ngram_pairs_10"] = partial(combined_ngram_pairs, n=10)
    texts["ngram_pairs_5"] = partial(rare_ngram_pairs, n=5)
    for n in (5, 10):
        texts[f"ngram_pairs_{n}_coded"] = partial(coded_ngram_pairs, n=n)
    for n in (3, 5, 10):
        texts[f"ngram_head_tail_{n}"] = partial(ngram_head_tail, n=n)
        texts[f"ngram_stripes_{n}"] = partial(ngram_stripes, n=n)
    texts["ngram_stripes_3_in_parts"] = partial(ngram_stripes, n=3, part_bytes=SMALL_PART_BYTES)
    return texts


def queries() -> dict[str, Query]:
    return text_queries() | {
        "run_recap": run_recap,
        "series_means": series_means,
        "two_series_round_trip": two_series_round_trip,
    }
