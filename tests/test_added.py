"""Adding up stripes and counts, places in files, reports of one scan."""

import os
import random

import brute
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_plans import executed, planned

from wordloom.functions import stripes as texts
from wordloom.operators import counts, profile, ranking, stripes
from wordloom.plans import catalog
from wordloom.sources.buckets import read_buckets, write_buckets
from wordloom.sources.positions import read_places
from wordloom.sources.scratch import scratch_path
from wordloom.sources.tsv import read_counts

FOLDER = "/root/testdata/sf0.001"


def random_lines(seed, n):
    rng = random.Random(seed)
    words = ["the", "a", "b-c", "o'd", "é", "日本", "x1", "z"]
    return [" ".join(rng.choices(words, k=rng.randrange(9))) for _ in range(n)]


@pytest.mark.parametrize("n", [2, 3, 5])
def test_entries_are_the_inverse_of_texts(frame, n):
    entries = counts.head_tail_counts(frame(random_lines(n, 60)), n)
    back = stripes.entries_of(stripes.stripe_texts(entries, 40))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, entries.collect()))


def test_empty_stripes_and_counts_that_are_none(spark):
    rows = [("a", 0, ""), ("b", 0, None), ("c", 1, "x:1")]
    table = spark.createDataFrame(rows, "head string, part bigint, stripe string")
    assert [tuple(r) for r in stripes.entries_of(table).collect()] == [("c", "x", 1)]
    bad = spark.createDataFrame([("a", "x:1, y:z")], "head string, stripe string")
    with pytest.raises(PySparkException):
        bad.select(texts.parsed(F.col("stripe"))).collect()


@pytest.mark.parametrize("n, part_bytes", [(2, 30), (3, 10**6), (3, 25)])
def test_merged_stripes_equal_one_count(frame, n, part_bytes):
    lines = random_lines(n, 90)
    halves = [lines[:40], lines[40:70], lines[70:]]
    # Each with parts of its own size: they are laid out anew.
    tables = [
        stripes.stripe_texts(counts.head_tail_counts(frame(h), n), size)
        for h, size in zip(halves, (20, 10**6, 35))
    ]
    found = stripes.merged(*tables, part_bytes=part_bytes)
    whole = stripes.stripe_texts(counts.head_tail_counts(frame(lines), n), part_bytes)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    assert stripes.merged(tables[0].limit(0), tables[1].limit(0)).count() == 0


def test_measured_stripes_name_each_head_once(frame):
    lines = random_lines(4, 80)
    entries = counts.head_tail_counts(frame(lines), 3)
    rows = stripes.measured_texts(entries, 20).collect()
    expected = brute.stripe_counts(lines, 3)
    assert sum(r.first for r in rows) == len(expected) < len(rows)
    assert sum(r.n for r in rows) == sum(sum(e.values()) for e in expected.values())


def test_merged_counts(frame):
    lines = random_lines(7, 60)
    tables = [counts.word_counts(frame(part)) for part in (lines[:20], lines[20:], [])]
    found = {r.word: r.n for r in counts.merged(*tables).collect()}
    assert found == brute.word_counts(lines)


def test_a_further_run_moves_the_new_counts_only(spark, frame):
    lines = random_lines(8, 60)
    older, newer = counts.word_counts(frame(lines[:35])), counts.word_counts(frame(lines[35:]))
    path = scratch_path(spark, "buckets")
    known = write_buckets(older, path, buckets=8)
    assert sorted(map(tuple, known.collect())) == sorted(map(tuple, older.collect()))
    total = counts.added(known, newer)
    assert {r.word: r.n for r in total.collect()} == brute.word_counts(lines)
    text = planned(total)
    assert "Bucketed: true" in text and "SelectedBucketsCount: 8 out of 8" in text
    join = text[text.index("SortMergeJoin") :]
    older_side = join[: join.index("FileScan parquet")]
    assert "Exchange" not in older_side.split("FileScan parquet")[0].split("Project")[0]
    assert "Exchange" not in older_side
    # The sums are in the same buckets, so a third run is added in the same way.
    third = write_buckets(total, scratch_path(spark, "buckets"), buckets=8)
    more = counts.word_counts(frame(lines[:10]))
    found = {r.word: r.n for r in counts.added(third, more).collect()}
    assert found == brute.word_counts(lines + lines[:10])
    again = read_buckets(spark, path, buckets=8)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, older.collect()))
    with pytest.raises(PySparkException):
        write_buckets(older, path, buckets=8)
    with pytest.raises(ValueError):
        write_buckets(older, scratch_path(spark, "buckets"), buckets=0)


def test_older_counts_of_the_query_are_not_shuffled(spark):
    text = planned(catalog.word_count_two_runs(spark, FOLDER))
    assert "Bucketed: true" in text and text.count("FileScan") == 2
    join = text[text.index("SortMergeJoin") :]
    assert "Exchange" not in join[: join.index("FileScan")]


def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


def usual_splits(spark):
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(name)


def test_places_order_lines_over_splits(spark, tmp_path):
    lines = {f"f{i}": [f"line {i} {k} " + "x" * (k % 40) for k in range(50)] for i in range(3)}
    for name, content in lines.items():
        (tmp_path / name).write_text("\n".join(content))
    small_splits(spark)
    try:
        table = read_places(spark, str(tmp_path))
        assert table.rdd.getNumPartitions() > 3
        rows = sorted(table.collect(), key=lambda r: tuple(r.place))
    finally:
        usual_splits(spark)
    assert [r.line for r in rows] == [line for name in sorted(lines) for line in lines[name]]
    assert len({r.place.block for r in rows if r.file.endswith("f0")}) > 3


def ranked_as_in_python(lines):
    """Counts of one file as a dict takes them: the last one, at the first place."""
    found = {}
    for line in lines:
        parts = line.strip().split("\t")
        if len(parts) == 2:
            try:
                found[parts[0]] = int(parts[1])
            except ValueError:
                pass
    ordered = sorted(found.items(), key=lambda x: x[1])
    return ordered[:10], ordered[-10:][::-1]


def test_last_counts_and_rankings_of_repeated_words(spark, tmp_path):
    rng = random.Random(3)
    lines = [
        f"w{rng.randrange(30)}\t{rng.choice([rng.randrange(12), 'x', '', ' 7 '])}" for _ in range(400)
    ]
    lines += ["no field", "a\tb\tc", "w1\t"]
    (tmp_path / "t").write_text("\n".join(lines))
    small_splits(spark)
    try:
        rows = read_counts(spark, str(tmp_path / "t"), places=True)
        last = ranking.last_counts(rows)
        least = ranking.least_frequent(last, key="place").collect()
        most = ranking.most_frequent(last, key="place").collect()
        assert "Exchange rangepartitioning" not in planned(last)
    finally:
        usual_splits(spark)
    expected = ranked_as_in_python(lines)
    assert [(r.word, r.n) for r in least] == expected[0]
    assert [(r.word, r.n) for r in most] == expected[1]
    totals = profile.corpus_totals(rows).first()
    assert totals.words == sum(len(line.strip().split("\t")) == 2 for line in lines)


def test_report_counts_the_corpus_once(spark):
    df = catalog.corpus_report(spark, FOLDER)
    text = executed(df)
    assert text.count("FileScan") == 1 and text.count("ReusedExchange") == 2
    rows = df.collect()
    assert {r.section: r.n for r in rows if r.word is None}.keys() == {"words", "tokens"}
    assert len(rows) == 22


def test_report_of_few_words(frame):
    rows = profile.corpus_report(counts.word_counts(frame(["b a a"])), 5).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [
            ("words", 1, None, 2),
            ("tokens", 1, None, 3),
            ("most frequent", 1, "a", 2),
            ("most frequent", 2, "b", 1),
            ("least frequent", 1, "b", 1),
            ("least frequent", 2, "a", 2),
        ],
        key=str,
    )


def test_totals_shuffle_digests(spark):
    text = planned(catalog.gram_totals(spark, FOLDER, 10))
    for line in text.split("\n"):
        if "Exchange hashpartitioning" in line:
            assert "gram" not in line and "words" not in line
    assert "array_join" not in text


def test_two_series_over_many_splits(spark, tmp_path):
    from wordloom.sources.series import read_two_series

    values = {f"f{i}": ([i * 1000 + k for k in range(60)], [i * 1000 + k for k in range(500, 530)]) for i in range(3)}
    for name, (first, second) in values.items():
        text = "\n".join(["head", *map(str, first), " \t", *map(str, second), "", "9x"])
        (tmp_path / name).write_text(text)
    small_splits(spark)
    try:
        rows = read_two_series(spark, str(tmp_path), ("a", "b")).orderBy("place").collect()
    finally:
        usual_splits(spark)
    found = {}
    for r in rows:
        found.setdefault(os.path.basename(r.file), ([], []))[r.series == "b"].append(r.value)
    assert found == values
