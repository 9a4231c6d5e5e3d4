import random

import pytest
from pyspark.sql import functions as F

from wordloom.functions import units
from wordloom.operators import profile, ranking, recap


def one(spark, column, value, type_):
    return spark.createDataFrame([(value,)], f"v {type_}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "size, text",
    [
        (0, "0.000 B"),
        (1023, "1023.000 B"),
        (1024, "1.000 KB"),
        (1088, "1.063 KB"),
        (1536, "1.500 KB"),
        (1024**2 - 1, "1023.999 KB"),
        (9068074, "8.648 MB"),
        (1024**3, "1.000 GB"),
        (1024**4, "1.000 TB"),
        (5 * 1024**5, "5120.000 TB"),
        (-5, "-5.000 B"),
        (None, None),
    ],
)
def test_format_bytes(spark, size, text):
    assert one(spark, units.format_bytes, size, "bigint") == text


def test_format_mean_bytes_as_python_does(spark):
    rng = random.Random(2)
    values = [rng.uniform(0, 10 ** rng.randrange(1, 14)) for _ in range(500)]
    values += [1088.0, 1152.0, 0.0625, 1023.9999, 1048575.99, 247463936.4]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", units.format_mean_bytes(F.col("v")).alias("t")).collect():
        value, unit = row.v, 0
        while value >= 1024 and unit < 4:
            value, unit = value / 1024, unit + 1
        assert row.t == f"{value:.3f} {('B', 'KB', 'MB', 'GB', 'TB')[unit]}", row.v


@pytest.mark.parametrize(
    "millis, text",
    [
        (0, "00:00:00.000"),
        (999, "00:00:00.999"),
        (61_001, "00:01:01.001"),
        (3_880_959, "01:04:40.959"),
        (360_000_000, "100:00:00.000"),
    ],
)
def test_format_millis(spark, millis, text):
    assert one(spark, units.format_millis, millis, "bigint") == text


def test_ties_in_rankings(spark):
    rows = [(w, n) for n, words in ((5, "abc"), (1, "xyzuvw"), (3, "de")) for w in words]
    table = spark.createDataFrame(rows + [("bad", None)], "word string, n bigint").repartition(4)
    top = [tuple(r) for r in ranking.most_frequent(table, 4).collect()]
    assert top == [("c", 5), ("b", 5), ("a", 5), ("e", 3)]
    bottom = [tuple(r) for r in ranking.least_frequent(table, 7).collect()]
    assert bottom == [(w, 1) for w in "uvwxyz"] + [("d", 3)]
    with pytest.raises(ValueError):
        ranking.most_frequent(table, 0)


def test_totals_count_words_with_a_bad_count(spark):
    rows = [("a", "3"), ("b", "x"), ("c", None), ("d", "4")]
    totals = profile.corpus_totals(spark.createDataFrame(rows, "word string, n string")).first()
    assert (totals.words, totals.tokens) == (4, 7)
    empty = profile.corpus_totals(spark.createDataFrame([], "word string, n bigint")).first()
    assert (empty.words, empty.tokens) == (0, 0)


RUNS = "job string, run bigint, succeeded boolean, duration_ms bigint, b bigint, m bigint, l bigint"


def test_recap(spark):
    rows = [
        ("j", 0, True, 1000, 2048, 10, 7),
        ("j", 1, False, 99999, 99999, 99, 99),
        ("j", 2, True, 2001, 1025, 11, 8),
        ("j", 3, False, 5, 5, 5, 5),
        ("bad", 0, False, 5, 5, 5, 5),
    ]
    table = spark.createDataFrame(rows, RUNS).repartition(3)
    got = {
        r.job: r.asDict()
        for r in recap.run_recap(table, byte_means=["b"], means=["m"], last=["l"]).collect()
    }
    assert got["j"] == {
        "job": "j",
        "successful_runs": 2,
        "total_attempts": 4,
        "failed_runs": 2,
        "total_time": "00:00:03.001",
        "average_time": "00:00:01.500",
        "avg_b": "1.500 KB",
        "avg_m": 10,
        "l": 8,
    }
    assert got["bad"] == {
        "job": "bad",
        "successful_runs": 0,
        "total_attempts": 1,
        "failed_runs": 1,
        "total_time": "00:00:00.000",
        "average_time": "00:00:00.000",
        "avg_b": "0.000 B",
        "avg_m": 0,
        "l": 0,
    }


def test_series_means(spark):
    values = [247463936, 247463937, 1]
    rows = [("map", v) for v in values] + [("reduce", 1088)]
    table = spark.createDataFrame(rows, "series string, value bigint").repartition(3)
    got = {r.series: (r["mean"], r.shown) for r in recap.series_means(table, "series").collect()}
    mean = sum(values) / 3
    assert got == {"map": (mean, f"{mean / 1024**2:.3f} MB"), "reduce": (1088.0, "1.062 KB")}
