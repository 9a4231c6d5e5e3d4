"""Files of two series, written behind joins that adaptive execution reads in pieces."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.plans import catalog

# The table is thought large when the join is planned and found small when it runs.
SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "20k",
    "spark.sql.files.maxPartitionBytes": "32k",
    "spark.sql.files.openCostInBytes": "1k",
}


@pytest.fixture
def splitting(spark):
    before = {name: spark.conf.get(name, None) for name in SPLIT}
    for name, value in SPLIT.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_name_is_one_file_however_its_rows_are_joined(spark, tmp_path, splitting):
    day = dt.datetime(2024, 1, 5)
    rows = [(i, "view" if i % 10 else "click", day, i % 997 / 8) for i in range(40_000)]
    events = spark.createDataFrame(rows, "event_id bigint, event_type string, ts timestamp, value double")
    events.repartition(8).write.parquet(str(tmp_path / "events.parquet"))
    found = catalog.two_series_round_trip(spark, str(tmp_path))
    got = {tuple(r)[:3]: r.n for r in found.groupBy("name", "series", "value").agg(F.count("*").alias("n")).collect()}
    # Clicks have even ids only, so they have no file.
    kinds = ("even", "odd")
    assert got == Counter(("view_202401", kinds[i % 2], int(v * 1000)) for i, kind, _, v in rows if kind == "view")
