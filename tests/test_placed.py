"""Stripes whose n-grams are moved once: the same rows from fewer bytes."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wordloom.operators import counts, placed, stripes
from wordloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"


def text_lines(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["a", "b-c", "o'd", "é", "日本", "x" * 90, "0", "ß", "ﬁ", "𐐨"]
    ranks = [1 / (i + 1) for i in range(len(words))]
    line = lambda: rng.choice([" ", "  ", ", "]).join(rng.choices(words, ranks, k=rng.randrange(30)))
    return [line() for _ in range(n)] * 2 + ["", None, "w3 " * 40, "z " * 200, "z y " * 30]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(table):
    return sorted(map(tuple, table.collect()))


@pytest.mark.parametrize("n", [2, 3, 10])
@pytest.mark.parametrize("part_bytes", [60, stripes.PART_BYTES])
@pytest.mark.parametrize("place_bytes", [300, placed.PLACE_BYTES])
def test_stripes_of_entries_that_are_moved_once(frame, n, part_bytes, place_bytes):
    table = frame(text_lines(10 + n, 60))
    spread = placed.spread_heads(table, n, share=1.0, place_bytes=place_bytes)
    assert bool(spread) == (place_bytes == 300)
    found = placed.stripe_texts(placed.head_counts(table, n, spread), spread, part_bytes)
    expected = stripes.stripe_texts(counts.head_tail_counts(table, n), part_bytes)
    assert found.schema == expected.schema
    assert rows_of(found) == rows_of(expected)


@pytest.mark.parametrize("part_bytes", [60, 700])
@pytest.mark.parametrize("place_bytes", [200, placed.PLACE_BYTES])
def test_merged_texts(frame, part_bytes, place_bytes):
    tables = [
        stripes.stripe_texts(counts.head_tail_counts(frame(text_lines(seed, 50)), 3), 100) for seed in (20, 21, 22)
    ]
    found = placed.merged(*tables, part_bytes=part_bytes, place_bytes=place_bytes)
    expected = stripes.merged(*tables, part_bytes=part_bytes)
    assert found.columns == expected.columns
    assert rows_of(found) == rows_of(expected)
    assert placed.merged(tables[0].limit(0), tables[1].limit(0)).count() == 0


@pytest.mark.parametrize("n", [5, 10])
def test_long_stripes_are_moved_once(spark, n):
    text = planned(catalog.queries()[f"ngram_stripes_{n}"](spark, FOLDER))
    entries = text.split("BroadcastExchange")[0]
    assert len(re.findall(r"\bExchange\b", entries)) == 1
    assert "Aggregate" not in entries.rsplit("Exchange", 1)[1]


def test_merged_stripes_are_moved_as_texts(spark):
    text = planned(catalog.queries()["ngram_stripes_3_merged"](spark, FOLDER))
    entries = text.split("BroadcastExchange")[0]
    assert len(re.findall(r"\bExchange\b", entries)) == 1
    assert "str_to_map" not in entries.rsplit("Exchange", 1)[1]


def test_heads_of_several_places_are_packed_from_one_count(spark, frame):
    table = frame(text_lines(30, 60))
    spread = placed.spread_heads(table, 3, share=1.0, place_bytes=300)
    found = placed.stripe_texts(placed.head_counts(table, 3, spread), spread, 60)
    found.collect()
    text = planned(found).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in text
    heads = found.where(F.hash("head").isin(*spread))
    assert heads.count() > heads.select("head").distinct().count()


def test_places_grow_with_the_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for asked, given in ((4, 4), (200, 200), (600, 200), (2000, 2000)):
            spark.conf.set("spark.sql.shuffle.partitions", str(asked))
            assert placed.places(spark) == given
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
