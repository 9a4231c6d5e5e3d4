"""Every registered query against its SQL on the smallest tables."""

import inspect

import __spark_entry__ as entry
import duckdb
import pytest
from compare import database, difference

from wordloom.functions import tokens, units
from wordloom.operators import stripes
from wordloom.plans import catalog, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_sql():
    assert catalog.queries().keys() == oracle.oracle_sql().keys()


@pytest.mark.parametrize("name", catalog.queries())
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "n"]
    assert df.count() > 0
    assert list(inspect.signature(entry.entry).parameters) == ["spark"]


@pytest.mark.parametrize("partitions", [None, 13])
def test_any_number_of_read_partitions_gives_the_same_rows(spark, con, partitions):
    for name in ("word_count", "ngram_stripes_3_in_parts", "gram_totals_3"):
        df = catalog.queries()[name](spark, FOLDER, partitions=partitions)
        assert difference(df, con, entry.oracle_sql()[name]) is None


def test_static_plans_give_the_same_rows(spark, con):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("ngram_stripes_3_in_parts", "gram_totals_1", "line_stripes", "top_words"):
            df = entry.queries()[name](spark, FOLDER)
            assert difference(df, con, entry.oracle_sql()[name]) is None
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_fixed_values_of_the_sql():
    """The SQL holds them itself; the worked examples of FIXTURES.md hold for either."""
    assert oracle.PART_BYTES == stripes.PART_BYTES
    assert oracle.SMALL_PART_BYTES == catalog.SMALL_PART_BYTES
    assert oracle.UNITS == units.UNITS
    assert oracle._WORD.replace("''", "'") == tokens.WORD
    for text, words in (("The cat's cat.", ["the", "cat's", "cat"]), ("-- a-b 'c'", ["a-b", "c"])):
        sql = f"SELECT regexp_extract_all(lower(?), '{oracle._WORD}')"
        assert duckdb.execute(sql, [text]).fetchone()[0] == words
