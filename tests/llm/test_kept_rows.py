"""The last step of both near-duplicate operators: the named rows, each once."""

import pytest
from pyspark.sql import functions as F

from wordloom.llm import near_copies, simhash
from wordloom.llm.texts import text_key

ROWS = [(1, "a b c", "x"), (1, "a b c", "y"), (1, "other", "z"), (2, None, "x"), (2, None, "x"), (None, "d", "x"), (3, "e", "x")]


def test_rows_are_kept_once_whatever_was_counted(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string").repartition(3)
    named = docs.where("source = 'x'").distinct()
    # A count of one is no promise that the table holds the row once.
    row = F.struct("doc_id", F.lit(1).cast("bigint").alias("n")).alias("row")
    chosen = named.select(row, text_key(F.col("text")).alias("key"))
    kept = simhash.kept_rows(docs, chosen, "doc_id", "text")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "d"), (1, "a b c"), (2, ""), (3, "e")]


@pytest.mark.parametrize("keep_one", [near_copies.keep_one, simhash.keep_one])
def test_tables_without_repeated_rows_are_searched_for_them(spark, keep_one):
    rows = [(i, " ".join(f"w{i}-{k}" for k in range(40))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = keep_one(docs)
    assert sorted(map(tuple, found.collect())) == rows
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [doc_id" in plan or "Deduplicate" in plan
