"""Bounded samples are the same rows however the table is laid out."""

from pyspark.sql import functions as F

from wordloom.llm.texts import bounded_sample


def test_a_sample_is_the_smallest_hashes_in_any_order_of_the_table(spark):
    table = spark.range(4000).withColumnRenamed("id", "doc_id")
    at = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    expected = {r.doc_id for r in table.orderBy(at, "doc_id").limit(1000).collect()}
    for laid in (table.coalesce(1), table.repartition(7), table.orderBy(F.desc("doc_id"))):
        assert {r.doc_id for r in bounded_sample(laid, 1000, "doc_id").collect()} == expected
