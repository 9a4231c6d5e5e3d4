"""n-grams moved by their rare words: the same counts from fewer bytes."""

import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from wordloom.operators import counts, rare
from wordloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"


def text_lines(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["a", "b-c", "o'd", "é", "日本", "x" * 90, "0", "ß", "ﬁ", "𐐨"]
    ranks = [1 / (i + 1) for i in range(len(words))]
    line = lambda: rng.choice([" ", "  ", ", ", " "]).join(rng.choices(words, ranks, k=rng.randrange(25)))
    return [line() for _ in range(n)] + ["", None, "w3 " * 40, "z " * 200, "z y " * 30]


@pytest.mark.parametrize("n", [2, 3, 5, 10])
@pytest.mark.parametrize("size", [1, 4, 1000])
def test_counts_are_those_of_plain_keys(frame, n, size):
    lines = text_lines(n, 60)
    # Over several tasks, as n-grams without a rare word are counted by task first.
    table = frame(lines).repartition(3)
    found = rare.ngram_counts(table, n, rare.frequent_hashes(table, size=size, share=1.0)).collect()
    assert {r.gram: r.n for r in found} == brute.gram_counts([x for x in lines if x], n)
    assert len({r.gram for r in found}) == len(found)


def test_which_words_are_frequent_changes_nothing(frame):
    lines = text_lines(5, 60)
    hashes = [r.h for r in frame(["w1 w2 w3 zz"]).select(F.explode(F.split("line", " ")).alias("w")).select(F.hash("w").alias("h")).collect()]
    for frequent in ([], hashes, [0, 1]):
        found = rare.ngram_counts(frame(lines), 3, frequent)
        assert {r.gram: r.n for r in found.collect()} == brute.gram_counts([x for x in lines if x], 3)
    assert rare.frequent_hashes(frame([])) == []
    assert rare.ngram_counts(frame([]), 5, []).count() == 0


def test_long_pairs_move_pieces_and_read_the_lines_once(spark):
    df = catalog.queries()["ngram_pairs_5"](spark, FOLDER)
    assert df.schema == counts.ngram_counts(df.select(F.col("gram").alias("line")), 5).schema
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.search(r"Exchange hashpartitioning\(key#\w+, task#", text)
    assert "ReusedExchange" in text
    assert text.count("FileScan") == 1
