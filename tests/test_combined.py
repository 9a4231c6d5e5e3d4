"""n-grams moved in pieces of counted lines: the same counts from fewer bytes."""

import random
import re

import brute
import pytest

from wordloom.operators import counts, rare
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


@pytest.mark.parametrize("n", [2, 3, 10])
@pytest.mark.parametrize("size", [1, 4, 1000])
def test_counts_of_combined_lines(frame, n, size):
    lines = text_lines(n, 60)
    table = frame(lines)
    found = rare.combined_counts(table, n, rare.frequent_hashes(table, size=size, share=1.0))
    assert found.schema == counts.ngram_counts(table, n).schema
    got = found.collect()
    assert {r.gram: r.n for r in got} == brute.gram_counts([x for x in lines if x], n)
    assert len({r.gram for r in got}) == len(got)


def test_no_combined_lines(frame):
    assert rare.combined_counts(frame([]), 5, []).count() == 0
    assert rare.combined_counts(frame(["a b", None, ""]), 3, [0]).count() == 0
    with pytest.raises(ValueError):
        rare.combined_counts(frame(["a b"]), 1, [])


def test_long_pairs_count_lines_and_not_ngrams_before_they_are_moved(spark):
    text = planned(catalog.queries()["ngram_pairs_10"](spark, FOLDER))
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", text) == ["words"]
    assert len(re.findall(r"\bExchange\b", text)) == 2
    assert "array_join" not in text.rsplit("Exchange hashpartitioning", 1)[1]
