"""Coded n-gram keys: the same counts from fewer bytes."""

import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from wordloom.functions import tokens
from wordloom.operators import codes, counts


def text_lines(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["a", "b-c", "o'd", "é", "日本", "x" * 90, "0", "ß", "ﬁ", "𐐨"]
    ranks = [1 / (i + 1) for i in range(len(words))]
    line = lambda: rng.choice([" ", "  ", ", ", " "]).join(rng.choices(words, ranks, k=rng.randrange(15)))
    return [line() for _ in range(n)]


@pytest.mark.parametrize("n", [2, 3, 10])
@pytest.mark.parametrize("size", [1, 7, 100])
def test_counts_are_those_of_plain_keys(frame, n, size):
    lines = frame(text_lines(n, 80))
    known = codes.dictionary_of(lines, size=size)
    found = codes.ngram_counts(lines, n, known)
    plain = counts.ngram_counts(lines, n)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_a_dictionary_of_another_corpus_changes_nothing(frame):
    lines = text_lines(5, 60)
    known = codes.dictionary_of(frame(["w1 w2 zz", "w1 qq"]))
    found = codes.ngram_counts(frame(lines), 3, known)
    assert {r.gram: r.n for r in found.collect()} == brute.gram_counts(lines, 3)
    none = codes.dictionary_of(frame([""]))
    found = codes.ngram_counts(frame(lines), 3, none)
    assert {r.gram: r.n for r in found.collect()} == brute.gram_counts(lines, 3)


def test_codes_are_no_part_of_any_word(spark):
    marks = spark.createDataFrame([(chr(c),) for c in codes._CODES], "c string")
    held = marks.where(F.size(tokens.words(F.col("c"))) > 0)
    assert held.count() == 0
    assert not any(re.match("[,'-]", chr(c)) for c in codes._CODES)
    assert len(set(codes._CODES)) == len(codes._CODES) >= codes.CODES
    for size in (0, len(codes._CODES) + 1):
        with pytest.raises(ValueError):
            codes.dictionary(marks.select(F.col("c").alias("word"), F.lit(1).alias("n")), size)


def test_frequent_words_have_the_short_codes(frame):
    lines = ["the the the the of of of a a b"] * 3
    known = codes.dictionary_of(frame(lines), size=100)
    by_word = dict(zip(known.slots, known.codes))
    order = [ord(by_word[w]) for w in ("the", "of", "a", "b")]
    assert order == sorted(order) == codes._CODES[:4]


def test_keys_are_shorter(frame):
    lines = frame(text_lines(3, 300))
    known = codes.dictionary_of(lines)
    coded = lines.select(F.array_join(codes.encoded(tokens.words(F.col("line")), known), "").alias("k"))
    plain = lines.select(F.array_join(tokens.words(F.col("line")), ",").alias("k"))
    size = lambda df: df.agg(F.sum(F.octet_length("k"))).first()[0]
    assert size(coded) < 0.6 * size(plain)


def test_pieces_hold_each_window_once_and_equal_windows_have_one_key(frame):
    lines = text_lines(9, 200)
    known = codes.dictionary_of(frame(lines), size=20)
    words = frame(lines).select(F.explode(F.array(tokens.words(F.col("line")))).alias("w"))
    coded = words.select(F.explode(F.array(codes.encoded(F.col("w"), known))).alias("c"))
    found = coded.select(F.explode(codes.pieces(F.col("c"), 5)).alias("p")).select(
        "p.key", codes.decoded_words(F.col("p.piece"), known).alias("words")
    )
    got, keys, moved = {}, {}, 0
    for row in found.collect():
        moved += len(row.words)
        for i in range(len(row.words) - 4):
            gram = ",".join(row.words[i : i + 5])
            got[gram] = got.get(gram, 0) + 1
            assert keys.setdefault(gram, row.key) == row.key
    assert got == brute.gram_counts(lines, 5)
    assert moved < 0.75 * 5 * sum(got.values())


def test_pieces_are_moved_once(frame):
    lines = frame(text_lines(4, 50))
    found = codes.ngram_counts(lines, 10, codes.dictionary_of(lines))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_count(1)" not in text.split("Exchange hashpartitioning")[1]
