import random

import brute
import pytest
from pyspark.sql import functions as F

from wordloom.functions import tokens

EDGES = [
    ("", []),
    ("--a 'b' c-- d'-'e -'- x", ["a", "b", "c", "d'-'e", "x"]),
    ("rock-'n'-roll 'Tis don’t don't", ["rock-'n'-roll", "tis", "don", "t", "don't"]),
    ("café", ["café"]),
    ("näive", ["na", "ive"]),
    ("_x_ 3.14", ["x", "3", "14"]),
    ("İstanbul ΣΑΣ", ["i", "stanbul", "σας"]),
    ("a\0b \x0bc", ["a", "b", "c"]),
    ("a - - b", ["a", "b"]),
    ("-a' 'b- '", ["a", "b"]),
    ("12-'", ["12"]),
    ("The cat's cat.", ["the", "cat's", "cat"]),
    ("٣ ½ ²", []),
    ("a,b:c\td", ["a", "b", "c", "d"]),
]


@pytest.mark.parametrize("line, expected", EDGES)
def test_edge_lines(frame, line, expected):
    row = frame([line]).select(
        tokens.words(F.col("line")).alias("words"),
        tokens.normalized(F.col("line")).alias("normalized"),
    ).first()
    assert row.words == expected
    assert row.normalized == " ".join(expected)


def test_both_forms_agree_on_random_lines(frame):
    rng = random.Random(7)
    alphabet = "abÉß9 0'-'- \t.,_’"
    lines = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(2000)]
    rows = frame(lines).select(
        "line",
        tokens.words(F.col("line")).alias("words"),
        tokens.normalized(F.col("line")).alias("normalized"),
    ).collect()
    for row in rows:
        assert row.words == brute.words(row.line), row.line
        assert row.normalized == " ".join(row.words), row.line


def test_one_very_long_word(frame):
    line = "a-" * 500_000 + "a"
    row = frame([line]).select(F.length(tokens.words(F.col("line"))[0]).alias("n")).first()
    assert row.n == len(line)


def test_single_cleaning_steps(frame):
    row = frame(["X_y - 'z' "]).select(
        tokens.lower_case(F.col("line")).alias("lower"),
        tokens.drop_outside_alphabet(F.lit("x_y")).alias("alphabet"),
        tokens.drop_isolated_marks(F.lit("a -- b")).alias("isolated"),
        tokens.drop_leading_marks(F.lit("'-a b-c")).alias("leading"),
        tokens.drop_trailing_marks(F.lit("a-' b-c")).alias("trailing"),
        tokens.split_on_space(F.lit(" a \t b ")).alias("split"),
    ).first()
    assert row.lower == "x_y - 'z' "
    assert row.alphabet == "x y"
    assert row.isolated.split() == ["a", "b"]
    assert row.leading == " a b-c"
    assert row.trailing.split() == ["a", "b-c"]
    assert row.split == ["a", "b"]


def test_raw_words_keep_case_and_marks(frame):
    row = frame(["The cat's  -- cat.\tX\r\ny\x0bz"]).select(
        tokens.raw_words(F.col("line")).alias("w")
    ).first()
    assert row.w == ["The", "cat's", "--", "cat.", "X", "y\x0bz"]


def test_null_line_has_no_words(frame):
    row = frame([None, "a"]).where("id = 0").select(tokens.words(F.col("line")).alias("w")).first()
    assert row.w is None
