"""Phrase collocations against counts of whole phrases in Python."""

import random
import re
from collections import Counter

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest

from wordloom.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string, n int, phrase string, key string"


def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.ascii_lower(text)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def ngrams_of(docs, longest=3, least=10):
    found = Counter()
    for text, lang in docs:
        for words in pieces_of(text):
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    found[lang or "und", tuple(words[i : i + n])] += 1
    return {k: n for k, n in found.items() if n >= least}


def collocations_of(docs, longest=3, least=10, percent=50, top=2000):
    counted, totals = ngrams_of(docs, longest, least), Counter()
    for text, lang in docs:
        totals[lang or "und"] += sum(map(len, pieces_of(text)))
    rows = []
    for (lang, p), a in counted.items():
        if len(p) == 1:
            continue
        longer = [
            f
            for (other, q), f in counted.items()
            if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
        ]
        if any(100 * f >= percent * a for f in longer):
            continue
        cuts = [(counted[lang, p[:k]], counted[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min((10**6 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        rows.append((lang, " ".join(p), a, left, right, totals[lang], score))
    out = []
    for lang in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(out)


def made_up(seed=3, n=60):
    rng = random.Random(seed)
    words = ["a", "b", "New", "york", "CITY", "é", "日本", "of", "the", "x" * 40]
    docs = []
    for i in range(n):
        parts = rng.choices(words, k=rng.randrange(1, 120))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x00 "]) for w in parts)
        docs.append((text, rng.choice(["en", "en", "de", None])))
    docs += [(None, "en"), ("", None), (" .,; ", "fr"), ("alone", "und"), ("the city of new york " * 30, "en")] * 2
    return docs


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i % 7, text, lang, 1, "p", "k") for i, (text, lang) in enumerate(made_up())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_collocations_of_a_small_table(docs):
    found = phrases.collocations(docs)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    kinds = dict(found.dtypes)
    assert [kinds[c] for c in ("rank", "a", "l", "r", "n", "score")] == ["bigint"] * 6
    expected = collocations_of(made_up())
    assert sorted(map(tuple, found.collect())) == expected and len(expected) > 20


@pytest.mark.parametrize("longest, least, percent, top", [(2, 3, 50, 5), (4, 6, 90, 2000), (5, 4, 1, 7)])
def test_other_parameters(docs, longest, least, percent, top):
    found = phrases.collocations(docs, longest, least, percent, top)
    assert sorted(map(tuple, found.collect())) == collocations_of(made_up(), longest, least, percent, top)


@pytest.mark.parametrize("bits", [2, 9, 40])
def test_collisions_change_nothing(docs, bits):
    found = phrases.frequent_ngrams(docs, 3, 10, fingerprint_bits=bits).collect()
    expected = ngrams_of(made_up())
    assert sorted((r.lang, tuple(r.phrase.split(" ")), r.n) for r in found) == sorted(
        (lang, p, n) for (lang, p), n in expected.items()
    )


def test_a_collision_of_few_fingerprints_is_seen_and_counted_by_text(docs, monkeypatch):
    """Two words get one value in the first hash; the second tells them apart."""
    first = phrases._FIRST
    letters = first.letters.copy()
    letters[ord("a")] = letters[ord("b")]
    monkeypatch.setattr(first, "letters", letters)
    texts = phrases._texts(docs, "text", "lang")
    # In workers the letters are as ever, so the path is taken apart here.
    batch = pa.table(texts.toArrow()).combine_chunks().to_batches()[0]
    totals, checks = Counter(), Counter()
    for data, starts, at in phrases.segments(batch.column(2)):
        words = phrases.Words(data, starts)
        own = phrases._salts(batch.column(1))[at : at + len(starts)]
        _, prints, seconds = words.grams(1, own)
        for p, c in zip(prints.tolist(), seconds.tolist()):
            totals[p] += 1
            checks[p] += c
    data = np.frombuffer(b"a", np.uint8)
    _, shared, second = phrases.Words(data, np.array([0])).grams(1, np.array([phrases.salt("en")], np.uint64))
    n = ngrams_of(made_up(), 1, 1)
    assert totals[int(shared[0])] == n["en", ("a",)] + n["en", ("b",)]
    assert checks[int(shared[0])] != totals[int(shared[0])] * int(second[0])


def test_suspects_are_counted_by_text(docs):
    texts = phrases._texts(docs, "text", "lang")
    everything = docs.sparkSession.range(512).selectExpr("id as print")
    found = phrases._counted_by_text(texts, everything, 2, 9, 10)
    expected = ngrams_of(made_up(), 2)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found.collect()} == expected


def test_segments_cut_at_piece_ends_only(monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 16)
    texts = ["", "one two three four five six seven", "", "a,b. c d\ne f g h i j k l m n", "x", "", "y z", ""] * 3
    column = pa.array(["left out", *texts], pa.string()).slice(1)
    found = []
    for data, starts, first in phrases.segments(column):
        words = phrases.Words(data, starts)
        for n in (1, 2, 3):
            at, _, _ = words.grams(n, np.zeros(len(starts), np.uint64))
            found += [(first + words.text[i], phrases._phrase(data, words, i, n)) for i in at]
    expected = [
        (t, " ".join(words[i : i + n]))
        for t, text in enumerate(texts)
        for words in pieces_of(text)
        for n in (1, 2, 3)
        for i in range(len(words) - n + 1)
    ]
    assert sorted(found) == sorted(expected)


def test_long_texts_and_empty_tables(spark, docs):
    long = "w " * 2_000_000
    rows = [(long, "en"), ("w w.", "en"), ("v" * 3_000_000, "en")]
    table = spark.createDataFrame(rows, "text string, lang string")
    found = sorted(map(tuple, phrases.frequent_ngrams(table, 2, 2).collect()))
    assert found == [("en", 1, "w", 2_000_002), ("en", 2, "w w", 2_000_000)]
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_scores_past_64_bits(spark):
    n = 10**15
    rows = [("en", 1, "a", n + 1), ("en", 1, "b", n), ("en", 2, "a b", n - 1)]
    found = phrases.scored(spark.createDataFrame(rows, "lang string, size int, phrase string, n bigint"))
    assert found.first().score == 10**6 * (n - 1) ** 2 // ((n + 1) * n)
