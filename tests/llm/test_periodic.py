"""Periodic runs against direct scans at every lag."""

import hashlib
import random
import zlib

import llm_brute as brute
import numpy as np
from pyspark.sql import functions as F

from wordloom.llm import catalog, periodic

FOLDER = "/root/testdata/sf0.001"


def runs_of(words):
    """Every run of ``words``: a scan at each lag, smaller periods first."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
    return sorted((start, stop - start, q) for (start, stop), q in found.items())


def collapsed_of(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def planted(doc_id, text):
    words = brute.SPACED.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n > 0:
        a, g = h // 10 % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_nested_and_broken_runs():
    rng = random.Random(1)
    seen = 0
    for _ in range(1500):
        n, letters = rng.randrange(260), rng.choice([1, 2, 2, 3, 5, 50])
        words = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randrange(4) if n >= 8 else 0):
            s = rng.randrange(n - 4)
            p = rng.randrange(1, (n - s) // 4 + 2)
            block = words[s : s + p]
            if rng.random() < 0.5 and p > 4:
                inner = rng.randrange(1, p // 2 + 1)
                block = [block[i % inner] for i in range(p)]
                block[-1] = 99
            for i in range(min(n - s, rng.choice([4 * p, 4 * p - 1, 4 * p + rng.randrange(p + 1), 9 * p]))):
                words[s + i] = block[i % p]
        expected = runs_of(words)
        assert periodic.find_runs(np.array(words, np.int64)) == expected, words
        seen += len(expected)
    assert seen > 2000


def test_long_periods_and_long_texts():
    rng = random.Random(2)
    for n, period in [(5000, 1250), (5000, 1251), (20_000, 17), (20_000, 4096), (20_000, 4999)]:
        block = [rng.randrange(300) for _ in range(period)]
        words = [-1, *[block[i % period] for i in range(n)], -2]
        expected = [(1, n, period)] if n >= 4 * period else []
        assert [r for r in periodic.find_runs(np.array(words)) if r[2] > 100] == [
            r for r in expected if r[2] > 100
        ]
    rare = np.array([0 if i % 1000 else 1 for i in range(200_000)])
    found = periodic.find_runs(rare)
    assert (0, 200_000, 1000) in found and len(found) == 201
    assert periodic.find_runs(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]


def test_query(spark):
    found = catalog.periodic_runs(spark, FOLDER)
    expected = []
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        words = planted(r.doc_id, r.text)
        runs = runs_of(words)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None,) * 3
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        left = " ".join(collapsed_of(words, runs))
        milli = 1000 * best[1] // best[2] if runs else None
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, left)]
        expected.append((r.doc_id, len(runs), *best, milli, *digests))
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert sum(r[1] for r in expected) > 10
    kinds = dict(found.dtypes)
    assert [kinds[c] for c in ("n_runs", "start", "length", "period", "exponent_milli")] == ["bigint"] * 5


def test_odd_rows_and_clashing_names(spark):
    rows = [
        (1, None, 5, "r"),
        (None, "", 5, "r"),
        (2, " \x0b\t ", 5, None),
        (3, "a b " * 5, None, "r"),
        (3, "a b " * 5, None, "r"),
        (4, "x " * 5 + "y", 1, "r"),
        (5, "x " * 6, 1, "r"),
        (6, "X x " * 4 + "    " * 6, 1, "r"),
        (7, "w" * 300_000 + " w" * 90_000, 1, "r"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, runs string").repartition(2)
    found = periodic.with_runs(docs)
    assert found.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = sorted((r.text or "", r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect())
    expected = []
    for _, text, *_ in rows:
        words = brute.SPACED.findall(text or "")
        runs = [(1, 90_000, 1)] if len(text or "") > 10_000 else runs_of(words)
        expected.append((text or "", len(words), runs, " ".join(collapsed_of(words, runs))))
    assert got == sorted(expected)
    assert periodic.with_runs(docs.where("doc_id = 99")).count() == 0
    text_only = periodic.with_runs(docs.select(F.col("text").alias("runs")), "runs")
    assert text_only.columns == ["n_words", "runs", "collapsed"] and text_only.count() == len(rows)


def test_strongest_run_compares_exactly(spark):
    rows = [([(5, 40, 10), (0, 4, 1), (9, 41, 10)],), ([(7, 8, 2), (3, 12, 3), (3, 8, 2)],), ([],)]
    kind = "runs array<struct<start: bigint, length: bigint, period: bigint>>"
    found = spark.createDataFrame(rows, kind).select(periodic.strongest(F.col("runs")).alias("r"))
    assert [r.r and tuple(r.r) for r in found.collect()] == [(9, 41, 10), (3, 8, 2), None]
