"""Phrase collocations, counted through Rabin-Karp fingerprints.

A text is lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words at
spaces and tabs. The words of a piece, one space between them, are a polynomial over their
bytes modulo 2^64. Numpy computes its prefixes for a megabyte of texts at a time, and the
difference of two prefixes is the fingerprint of any n-gram, mixed with its language and
length. What is shuffled for an n-gram is its fingerprint, its occurrences, the sum of a
second, independent hash, and a pointer: the smallest key of a document that holds it.

Only fingerprints of ``least`` occurrences or more go on. Each is turned into text through its
pointer: that document is hashed again and the words are cut out. The text proves the count:
its own second hash times the occurrences is the sum, unless other texts share the
fingerprint. Those fingerprints are counted once more by their texts, so collisions cost
time, never a wrong number. No other n-gram ever becomes text.

Lengths 1 and 2 are counted together; a longer n-gram is emitted only where both its parts of
one word less have passed. That test is a bit table of ``FILTER_BITS`` bits, 16 MB whatever
the corpus. A full table lets n-grams through that are too rare; it never stops one.

Defined cases: a null text is empty, a null language is ``und``. Repeated rows count each.
Equal scores are ordered by occurrences, then by the bytes of the phrase. Columns other than
the text and the language are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.shipping import send_code
from wordloom.sources.scratch import written

LEAST = 10
LONGEST = 3
CONTAINED_PERCENT = 50
TOP = 2000
NO_LANGUAGE = "und"
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
FILTER_BITS = 1 << 27
CHECK_BITS = 26  # so that the sums of 10^11 occurrences fit 64 bits
SEGMENT = 1 << 20  # bytes hashed at a time; a longer piece is hashed as a whole

_PIECE_END, _SPACE = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_PIECE_END)] = 2
_KIND[list(_SPACE)] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

Grams = tuple[np.ndarray, np.ndarray, np.ndarray]


class _Polynomial:
    """Prefixes of a polynomial modulo 2^64 over letters of random values."""

    def __init__(self, seed: int) -> None:
        random = np.random.default_rng(seed)
        self.letters = random.integers(1, 1 << 63, 256, np.uint64)[_LOWER]
        self.base = int(random.integers(1, 1 << 60)) * 8 + 5
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _grown(self, n: int) -> None:
        if len(self._powers) < n:
            def powers(base: int) -> np.ndarray:
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                return np.cumprod(steps)

            self._powers = powers(self.base)
            self._inverses = powers(pow(self.base, -1, 1 << 64))

    def prefixes(self, values: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Sums of ``values`` times the powers ``at``, which go 0, 1, 2 ... by default."""
        if at is None:
            self._grown(len(values) + 1)
            powers = self._powers[: len(values)]
        else:
            self._grown(int(at[-1]) + 1 if len(at) else 1)
            powers = self._powers[at]
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers, out=out[1:])
        return out

    def between(self, prefixes: np.ndarray, start: np.ndarray, stop: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The polynomials of ``start`` to ``stop``, moved from the power ``at`` to 0."""
        return (prefixes[stop] - prefixes[start]) * self._inverses[at]


_FIRST, _SECOND = _Polynomial(11), _Polynomial(12)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Words:
    """The words of some texts that stand one behind the other in ``data``, with prefix hashes."""

    def __init__(self, data: np.ndarray, text_starts: np.ndarray) -> None:
        kind = _KIND[data]
        inside = kind == 0
        opens = np.zeros(len(data) + 1, bool)
        opens[text_starts] = True
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        self.starts = np.flatnonzero(inside & (~before[:-1] | opens[:-1]))
        self.stops = np.flatnonzero(inside & (~np.append(inside[1:], False) | opens[1:])) + 1
        self.text = np.searchsorted(text_starts, self.starts, "right") - 1
        self._piece = np.cumsum((kind == 2) | opens[:-1])[self.starts]
        self.at = np.zeros(len(self.starts) + 1, np.int64)  # places with single spaces
        np.cumsum(self.stops - self.starts + 1, out=self.at[1:])
        self._prefixes = []
        for polynomial in (_FIRST, _SECOND):
            raw = polynomial.prefixes(polynomial.letters[data])
            words = polynomial.between(raw, self.starts, self.stops, self.starts)
            self._prefixes.append((polynomial, polynomial.prefixes(words, self.at[:-1])))

    def grams(self, n: int, salts: np.ndarray, bits: int = 64) -> Grams:
        """First words, fingerprints and second hashes of the n-grams inside pieces."""
        first = np.arange(max(0, len(self.starts) - n + 1))
        first = first[self._piece[first] == self._piece[first + n - 1]]
        one, two = (p.between(sums, first, first + n, self.at[first]) for p, sums in self._prefixes)
        prints = _mixed(one + salts[self.text[first]] + np.uint64(n)) >> np.uint64(64 - bits)
        checks = _mixed(two) >> np.uint64(64 - CHECK_BITS)
        return first, prints, checks.astype(np.int64)


def salt(language: str) -> int:
    return xxhash.xxh64_intdigest(language.encode(), 7)


def segments(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``(bytes, text starts, first text)``: the texts of a column cut up at piece ends.

    A text that goes on in the next segment counts as a text of its own there.
    """
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    start, total = int(ends[0]), int(ends[-1])
    while start < total:
        stop = min(start + SEGMENT, total)
        if stop < total:
            later = ends[np.searchsorted(ends, stop)]
            breaks = np.flatnonzero(_KIND[data[start:stop]] == 2)
            before = ends[np.searchsorted(ends, stop, "right") - 1]
            cut = max(int(before), start + int(breaks[-1]) + 1 if len(breaks) else 0)
            if cut <= start:
                after = np.flatnonzero(_KIND[data[stop:later]] == 2)
                cut = stop + int(after[0]) + 1 if len(after) else int(later)
            stop = cut
        first = int(np.searchsorted(ends, start, "right")) - 1
        last = int(np.searchsorted(ends, stop))
        starts = np.maximum(ends[first:last], start) - start
        yield data[start:stop], starts, first
        start = stop


def _totals(order: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each fingerprint begins in ``order``, and how often it occurs."""
    held = prints[order]
    begins = np.flatnonzero(np.append(True, held[1:] != held[:-1])) if len(held) else np.empty(0, np.int64)
    return begins, np.diff(np.append(begins, len(held)))


def _in_filter(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    at = prints & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _salts(languages: pa.Array) -> np.ndarray:
    coded = languages.dictionary_encode()
    own = np.array([salt(x) for x in coded.dictionary.to_pylist()], np.uint64)
    return own[coded.indices.to_numpy()] if len(own) else np.empty(0, np.uint64)


def _emitted(
    texts: DataFrame, sizes: tuple[int, ...], passed: Broadcast | None, bits: int
) -> DataFrame:
    """``(print, n, checks, key)`` of the n-grams of ``sizes``, summed up segment by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, salts = batch.column(0).to_numpy(), _salts(batch.column(1))
            for data, starts, first in segments(batch.column(2)):
                words = Words(data, starts)
                own = salts[first : first + len(starts)]
                for n in sizes:
                    at, prints, checks = words.grams(n, own, bits)
                    if passed is not None:
                        shorter = words.grams(n - 1, own, bits)
                        good = np.zeros(len(words.starts) + 1, bool)
                        good[shorter[0]] = _in_filter(passed.value, shorter[1])
                        wanted = good[at] & good[at + 1]
                        at, prints, checks = at[wanted], prints[wanted], checks[wanted]
                    order = np.argsort(prints, kind="stable")
                    begins, counts = _totals(order, prints)
                    if not len(begins):
                        continue
                    key = keys[first + words.text[at]][order]
                    made = [
                        prints[order[begins]].view(np.int64),
                        counts,
                        np.add.reduceat(checks[order], begins),
                        np.minimum.reduceat(key, begins),
                    ]
                    yield pa.RecordBatch.from_arrays(
                        list(map(pa.array, made)), names=["print", "n", "checks", "key"]
                    )

    return texts.mapInArrow(run, "print bigint, n bigint, checks bigint, key bigint")


def _frequent(emitted: DataFrame, least: int, label: str) -> DataFrame:
    sums = emitted.groupBy("print").agg(
        F.sum("n").alias("n"), F.sum("checks").alias("checks"), F.min("key").alias("key")
    )
    return written(sums.where(F.col("n") >= least), label)


def _bit_table(prints: DataFrame, bits: int) -> np.ndarray:
    """A table of ``bits`` bits with a one at each of ``prints.print``; at most ``bits / 64`` rows come here."""
    at = F.col("print").bitwiseAND(F.lit(bits - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))
    words = prints.groupBy(F.expr(f"(print & {bits - 1}) div 64").alias("word")).agg(F.bit_or(one).alias("ones"))
    found = words.toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[found["word"].to_numpy()] = found["ones"].to_numpy()
    return table.view(np.uint8)


def _phrase(data: np.ndarray, words: Words, first: int, n: int) -> str:
    parts = zip(words.starts[first : first + n], words.stops[first : first + n])
    return b" ".join(_LOWER[data[a:b]].tobytes() for a, b in parts).decode()


def _materialised(texts: DataFrame, wanted: DataFrame, longest: int, bits: int) -> DataFrame:
    """``(lang, size, phrase, n, print, clean)``: the text of each fingerprint, read from its document."""
    asked = wanted.groupBy("key").agg(F.collect_list(F.struct("print", "n", "checks")).alias("asked"))
    pointed = texts.dropDuplicates(["key"]).join(asked, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salts = _salts(batch.column(1))
            rows: list[list] = [[], [], [], [], [], []]
            for row, language in enumerate(batch.column(1).to_pylist()):
                left = {
                    np.uint64(a["print"] % (1 << 64)): (a["n"], a["checks"]) for a in batch.column(3)[row].as_py()
                }
                for data, starts, _ in segments(batch.column(2).slice(row, 1)):
                    words = Words(data, starts)
                    own = np.full(len(starts), salts[row])
                    for size in range(1, longest + 1):
                        at, prints, checks = words.grams(size, own, bits)
                        open_ = np.array(sorted(left), np.uint64)
                        for i in np.flatnonzero(np.isin(prints, open_)):
                            if prints[i] not in left:
                                continue
                            n, total = left.pop(prints[i])
                            phrase = _phrase(data, words, at[i], size)
                            values = [language, size, phrase, n, int(prints[i].view(np.int64)), n * checks[i] == total]
                            for column, value in zip(rows, values):
                                column.append(value)
            kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(rows, kinds)],
                names=["lang", "size", "phrase", "n", "print", "clean"],
            )

    return pointed.select("key", "lang", "text", "asked").mapInArrow(
        run, "lang string, size int, phrase string, n bigint, print bigint, clean boolean"
    )


def _counted_by_text(texts: DataFrame, suspects: DataFrame, longest: int, bits: int, least: int) -> DataFrame:
    """``(lang, size, phrase, n)`` of all texts of the fingerprints of ``suspects``."""
    passed = texts.sparkSession.sparkContext.broadcast(_bit_table(suspects, FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, salts = batch.column(1).to_pylist(), _salts(batch.column(1))
            for data, starts, first in segments(batch.column(2)):
                words = Words(data, starts)
                own = salts[first : first + len(starts)]
                for size in range(1, longest + 1):
                    at, prints, _ = words.grams(size, own, bits)
                    hit = _in_filter(passed.value, prints)
                    at, prints = at[hit], prints[hit]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([languages[first + t] for t in words.text[at]], pa.string()),
                            pa.array(np.full(len(at), size, np.int32)),
                            pa.array([_phrase(data, words, i, size) for i in at], pa.string()),
                            pa.array(prints.view(np.int64)),
                        ],
                        names=["lang", "size", "phrase", "print"],
                    )

    found = texts.mapInArrow(run, "lang string, size int, phrase string, print bigint")
    found = found.groupBy("lang", "size", "phrase", "print").agg(F.count("*").alias("n"))
    return found.join(suspects, "print", "left_semi").where(F.col("n") >= least).drop("print")


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    language = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANGUAGE))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.xxhash64(language, body).alias("key"), language.alias("lang"), body.alias("text"))


def frequent_ngrams(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    text: str = "text",
    lang: str = "lang",
    fingerprint_bits: int = 64,
) -> DataFrame:
    """``(lang, size, phrase, n)`` of every n-gram of 1 to ``longest`` words that occurs ``least`` times.

    Written to the shared folder. ``fingerprint_bits`` changes the cost, not the rows.
    """
    if longest < 2 or least < 1:
        raise ValueError(f"longest must be 2 or more and least 1 or more, got {longest} and {least}")
    send_code(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    texts = _texts(docs, text, lang)
    last = _frequent(_emitted(texts, (1, 2), None, fingerprint_bits), least, "phrase-prints")
    levels = [last]
    for n in range(3, longest + 1):
        passed = context.broadcast(_bit_table(last, FILTER_BITS))
        last = _frequent(_emitted(texts, (n,), passed, fingerprint_bits), least, "phrase-prints")
        levels.append(last)
    wanted = reduce(DataFrame.union, levels)
    if fingerprint_bits < 64:  # lengths can share a fingerprint: all of it goes by the text
        suspects = written(wanted.select("print").distinct(), "phrase-suspects")
        return written(_counted_by_text(texts, suspects, longest, fingerprint_bits, least), "phrases")
    found = written(_materialised(texts, wanted, longest, fingerprint_bits), "phrase-texts")
    suspects = found.where(~F.col("clean")).select("print")
    clean = found.where("clean").drop("print", "clean")
    if suspects.isEmpty():
        return clean
    again = _counted_by_text(texts, suspects, longest, fingerprint_bits, least)
    return written(clean.union(again), "phrases")


def _exact(n: str) -> Column:
    return F.col(n).cast("decimal(18,0)")


def scored(ngrams: DataFrame, contained_percent: int = CONTAINED_PERCENT) -> DataFrame:
    """``(lang, size, phrase, a, l, r, score)`` of the phrases of two words or more.

    ``score`` is ``floor(1000000 * a * a / (l * r))`` at the cut between first part and rest where
    it is lowest, the earliest of these. Phrases inside a longer one of ``ngrams`` that
    has ``contained_percent`` of their occurrences or more are left out.
    """
    known = ngrams.select("lang", "phrase", "n")
    phrases = ngrams.where("size > 1").withColumn("words", F.split("phrase", " "))

    def joined(start: Column, n: Column) -> Column:
        return F.array_join(F.slice("words", start, n), " ")

    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda k: F.struct(
            k.alias("k"),
            joined(F.lit(1), k).alias("first"),
            joined(k + 1, F.col("size") - k).alias("rest"),
        ),
    )
    cut = phrases.select("lang", "size", "phrase", F.col("n").alias("a"), F.explode(cuts).alias("c"))
    cut = cut.select("lang", "size", "phrase", "a", "c.*")
    cut = cut.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cut = cut.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    share = F.call_function("div", _exact("a") * _exact("a") * 1000000, _exact("l") * _exact("r"))
    best = (
        cut.withColumn("score", share.cast("bigint"))
        .groupBy("lang", "size", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
        .select("lang", "size", "phrase", "a", "b.l", "b.r", "b.score")
    )
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda s: joined(s, n)),
        )
    )
    inside = (
        phrases.where("size > 2")
        .select("lang", F.col("n").alias("longer"), F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    held = best.join(inside, ["lang", "phrase"], "left")
    contained = F.coalesce(100 * F.col("longer") >= contained_percent * F.col("a"), F.lit(False))
    return held.where(~contained).drop("longer")


def word_totals(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, n)``: all words of each language."""
    texts = _texts(docs, text, lang)
    return texts.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(WORD))).cast("bigint").alias("n"))


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    contained_percent: int = CONTAINED_PERCENT,
    top: int = TOP,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language."""
    ngrams = frequent_ngrams(docs, longest, least, text, lang)
    found = scored(ngrams, contained_percent)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(word_totals(docs, text, lang), "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
