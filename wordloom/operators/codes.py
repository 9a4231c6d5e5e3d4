"""n-gram keys in which frequent words are one character.

The key of an n-gram holds ``n`` words, and a corpus has about as many n-grams as words, so
counting them shuffles the corpus ``n`` times. Here the words of a dictionary are written as
single characters that no word can hold, the most frequent ones as those of fewest bytes, and
all others as they are, behind a comma.

Neighbouring n-grams share all but one of their words, so they travel together. The key of an
n-gram is the least hash of those of its words that have no code, or the hash of all of them where
each has one. A run of n-grams of one key is moved as one array of codes and words, to the place
that the key names, becomes words again there, and gives its n-grams, which are counted where
they are: equal n-grams have equal keys. Words without a code are the rare ones, so keys
are many. Pieces are not combined before they are moved: all copies of a line that is repeated
over and over are read by the same few tasks.

A dictionary is made from word counts, of the corpus or of another like it: it changes the size of
the keys, never the counts. It is a constant of the plan, of at most ``CODES`` words. A word
is found by its hash: the slot that the hash names holds the word or another one. Where two
words of the dictionary have the same slot, the more frequent one has it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import grams, runs, tokens
from wordloom.functions.checks import window_size
from wordloom.operators.counts import count_by
from wordloom.operators.expand import explode_words
from wordloom.operators.ranking import most_frequent

# Characters of one, two and three bytes in UTF-8 that are neither letters nor parts of a word.
_PRIVATE = 0xE000
_FIRST = [c for c in range(1, 128) if not re.match(r"[A-Za-z0-9',-]", chr(c))]
_CODES = [*_FIRST, *range(0x80, 0xA0), *range(_PRIVATE, 0xF900)]
CODES = 4096
SLOTS_A_CODE = 4
LONGEST = 64
_LITERAL = ","
_NONE, _BETWEEN = "", "\x00"


@dataclass(frozen=True)
class Dictionary:
    """Words by slot with their codes, and words by code."""

    slots: tuple[str, ...]
    codes: tuple[str, ...]
    words: tuple[str, ...]


def dictionary(counts: DataFrame, size: int = CODES) -> Dictionary:
    """The ``size`` most frequent words of ``(word, n)``; ``size`` rows come to the driver."""
    if not 1 <= size <= len(_CODES):
        raise ValueError(f"size must be 1 to {len(_CODES)}, got {size}")
    n_slots = SLOTS_A_CODE * size
    slot = F.pmod(F.xxhash64("word"), F.lit(n_slots)).alias("slot")
    known = counts.where(F.length("word") <= LONGEST)
    rows = most_frequent(known, size).select("word", "n", slot).collect()
    slots, codes, words = [_NONE] * n_slots, [_NONE] * n_slots, {}
    taken = iter(_CODES)
    for row in sorted(rows, key=lambda r: (-r["n"], r["word"])):
        if slots[row["slot"]] == _NONE:
            code = next(taken)
            slots[row["slot"]], codes[row["slot"]] = row["word"], chr(code)
            words[_place(code)] = row["word"]
    by_code = [words.get(i, _NONE) for i in range(max(words, default=0) + 1)]
    return Dictionary(tuple(slots), tuple(codes), tuple(by_code))


def _place(code: int) -> int:
    return code if code < _PRIVATE else code - _PRIVATE + 0xA0


def _constant(values: tuple[str, ...]) -> Column:
    """An array that the optimizer computes once."""
    return F.split(F.lit(_BETWEEN.join(values)), _BETWEEN, -1)


def encoded(words: Column, known: Dictionary) -> Column:
    """An array of words with the codes of those that have one and the others marked."""
    slots, codes = _constant(known.slots), _constant(known.codes)

    def one(word: Column) -> Column:
        at = F.pmod(F.xxhash64(word), F.lit(len(known.slots))).cast("int")
        return F.when(F.get(slots, at) == word, F.get(codes, at)).otherwise(
            F.concat(F.lit(_LITERAL), word)
        )

    return F.transform(words, one)


def decoded_words(parts: Column, known: Dictionary) -> Column:
    """The words of an array as :func:`encoded` makes it."""
    words = _constant(known.words)

    def one(part: Column) -> Column:
        code = F.ascii(part)
        at = F.when(code < _PRIVATE, code).otherwise(code - (_PRIVATE - 0xA0))
        return F.when(part.startswith(_LITERAL), F.substring(part, 2, F.length(part))).otherwise(
            F.get(words, at)
        )

    return F.transform(parts, one)


def pieces(coded: Column, n: int) -> Column:
    """``array<struct<key, piece>>`` of the ``n``-grams in ``coded``; null if there is none."""

    def keys(hashes: Column) -> Column:
        return F.transform(
            grams.starts(coded, n),
            lambda i: F.coalesce(F.array_min(F.slice(hashes, i, n)), F.xxhash64(F.slice(coded, i, n))),
        )

    def cut(found: Column) -> Column:
        return runs.bound(
            runs.run_starts(found, lambda a, b: a == b),
            lambda starts: F.transform(
                runs.runs(starts, F.size(found)),
                lambda r: F.struct(
                    F.get(found, r["start"] - 1).alias("key"),
                    F.slice(coded, r["start"], r["n"] + (n - 1)).alias("piece"),
                ),
            ),
        )

    rare = F.transform(coded, lambda c: F.when(c.startswith(_LITERAL), F.xxhash64(c)))
    return runs.bound(rare, lambda hashes: runs.bound(keys(hashes), cut))


def ngram_counts(lines: DataFrame, n: int, known: Dictionary, column: str = "line") -> DataFrame:
    """``(gram, n)`` as :func:`wordloom.operators.counts.ngram_counts`, moved in coded pieces.

    A piece holds some ``n / 2`` n-grams, so there are more partitions than for other
    shuffles by half as much.
    """
    window_size(n)
    words = tokens.words(F.col(column))
    # Arrays pass through a generator, or the lambdas would compute them anew each time.
    coded = lines.select(F.explode_outer(F.array(encoded(words, known))).alias("coded"))
    found = coded.select(F.explode_outer(pieces(F.col("coded"), n)).alias("p")).where(F.col("p").isNotNull())
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")) * -(-n // 2)
    moved = found.select("p.key", "p.piece").repartition(partitions, "key")
    texts = moved.select("key", F.explode_outer(F.array(decoded_words(F.col("piece"), known))).alias("words"))
    placed = texts.select("key", "words", F.explode_outer(grams.starts(F.col("words"), n)).alias("start"))
    counted = count_by(
        placed.select("key", grams.gram(F.col("words"), F.col("start"), n).alias("gram")), "key", "gram"
    )
    return counted.select("gram", "n")


def dictionary_of(lines: DataFrame, column: str = "line", size: int = CODES) -> Dictionary:
    """A dictionary from the words of ``lines`` themselves, in a pass of its own."""
    return dictionary(count_by(explode_words(lines, column), "word"), size)
