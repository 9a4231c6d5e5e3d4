"""Periodic runs: stretches of words that repeat with a fixed period, by multi-scale minimizers.

A run is a stretch of consecutive words whose smallest period is ``q`` (words ``q`` apart are
the same), at least ``LEAST_LENGTH`` words and ``LEAST_POWER`` periods long, which neither
neighbour extends. Periods below ``SHORT`` are found by direct scans at each lag.

Longer ones are found scale by scale. At scale ``w``, a power of two, every ``w`` words have a
hash, and the smallest hash of every ``w`` neighbouring starts marks a minimizer. Inside a
run of period ``w <= q < 2w`` equal windows lie ``q`` apart, and so do their minima: a run of
four periods holds a pair of equal minimizers at exactly that distance. Each such pair is a
seed, extended over the words themselves in both directions.

Grams inside a run of period ``w / 4`` or less, which earlier scales have found, are no
minimizers. What is left of a long period always holds others, since a stretch made of such
grams only would have the short period as a whole; and equal grams among them start more
than ``w / 4`` apart, so a minimizer has at most eight partners below ``2w``. Nothing is
missed, and the work is ``n log(n) ** 2`` for ``n`` words, however periodic the text. Hashes only
propose: what is returned has been compared word by word.

A text is one row of one task; nothing is shuffled. Defined cases: words lie between ASCII
white space and are compared as they stand. A null or empty text has no words, no run and
an empty collapsed text. Repeated rows are each their own; other columns stay, those of the
names of outputs are replaced. Runs that overlap are all given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.shipping import send_code
from wordloom.llm.texts import replacing, unused

LEAST_LENGTH, LEAST_POWER = 6, 4
SHORT = 8  # the first scale; smaller periods are scanned directly
FIRST_STEP = 64  # words compared at once when a seed is extended; doubled while they agree

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MORE = np.uint64(0xBF58476D1CE4E5B9)
_NEVER = np.iinfo(np.uint64).max

RUNS = T.ArrayType(
    T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")]),
    False,
)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of each pair; the order of the two matters."""
    h = (a * _ODD) ^ (b + (a >> np.uint64(29)))
    h = (h ^ (h >> np.uint64(32))) * _MORE
    return h ^ (h >> np.uint64(29))


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _least(period: int) -> int:
    return max(LEAST_LENGTH, LEAST_POWER * period)


def _direct(ids: np.ndarray, lag: int) -> Iterator[tuple[int, int]]:
    """``(start, stop)`` of the stretches of period ``lag`` that are long enough."""
    edges = np.flatnonzero(np.diff(ids[lag:] == ids[:-lag], prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2] + lag
    long = stops - starts >= _least(lag)
    return zip(starts[long].tolist(), stops[long].tolist())


def _minimizers(keys: np.ndarray, width: int) -> np.ndarray:
    """Positions of the leftmost smallest key of every ``width`` neighbours, a power of two."""
    at = np.arange(len(keys))
    half = 1
    while half < width:
        left, right = at[:-half], at[half:]
        at = np.where(keys[left] <= keys[right], left, right)
        half *= 2
    chosen = at[np.diff(at, prepend=-1) != 0]  # windows move to the right, and so do their minima
    return chosen[keys[chosen] != _NEVER]


def _seeds(keys: np.ndarray, width: int) -> list[tuple[int, int]]:
    """``(lag, position)``, sorted: equal minimizers ``width`` or more and below twice that apart."""
    at = _minimizers(keys, width)
    at = at[np.argsort(keys[at], kind="stable")]
    found, step = [], 1
    while step < len(at):
        a, b = at[:-step], at[step:]
        close = (keys[a] == keys[b]) & (b - a < 2 * width)
        if not close.any():
            break
        wanted = close & (b - a >= width)
        found += zip((b - a)[wanted].tolist(), a[wanted].tolist())
        step += 1
    return sorted(found)


def _agreeing(ids: np.ndarray, at: int, lag: int) -> int:
    """How many words from ``at`` on are the same as those ``lag`` later."""
    start, step = at, FIRST_STEP
    while start < len(ids) - lag:
        stop = min(start + step, len(ids) - lag)
        differs = ids[start:stop] != ids[start + lag : stop + lag]
        first = int(differs.argmax())
        if differs[first]:
            return start + first - at
        start, step = stop, 2 * step
    return start - at


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of the words ``ids``, by start, then period."""
    n = len(ids)
    found: dict[tuple[int, int], int] = {}  # a stretch and its smallest period
    for lag in range(1, SHORT):
        if _least(lag) > n:
            break
        for stretch in _direct(ids, lag):
            found.setdefault(stretch, lag)
    back, width = ids[::-1], SHORT
    if _least(width) <= n:
        keys = ids.view(np.uint64)
        for half in (1, 2, 4):
            keys = _mixed(keys[:-half], keys[half:])
    while _least(width) <= n:
        inside = np.zeros(len(keys) + 1, np.int64)
        for (start, stop), period in found.items():
            if 4 * period <= width <= stop - start:
                inside[start] += 1
                inside[stop - width + 1] -= 1
        covered = inside[:-1].cumsum() > 0
        lag, reached = 0, 0
        for seed_lag, at in _seeds(np.where(covered, _NEVER, keys), width):
            if seed_lag == lag and at < reached:
                continue
            lag = seed_lag
            stop = at + _agreeing(ids, at, lag)
            start = at - _agreeing(back, n - at - lag, lag)
            reached = stop
            if stop + lag - start >= _least(lag):
                found.setdefault((start, stop + lag), lag)
        keys = _mixed(keys[:-width], keys[width:])
        width *= 2
    return sorted((start, stop - start, period) for (start, stop), period in found.items())


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, less those of any run behind its first period."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(change[:-1].cumsum() == 0)]
    return b" ".join(words)


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed`` of the column ``text``.

    ``runs`` is an array of ``struct<start, length, period>`` by start, then period; words are
    numbered from 0. ``collapsed`` is the text with the first period of each run only.
    """
    send_code(docs.sparkSession)
    body = F.col(f"`{text}`").alias(unused(docs.columns, "whole"))
    kept = replacing(docs, "n_words", "runs", "collapsed").columns
    docs = docs.select(*[F.col(f"`{c}`") for c in kept], body)
    schema = T.StructType(
        [
            *docs.schema.fields[:-1],
            T.StructField("n_words", T.LongType(), False),
            T.StructField("runs", RUNS, False),
            T.StructField("collapsed", T.StringType(), False),
        ]
    )
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, flat, left = [], [0], [], []
            for body in batch.columns[-1].cast(pa.binary()).to_pylist():
                words = (body or b"").split()  # the ASCII white space
                runs = find_runs(word_ids(words))
                sizes.append(len(words))
                flat += runs
                ends.append(len(flat))
                left.append(collapsed(words, runs))
            parts = np.array(flat, np.int64).reshape(-1, 3)
            struct = pa.StructArray.from_arrays(
                [pa.array(parts[:, k]) for k in range(3)], ["start", "length", "period"]
            )
            made = [
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct),
                pa.array(left, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=names)

    return docs.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run of most periods of an array of runs, compared exactly; null for none.

    Ties go to the smallest start, then to the smallest period.
    """

    def first(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (
            F.when(left != right, F.when(left > right, -1).otherwise(1))
            .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
            .otherwise(F.signum(a["period"] - b["period"]).cast("int"))
        )

    return F.get(F.array_sort(runs, first), F.lit(0))
