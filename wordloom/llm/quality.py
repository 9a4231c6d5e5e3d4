"""Quality rules as a short-circuit cascade.

A document is kept if it passes every rule, so it can be given up at the first
rule it fails, and the order of the rules changes the cost but not the verdict.
The cost and the rejections of each rule are measured on a bounded sample; rules
run in descending order of rejections per second, which is the cheapest order
for rules that reject independently of each other.

What a rule needs of a text (its words, repeated windows, repeated lines) is
computed when first asked for and shared by the rules behind it.

Defined cases: a null text is an empty one and fails for having too few words. A
table without rows gives no rows, and the rules keep the order they were given
in. Equal rows get equal verdicts. The columns of the table are passed through, but one
with the name of an output column is replaced by it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.functions.checks import at_least
from wordloom.llm.shipping import send_code
from wordloom.llm.texts import bounded_sample, replacing, unused

# The white space that separates words, and what counts as a symbol.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

SAMPLE_ROWS = 512
WINDOW = 3


class Text:
    """One text, measured on demand."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # bytes.split knows the six ASCII spaces only

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(self.text.count(c) for c in SPACES)

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.text.count(c) for c in SYMBOLS)

    @cached_property
    def n_distinct_words(self) -> int:
        return len(set(self.words))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows of three words that occur twice or more in the text."""
        words = self.words
        grams = list(zip(words, words[1:], words[2:]))
        seen: set[tuple[bytes, ...]] = set()
        again: set[tuple[bytes, ...]] = set()
        for gram in grams:
            (again if gram in seen else seen).add(gram)
        covered = reached = 0
        for at, gram in enumerate(grams) if again else ():
            if gram in again:
                covered += at + WINDOW - max(at, reached)
                reached = at + WINDOW
        return covered


@dataclass(frozen=True)
class Rule:
    """A named reason to reject a text."""

    name: str
    rejects: Callable[[Text], bool]
    base: bool = False


RULES = (
    Rule("few_words", lambda t: t.n_words < 50, base=True),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 50 * t.n_words, base=True),
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("repeated_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 25 * t.n_words),
    Rule("few_distinct_words", lambda t: t.n_distinct_words**2 < t.n_words),
)


@dataclass(frozen=True)
class Measured:
    """What the sample says about a rule."""

    rule: str
    seconds: float
    rejected: int


def measure_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    doc_id: str = "doc_id",
    text: str = "text",
    rows: int = SAMPLE_ROWS,
) -> list[Measured]:
    """Cost and rejections of each rule on ``rows`` documents at most, chosen by a hash.

    The sample is judged in one task, each rule on a fresh text, so that no rule
    gains from what another has computed; one row per rule comes to the driver.
    """
    at_least("rows", rows, 1)
    send_code(docs.sparkSession)
    sample = bounded_sample(docs, rows, doc_id, text).select(F.col(text).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected = [0.0] * len(rules), [0] * len(rules)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                for i, rule in enumerate(rules):
                    fresh = Text(value)
                    start = time.thread_time()
                    rejected[i] += rule.rejects(fresh)
                    seconds[i] += time.thread_time() - start
        names = [rule.name for rule in rules]
        yield pa.RecordBatch.from_pydict({"rule": names, "seconds": seconds, "rejected": rejected})

    found = sample.coalesce(1).mapInArrow(measure, "rule string, seconds double, rejected bigint")
    return [Measured(**row.asDict()) for row in found.collect()]


def in_cascade_order(rules: Sequence[Rule], measured: Sequence[Measured]) -> list[Rule]:
    """Most rejections per second first; ties, and rules that reject nothing, in given order."""
    gain: dict[str, float] = {}
    for m in measured:
        gain[m.rule] = gain.get(m.rule, 0.0) + m.rejected / max(m.seconds, 1e-9)
    return sorted(rules, key=lambda rule: -gain.get(rule.name, 0.0))


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    measures: Sequence[str] = (),
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    kept_as: str = "kept",
) -> DataFrame:
    """``docs`` with ``kept_as`` and the ``measures`` asked for, names of :class:`Text`.

    Measures are taken of every text. Without them a rejected text is measured
    only as far as the rule that rejects it needs.
    """
    send_code(docs.sparkSession)
    ordered = in_cascade_order(rules, measure_rules(docs, rules, doc_id, text, sample_rows))
    docs = replacing(docs, *measures, kept_as)
    schema = T.StructType(
        docs.schema.fields
        + [T.StructField(m, T.LongType(), False) for m in measures]
        + [T.StructField(kept_as, T.BooleanType(), False)]
    )
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: list[bool] = []
            taken: list[list[int]] = [[] for _ in measures]
            for value in batch.column(at).to_pylist():
                t = Text(value)
                kept.append(not any(rule.rejects(t) for rule in ordered))
                for column, name in zip(taken, measures):
                    column.append(getattr(t, name))
            new = [pa.array(c, pa.int64()) for c in taken] + [pa.array(kept, pa.bool_())]
            names = [*batch.schema.names, *measures, kept_as]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, **options) -> DataFrame:
    """The rows of ``docs`` that pass every rule, with the columns they had."""
    kept = unused(docs.columns, "kept")
    judged = judge(docs, rules, kept_as=kept, **options)
    return judged.where(F.col(kept)).drop(kept)
