"""Toxicity by two class-conditional Kneser-Ney models.

The models are over the letters of words, so an expression that training has not seen
is judged by its parts. Each class has counts of letter sequences of three to ``ORDER``
letters: occurrences for the longest and for those at the front of a word, and for the
others the number of different letters in front of them. The probability of a letter is
discounted and interpolated over ever shorter contexts. The lowest orders are shared by both
classes: how many different words of the whole collection hold a pair of letters, and how
many different letters stand in front of one. A rare expression so falls back on counts that
are the same on either side, and says little about the class.

A text is compared as a whole. Its ordinary log-likelihood is that of its words under the
ordinary model. Toxic texts are ordinary ones in most of their words, so the toxic
log-likelihood is that under a mixture, ``TOXIC_SHARE`` of the toxic model and the rest of the
ordinary one. The measure of a text is the difference of the two by word; every word counts,
for either class. A logistic curve, fitted on training rows that were not counted, makes it
a score.

What is bounded, and by what: class counts and curve come from ``SAMPLE_ROWS`` labelled rows of
each class at most, chosen by a hash of the id, of ``SAMPLE_BYTES`` in all; the model of a task
grows with those numbers and not with the corpus. The shared counts come from all texts
and all pairs of letters. Only those of the pairs that a class has seen are kept: of any
other pair either model has the same shared probability, up to what it leaves to it,
and it cancels in the difference. Every text is scored whole.

Defined cases: a null or empty text has no words and gets the score of a difference of 0. Labels that are null or neither 0 nor 1 are not learned from; without labels of
both classes every score is the share of toxic ones, 0.5 without any. A labelled id with
several texts is learned from once, by the smallest text. A null id counts as an empty
one in the choice of held-out rows. Other columns are passed through, but one with the
name of the score is replaced by it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.decontamination import words
from wordloom.llm.shipping import send_code
from wordloom.llm.texts import bounded_sample, replacing
from wordloom.sources.scratch import written

ORDER = 6
SHARED_ORDER = 2
DISCOUNT = 0.75
TOXIC_SHARE = 0.02
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 64 << 20
HELD_OUT_OF = 5
FOLDS = 4
CACHED = 400_000

# Marks in front of and behind a word; neither can be part of one.
FRONT, BACK = "^^", "$"
# One byte in, one byte out: A-Z in lower case, digits and bytes above 127 kept, the rest spaces.
AS_WORDS = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i > 127 else 32
    for i in range(256)
)


def held_out(doc_id: Column) -> Column:
    """Whether a row is never learned from: a fifth of the ids, by their checksum."""
    return _checksum(doc_id) % HELD_OUT_OF == 0


def _checksum(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


@dataclass
class Shared:
    """Counts of the whole collection: different words with a pair of letters.

    ``pairs`` are those that a class has seen. ``first`` has the sum and the number of all pairs
    that begin with a letter, ``last`` the number of all that end with it. ``n_pairs`` and
    ``n_letters`` count all different pairs and all letters at their ends.
    """

    pairs: dict[str, int] = field(default_factory=dict)
    first: dict[str, tuple[int, int]] = field(default_factory=dict)
    last: dict[str, int] = field(default_factory=dict)
    n_pairs: int = 0
    n_letters: int = 0


@dataclass
class Model:
    """Counts by class, shared counts and the curve; one object a worker."""

    grams: tuple[dict[str, int], dict[str, int]]
    shared: Shared = field(default_factory=Shared)
    curve: tuple[float, float] = (0.0, 0.0)
    contexts: list[Counter] = field(init=False)
    followers: list[Counter] = field(init=False)

    def __post_init__(self) -> None:
        self.contexts, self.followers = [Counter(), Counter()], [Counter(), Counter()]
        for i, table in enumerate(self.grams):
            for gram, n in table.items():
                self.contexts[i][gram[:-1]] += n
                self.followers[i][gram[:-1]] += 1
        self.spread = self.shared.n_pairs + 0.5 * self.shared.n_letters + 1
        self.ratios: dict[str, float] = {}
        self.known: dict[bytes, float] = {}
        self.older: dict[bytes, float] = {}

    def __getstate__(self) -> tuple:
        return self.grams, self.shared, self.curve

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def _shared(self, pair: str) -> float:
        """Probability of the second letter of ``pair`` after the first."""
        alone = (self.shared.last.get(pair[-1], 0) + 0.5) / self.spread
        n, followers = self.shared.first.get(pair[0], (0, 0))
        if not n:
            return alone
        seen = max(self.shared.pairs.get(pair, 0) - DISCOUNT, 0.0)
        return (seen + DISCOUNT * followers * alone) / n

    def _probability(self, side: int, gram: str) -> float:
        p = self._shared(gram[-SHARED_ORDER:])
        for size in range(SHARED_ORDER, len(gram)):
            context = gram[-size - 1 : -1]
            n = self.contexts[side][context]
            if not n:
                break
            seen = max(self.grams[side].get(gram[-size - 1 :], 0) - DISCOUNT, 0.0)
            p = (seen + DISCOUNT * self.followers[side][context] * p) / n
        return p

    def _ratio(self, gram: str) -> float:
        found = self.ratios.get(gram)
        if found is None:
            found = math.log(self._probability(1, gram) / self._probability(0, gram))
            if len(self.ratios) >= CACHED:
                self.ratios.clear()
            self.ratios[gram] = found
        return found

    def difference(self, word: bytes) -> float:
        """Toxic less ordinary log-likelihood of ``word``."""
        marked = FRONT + word.decode() + BACK
        ratio = sum(
            self._ratio(marked[max(0, i - ORDER + 1) : i + 1])
            for i in range(len(FRONT), len(marked))
        )
        # log(1 - share + share * e^ratio), for ratios of any size
        high = max(ratio + math.log(TOXIC_SHARE), math.log(1 - TOXIC_SHARE))
        low = min(ratio + math.log(TOXIC_SHARE), math.log(1 - TOXIC_SHARE))
        return high + math.log1p(math.exp(low - high))

    def measure(self, text: str | None) -> float:
        """The difference of the log-likelihoods of ``text``, by word."""
        found = (text or "").encode().translate(AS_WORDS).split()
        if not found:
            return 0.0
        known, older, total = self.known, self.older, 0.0
        for word in found:
            value = known.get(word)
            if value is None:
                value = older.get(word)
                if value is None:
                    value = self.difference(word)
                known[word] = value
            total += value
        if len(known) > CACHED:
            self.known, self.older = {}, known
        return total / len(found)

    def score(self, measure: float) -> float:
        a, b = self.curve
        return 1.0 / (1.0 + math.exp(-min(max(a * _bent(measure) + b, -30.0), 30.0)))


def _bent(measure: float) -> float:
    """The scale the curve is fitted on: measures are small and spread over decades.

    The least measure is that of a text in which no word is of the toxic model.
    """
    return math.log(measure - math.log(1 - TOXIC_SHARE) + 1e-3)


def fit_curve(measures: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of ``toxic`` on bent ``measures``, with a slight ridge."""
    x = np.array([_bent(m) for m in measures])
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    weights = weights / weights.sum() * len(x)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weights * (toxic - p)) - 1e-3 * beta
        hessian = design.T @ (design * (weights * p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _pieces(counted: DataFrame, least: int, most: int, *keep: str) -> DataFrame:
    """``(*keep, gram)``: the letter sequences of ``counted.word`` that end at each letter."""
    marked = counted.select(*keep, F.concat(F.lit(FRONT), "word", F.lit(BACK)).alias("marked"))
    ends = marked.select(
        *keep,
        "marked",
        F.explode(F.sequence(F.lit(len(FRONT) + 1), F.length("marked"))).alias("end"),
    )
    sizes = F.sequence(F.lit(least), F.least(F.lit(most), F.col("end")))
    sized = ends.select(*keep, "marked", "end", F.explode(sizes).alias("size"))
    gram = F.substring("marked", F.col("end") - F.col("size") + 1, F.col("size"))
    return sized.select(*keep, gram.alias("gram"))


def _words(texts: DataFrame, *keep: str) -> DataFrame:
    return texts.select(*keep, F.explode_outer(words(F.col("text"))).alias("word")).where(
        F.col("word").isNotNull()
    )


def class_counts(counted: DataFrame) -> DataFrame:
    """``(toxic, gram, n)`` from ``(toxic, word, n)``, as the models take them.

    Occurrences for sequences of ``ORDER`` letters and for those at the front of a word, else the
    number of different letters in front.
    """
    pieces = _pieces(counted, SHARED_ORDER + 1, ORDER, "toxic", "n")
    found = pieces.groupBy("toxic", "gram").agg(F.sum("n").alias("n"))
    inner = found.where(F.length("gram") > SHARED_ORDER + 1).select(
        "toxic", F.expr("substring(gram, 2)").alias("gram")
    )
    inner = inner.groupBy("toxic", "gram").agg(F.count("*").alias("_in_front"))
    whole = (F.length("gram") == ORDER) | F.startswith("gram", F.lit(FRONT))
    return found.join(inner, ["toxic", "gram"], "left").select(
        "toxic", "gram", F.when(whole, F.col("n")).otherwise(F.col("_in_front")).alias("n")
    )


def shared_counts(texts: DataFrame, seen: DataFrame) -> Shared:
    """Counts of all ``texts``; of single pairs those among ``seen.gram``."""
    types = _words(texts).groupBy("word").agg(F.count("*").alias("_n"))
    pairs = _pieces(types, SHARED_ORDER, SHARED_ORDER).groupBy("gram").agg(F.count("*").alias("n"))
    pairs = written(pairs, "toxic-shared")
    letters = seen.select(F.explode(F.split("gram", "")).alias("letter")).distinct()

    def by(letter: Column, *sums: Column) -> list[tuple]:
        found = pairs.groupBy(letter.alias("letter")).agg(*sums)
        found = found.join(letters, "letter", "left_semi").toArrow()
        return list(zip(*(c.to_pylist() for c in found.columns)))

    kept = pairs.join(seen, "gram", "left_semi").toArrow()
    first = by(F.substring("gram", 1, 1), F.sum("n").alias("n"), F.count("*").alias("k"))
    last = by(F.substring("gram", 2, 1), F.count("*").alias("n"))
    all_of = pairs.agg(F.count("*"), F.count_distinct(F.substring("gram", 2, 1))).first()
    return Shared(
        dict(zip(*(c.to_pylist() for c in kept.columns))),
        {x: (n, k) for x, n, k in first},
        dict(last),
        *all_of,
    )


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES
) -> Model:
    """A model from ``(doc_id, text)`` and ``(doc_id, toxic)`` without the held-out ids."""
    spark = docs.sparkSession
    send_code(spark)
    docs = docs.select("doc_id", "text")
    labels = labels.select("doc_id", "toxic")
    allowed = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic")
    )
    sizes = {r["toxic"]: r["n"] for r in allowed.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        share = min(max(sum(k * n for k, n in sizes.items()) / max(1, sum(sizes.values())), 0.001), 0.999)
        bias = math.log(share / (1 - share)) if sizes else 0.0
        return Model(({}, {}), curve=(0.0, bias))
    chosen = written(
        bounded_sample(allowed.where("toxic = 0"), sample_rows, "doc_id").union(
            bounded_sample(allowed.where("toxic = 1"), sample_rows, "doc_id")
        ),
        "toxic-labels",
    )
    fold = F.floor(_checksum(F.col("doc_id")) / HELD_OUT_OF) % FOLDS
    whole = written(
        docs.join(chosen, "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .withColumn("fold", fold),
        "toxic-rows",
    )
    # Over the bounded rows of a class, without their texts.
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    sizes_so_far = whole.select("doc_id", "toxic", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    fitting = sizes_so_far.withColumn("upto", F.sum("size").over(order)).where(F.col("upto") <= sample_bytes)
    texts = written(whole.join(fitting.select("doc_id", "toxic"), ["doc_id", "toxic"], "left_semi"), "toxic-texts")
    counted = written(
        _words(texts.where("fold > 0"), "toxic").groupBy("toxic", "word").agg(F.count("*").alias("n")),
        "toxic-words",
    )
    grams: tuple[dict[str, int], dict[str, int]] = ({}, {})
    by_class = class_counts(counted).toArrow()
    for toxic, gram, n in zip(*(by_class.column(i).to_pylist() for i in range(3))):
        grams[toxic][gram] = n
    seen = written(_pieces(counted, SHARED_ORDER, SHARED_ORDER).distinct(), "toxic-pairs")
    model = Model(grams, shared_counts(docs, seen))
    measured = measure(texts.where("fold = 0").select("toxic", "text"), model).toArrow()
    toxic = np.array(measured.column("toxic").to_pylist(), float)
    if 0 < toxic.sum() < len(toxic):
        values = np.array(measured.column("measure").to_pylist(), float)
        per_row = [sizes[k] / max(1, (toxic == k).sum()) for k in (0, 1)]
        model.curve = fit_curve(values, toxic, np.where(toxic == 1, per_row[1], per_row[0]))
    else:
        model.curve = (0.0, math.log(sizes[1] / sizes[0]))
    return model


def measure(texts: DataFrame, model: Model, name: str = "measure") -> DataFrame:
    """``texts`` with the difference of the log-likelihoods of each, by word."""
    return _scored(texts, model, name, lambda m, value: value)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each text."""
    return _scored(docs, model, name, lambda m, value: m.score(value))


def _scored(texts: DataFrame, model: Model, name: str, last) -> DataFrame:
    spark = texts.sparkSession
    send_code(spark)
    shipped = spark.sparkContext.broadcast(model)  # bounded by the sample, see above
    texts = replacing(texts, name)
    schema = T.StructType([*texts.schema.fields, T.StructField(name, T.DoubleType(), False)])
    at = texts.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shipped.value
        for batch in batches:
            found = [last(held, held.measure(t)) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, name]
            )

    return texts.mapInArrow(run, schema)
