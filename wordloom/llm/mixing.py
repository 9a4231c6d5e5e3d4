"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target in words. It is met by whole epochs first: each document
of the source is taken ``epochs`` times. What is left of the target is met by a
weighted sample without replacement: document ``i`` draws the key ``-ln(u) / w``, with
``u`` from a hash of its id and ``w`` its quality weight, and documents are taken in
ascending order of keys until their sizes add up to the rest. The last one is taken
if that ends nearer to the target than stopping in front of it.

The running sum over a source never meets in one task. Keys are put into buckets,
4096 to a factor of two, in their order; the sizes of the buckets of a source are
summed and only these sums are accumulated. All documents in lower buckets are in,
all in higher ones are out, and only the one bucket where the sum passes the rest is
sorted document by document: about 1 in 10,000 of a source.

Targets: sources are ranked by code point, null last, and take the weights in turn.
They share ``total`` words by weight; no target exceeds ``max_epochs`` times the size
of its source, and what is cut off is shared by weight among the others. With all
sources in the order of ``cap / weight``, that is one running sum: those up to some
point are cut off, the rest share what is left. It runs over one row a source.

Defined cases: a null or empty text has size 0 and is taken with its epochs, adding
nothing. Null is a source like others. Rows that repeat an id and a text are one
unit of the sample, taken together or not. A source without words has target 0, a
table without rows a mix without rows. Reruns give the same rows. Other columns are
passed through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.texts import spaced_words, unused
from wordloom.sources.scratch import written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix"
BUCKETS_PER_DOUBLING = 4096
LEAST_QUALITY = 0.1


def quality_weight(text: Column) -> Column:
    """Share of the lines of ``text`` that end like a sentence, ``LEAST_QUALITY`` at least."""
    filled = F.coalesce(text, F.lit(""))
    lines = F.regexp_count(filled, F.lit(r"(?m)\S[ \t\r]*$"))
    closed = F.regexp_count(filled, F.lit(r"(?m)[.!?][\"')]*[ \t\r]*$"))
    share = closed.cast("double") / F.greatest(lines, F.lit(1))
    return F.least(F.lit(1.0), F.greatest(F.lit(LEAST_QUALITY), share))


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number inside (0, 1) from 52 bits of a hash of id and text."""
    parts = [doc_id.cast("string"), F.md5(text.cast("binary"))]
    name = F.concat_ws(":", F.lit(seed), *[F.coalesce(p, F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def sampling_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """An exponential key: small ones are taken first, and high quality makes them small."""
    return -F.log(uniform(doc_id, text, seed)) / quality_weight(text)


def targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row a source."""
    listed = F.array(*[F.lit(w) for w in weights])
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighed = sources.withColumn("weight", F.element_at(listed, (rank % len(weights)) + 1))
    weighed = weighed.withColumn("cap", F.col("source_size") * max_epochs)
    everything = Window.partitionBy(F.lit(0))
    earlier = everything.orderBy(
        F.col("cap") / F.col("weight"), F.asc_nulls_last("source")
    ).rowsBetween(Window.unboundedPreceding, -1)

    def behind(all_of: str, less: str) -> Column:
        return F.sum(all_of).over(everything) - F.coalesce(F.sum(less).over(earlier), F.lit(0))

    running = weighed.withColumn("left", behind("source_size", "cap"))
    running = running.withColumn("shares", behind("weight", "weight"))
    # A source is cut off if its cap is no more than its share of what is left for it
    # and those behind it. Both numbers fall along the order, so the largest of the
    # others are those of the first source that is not cut off.
    cut = F.col("cap") * F.col("shares") <= F.col("left") * F.col("weight")
    left = F.max(F.when(~cut, F.col("left"))).over(everything)
    shares = F.max(F.when(~cut, F.col("shares"))).over(everything)
    shared = (F.col("weight") * left).cast("double") / shares.cast("double")
    target = F.when(cut, F.col("cap").cast("double")).otherwise(shared)
    return running.select("source", "source_size", target.alias("target"))


def plan(measured: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """One row a source from ``(source, size, key)``: target, epochs and where the sample ends.

    A document gets one copy more than the epochs if its bucket is below
    ``bucket``, or equal to it and its key not above ``key``.
    """
    bucket = F.floor(F.log2("key") * BUCKETS_PER_DOUBLING).alias("bucket")
    bucketed = measured.select("source", "size", "key", bucket)
    sums = written(
        bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-buckets"
    )
    sources = sums.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = targets(sources, weights, max_epochs)
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    wanted = wanted.withColumn("epochs", epochs.cast("int"))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    wanted = written(wanted.withColumn("rest", rest), "mix-targets")
    order = Window.partitionBy("source").orderBy("bucket")
    before = F.sum("size").over(order) - F.col("size")
    ends = (
        sums.withColumn("before", before)
        .alias("s")
        .join(wanted.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")))
        # Where nothing is left behind the epochs no document gets one more, not even an empty one.
        .where("rest > 0 and before <= rest and rest < before + size")
        .select("s.source", "bucket", "before", "rest")
    )
    ends = written(ends, "mix-ends")
    units = (
        bucketed.alias("b")
        .join(
            ends.alias("e"),
            F.col("b.source").eqNullSafe(F.col("e.source"))
            & (F.col("b.bucket") == F.col("e.bucket")),
        )
        .groupBy("e.source", "e.bucket", "before", "rest", "key")
        .agg(F.sum("b.size").alias("size"))
    )
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("key"))
    over, short = F.col("upto") - F.col("rest"), F.col("rest") - (F.col("upto") - F.col("size"))
    last = (
        units.withColumn("upto", upto)
        .where((over <= 0) | (short > 0) & (over < short))
        .groupBy("source")
        .agg(F.max("key").alias("key"))
    )
    out = wanted.alias("w").join(ends.alias("e"), _same_source("w", "e"), "left")
    out = out.join(last.alias("l"), _same_source("w", "l"), "left")
    return written(
        out.select("w.source", "source_size", "target", "epochs", "bucket", "l.key"), "mix-plan"
    )


def _same_source(one: str, other: str) -> Column:
    return F.col(f"{one}.source").eqNullSafe(F.col(f"{other}.source"))


def _copies(key: Column, planned: Column) -> Column:
    bucket = F.floor(F.log2(key) * BUCKETS_PER_DOUBLING)
    inside = (bucket < planned["bucket"]) | (
        (bucket == planned["bucket"]) & (key <= F.coalesce(planned["key"], F.lit(-1.0)))
    )
    return planned["epochs"] + F.when(inside, 1).otherwise(0)


def report(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``(doc_id, size, source_size, target, copies)`` for every row; texts are read once."""
    measured = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            spaced_words(F.col(text)).alias("size"),
            sampling_key(F.col(doc_id), F.col(text), seed).alias("key"),
        ),
        "mix-sizes",
    )
    planned = plan(measured, weights, max_epochs)
    per_source = planned.select(F.struct("*").alias("plan"))
    same = F.col("source").eqNullSafe(F.col("plan.source"))
    return measured.join(per_source, same).select(
        "doc_id",
        "size",
        "plan.source_size",
        "plan.target",
        _copies(F.col("key"), F.col("plan")).alias("copies"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the columns they had.

    Texts are not shuffled: the plan, one row a source, comes to them.
    """
    body, name = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    measured = written(
        docs.select(
            F.col(f"`{source}`").alias("source"),
            spaced_words(body).alias("size"),
            sampling_key(name, body, seed).alias("key"),
        ),
        "mix-sizes",
    )
    as_plan, as_copy = unused(docs.columns, "plan"), unused(docs.columns, "copy")
    per_source = plan(measured, weights, max_epochs).select(F.struct("*").alias(as_plan))
    planned = F.col(as_plan)
    joined = docs.join(per_source, F.col(f"`{source}`").eqNullSafe(planned["source"]))
    times = F.array_repeat(F.lit(1), _copies(sampling_key(name, body, seed), planned))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, F.explode(times).alias(as_copy)).select(*columns)
