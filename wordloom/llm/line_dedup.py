"""Removal of repeated passages by overlapping windows of three lines.

Every three consecutive lines of a text are one window, known by a 128-bit hash. The
first occurrence of a window in the collection, in the order of ids and positions,
stays; the lines that later occurrences cover are removed. Overlapping
occurrences are merged before, so a passage of any length goes as a whole.

First occurrences are grouped minima, combined before the shuffle: a window that a
third of all texts hold is one row a task there. Those of windows found more than once
are written, and joined back from there: the join has two shuffled sides, so adaptive
execution can split the rows of a frequent window. Texts are shuffled once, with the
spans to take out of them.

Defined cases: a text of one or two lines is one window. Lines end at a line feed; a
window without a character other than white space is not looked at. Where an
occurrence overlaps the first one, in a run of equal lines, only the lines behind the
first one go. A null text has no lines and stays null; a text that loses all its lines
becomes empty and stays as a row. Rows that repeat an id and a text are one document
and come out equal; null ids come first in the order. Other columns are passed
through, but one with the name of an output column is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.checks import at_least
from wordloom.llm import spans
from wordloom.llm.texts import kept_pieces, replacing, text_key, unused
from wordloom.sources.scratch import written

WINDOW = 3
LINE_END = "\n"


def lines(text: Column) -> Column:
    return F.split(text, LINE_END, -1)


def windows(
    docs: DataFrame, n: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(_id, _key, start, stop, h1, h2)`` for every window of every text."""
    at_least("n", n, 1)
    split = docs.select(
        F.col(doc_id).alias("_id"),
        text_key(F.col(text)).alias("_key"),
        lines(F.col(text)).alias("_lines"),
    )
    size = F.size("_lines")
    width = F.least(F.lit(n), size)
    starts = F.when(size > 0, F.sequence(F.lit(1), size - width + 1))
    placed = split.select("_id", "_key", "_lines", F.explode_outer(starts).alias("_start")).where(
        F.col("_start").isNotNull()
    )
    inside = F.slice("_lines", F.col("_start"), F.least(F.lit(n), F.size("_lines")))
    filled = F.array_join(inside, "").rlike(r"[^\x20\x09-\x0D]")
    return placed.where(filled).select(
        "_id",
        "_key",
        (F.col("_start") - 1).alias("start"),
        (F.col("_start") - 1 + F.least(F.lit(n), F.size("_lines"))).alias("stop"),
        F.xxhash64(inside).alias("h1"),
        F.xxhash64(F.lit(n), inside).alias("h2"),
    )


def repeated(found: DataFrame) -> DataFrame:
    """``(_id, _key, start, stop)``: what later occurrences of a window cover."""
    place = F.struct("_id", "_key", "start", "stop")
    first = (
        found.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    first = written(first, "line-firsts")
    later = found.join(first, ["h1", "h2"]).where(place != F.col("first"))
    same = F.col("_id").eqNullSafe(F.col("first._id")) & (F.col("_key") == F.col("first._key"))
    start = F.when(same, F.greatest("start", F.col("first.stop"))).otherwise(F.col("start"))
    return later.select("_id", "_key", start.alias("start"), "stop").where("start < stop")


def dedup_lines(
    docs: DataFrame,
    n: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    lines_as: str = "n_lines",
    removed_as: str = "n_removed",
) -> DataFrame:
    """``docs`` with later occurrences cut out of the texts, and the lines they had and lost."""
    docs = replacing(docs, lines_as, removed_as)
    covered = spans.merged(repeated(windows(docs, n, doc_id, text)), ["_id", "_key"])
    id_as, key_as = unused(docs.columns, "cut_id"), unused(docs.columns, "cut_key")
    spans_as, body = unused(docs.columns, "cut"), F.col(f"`{text}`")
    covered = covered.select(
        F.col("_id").alias(id_as),
        F.col("_key").alias(key_as),
        F.struct("spans", "covered").alias(spans_as),
    )
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(id_as)) & (text_key(body) == F.col(key_as))
    joined = docs.join(covered, same, "left")
    cut = F.col(spans_as)
    kept = F.array_join(kept_pieces(lines(body), cut["spans"]), LINE_END)
    n_lines = F.coalesce(F.regexp_count(body, F.lit(LINE_END)) + 1, F.lit(0))
    columns = [
        F.when(cut.isNull(), body).otherwise(kept).alias(c) if c == text else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return joined.select(
        *columns,
        n_lines.cast("bigint").alias(lines_as),
        F.coalesce(cut["covered"], F.lit(0)).cast("bigint").alias(removed_as),
    )
