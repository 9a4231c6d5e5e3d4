"""Benchmark decontamination: find test passages in training texts and take them out.

The normalised n-grams of the benchmark form a set, which every task holds; each
window of a training text is hashed and looked up in it, and the words of a
window whose hash is found are compared, so a hash collision is no hit. The scan
neither shuffles nor materialises the windows: they are positions in generated
code until the lookup.

The benchmark is small next to the corpus, yet it is not trusted to be: the bytes of
its windows are counted first, and a set above ``max_broadcast`` bytes is joined by
a shuffle on the hash instead of being sent to the tasks. Windows go by a number; the
items that hold them are looked up once the hits of a document are merged.

Only hits are shuffled, to merge overlapping ones per document. A document is
told apart by its id and a hash of its text.

Defined cases: a null or empty text has no words and no hits; it stays. A
benchmark row without words adds nothing; one without an id marks words but is
listed nowhere. Rows that repeat an id and a text all get the same result, rows
that share an id only are separate documents. Columns beside id and text are
passed through whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.checks import at_least
from wordloom.llm import spans
from wordloom.llm.texts import ascii_lower, kept_pieces, text_key, unused
from wordloom.sources.scratch import written

# Which characters form a word, before and after lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_OF_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_WITH_LEAD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*+" + WORD_OF_ANY_CASE

WINDOW = 10
MAX_BROADCAST_BYTES = 64 << 20
WINDOW_BYTES = 64  # of a window in memory, beside its words
DROP_SHARE = 0.5


def words(text: Column) -> Column:
    """The normalised words of ``text`` in order."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)


def benchmark_windows(
    benchmark: DataFrame, n: int = WINDOW, item: str = "item_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``(window, hash, length, gram)``, each window once, and ``(window, item)``, who holds it.

    A window is ``n`` consecutive words. An item of fewer words, but not none, is
    one window of its own length. Both tables are written.
    """
    at_least("n", n, 1)
    split = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("_words"))
    size = F.size("_words")
    length = F.least(size, F.lit(n))
    starts = F.when(size > 0, F.sequence(F.lit(1), size - length + 1))
    found = split.select(
        "item", "_words", length.alias("length"), F.explode_outer(starts).alias("_start")
    ).where(F.col("_start").isNotNull())
    gram = F.slice("_words", F.col("_start"), F.col("length"))
    held = written(found.select("length", gram.alias("gram"), "item").distinct(), "benchmark-grams")
    numbered = held.select("length", "gram").distinct().select(
        F.monotonically_increasing_id().alias("window"), F.xxhash64("gram").alias("hash"), "length", "gram"
    )
    windows = written(numbered, "benchmark-windows")
    items = held.join(windows, ["length", "gram"]).where(F.col("item").isNotNull())
    return windows, written(items.select("window", "item"), "benchmark-items")


def hits(
    docs: DataFrame,
    windows: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    max_broadcast: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``(_id, _key, start, stop, window)``: every occurrence of a window in a text.

    Positions are words, counted from 0.
    """
    taken = F.octet_length(F.array_join("gram", " ")) + 8 * F.col("length") + WINDOW_BYTES
    counted = windows.groupBy("length").agg(F.sum(taken).alias("n")).collect()  # a row a length
    lengths = sorted(row["length"] for row in counted)
    broadcast = sum(row["n"] for row in counted) <= max_broadcast
    if broadcast:
        windows = F.broadcast(windows)
    split = docs.select(
        F.col(doc_id).alias("_id"), text_key(F.col(text)).alias("_key"),
        words(F.col(text)).alias("_words"),
    )
    size = F.size("_words")
    shortest = lengths[0] if lengths else 1
    starts = F.when(size >= shortest, F.sequence(F.lit(1), size - (shortest - 1)))
    placed = split.select("_id", "_key", "_words", F.explode_outer(starts).alias("_start"))
    if len(lengths) == 1:
        placed = placed.withColumn("_length", F.lit(shortest))
    else:
        every = F.array(*[F.lit(x) for x in lengths]).cast("array<int>")
        placed = placed.withColumn("_length", F.explode_outer(every))
    inside = F.col("_start") + F.col("_length") - 1 <= F.size("_words")
    gram = F.slice("_words", F.col("_start"), F.col("_length"))
    looked_up = placed.where(inside).withColumn("_hash", F.xxhash64(gram))
    if not broadcast:
        # Rows that are shuffled hold the words of their window, not those of their text.
        gram = F.col("_gram")
        cut = F.slice("_words", F.col("_start"), F.col("_length")).alias("_gram")
        looked_up = looked_up.select("_id", "_key", "_start", "_length", "_hash", cut)
    # Words are compared on a hit only: as an equality this would become a join
    # key, and every window of the corpus would be copied to build it.
    same_words = (F.col("gram") <= gram) & (F.col("gram") >= gram)
    return (
        looked_up.join(
            windows, (F.col("_hash") == F.col("hash")) & (F.col("_length") == F.col("length"))
        )
        .where(same_words)
        .select(
            "_id",
            "_key",
            (F.col("_start") - 1).alias("start"),
            (F.col("_start") + F.col("_length") - 1).alias("stop"),
            "window",
        )
    )


def _with_hits(
    docs: DataFrame, found: DataFrame, doc_id: str, key: Column, spans_as: str
) -> DataFrame:
    """``docs`` with ``spans_as``, a struct of what ``found`` holds for a row, null for nothing.

    ``found`` is ``(_id, _key, spans, covered)`` and what more there is.
    """
    id_as, key_as = unused(docs.columns, "hit_id"), unused(docs.columns, "hit_key")
    results = found.select(
        F.col("_id").alias(id_as),
        F.col("_key").alias(key_as),
        F.struct(*[c for c in found.columns if c not in ("_id", "_key")]).alias(spans_as),
    )
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(id_as)) & (key == F.col(key_as))
    return docs.join(results, same, "left").drop(id_as, key_as)


def _merged_with_items(found: DataFrame, items: DataFrame) -> DataFrame:
    """``(_id, _key, spans, covered, items)`` of hits; items are looked up for each window once."""
    keys = ["_id", "_key"]
    merged = written(spans.merged(found, keys, union="window"), "benchmark-hits")
    held = merged.select(*keys, F.explode("window").alias("window")).join(items, "window")
    listed = held.groupBy(*keys).agg(F.collect_set("item").alias("items"))
    one, other = merged.alias("m"), listed.alias("l")
    same = F.col("m._id").eqNullSafe(F.col("l._id")) & (F.col("m._key") == F.col("l._key"))
    return one.join(other, same, "left").select("m._id", "m._key", "spans", "covered", "items")


def report(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    max_broadcast: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, spans)`` for every document.

    ``n_hit`` counts words inside any occurrence of a window, ``items`` lists the
    benchmark rows whose windows occur. No text is shuffled.
    """
    windows, items = benchmark_windows(benchmark, n, item, text)
    found = _merged_with_items(hits(docs, windows, doc_id, text, max_broadcast), items)
    n_words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_OF_ANY_CASE)), F.lit(0))
    measured = docs.select(
        F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("_text_key"),
        n_words.cast("bigint").alias("n_words"),
    )
    joined = _with_hits(measured, found, "doc_id", F.col("_text_key"), "_hit")
    item_type = benchmark.schema[item].dataType.simpleString()
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("_hit.covered", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("_hit.items", F.array().cast(f"array<{item_type}>")).alias("items"),
        F.coalesce("_hit.spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
    )


def _cut(text: Column, covered: Column) -> Column:
    """``text`` without the words at ``covered`` and the characters in front of each."""
    pieces = F.regexp_extract_all(text, F.lit(WORD_WITH_LEAD), 0)
    whole = F.array_join(pieces, "")
    rest = F.substring(text, F.length(whole) + 1, F.length(text))
    return F.concat(F.array_join(kept_pieces(pieces, covered), ""), rest)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    drop_share: float = DROP_SHARE,
    doc_id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    max_broadcast: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` without test passages, with the columns it has.

    Hit words are cut out of their texts; a document of which more than
    ``drop_share`` of the words were hit is removed (0: every document with a hit,
    1: none). Texts without a hit stay as they are, byte for byte.
    """
    windows, _ = benchmark_windows(benchmark, n, item, text)
    found = spans.merged(hits(docs, windows, doc_id, text, max_broadcast), ["_id", "_key"])
    body = F.col(f"`{text}`")
    as_name = unused(docs.columns, "hit")
    joined = _with_hits(docs, found, doc_id, text_key(body), as_name)
    hit = F.col(as_name)
    n_words = F.regexp_count(body, F.lit(WORD_OF_ANY_CASE))
    heavy = hit["covered"] > F.lit(drop_share) * n_words
    kept = joined.where(hit.isNull() | ~heavy)
    cut = F.when(hit.isNull(), body).otherwise(_cut(body, hit["spans"]))
    return kept.withColumn(text, cut).select(*[F.col(f"`{c}`") for c in docs.columns])
