"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits. Covering hashing (Pagh, 2016) gives each bit a non-zero
vector of ``r + 1`` binary digits; table ``v``, one for each non-zero vector, keeps the
bits whose vector has an odd product with ``v``. Any ``r`` bits leave a ``v`` that is
orthogonal to all of their vectors, so two fingerprints that differ in at most
``r`` bits agree in every bit that some table keeps: no link can be missed.

Equal fingerprints are one node, whatever their number. Among different ones, a
bucket with few members is compared pair by pair. A crowded bucket is not: each
of its members takes part under itself and under every value one free bit away,
and members that meet under one value are linked to the smallest of them. Two
values two bits apart meet in the value between them, and what meets differs by
two bits at most, so this is exact as well, with 65 rows a member at most and no
pair ever formed. It needs a radius of two or less.

Defined cases: a null or empty text has fingerprint 0 and is linked like any
other. Repeated rows are members like all others. Rows without an id are linked
too, but an id is chosen before none as the name of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.components import components
from wordloom.llm.shipping import send_code
from wordloom.llm.texts import replacing, text_key, unused
from wordloom.sources.scratch import written

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
CHUNK = 8192  # shingles counted at a time, whatever the length of the text
SMALL_BUCKET = 16


def fingerprint(text: str | None) -> int:
    """The fingerprint of ``text``, unsigned: a bit is set if it is in over half the hashes."""
    words = (text or "").encode().lower().split()  # both know ASCII only
    if not words:
        return 0
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    ones = np.zeros(BITS, np.int64)
    for start in range(0, n, CHUNK):
        stop = min(n, start + CHUNK)
        shifted = [words[start + k : stop + k] for k in range(width)]
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(gram), SEED) for gram in zip(*shifted)),
            np.uint64,
            stop - start,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with a fingerprint, a signed 64-bit integer, in place of a column of that name."""
    send_code(docs.sparkSession)
    docs = replacing(docs, name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType(), False)])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(at).to_pylist()], np.uint64)
            names = [*batch.schema.names, name]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found.view(np.int64))], names=names
            )

    return docs.mapInArrow(run, schema)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One mask of kept bits for each table, as signed 64-bit integers."""
    tables = 2 ** (radius + 1) - 1
    masks = []
    for v in range(1, tables + 1):
        kept = sum(1 << i for i in range(BITS) if ((1 + i % tables) & v).bit_count() % 2)
        masks.append(kept - (1 << BITS) if kept >> (BITS - 1) else kept)
    return masks


def _near_pairs(values: Column, radius: int) -> Column:
    def partners(x: Column, at: Column) -> Column:
        later = F.slice(values, at + 2, F.size(values))
        near = F.filter(later, lambda y: F.bit_count(x.bitwiseXOR(y)) <= radius)
        return F.transform(near, lambda y: F.struct(x.alias("u"), y.alias("v")))

    return F.flatten(F.transform(values, partners))


def links(values: DataFrame, radius: int = RADIUS, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """``(u, v)``: links from which every pair of ``values.value`` within ``radius`` is reachable.

    ``values`` holds distinct 64-bit integers. Every link is a true one; of the
    values in a crowded bucket only as many are given as reach all of them.
    """
    if not 0 <= radius <= 2:
        raise ValueError(f"radius must be 0, 1 or 2, got {radius}")
    masks = covering_masks(radius)
    tables = F.array(
        *[
            F.struct(F.lit(i).alias("t"), F.col("value").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(masks)
        ]
    )
    placed = values.select("value", F.explode(tables).alias("at")).select("value", "at.t", "at.key")
    shared = placed.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    members = written(placed.join(shared, ["t", "key"]), "buckets")
    pairs = (
        members.where(F.col("n") <= small_bucket)
        .groupBy("t", "key")
        .agg(F.collect_list("value").alias("values"))
        .select(F.explode(_near_pairs(F.col("values"), radius)).alias("p"))
        .select("p.u", "p.v")
    )
    free = F.element_at(F.array(*[F.lit(m) for m in masks]), F.col("t") + 1)
    crowded = (
        members.where(F.col("n") > small_bucket)
        .groupBy("value")
        .agg(F.bit_or(F.bitwise_not(free)).alias("free"))
    )
    flips = F.filter(
        F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.col("free").bitwiseAND(_bit(b)) != 0
    )
    met = F.concat(
        F.array("value"), F.transform(flips, lambda b: F.col("value").bitwiseXOR(_bit(b)))
    )
    around = crowded.select("value", F.explode(met).alias("middle"))
    centre = (
        around.groupBy("middle")
        .agg(F.min("value").alias("v"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )
    stars = around.join(centre, "middle").select(F.col("value").alias("u"), "v")
    return pairs.union(stars.where(F.col("u") != F.col("v"))).distinct()


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def components_of(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fingerprint, root, component_id)``, one row per distinct fingerprint of ``prints``.

    ``root`` is one fingerprint of the component, ``component_id`` the smallest
    ``doc_id`` among all documents reachable over links.
    """
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    values = nodes.select(F.col("fingerprint").alias("value"))
    roots = components(links(values, radius)).withColumnRenamed("node", "fingerprint")
    placed = nodes.join(roots, "fingerprint", "left").select(
        "fingerprint", "doc_id", F.coalesce("root", "fingerprint").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(named, "root").select("fingerprint", "root", "component_id")


def _prints(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, key, fingerprint)`` of every row, written once."""
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        text_key(F.col(text)).alias("key"),
    )
    return written(
        with_fingerprints(narrow).select("doc_id", "key", "fingerprint"), "fingerprints"
    )


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row; the fingerprint is signed."""
    prints = _prints(docs, doc_id, text)
    found = components_of(prints, radius)
    return prints.join(found, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(
    docs: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The row of ``docs`` with the smallest id of each component, with the columns it had.

    Where several rows share that id, the one whose text has the smallest hash
    stays; where they share the text too, any one of them.
    """
    prints = _prints(docs, doc_id, text)
    named = prints.join(components_of(prints, radius), "fingerprint").where(
        F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
    first = F.min_by(F.struct("doc_id"), "key")
    chosen = written(
        named.groupBy("root").agg(F.min("key").alias("key"), first.alias("row")), "kept"
    )
    return kept_rows(docs, chosen, doc_id, text)


def kept_rows(docs: DataFrame, chosen: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` names by ``row.doc_id`` and ``key``, each once.

    Repeated rows are looked for in every table, whether or not it has any.
    """
    id_as, key_as = unused(docs.columns, "kept_id"), unused(docs.columns, "kept_key")
    wanted = chosen.select(F.col("row.doc_id").alias(id_as), F.col("key").alias(key_as))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(id_as))
    kept = docs.join(wanted, same & (text_key(F.col(f"`{text}`")) == F.col(key_as)), "left_semi")
    return kept.dropDuplicates([doc_id, text])
