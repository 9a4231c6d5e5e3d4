"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.runs import bound
from wordloom.llm import (
    decontamination,
    licenses,
    line_dedup,
    mixing,
    neighbours,
    periodic,
    phrases,
    quality,
    sharding,
    simhash,
    token_store,
    toxicity,
    warc,
)
from wordloom.llm.texts import SPACED_WORD
from wordloom.sources.scratch import scratch_path
from wordloom.sources.tables import read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", *columns)


def decontamination_report(spark, folder):
    found = decontamination.report(
        _table(spark, folder, "documents", "doc_id", "text"),
        _table(spark, folder, "benchmark", "item_id", "text"),
    )
    names = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def token_files(spark, folder):
    """Writes a store when called, as a round trip through files must; the rows come from it."""
    store = scratch_path(spark, "tokens")
    token_store.write_store(_table(spark, folder, "documents", "doc_id", "text"), store, TOKENIZER)
    index = token_store.read_index(spark, store)
    return token_store.checksums(token_store.read_ids(spark, store, index))


def mixed_sources(spark, folder):
    found = mixing.report(_table(spark, folder, "documents", "doc_id", "text", "source"))
    taken = (F.col("copies") * F.col("size")).cast("bigint")
    return found.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def quality_verdicts(spark, folder):
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality.judge(_table(spark, folder, "documents", "doc_id", "text"), measures=measures)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *measures, failed.alias("base_failed"), "kept")


def simhash_components(spark, folder):
    found = simhash.near_duplicates(_table(spark, folder, "documents", "doc_id", "text"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def deduplicated_lines(spark, folder):
    found = line_dedup.dedup_lines(_table(spark, folder, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def warc_round_trip(spark, folder):
    """Writes an archive when called, as a round trip through files must; the rows come from it."""
    pages = _table(spark, folder, "pages", "page_id", "url", "html")
    files = warc.write_warc(pages, scratch_path(spark, "warc"))
    return warc.read_warc(files, payloads=False).select(
        warc.page_of("record_id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").cast("bigint").alias("refers_to"),
    )


def sharded(spark, folder):
    docs = _table(spark, folder, "documents", "doc_id", "text").select(
        "doc_id",
        "text",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    # The text is only needed for its hash, which orders rows of one id.
    narrow = docs.withColumn("text", F.xxhash64("text"))
    placed = sharding.shard_rows(narrow)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def license_scan(spark, folder):
    docs = _table(spark, folder, "documents", "doc_id", "text")
    known = licenses.known(spark)
    whole = licenses.scan(docs, known).select(
        "doc_id", F.xxhash64("text").alias("text_key"), "canonical_sha256", "license"
    )
    lines = licenses.notices(docs, known).withColumnRenamed("doc_id", "line_id")
    same = F.col("doc_id").eqNullSafe(F.col("line_id")) & (whole["text_key"] == lines["text_key"])
    return whole.join(lines, same, "left").select(
        "doc_id",
        "canonical_sha256",
        "license",
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_notice_lines"),
        F.coalesce(F.array_join("licenses", ","), F.lit("")).alias("notices"),
    )


def toxicity_scores(spark, folder):
    docs = _table(spark, folder, "documents", "doc_id", "text")
    model = toxicity.train(docs, _table(spark, folder, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def _with_planted_runs(docs):
    """``(doc_id, text)``; by the hash of its id, a tenth of the documents repeats a part to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeated(words):
        n = F.size(words).cast("bigint")
        g = F.expr("h div 10")
        a = g % n
        p = 1 + F.call_function("div", n - a, 3 + g % 8)
        found = F.transform(
            F.sequence(F.lit(0), F.size(words) - 1),
            lambda i: F.get(words, F.when(i < a, i).otherwise((a + (i - a) % p).cast("int"))),
        )
        return F.when(n > 0, F.array_join(found, " "))

    words = F.regexp_extract_all("text", F.lit(SPACED_WORD), 0)
    return docs.withColumn("h", h).select(
        "doc_id", F.when(F.col("h") % 10 == 0, bound(words, repeated)).otherwise(F.col("text")).alias("text")
    )


def periodic_runs(spark, folder):
    found = periodic.with_runs(_with_planted_runs(_table(spark, folder, "documents", "doc_id", "text")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = found.withColumn("best", periodic.strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def nearest_vectors(spark, folder):
    vectors = _table(spark, folder, "embeddings", "vec_id", "embedding")
    return neighbours.nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def phrase_collocations(spark, folder):
    return phrases.collocations(_table(spark, folder, "documents", "text", "lang"))


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": decontamination_report,
        "op2_token_files": token_files,
        "op3_line_dedup": deduplicated_lines,
        "op4_mixing": mixed_sources,
        "op5_quality_rules": quality_verdicts,
        "op6_toxicity": toxicity_scores,
        "op7_simhash": simhash_components,
        "op8_license_scan": license_scan,
        "op9_warc": warc_round_trip,
        "op10_sharding": sharded,
        "op11_periodic_runs": periodic_runs,
        "op12_nearest_vectors": nearest_vectors,
        "op13_phrase_collocations": phrase_collocations,
    }
