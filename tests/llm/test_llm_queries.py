"""The registered queries over a whole small folder, against SQL or plain Python."""

import zlib

import corpus_pipeline
import llm_brute as brute
import pytest
from compare import database
from llm_rows import rows, sql_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordloom.llm import catalog, oracle, sharding, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.fixture(scope="module")
def docs(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return [(r.doc_id, r.text, r.source) for r in table.orderBy("doc_id").collect()]


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_query_equals_sql(spark, con, name):
    df = catalog.queries()[name](spark, FOLDER)
    assert rows(df) == sql_rows(con, oracle.oracle_sql()[name], df.columns)


def test_token_files(spark, docs):
    found = catalog.token_files(spark, FOLDER)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    tokenizer = Tokenizer.from_file(catalog.TOKENIZER)
    assert sorted(map(tuple, found.collect())) == brute.packed([d[:2] for d in docs], tokenizer)


def test_simhash(spark, docs):
    prints = [brute.fingerprint(text) for _, text, _ in docs]
    expected = {
        d[0]: (f"{p:016x}", docs[g][0]) for d, p, g in zip(docs, prints, brute.groups(prints))
    }
    found = catalog.simhash_components(spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == expected
    assert len(found) == len(docs)


def test_sharding(spark, docs):
    found = catalog.sharded(spark, FOLDER)
    assert found.where("law <> 'rows' or grown_shard is not null").isEmpty()
    half, keys = 16, sharding.round_keys("shards")
    assert half * half >= len(docs) > (half // 2) ** 2

    def place(v):
        while True:
            left, right = divmod(v, half)
            for a, b, c in keys:
                mixed = (right * a + b) % sharding.PRIME
                left, right = right, left ^ (mixed * mixed + c) % sharding.PRIME % half
            v = left * half + right
            if v < len(docs):
                return v % 8, v // 8

    expected = [
        (d[0], len(d[1].encode()) + 1, zlib.crc32(d[1].encode()), *place(i))
        for i, d in enumerate(docs)
    ]
    got = found.select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert sorted(map(tuple, got)) == expected
    slots = {}
    for _, _, _, shard, slot in expected:
        slots.setdefault(shard, []).append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_toxicity(spark):
    found = catalog.toxicity_scores(spark, FOLDER)
    scored = found.collect()
    assert len(scored) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_toxicity_of_held_out_rows(spark):
    """The labelled documents of a larger folder, a few hundred of them held out."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi").repartition(8)
    model = toxicity.train(docs, labels.select("doc_id", "toxic"))
    held = docs.where(toxicity.held_out(F.col("doc_id"))).join(labels, "doc_id")
    found = toxicity.score(held.select("text", "toxic"), model).collect()
    toxic = [r.score for r in found if r.toxic == 1]
    clean = [r.score for r in found if r.toxic == 0]
    wins = sum((a > b) + (a == b) / 2 for a in toxic for b in clean)
    assert wins / (len(toxic) * len(clean)) > 0.92
    right = sum(x >= 0.5 for x in toxic) + sum(x < 0.5 for x in clean)
    assert right / len(found) > 0.92


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "toxic")
    flipped = F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    one = toxicity.train(docs, labels)
    other = toxicity.train(docs, labels.withColumn("toxic", flipped))
    assert (one.grams, one.shared, one.curve) == (other.grams, other.shared, other.curve)


def test_pipeline(spark, docs):
    """Each stage on its own input, and the last rows of all stages."""
    found = brute.windows(
        [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    )
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id")
    kept = [tuple(r) for r in table.collect() if brute.good(r.text)]
    expected = [kept]
    kept = [r for i, (r, g) in enumerate(zip(kept, brute.near_groups([r[1] for r in kept]))) if i == g]
    expected.append(kept)
    cut = [(r[0], brute.decontaminated(r[1], found), *r[2:]) for r in kept]
    kept = [r for r in cut if r[1] is not None]
    expected.append(kept)
    at = table.columns.index("source")
    copies = brute.mixed([(r[0], r[1], r[at]) for r in kept])
    kept = [r for r, n in zip(kept, copies) for _ in range(n)]
    expected.append(kept)
    stage_docs = table
    for (name, stage), wanted in zip(corpus_pipeline.STAGES, expected):
        stage_docs = stage(spark, stage_docs, FOLDER)
        assert stage_docs.columns == table.columns, name
        assert sorted(map(tuple, stage_docs.collect())) == sorted(wanted), name
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    result = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, result.collect())) == brute.packed([r[:2] for r in kept], tokenizer)
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_of_odd_and_empty_tables(spark, tmp_path):
    """All stages as a chain: nulls, empty and long texts, repeated rows, columns of clashing names."""
    clean = " ".join(f"alpha{i}" for i in range(200))
    passage = " ".join(f"q{i}" for i in range(14))
    rows = [
        (3, clean, "en", "a", 1, "x", 7),
        (3, clean, "en", "a", 1, "x", 7),
        (1, clean.upper(), None, None, 1, None, 7),
        (None, clean.replace("alpha", "beta"), "en", "b", 1, "x", None),
        (4, clean.replace("alpha", "gamma") + " " + passage, "en", "b", 1, "x", 7),
        (5, None, "en", "b", 1, "x", 7),
        (6, "", "en", "b", 1, "x", 7),
        (7, "too short", "en", "b", 1, "x", 7),
        (8, " ".join(f"w{i}x" for i in range(30_000)), "en", "c", 1, "x", 7),
    ]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint, hit string, key int"
    folder = str(tmp_path / "odd")
    docs = spark.createDataFrame(rows, names)
    docs.write.parquet(f"{folder}/documents.parquet")
    items = spark.createDataFrame([(1, passage), (None, None), (2, "")], "item_id bigint, text string")
    items.write.parquet(f"{folder}/benchmark.parquet")
    table = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, folder)
        assert table.columns == docs.columns, name
        kept[name] = [tuple(r) for r in table.collect()]
    ids = {name: sorted((r[0] is None, r[0] or 0) for r in found) for name, found in kept.items()}
    assert [i for _, i in ids["quality rules"] if i] == [1, 3, 3, 4, 8]
    assert [i for _, i in ids["near duplicates"] if i] == [1, 4, 8]
    texts = {r[0]: r[1] for r in kept["decontamination"]}
    assert texts[1] == rows[2][1] and "q3" not in texts[4] and texts[4].startswith("gamma0 gamma1 ")
    last = corpus_pipeline.run(spark, folder).collect()
    assert len(last) == len(kept["mixing"]) and {r.doc_id for r in last} == {r[0] for r in kept["mixing"]}
    for label, empty in (("none", docs.limit(0)), ("short", docs.where("doc_id > 4 and doc_id < 8"))):
        folder = str(tmp_path / label)
        empty.write.parquet(f"{folder}/documents.parquet")
        items.write.parquet(f"{folder}/benchmark.parquet")
        assert corpus_pipeline.run(spark, folder).collect() == []
