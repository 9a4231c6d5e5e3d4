"""Nulls, empty tables, repeated rows, ties, long texts and clashing column names."""

import random
import zlib

import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordloom.llm import (
    catalog,
    components,
    decontamination,
    licenses,
    line_dedup,
    mixing,
    quality,
    sharding,
    simhash,
    spans,
    token_store,
    toxicity,
    warc,
)
from wordloom.llm.storage import listed, opened
from wordloom.sources.scratch import scratch_path

CLEAN = " ".join(f"word{i} of plain text." for i in range(40))
SCHEMA = "doc_id bigint, text string, source string, hit string, plan int, kept string, key int"
ROWS = [
    (1, CLEAN, "a", "x", 1, "k", 5),
    (1, CLEAN, "a", "x", 1, "k", 5),
    (1, CLEAN + " more", None, "x", None, "k", 5),
    (None, CLEAN.upper(), "a", None, 2, None, None),
    (2, None, "b", "x", 3, "k", 1),
    (3, "", None, "x", 3, "k", 2),
    (4, "one two\nthree\n\none two\nthree\n\n", "b", "x", 3, "k", 3),
    (5, "é" * 200_000, "b", "y", 4, "k", 4),
    (6, " ".join(random.Random(1).choices("abcdefghij", k=60_000)), "c", "y", 4, "k", 4),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "plain text word3 of plain text word4 of plain text word5"), (2, "One, TWO!")]
    return spark.createDataFrame(
        [*rows, (None, "three"), (3, ""), (4, None), (2, "one two")], "item_id bigint, text string"
    )


def plain(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_decontamination_of_odd_rows(spark, docs, empty, benchmark):
    found = brute.windows([tuple(r) for r in benchmark.collect()])
    expected = [(r[0], brute.decontaminated(r[1], found), *r[2:]) if r[1] else r for r in ROWS]
    expected = [r for r, was in zip(expected, ROWS) if r[1] is not None or not was[1]]
    assert plain(decontamination.decontaminate(docs, benchmark)) == sorted(map(repr, expected))
    got = decontamination.report(docs, benchmark).collect()
    assert len(got) == len(ROWS)
    hits = sorted((len(c), sorted(i)) for _, c, i in (brute.hits(r[1], found) for r in ROWS))
    assert sorted((r.n_hit, sorted(r["items"])) for r in got) == hits
    assert decontamination.decontaminate(empty, benchmark).count() == 0
    assert plain(decontamination.decontaminate(docs, benchmark.limit(0))) == plain(docs)
    every = decontamination.decontaminate(docs, benchmark, drop_share=0)
    assert every.count() == sum(not brute.hits(r[1], found)[1] for r in ROWS)


def test_a_benchmark_too_large_to_broadcast_gives_the_same(docs, benchmark):
    small = decontamination.report(docs, benchmark)
    large = decontamination.report(docs, benchmark, max_broadcast=0)
    assert plain(small) == plain(large)
    windows, _ = decontamination.benchmark_windows(benchmark)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_hash" in plan(decontamination.hits(docs, windows))
    # What is sent to the tasks holds no items, whose number a window does not bound.
    assert "item" not in plan(decontamination.hits(docs, windows))


def test_a_window_of_very_many_items(spark):
    shared = " ".join(f"w{i}" for i in range(12))
    benchmark = spark.createDataFrame([(i, shared) for i in range(3000)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"a b {shared} c"), (2, "none")], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_hit, len(r["items"])) for r in decontamination.report(docs, benchmark).collect()}
    assert got == {1: (12, 3000), 2: (0, 0)}


def test_hits_are_compared_word_by_word(docs, benchmark):
    windows, _ = decontamination.benchmark_windows(benchmark)
    forged = windows.withColumn("gram", F.array(F.lit("other")))
    assert decontamination.hits(docs, forged).count() == 0
    assert decontamination.hits(docs, windows).count() > 0


def test_spans_are_merged(spark):
    rows = [(None, 5, 9), (None, 5, 9), (None, 9, 10), (None, 0, 2), (1, 3, 4), (None, 6, 7)]
    table = spark.createDataFrame(rows, "k int, start int, stop int")
    got = {r.k: ([tuple(s) for s in r.spans], r.covered) for r in spans.merged(table, ["k"]).collect()}
    assert got == {None: ([(0, 2), (5, 10)], 7), 1: ([(3, 4)], 1)}


def test_many_equal_rows_have_equal_spans(spark):
    rows = [(1, s, s + 2, w) for s in (0, 1, 7) for w in (5, 6)] * 50
    table = spark.createDataFrame(rows, "k int, start int, stop int, w int")
    found = spans.merged(table, ["k"], union="w").first()
    assert ([tuple(s) for s in found.spans], found.covered, sorted(found.w)) == ([(0, 3), (7, 9)], 5, [5, 6])


def test_no_text_is_taken_behind_the_last_epoch(spark):
    """A small source that is cut off at three epochs, empty texts among its rows, and a large one."""
    rows = [(0, "one two three four five six seven eight nine ten", "a")]
    rows += [(i, "" if i % 2 else None, "a") for i in range(1, 30)]
    rows += [(100 + i, "word " * 500, "b") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    copies = {r.doc_id: r.copies for r in mixing.report(docs).collect()}
    assert [copies[i] for i in range(30)] == [3] * 30
    expected = brute.mixed(rows)
    assert [copies[r[0]] for r in rows] == expected
    assert mixing.mix(docs).count() == sum(expected)


def test_token_store_of_odd_rows(spark, docs, empty):
    store = scratch_path(spark, "tokens")
    token_store.write_store(docs, store, catalog.TOKENIZER, shards=3)
    index = token_store.read_index(spark, store)
    assert index.select("shard").distinct().count() > 1
    got = token_store.checksums(token_store.read_ids(spark, store, index)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 1, 1, 2, 3, 4, 5, 6]
    tokenizer = Tokenizer.from_file(catalog.TOKENIZER)
    alone = sorted(brute.packed([r[:2]], tokenizer)[0][2:] for r in ROWS)
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == alone
    for one, other in zip(got, got[1:]):
        assert one.start + one.n_tokens == other.start
    # One short document alone, through the index.
    four = token_store.read_ids(spark, store, index.where("doc_id = 4")).first()
    ids = tokenizer.encode(ROWS[6][1], add_special_tokens=False).ids + [1]
    assert np.frombuffer(four.ids, "<u4").tolist() == ids
    store = scratch_path(spark, "tokens")
    token_store.write_store(empty, store, catalog.TOKENIZER)
    index = token_store.read_index(spark, store)
    assert token_store.read_ids(spark, store, index).count() == 0


def test_a_store_is_not_read_with_another_dictionary(spark, docs):
    stores = [scratch_path(spark, "tokens") for _ in range(2)]
    many = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("many words "), F.col("id")).alias("text")
    )
    token_store.write_store(docs, stores[0], catalog.TOKENIZER)
    token_store.write_store(many, stores[1], catalog.TOKENIZER)
    index = token_store.read_index(spark, stores[0])
    other = spark.read.parquet(f"{stores[1]}/dictionary")
    assert other.first()["sha256"] != spark.read.parquet(f"{stores[0]}/dictionary").first()["sha256"]
    other.write.mode("overwrite").parquet(f"{stores[0]}/dictionary")
    with pytest.raises(Exception, match="not written with this dictionary"):
        token_store.read_ids(spark, stores[0], index).count()


@pytest.mark.parametrize("by_piece", [True, False])
def test_pieces_give_the_ids_of_whole_texts(by_piece):
    encoder = token_store.Encoder(catalog.TOKENIZER)
    assert encoder.by_piece and encoder.plain
    encoder.by_piece = by_piece
    rng = random.Random(3)
    parts = list("aAbBéÉßİıſ'’ \t\n\x0b\x0c\r\x1c\x85  　̱́ςΣσ1٣²|<>._-$漢字ﾞ한👍🏽‍\x00")
    parts += ["<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'ll", "  ", "word,", "Word.", "longer words "]
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(800)]
    for some in (texts, texts[::-1]):
        for text, ids in zip(some, encoder.encode(some)):
            whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == whole, repr(text)


def test_a_tokenizer_that_reads_spaces_gets_whole_texts():
    import public_tokenizers

    encoder = token_store.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not encoder.by_piece
    text = "two  words\n here"
    ids = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
    assert ids == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_cache_keeps_giving_the_same_ids(monkeypatch):
    monkeypatch.setattr(token_store, "CACHED_PIECES", 5)
    monkeypatch.setattr(token_store, "CACHED_LENGTH", 6)
    encoder = token_store.Encoder(catalog.TOKENIZER)
    rng = random.Random(2)
    for _ in range(60):
        texts = [" ".join(rng.choices(["a", "bb", "ccc,", "dé", "eeeeeeeee", "Ff.", "g-h"], k=5))]
        whole = encoder.tokenizer.encode(texts[0], add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(texts)[0], "<u4").tolist() == whole
        assert len(encoder.known) <= 5 + 7


def test_line_dedup_of_odd_rows(spark, docs, empty):
    rows = [
        (1, "p\nq\nr\ns"),
        (2, "x\nq\nr\ns\ny"),
        (2, "x\nq\nr\ns\ny"),
        (3, "p\nq"),
        (4, "p\nq"),
        (None, "q\nr\ns"),
        (5, "a\na\na\na\na"),
        (6, "\n\n\n\n"),
        (7, "\n\n\n\n"),
        (8, None),
        (9, ""),
    ]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted(map(tuple, line_dedup.dedup_lines(table).collect()), key=repr)
    # The row without an id comes first, so it keeps the passage.
    expected = [
        (1, "p", 4, 3),
        (2, "x\ny", 5, 3),
        (2, "x\ny", 5, 3),
        (3, "p\nq", 2, 0),
        (4, "", 2, 2),
        (None, "q\nr\ns", 3, 0),
        (5, "a\na\na", 5, 2),
        (6, "\n\n\n\n", 5, 0),
        (7, "\n\n\n\n", 5, 0),
        (8, None, 0, 0),
        (9, "", 1, 0),
    ]
    assert got == sorted(expected, key=repr)
    assert line_dedup.dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_removed"]
    assert line_dedup.dedup_lines(docs).count() == len(ROWS)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_mixing_of_odd_rows(spark, docs, empty):
    copies = brute.mixed([r[:3] for r in ROWS])
    expected = [r for r, n in zip(ROWS, copies) for _ in range(n)]
    assert plain(mixing.mix(docs)) == sorted(map(repr, expected))
    got = mixing.report(docs).collect()
    assert sorted((r.doc_id or -1, r.size, r.copies) for r in got) == sorted(
        (r[0] or -1, len((r[1] or "").split()), n) for r, n in zip(ROWS, copies)
    )
    assert mixing.mix(empty).count() == 0
    assert mixing.report(docs.withColumn("text", F.lit(""))).where("copies > 0").isEmpty()


def test_targets_share_out_the_excess(spark):
    rng = random.Random(4)
    for _ in range(8):
        sizes = {s: rng.choice([0, 1, 5, 40, 1000, 10**6]) for s in ["a", "B", "é", "zz", "", None]}
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r.source: r.target for r in mixing.targets(table).collect()}
        expected = brute.shares(sizes)
        assert got.keys() == expected.keys()
        assert all(abs(got[s] - expected[s]) < 1e-6 * max(1, expected[s]) for s in got)
        assert all(got[s] <= 3 * sizes[s] for s in got)


def test_taken_words_come_near_the_targets(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice("aaab")) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    got = mixing.report(table)
    sums = got.groupBy("target", "source_size").agg(F.sum(F.col("copies") * F.col("size")).alias("t"))
    for r in sums.collect():
        assert abs(r.t - r.target) <= 60
    assert got.agg(F.max("copies")).first()[0] <= 3


def test_quality_of_odd_rows(docs, empty):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = quality.judge(docs, measures=names).collect()
    expected = []
    for row in ROWS:
        m = brute.measures(row[1])
        # The table's column of the verdict's name is replaced.
        expected.append((*row[:5], row[6], *(m[n] for n in names), brute.good(row[1])))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert plain(quality.keep_good(docs)) == sorted(repr(r) for r in ROWS if brute.good(r[1]))
    assert quality.keep_good(empty).count() == 0


def test_order_of_rules_changes_the_cost_only(docs):
    rules = quality.RULES
    measured = [
        quality.Measured("few_words", 1.0, 1),
        quality.Measured("symbols", 0.1, 5),
        quality.Measured("word_length", 1.0, 0),
    ]
    ordered = quality.in_cascade_order(rules, measured)
    assert [r.name for r in ordered[:2]] == ["symbols", "few_words"]
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)
    assert plain(quality.keep_good(docs, rules)) == plain(quality.keep_good(docs, rules[::-1]))
    found = quality.measure_rules(docs, rules, rows=4)
    assert [m.rule for m in found] == [r.name for r in rules]
    calls = []
    first = quality.Rule("first", lambda t: True)
    second = quality.Rule("second", lambda t: calls.append(t) or False)
    text = quality.Text("x")
    assert any(rule.rejects(text) for rule in (first, second)) and not calls


def test_simhash_of_odd_rows(docs, empty):
    prints = [brute.fingerprint(r[1]) for r in ROWS]
    names = [None if r[0] is None else r[0] for r in ROWS]
    members = {}
    for root, name in zip(brute.groups(prints), names):
        members.setdefault(root, []).append(name)
    least = [
        min((n for n in members[g] if n is not None), default=None) for g in brute.groups(prints)
    ]
    got = simhash.near_duplicates(docs).collect()
    expected = [(n, p - (p >> 63 << 64), c) for n, p, c in zip(names, prints, least)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(members)
    assert simhash.keep_one(empty).count() == simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_some_table_keeps_no_differing_bit(radius):
    import itertools

    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in itertools.combinations(range(64), radius):
        differ = sum(1 << b for b in bits)
        assert any(mask & differ == 0 for mask in masks)


@pytest.mark.parametrize("small_bucket", [1, 16, 10**6])
def test_no_link_is_lost_in_crowded_buckets(spark, small_bucket):
    rng = random.Random(1)
    values = set()
    for base in [rng.getrandbits(64) for _ in range(3)]:
        values.add(base)
        for _ in range(80):
            near = base
            for _ in range(rng.choice([1, 2, 3])):
                near ^= 1 << rng.randrange(64)
            values.add(near)
    values = sorted(v - (v >> 63 << 64) for v in values)
    table = spark.createDataFrame([(v,) for v in values], "value bigint")
    found = simhash.links(table, 2, small_bucket)
    mask = (1 << 64) - 1
    assert all(((r.u ^ r.v) & mask).bit_count() <= 2 for r in found.collect())
    roots = {v: v for v in values}
    roots |= {r.node: r.root for r in components.components(found).collect()}
    expected = brute.groups([v & mask for v in values])
    assert [roots[v] for v in values] == [values[g] for g in expected]


def test_components_of_a_chain_and_of_nothing(spark):
    n = 200
    chain = [(i, i + 1) for i in range(n)] + [(5, 5), (1, 0), (900, 901), (902, 901)]
    table = spark.createDataFrame(chain, "u bigint, v bigint").repartition(3)
    got = {r.node: r.root for r in components.components(table).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 901: 900, 902: 900}
    assert components.components(table.limit(0)).count() == 0


def test_licenses_of_odd_rows(spark, docs, empty):
    mit = dict(licenses.LICENSES[::-1])["MIT"]
    text = f"Copyright (c) 2020 Some One\n\n{mit.lower()}".replace("sublicense", "sub-licence")
    rows = [
        (1, text.replace("\n", "\r\n   ")),
        (1, text),
        (2, f"{mit} and more"),
        (3, None),
        (None, "© 1999 X\nRELEASED under the MIT Licence\nlicensed under the MIT license"),
        (4, " -- "),
    ]
    table = spark.createDataFrame(rows, "license int, text string").repartition(2)
    known = licenses.known(spark)
    got = licenses.scan(table, known, license_as="found").collect()
    assert [r.license for r in got if r.found == "MIT"] == [1, 1]
    assert sum(r.found is not None for r in got) == 2
    lines = licenses.notices(table.withColumnRenamed("license", "doc_id"), known).collect()
    assert [(r.doc_id, r.n_lines, r.licenses) for r in lines] == [(None, 2, ["MIT"])]
    assert licenses.scan(docs, known).count() == len(ROWS)
    assert licenses.scan(empty, known).count() == 0
    assert licenses.scan(table, known.limit(0)).where("license is null").count() == len(rows)


def _pages(spark):
    big = "<p>" + "é" * 600
    rows = [
        (1, "http://a/ b\r\nX: y", big),
        (2, None, big),
        (9, "http://c/ü", big),
        (9, "http://d", big),
        (None, "http://e", big),
        (3, "http://f", "small"),
        (4, "http://g", "small"),
        (5, "http://h", None),
        (6, "http://i", "WARC/1.1\r\n\r\n\x1f\x8b" + "".join(chr(i) for i in range(1, 3000))),
        (7, "http://j", "x" * 3_000_000),
    ]
    return rows, spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


@pytest.mark.parametrize("split, file_bytes", [(97, 1 << 30), (5000, 1), (1 << 20, 3000)])
def test_archives_are_read_whole_in_any_splits(spark, split, file_bytes):
    import hashlib

    rows, pages = _pages(spark)
    folder = scratch_path(spark, "warc")
    manifest = warc.write_warc(pages, folder, file_bytes=file_bytes)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    got = warc.read_warc(manifest, split_bytes=split).collect()
    assert len(got) == len(rows)
    for r in got:
        name = r.record_id.removeprefix("<urn:page:").removesuffix(">")
        html = next(h or "" for i, _, h in rows if name == ("" if i is None else str(i)))
        assert r.payload_bytes == len(html.encode())
        assert r.payload_digest == hashlib.sha1(html.encode()).hexdigest()
        revisit = name in ("1", "2", "")
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to == ("<urn:page:9>" if revisit else None)
        assert r.payload == (None if revisit else html.encode())
        assert "\n" not in (r.target_uri or "")
    files = listed(spark, f"{folder}/data", "*.warc.gz")
    assert warc.read_warc(files, split_bytes=10**6, payloads=False).count() == len(rows)


def test_a_member_is_plain_gzip_and_no_pages_make_no_files(spark):
    import gzip

    _, pages = _pages(spark)
    manifest = warc.write_warc(pages, scratch_path(spark, "warc"))
    path = manifest.first()["path"]
    store, name = opened(path)
    with store.open_input_file(name) as file:
        assert gzip.decompress(file.read()).startswith(b"WARC/1.1\r\n")
    none = warc.write_warc(pages.limit(0), scratch_path(spark, "warc"))
    assert none.count() == warc.read_warc(none).count() == 0


def test_shards_of_odd_rows(docs, empty):
    got = sharding.shard_rows(docs, 4, shard_as="shard", slot_as="slot")
    assert got.columns == [*docs.columns, "shard", "slot"]
    places = sorted((r.shard, r.slot) for r in got.collect())
    assert places == sorted((p % 4, p // 4) for p in range(len(ROWS)))
    assert plain(got) == plain(sharding.shard_rows(docs.repartition(7), 4))
    assert sharding.shard_rows(empty).count() == 0


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 63, 64, 65, 1000])
def test_permutations(rows):
    numbers = np.arange(rows)
    found = sharding.permuted(numbers, rows)
    assert sorted(found.tolist()) == numbers.tolist()
    assert sharding.permuted(found, rows, inverse=True).tolist() == numbers.tolist()
    assert rows < 10 or found.tolist() != sharding.permuted(numbers, rows, "other").tolist()


def test_toxicity_of_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (None, 1), (2, None), (3, 0), (4, 7), (77, 1), (6, 0)],
        "doc_id bigint, toxic int",
    )
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    scores = toxicity.score(docs, model).collect()
    assert len(scores) == len(ROWS) and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.score(empty, model).count() == 0
    for some in (labels.limit(0), labels.where("toxic = 0")):
        bare = toxicity.train(docs.select("doc_id", "text"), some)
        same = {r.score for r in toxicity.score(docs, bare).collect()}
        assert len(same) == 1
        assert same == {0.5} if some.isEmpty() else max(same) < 0.5
    toxicity.train(empty.select("doc_id", "text"), labels)
    odd = docs.select("doc_id", "text", F.lit("x").alias("toxic"), F.lit(1).alias("fold"), F.lit(2).alias("n"))
    more = labels.select("doc_id", "toxic", F.lit("y").alias("text"), F.lit("z").alias("word"))
    again = toxicity.train(odd, more)
    assert (again.grams, again.shared, again.curve) == (model.grams, model.shared, model.curve)
    assert toxicity.score(odd, again).columns == [*odd.columns, "score"]
    # No row fits into the bytes: nothing is learned from, and every text scores alike.
    assert len({r.score for r in toxicity.score(docs, toxicity.train(docs, labels, sample_bytes=0)).collect()}) == 1


def test_toxicity_equals_the_definitions(spark):
    rng = random.Random(5)
    letters = "abcé"
    word = lambda: "".join(rng.choices(letters, k=rng.randrange(1, 9)))
    bad = [word() for _ in range(6)]
    rows, marks = [], []
    for i in range(60):
        words = [word() for _ in range(rng.randrange(0, 20))]
        toxic = i % 3 == 0
        words += rng.choices(bad, k=4) if toxic else []
        rng.shuffle(words)
        rows.append((i, rng.choice([" ", "\n", "-- "]).join(words).upper()))
        marks.append((i, int(toxic)))
    rows += [(100, "OTHER words, 12 x9"), (101, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    split = lambda text: brute.WORD.findall(brute.ascii_lower(text))
    sides, corpus = ([], []), [w for _, text in rows for w in split(text)]
    for (i, text), (_, toxic) in zip(rows, marks):
        checksum = zlib.crc32(str(i).encode())
        if checksum % 5 and checksum // 5 % 4:
            sides[toxic].extend(split(text))
    exact = brute.KneserNey(*sides, corpus)
    for r in toxicity.measure(docs, model).collect():
        assert r.measure == pytest.approx(exact.difference(split(r.text)), abs=1e-9)
