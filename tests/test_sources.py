import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wordloom.operators import counts, stripes
from wordloom.plans import catalog
from wordloom.sources import scratch, tables
from wordloom.sources.lines import lines_of, read_lines
from wordloom.sources.series import read_two_series
from wordloom.sources.tables import read_table
from wordloom.sources.tsv import read_counts, read_stripes, write_tsv


def part_files(path):
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    found = []
    for name in names:
        with open(os.path.join(path, name), encoding="utf-8", newline="") as file:
            found.append(file.read().split("\n"))
    assert all(rows[-1] == "" for rows in found)
    return [rows[:-1] for rows in found]


TEXTS = [
    ("", []),
    ("a", ["a"]),
    ("a\n", ["a"]),
    ("a\n\n", ["a", ""]),
    ("\n", [""]),
    ("a\r\nb\rc\nd", ["a", "b", "c", "d"]),
    ("a\n\rb", ["a", "", "b"]),
    ("\r\n\r\n", ["", ""]),
    (None, []),
]


@pytest.mark.parametrize("text, expected", TEXTS)
def test_lines_of_a_text(frame, text, expected):
    rows = lines_of(frame([text], "text"), "text", "id").orderBy("line_no").collect()
    assert [r.line for r in rows] == expected
    assert [r.line_no for r in rows] == list(range(len(expected)))


def test_text_column_and_text_file_give_the_same_lines(spark, tmp_path):
    for i, (text, expected) in enumerate(TEXTS):
        if text is not None:
            path = tmp_path / f"{i}.txt"
            path.write_bytes(text.encode())
            rows = read_lines(spark, str(path)).collect()
            assert [r.line for r in rows] == expected, repr(text)


def test_many_small_files_share_read_tasks(spark, tmp_path):
    for i in range(250):
        (tmp_path / f"{i:03}.txt").write_text(f"common word{i}\nsecond line\n")
    lines = read_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() <= 25
    got = {r.word: r.n for r in counts.word_counts(lines).collect()}
    assert got["common"] == got["second"] == 250
    assert len(got) == 253


def test_read_lines_takes_several_paths(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).write_text(name)
    paths = [str(tmp_path / name) for name in "ab"]
    assert {r.line for r in read_lines(spark, paths).collect()} == {"a", "b"}


def test_scan_reads_only_named_columns_and_is_dealt_out_when_asked(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    scan = read_table(spark, path, "text")
    assert scan.columns == ["text"]
    assert "Exchange" not in scan._jdf.queryExecution().executedPlan().toString()
    dealt = read_table(spark, path, "text", partitions=3)
    assert dealt.rdd.getNumPartitions() == 3
    assert dealt.count() == scan.count()


@pytest.mark.parametrize("files", [None, 1, 2, 5])
def test_tsv_is_sorted_by_key_bytes_and_complete(spark, frame, tmp_path, files):
    words = ["b", "a", "é", "z", "a'b", "a-b", "a1", "ab", "ﬀ", "𐐨", "b", "ü"] * 20
    table = counts.word_counts(frame([" ".join(words)]))
    path = str(tmp_path / "out")
    write_tsv(table, path, "word", "n", files=files)
    parts = part_files(path)
    if files is not None:
        assert min(files, 2) <= len(parts) <= files
    for rows in parts:
        keys = [r.split("\t")[0].encode() for r in rows]
        assert keys == sorted(keys)
    expected = {(r.word, r.n) for r in table.collect()}
    written = [tuple(r.split("\t")) for rows in parts for r in rows]
    assert {(w, int(n)) for w, n in written} == expected
    assert len(written) == len(expected)
    assert {tuple(r) for r in read_counts(spark, path).collect()} == expected


def test_existing_output_is_never_overwritten(frame, tmp_path):
    table = counts.word_counts(frame(["a"]))
    write_tsv(table, str(tmp_path / "out"), "word", "n")
    with pytest.raises(PySparkException):
        write_tsv(table, str(tmp_path / "out"), "word", "n")


@pytest.mark.parametrize("files", [0, -1, 1.5, True])
def test_number_of_files_is_checked(frame, tmp_path, files):
    with pytest.raises(ValueError):
        write_tsv(counts.word_counts(frame(["a"])), str(tmp_path / "o"), "word", "n", files=files)


def test_stripes_round_trip(spark, frame, tmp_path):
    table = stripes.stripe_texts(counts.head_tail_counts(frame(["a b a c", "b a b"]), 2), 4)
    path = str(tmp_path / "out")
    write_tsv(table, path, "head", "part", "stripe", files=2)
    got = {tuple(r) for r in read_stripes(spark, path).collect()}
    assert got == {(r.head, r.part, r.stripe) for r in table.collect()}
    assert max(part for _, part, _ in got) > 0


def test_count_table_with_bad_lines(spark, tmp_path):
    (tmp_path / "t").write_text(
        "a\t1\nb\t x\n\nonly\nc\td\te\n  f\t 7 \ng\t\nh\t+5\ni\t1.5\n\tj\t2\n"
    )
    got = {tuple(r) for r in read_counts(spark, str(tmp_path / "t")).collect()}
    assert got == {("a", 1), ("b", None), ("f", 7), ("h", 5), ("i", None), ("j", 2)}


def series(spark, path):
    found = {}
    for r in read_two_series(spark, str(path), ("map", "reduce")).orderBy("place").collect():
        found.setdefault((os.path.basename(r.file), r.series), []).append(r.value)
    return found


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_two_series(spark, tmp_path, end):
    (tmp_path / "a").write_bytes(end.join(["1", " 2 ", "x", "-3", " ", "4", "", "5", ""]).encode())
    (tmp_path / "b").write_bytes(end.join(["10", "", "20"]).encode())
    assert series(spark, tmp_path) == {
        ("a", "map"): [1, 2],
        ("a", "reduce"): [4, 5],
        ("b", "map"): [10],
        ("b", "reduce"): [20],
    }


@pytest.mark.parametrize("text", ["1\n2\n", "1\r\n2", " ", "\n1\n2", "1\n\nx", "x\n\n1"])
def test_incomplete_series_fail(spark, tmp_path, text):
    (tmp_path / "a").write_bytes(text.encode())
    with pytest.raises(PySparkException, match="blank line or an empty series"):
        series(spark, tmp_path)


def test_scratch_folder_comes_from_the_session(spark):
    folder = scratch.shared_folder(spark)
    assert folder in (
        spark.conf.get("spark.checkpoint.dir", None),
        spark.sparkContext.getCheckpointDir(),
        spark.conf.get("spark.sql.warehouse.dir"),
    )
    assert scratch.scratch_path(spark, "x").startswith(f"{folder}/x-")
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")


def test_one_machine_folder_is_refused_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    with pytest.raises(ValueError, match="executors share"):
        scratch.scratch_path(spark, "x")


def test_a_mounted_folder_is_taken_on_a_standalone_cluster(spark, monkeypatch):
    get = type(spark.conf).get
    said = {"spark.checkpoint.dir": "file:/mnt/shared/"}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, k, *d: said.get(k) or get(self, k, *d))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert scratch.scratch_path(spark, "x").startswith("file:/mnt/shared/x-")
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    with pytest.raises(ValueError, match="executors share"):
        scratch.scratch_path(spark, "x")


@pytest.mark.parametrize("master", ["spark://host:7077", "k8s://https://host:443"])
def test_a_named_warehouse_is_taken_on_a_cluster_and_the_default_is_not(spark, monkeypatch, master):
    get = type(spark.conf).get
    said = {"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": "file:/mnt/tables"}
    monkeypatch.setattr(
        type(spark.conf), "get", lambda self, k, *d: said[k] if k in said else get(self, k, *d)
    )
    conf = type("Conf", (), {"get": lambda self, k: None})()
    monkeypatch.setattr(spark.sparkContext, "getConf", lambda: conf)
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    monkeypatch.setattr(spark.sparkContext, "master", master)
    assert scratch.scratch_path(spark, "x").startswith("file:/mnt/tables/x-")
    said["spark.sql.warehouse.dir"] = "file:/home/spark-warehouse"
    with pytest.raises(ValueError, match="executors share"):
        scratch.scratch_path(spark, "x")
    said["spark.checkpoint.dir"] = "file:/mnt/shared"
    assert scratch.scratch_path(spark, "x").startswith("file:/mnt/shared/x-")


def test_splits_are_made_smaller_but_not_larger(spark, tmp_path):
    name = "spark.sql.files.maxPartitionBytes"
    try:
        for before, after in (("128m", tables.SPLIT_BYTES), ("2m", 2 << 20), (str(20 << 20), tables.SPLIT_BYTES)):
            spark.conf.set(name, before)
            catalog.gram_totals(spark, "/root/testdata/sf0.001", 3)
            assert spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) == after
    finally:
        spark.conf.unset(name)


def test_written_rows_come_from_files(spark):
    table = scratch.written(spark.range(5), "ids")
    assert sorted(r.id for r in table.collect()) == [0, 1, 2, 3, 4]
    folder = scratch.shared_folder(spark).removeprefix("file:")
    assert all(f"{folder}/ids-" in f for f in table.inputFiles())
    assert scratch.written(spark.range(0), "ids").count() == 0


def test_parts_of_one_head_go_to_different_files(spark, frame, tmp_path):
    lines = frame([f"hot t{i}" for i in range(400)])
    table = stripes.stripe_texts(counts.head_tail_counts(lines, 2), 100)
    write_tsv(table, str(tmp_path / "o"), "head", "part", "stripe", files=4)
    assert len([p for p in part_files(str(tmp_path / "o")) if p]) > 1
    assert table.where(F.col("head") == "hot").count() > 10
