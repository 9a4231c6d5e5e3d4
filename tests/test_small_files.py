"""Read tasks of many small files, after a query has made the session's splits small."""

from wordloom.sources.lines import read_lines
from wordloom.sources.tables import small_splits


def test_small_files_share_read_tasks_in_small_splits_too(spark, tmp_path):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    for i in range(250):
        (tmp_path / f"{i:03}.txt").write_text(f"common word{i}\nsecond line\n")
    try:
        for name in names:
            spark.conf.unset(name)
        small_splits(spark)
        assert read_lines(spark, str(tmp_path)).rdd.getNumPartitions() <= 25
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
