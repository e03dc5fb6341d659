"""Refreshed tables: a version at a time, and only what has changed."""

import pytest
from pyspark.sql import functions as F

from runatlas.sources.tables import ConcurrentRefresh, TableStore, Version


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, *months):
    data = [(m, f"r{k}", float(k)) for m in months for k in range(3)]
    return spark.createDataFrame(data, "run_month int, name string, v double").select("name", "v", "run_month")


def test_a_killed_refresh_leaves_the_old_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.overwrite(frame(spark, 1), "t")
    broken = frame(spark, 2).withColumn("v", F.when(F.col("name") == "r2", F.raise_error(F.lit("killed")).cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        store.overwrite(broken.repartition(3), "t")
    assert rows(store.read("t")) == rows(frame(spark, 1)) and store.current("t").number == 1
    # Also if it dies after its rows are written, before the pointer.
    frame(spark, 5).write.parquet(str(tmp_path / "t" / "versions" / "version=2"))
    assert rows(store.read("t")) == rows(frame(spark, 1))
    assert rows(store.overwrite(frame(spark, 3), "t")) == rows(frame(spark, 3))


def test_an_open_reader_sees_one_version(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    opened = store.overwrite(frame(spark, 1, 2), "t", "run_month")
    store.overwrite(frame(spark, 2, 3), "t", "run_month")
    assert rows(opened) == rows(frame(spark, 1, 2))
    assert rows(store.read("t")) == rows(frame(spark, 2, 3))
    # A table may be made from its own version before.
    own = store.overwrite(store.read("t").withColumn("v", F.col("v") + 1), "t", "run_month")
    assert rows(own) == rows(frame(spark, 2, 3).withColumn("v", F.col("v") + 1))


def test_only_changed_months_are_written(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.overwrite(frame(spark, 1, 2, 3, None), "t", "run_month")
    changed = frame(spark, 1, 2, 4, None).withColumn("v", F.when(F.col("run_month") == 2, None).otherwise(F.col("v")))
    assert rows(store.overwrite(changed, "t", "run_month")) == rows(changed)
    folders = store.current("t").folders
    assert {p: f.split("/")[0] for p, f in folders.items()} == {
        "1": "version=1", "__HIVE_DEFAULT_PARTITION__": "version=1", "2": "version=2", "4": "version=2",
    }
    assert rows(store.overwrite(changed, "t", "run_month")) == rows(changed)
    assert store._names(str(tmp_path / "t" / "versions" / "version=3")) in ([], ["_SUCCESS"])
    assert rows(store.overwrite(frame(spark), "t", "run_month")) == []
    assert rows(store.overwrite(frame(spark, 7), "t", "run_month")) == rows(frame(spark, 7))


def test_repeated_rows_are_counted(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.overwrite(frame(spark, 1), "t", "run_month")
    twice = frame(spark, 1).union(frame(spark, 1))
    assert rows(store.overwrite(twice, "t", "run_month")) == rows(twice)


def test_old_versions_go_and_a_second_writer_is_told(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for k in range(5):
        store.overwrite(frame(spark, k), "t")
    assert store._numbers("t") == [4, 5]
    assert sorted(store._names(str(tmp_path / "t" / "versions"))) == ["version=4", "version=5"]
    with pytest.raises(ConcurrentRefresh):
        store._switch("t", Version(5, {"": "version=5"}))
