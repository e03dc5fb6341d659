"""Micro-batches look at ids before whole rows, and a day of a batch is one file."""

import glob

import pytest
from pyspark.sql import functions as F

from runatlas.streaming import ingest, metrics
from runatlas.streaming.ingest import read_predictions, store_batch


def raw(spark, rows, parts=1):
    """Rows of (entry, latency, day)."""
    found = spark.createDataFrame(rows, "i string, latency double, day int").repartition(parts)
    return found.select(
        F.col("i").alias("stream_entry_id"),
        F.lit("m").alias("model_name"),
        F.lit("v1").alias("model_version"),
        F.lit("0.5").alias("prediction"),
        F.lit(None).cast("string").alias("ground_truth"),
        F.col("latency").cast("string").alias("latency_ms"),
        F.timestamp_seconds(1_700_000_000 + F.col("day") * 86_400).cast("string").alias("event_timestamp"),
    )


@pytest.mark.parametrize("listed", [10**6, 3, 0])
def test_the_first_delivery_counts_in_a_batch_and_over_batches(spark, tmp_path, monkeypatch, listed):
    """With few repeated ids, with more than can be listed, and with none listed."""
    monkeypatch.setattr(ingest, "LISTED", listed)
    table, bad = str(tmp_path / "t"), str(tmp_path / "b")
    first = [("a", 2.0, 1), ("a", 1.0, 1), ("a", 9.0, 0), ("b", 3.0, 0), ("c", 4.0, 2), ("c", 4.0, 2), (None, 1.0, 0), ("d", -1.0, 0)]
    second = [("a", 0.5, 0), ("a", 0.5, 0), ("e", 7.0, 1), ("e", 6.0, 1), ("f", 8.0, 0), ("c", 0.1, 0)]

    def stored():
        return sorted((r.stream_entry_id, r.latency_ms, r.batch_id) for r in read_predictions(spark, table).collect())

    store_batch(raw(spark, first, 3), 0, table, bad)
    assert stored() == [("a", 9.0, 0), ("b", 3.0, 0), ("c", 4.0, 0)]
    want = [("a", 9.0, 0), ("b", 3.0, 0), ("c", 4.0, 0), ("e", 6.0, 1), ("f", 8.0, 1)]
    for _ in range(2):  # a replayed batch, too
        store_batch(raw(spark, second, 3), 1, table, bad)
        assert stored() == want
    store_batch(raw(spark, second + first, 3), 2, table, bad)
    assert stored() == want
    assert spark.read.parquet(bad).filter("batch_id = 0").count() == 2


def test_a_day_of_a_batch_is_one_file(spark, tmp_path):
    table = str(tmp_path / "t")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # else so few rows are one task
    try:
        store_batch(raw(spark, [(str(i), 1.0, i % 5) for i in range(4000)], 6), 0, table, str(tmp_path / "b"))
    finally:
        spark.conf.unset(merging)
    assert len(glob.glob(f"{table}/batch_id=0/event_date=*")) == 5
    assert len(glob.glob(f"{table}/batch_id=0/event_date=*/*.parquet")) == 5


def test_a_trailing_window_reads_only_its_days(spark, tmp_path, monkeypatch):
    table, panes = str(tmp_path / "t"), metrics.LatencyPanes(str(tmp_path / "panes"))
    panes(store_batch(raw(spark, [(str(i), 1.0 + i, i) for i in range(40)]), 0, table, str(tmp_path / "b")), 0)
    inside = metrics._from(read_predictions(spark, table), F.lit("2023-12-20 00:00:00").cast("timestamp"))
    assert len({f.split("event_date=")[1].split("/")[0] for f in inside.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}) < 10
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan.split("PartitionFilters")[1].split("]")[0]
    (row,) = panes.trailing(read_predictions(spark, table), 3 * 1440).collect()
    assert (row.event_count, row.p50_latency_ms) == (4, 38.5)
