"""Kept labels and the rollup against the batch operators over all rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from runatlas.operators import monitoring
from runatlas.streaming.ingest import read_predictions, store_batch
from runatlas.streaming.labels import LabelJob

LABELS = "stream_entry_id string, label double, t int"
DAY = 86_400


@pytest.fixture
def store(spark, tmp_path):
    """Stores events (entry, day, own truth) as micro-batches, beside a job."""
    table = str(tmp_path / "table")
    job = LabelJob(str(tmp_path / "labels"), table, compact_every=2)

    def send(rows, batch_id):
        raw = spark.createDataFrame(rows, "i int, day int, truth double").select(
            F.col("i").cast("string").alias("stream_entry_id"),
            F.concat(F.lit("m"), (F.col("i") % 2).cast("string")).alias("model_name"),
            F.lit("v1").alias("model_version"),
            (F.col("i") % 10 / 10).cast("string").alias("prediction"),
            F.col("truth").cast("string").alias("ground_truth"),
            (F.col("i") % 7 + 1).cast("string").alias("latency_ms"),
            F.timestamp_seconds(1_700_000_000 + F.col("day") * DAY).cast("string").alias("event_timestamp"),
        )
        job.add_events(store_batch(raw, batch_id, table, str(tmp_path / "bad")), batch_id)

    return job, send, lambda: read_predictions(spark, table)


def labels_of(spark, rows):
    found = spark.createDataFrame(rows, LABELS)
    return found.select("stream_entry_id", "label", F.timestamp_seconds("t").alias("label_timestamp"))


def truths(df):
    return {r.stream_entry_id: r.ground_truth for r in df.collect()}


def sums(df):
    return {
        (r.event_date, r.model_name): (r.event_count, r.labelled_count, r.mean_abs_error and round(r.mean_abs_error, 9), round(r.avg_latency_ms, 9))
        for r in df.collect()
    }


def test_any_order_of_events_and_labels_equals_the_batch_operators(spark, store):
    job, send, stored = store
    draw = random.Random(5)
    events = [(i, draw.randrange(4), 0.5 if i % 5 == 0 else None) for i in range(60)]
    draw.shuffle(events)
    sent = []
    for step in range(4):
        if step < 3:
            send(events[20 * step : 20 * step + 20], step)
        # Labels of stored, of later and of unknown entries; corrected, older, repeated, taken back and without a time.
        rows = [(str(draw.randrange(70)), draw.choice([None, 0.1, 0.7, 0.9]), draw.choice([None, 1, 2, 3, 4])) for _ in range(25)]
        rows += rows[:3]
        job.add_labels(labels_of(spark, rows), step)
        sent += rows
        everything = monitoring.with_late_labels(stored(), labels_of(spark, sent))
        assert truths(job.labelled(stored())) == truths(everything)
        assert sums(job.rollup(spark)) == sums(monitoring.daily_rollup(everything))


def test_waiting_labels_count_as_soon_as_their_events_come(spark, store):
    job, send, stored = store
    job.add_labels(labels_of(spark, [("3", 0.9, 1), (None, 0.9, 1)]), 0)
    send([(3, 0, None), (4, 1, None)], 0)
    assert truths(job.labelled(stored())) == {"3": 0.9, "4": None}
    assert sorted(r.labelled_count for r in job.rollup(spark).collect()) == [0, 1]
    job.add_labels(labels_of(spark, []), 1)
    assert truths(job.labelled(stored())) == {"3": 0.9, "4": None}
    assert sorted(r.labelled_count for r in job.rollup(spark).collect()) == [0, 1]


def test_a_replayed_batch_changes_nothing(spark, store):
    job, send, stored = store
    send([(1, 0, None), (2, 0, None), (3, 1, 0.5)], 0)
    job.add_labels(labels_of(spark, [("1", 0.4, 1), ("3", 0.1, 9)]), 0)
    for _ in range(2):
        job.add_labels(labels_of(spark, [("1", 0.8, 2), ("2", 0.3, 1)]), 1)
        assert truths(job.labelled(stored())) == {"1": 0.8, "2": 0.3, "3": 0.5}
        everything = monitoring.with_late_labels(stored(), labels_of(spark, [("1", 0.8, 2), ("2", 0.3, 1)]))
        assert sums(job.rollup(spark)) == sums(monitoring.daily_rollup(everything))


def test_a_batch_rewrites_only_the_days_it_touches(spark, store):
    job, send, stored = store
    send([(i, i % 5, None) for i in range(20)], 0)
    job.add_labels(labels_of(spark, [(str(i), 0.5, 1) for i in range(20)]), 0)
    days = sorted(r[0] for r in stored().select(F.to_date("event_timestamp").cast("string")).distinct().collect())
    before = {d: sorted(os.listdir(f"{job.root}/kept/part={d}")) for d in days}
    job.add_labels(labels_of(spark, [("0", 0.6, 2), ("5", 0.1, 2)]), 1)
    changed = [d for d in days if sorted(os.listdir(f"{job.root}/kept/part={d}")) != before[d]]
    assert len(days) == 5 and changed == days[:1]
    assert truths(job.labelled(stored(), days[:1])) == {"0": 0.6, "5": 0.1, "10": 0.5, "15": 0.5}
