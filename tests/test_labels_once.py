"""Kept labels: stored events are joined once a batch, and events with a truth of their own not at all when read."""

import pytest
from pyspark.sql import functions as F

from runatlas.streaming import labels
from test_labels import labels_of, store, truths  # noqa: F401


@pytest.mark.parametrize("few", [500_000, 0])
def test_events_with_a_truth_are_not_joined(spark, store, monkeypatch, few):  # noqa: F811
    monkeypatch.setattr(labels, "BROADCAST_LABELS", few)
    job, send, stored = store
    send([(1, 0, None), (2, 0, 0.5), (3, 1, None), (4, 1, None)], 0)
    reads = []
    plain = labels.read_batches
    monkeypatch.setattr(labels, "read_batches", lambda *a: (reads.append(a[2]), plain(*a).withColumn("prediction", F.col("prediction")))[1])
    job.add_labels(labels_of(spark, [("1", 0.4, 1), ("2", 0.1, 9), ("4", None, 1), ("9", 0.3, 1)]), 0)
    assert reads == [[0]]
    found = job.labelled(stored())
    assert truths(found) == {"1": 0.4, "2": 0.5, "3": None, "4": None}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(ground_truth" in plan and "Union" in plan
    assert found.columns == stored().columns


def test_stored_events_are_joined_once_a_batch(spark, store, monkeypatch):  # noqa: F811
    """The labels' events are written once; their days and what they change come from there."""
    job, send, _ = store
    send([(i, i % 3, None) for i in range(9)], 0)
    written = []
    plain = labels.materialize
    monkeypatch.setattr(labels, "materialize", lambda df, path: (written.append(path.rsplit("/", 1)[1]), plain(df, path))[1])
    job.add_labels(labels_of(spark, [(str(i), 0.5, 1) for i in range(9)]), 0)
    assert written == ["newest", "stored", "met"]
