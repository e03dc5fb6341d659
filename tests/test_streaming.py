import pytest
from pyspark.sql import functions as F

from runatlas.operators import drift, monitoring
from runatlas.sources import event_log
from runatlas.streaming import metrics
from runatlas.streaming.drift_job import DriftJob
from runatlas.streaming.ingest import ingest, read_predictions, store_batch


@pytest.fixture
def events(spark):
    def make(n, shift_after=10**9, first=0):
        i = F.col("id")
        return spark.range(first, first + n).select(
            i.cast("string").alias("stream_entry_id"),
            F.concat(F.lit("m"), (i % 2).cast("string")).alias("model_name"),
            F.lit("v1").alias("model_version"),
            ((F.abs(F.hash("id")) % 1000) / 1000 + F.when(i >= shift_after, 0.7).otherwise(0.0)).alias("prediction"),
            F.when(i % 3 == 0, 1.0).alias("ground_truth"),
            (10 + i % 50).cast("double").alias("latency_ms"),
            F.timestamp_seconds(1_700_000_000 + i * 60).alias("event_timestamp"),
        )

    return make


def drain(spark, tmp_path, **more):
    started = ingest(
        spark,
        str(tmp_path / "log"),
        str(tmp_path / "table"),
        str(tmp_path / "bad"),
        str(tmp_path / "checkpoint"),
        **more,
    )
    started.awaitTermination()
    return read_predictions(spark, str(tmp_path / "table"))


def test_ten_in_ten_out_and_nothing_twice(spark, events, tmp_path):
    log = str(tmp_path / "log")
    event_log.publish(events(10), log)
    assert drain(spark, tmp_path).count() == 10
    assert drain(spark, tmp_path).count() == 10
    event_log.publish(events(10), log)  # the same entries again
    event_log.publish(events(2, first=100), log)
    table = drain(spark, tmp_path)
    assert table.count() == 12
    assert table.filter("ingested_at IS NULL OR latency_ms <= 0").count() == 0


def test_replayed_batch_overwrites_itself(spark, events, tmp_path):
    table, bad = str(tmp_path / "t"), str(tmp_path / "b")
    raw = events(6).select(*[F.col(c).cast("string").alias(c) for c in events(1).columns])
    assert store_batch(raw, 0, table, bad).count() == 6
    assert store_batch(raw, 0, table, bad).count() == 6
    assert store_batch(raw, 1, table, bad).count() == 0
    assert read_predictions(spark, table).count() == 6


def test_bad_entry_is_set_aside(spark, events, tmp_path):
    good = events(3)
    event_log.publish(good.unionByName(events(1, first=50).withColumn("latency_ms", F.lit(-1.0))), str(tmp_path / "log"))
    assert drain(spark, tmp_path).count() == 3
    (row,) = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert row.validation_error == "latency_ms:range"


def test_carried_windows_equal_the_batch_check(spark, events, tmp_path):
    log = str(tmp_path / "log")
    job = DriftJob(str(tmp_path / "drift"), window=40)
    last = []
    for first in (0, 100, 200):  # the shift begins in the third delivery
        event_log.publish(events(100, shift_after=200, first=first).coalesce(1), log)
    drain(spark, tmp_path, max_files=1, after_batch=lambda f, b: (job(f, b), last.append(b)))
    assert len(last) == 3
    want = {tuple(r) for r in drift.check_drift(events(300, shift_after=200), window=40).collect()}
    got = {tuple(r)[:-1] for r in job.check(spark, last[-1]).collect()}
    assert got == want and all(r[3] for r in got)
    assert spark.read.parquet(job.alerts_path()).filter(F.col("batch_id") == last[-1]).count() == 2


def test_dashboard_queries(spark, events):
    df = events(20)
    cutoff = monitoring.latest_minus(df, 60)
    assert {r.event_count for r in monitoring.monitored_models(df).collect()} == {10}
    assert monitoring.recent_predictions(df, cutoff).count() == 20
    assert monitoring.recent_predictions(df, cutoff, limit=7).count() == 7
    future = F.lit("2030-01-01").cast("timestamp")
    assert monitoring.recent_predictions(df, future).count() == 0
    for row in monitoring.latency_summary(df, cutoff).collect():
        assert row.event_count == 10 and row.p50_latency_ms <= row.p95_latency_ms
    listed = monitoring.allow_listed(df, " m0:v1 ,, m1 ,x:v1")
    assert {r.model_name for r in listed.collect()} == {"m0"} and listed.count() == 10
    assert monitoring.volume_per_minute(df).count() == 20


def test_labels_fill_only_gaps(spark, events):
    labels = spark.createDataFrame([("0", 0.25), ("1", 0.5)], "stream_entry_id string, label double")
    rows = {r.stream_entry_id: r.ground_truth for r in monitoring.with_late_labels(events(3), labels).collect()}
    assert rows == {"0": 1.0, "1": 0.5, "2": None}


def test_an_id_is_stored_once_whatever_its_date(spark, events, tmp_path):
    table, bad = str(tmp_path / "t"), str(tmp_path / "b")
    raw = events(6).select(*[F.col(c).cast("string").alias(c) for c in events(1).columns])
    later = raw.withColumn("event_timestamp", F.lit("2031-01-01 00:00:00"))
    assert store_batch(raw, 0, table, bad).count() == 6
    assert store_batch(later, 1, table, bad).count() == 0
    assert store_batch(later.unionByName(raw.limit(0)), 2, table, bad).count() == 0
    assert read_predictions(spark, table).count() == 6


def test_volume_counts_every_event_in_any_order(spark, events, tmp_path):
    log = str(tmp_path / "log")
    everything = events(60)
    for part in (3, 0, 2, 1):  # late and early events in turn, one file each
        event_log.publish(everything.filter(F.col("stream_entry_id") % 4 == part).coalesce(1), log)
    job = metrics.VolumeJob(str(tmp_path / "volume"), compact_every=2)
    drain(spark, tmp_path, max_files=1, after_batch=job)
    got = {tuple(r) for r in job.volume(spark).collect()}
    assert got == {tuple(r) for r in monitoring.volume_per_minute(everything).collect()} and len(got) == 60


def test_replayed_partial_results_replace_themselves(spark, events, tmp_path):
    job = metrics.VolumeJob(str(tmp_path / "volume"), compact_every=2)
    for batch, first in enumerate((0, 10, 20, 30, 40)):
        for _ in range(2):
            job(events(10, first=first), batch)
    assert sum(r.event_count for r in job.volume(spark).collect()) == 50


def test_continuous_ingest_takes_what_comes_later(spark, events, tmp_path):
    log = str(tmp_path / "log")
    event_log.publish(events(4), log)
    started = ingest(spark, log, str(tmp_path / "table"), str(tmp_path / "bad"), str(tmp_path / "cp"), once=False)
    try:
        started.processAllAvailable()
        event_log.publish(events(3, first=50), log)
        started.processAllAvailable()
        assert read_predictions(spark, str(tmp_path / "table")).count() == 7
    finally:
        started.stop()


def test_the_latest_label_counts_once(spark, events):
    rows = [("1", 0.5, "2024-01-01 00:00:00"), ("1", 0.75, "2024-01-03 00:00:00"), ("1", 0.25, "2024-01-02 00:00:00")]
    labels = spark.createDataFrame(rows, "stream_entry_id string, label double, t string").withColumn("label_timestamp", F.to_timestamp("t"))
    found = monitoring.with_late_labels(events(3), labels.drop("t")).collect()
    assert len(found) == 3 and {r.stream_entry_id: r.ground_truth for r in found}["1"] == 0.75


def with_latencies(events, n):
    """Events with many different latencies; a few have none or an infinite one."""
    i = F.col("stream_entry_id").cast("long")
    latency = F.when(i % 97 == 0, F.lit(float("inf"))).otherwise(5 + F.abs(F.hash(i)) % 100_000 / 1000)
    return events(n).withColumns({"latency_ms": latency, "event_timestamp": F.timestamp_seconds(1_700_000_000 + i * 7)})


def test_percentiles_come_from_panes_and_few_events(spark, events, tmp_path):
    log = str(tmp_path / "log")
    everything = with_latencies(events, 3000)
    for part in (3, 0, 2, 1):
        event_log.publish(everything.filter(F.col("stream_entry_id") % 4 == part).coalesce(1), log)
    panes = metrics.LatencyPanes(str(tmp_path / "panes"), compact_every=2)
    drain(spark, tmp_path, max_files=1, after_batch=panes)
    stored = read_predictions(spark, str(tmp_path / "table"))

    import numpy as np

    rows = [(r.model_name, int(r.event_timestamp.timestamp()), r.latency_ms) for r in everything.collect()]
    windows = {}
    for model, at, latency in rows:
        for k in range(12):
            windows.setdefault((model, at // 300 * 300 - 300 * k), []).append(latency)
    found = {(r.model_name, int(r.window_start.timestamp())): r for r in panes.sliding(stored).collect()}
    assert set(found) == set(windows)
    for key, values in windows.items():
        row, finite = found[key], np.isfinite(values).all()
        assert row.event_count == len(values)
        assert row.p50_latency_ms == pytest.approx(np.quantile(values, 0.5), rel=1e-12)
        if finite:
            assert row.avg_latency_ms == pytest.approx(np.mean(values), rel=1e-9)
            assert row.p95_latency_ms == pytest.approx(np.quantile(values, 0.95), rel=1e-12)

    # The window of the last two hours begins inside a pane.
    newest = max(at for _, at, _ in rows)
    for row in panes.trailing(stored, 120).collect():
        inside = [x for model, at, x in rows if model == row.model_name and at >= newest - 7200]
        assert row.event_count == len(inside)
        assert row.p95_latency_ms == pytest.approx(np.quantile(inside, 0.95), rel=1e-12)


def test_few_stored_events_are_looked_at(spark, events, tmp_path):
    """Of the events in a trailing window only those in the buckets around the wanted ranks pass on."""
    from runatlas.operators.quantiles import buckets_with_ranks, coarse_counts, wanted_ranks

    stored = with_latencies(events, 3000)
    hits = buckets_with_ranks(coarse_counts(stored, metrics.MODEL, "latency_ms"), metrics.MODEL, wanted_ranks(metrics.TAILS))
    near = metrics.events_near(stored, hits, 60)
    assert 0 < near.count() < 3000 * 0.05
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_a_batch_of_one_model_leaves_the_other_parts_alone(spark, events, tmp_path):
    job = DriftJob(str(tmp_path / "drift"), window=20)
    many = events(400).withColumn("model_name", F.concat(F.lit("m"), (F.col("stream_entry_id").cast("long") % 10).cast("string")))
    job(many, 0)
    state = job.state(spark)
    before = {p: state._versions(p) for p in state._names(state.root, "part=")}
    assert len(before) > 3
    job(many.filter("model_name = 'm3'").withColumn("stream_entry_id", F.concat(F.lit("x"), "stream_entry_id")), 1)
    after = {p: state._versions(p) for p in state._names(state.root, "part=")}
    changed = [p for p in after if after[p] != before[p]]
    assert len(changed) == 1 and after[changed[0]] == [0, 1]
    assert [r.model_name for r in job.check(spark, 1).filter("touched").collect()] == ["m3"]
    assert job.check(spark, 1).count() == 10
    # The batch again starts from the state before it.
    job(many.filter("model_name = 'm3'").withColumn("stream_entry_id", F.concat(F.lit("x"), "stream_entry_id")), 1)
    assert {r.event_count for r in state.read(1).collect()} == {40, 80}
