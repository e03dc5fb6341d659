import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from runatlas.operators import alerts, drift


def brute(baseline, recent):
    """The index from sorted lists, for comparison."""
    if not len(baseline) or not len(recent):
        return 0.0
    bins = max(2, min(10, len(baseline) // 20))
    edges = sorted({float(np.quantile(baseline, min(1.0, i / bins))) for i in range(bins + 1)})
    if len(edges) < 3:
        return 0.0
    total = 0.0
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        last = i == len(edges) - 2
        b, r = (
            sum(low <= v < high or (last and v == high) for v in side) / len(side) + 1e-6
            for side in (baseline, recent)
        )
        total += (r - b) * math.log(r / b)
    return total


def normal(mean, sd, n, seed):
    return [float(v) for v in np.random.default_rng(seed).normal(mean, sd, n)]


def skewed(shape, n, seed):
    return [float(v) for v in np.random.default_rng(seed).gamma(shape, 2.0, n)]


CASES = {
    "nothing before": ([], [4.0, 7.5, 9.0]),
    "nothing after": ([4.0, 7.5, 9.0], []),
    "same rows": (skewed(3.0, 260, 11), skewed(3.0, 260, 11)),
    "one value before": ([7.0] * 150, skewed(3.0, 150, 12)),
    "few rows": (skewed(2.0, 24, 13), skewed(2.0, 24, 14)),
    "far away": (skewed(3.0, 180, 15), [-40.0] * 90 + [900.0] * 90),
    "many ties": ([1.0] * 70 + [2.0] * 70 + [5.0] * 20, [1.0] * 10 + [2.0] * 90 + [6.0] * 33),
    "unlike sizes": (skewed(4.0, 317, 16), skewed(5.0, 47, 17)),
}
for k in range(3):
    CASES[f"alike {k}"] = (skewed(3.0, 400, 20 + k), skewed(3.0, 400, 40 + k))
    CASES[f"moved {k}"] = (skewed(3.0, 400, 20 + k), skewed(9.0, 400, 60 + k))


def test_window_psi(spark):
    rows = [(k, b, r) for k, (b, r) in CASES.items()]
    df = spark.createDataFrame(rows, "k string, baseline array<double>, recent array<double>")
    found = {r.k: r.psi for r in drift.with_psi(df).collect()}
    for k, (b, r) in CASES.items():
        assert found[k] == pytest.approx(brute(b, r), abs=1e-9), k
    assert found["same rows"] == pytest.approx(0.0, abs=1e-9)
    assert found["one value before"] == 0.0
    assert all(found[f"alike {k}"] < 0.2 < found[f"moved {k}"] for k in range(3))


def test_sample_psi_equals_window_psi(spark):
    def side(i):
        rows = [(k, v) for k, pair in CASES.items() for v in pair[i]]
        return spark.createDataFrame(rows, "k string, prediction double")

    found = {r.k: r.psi for r in drift.sample_psi(side(0), side(1), ["k"]).collect()}
    for k, (b, r) in CASES.items():
        assert found[k] == pytest.approx(brute(b, r), abs=1e-9), k


@pytest.fixture
def events(spark):
    def make(counts):
        frames = [
            spark.range(n).select(
                F.lit(m).alias("model_name"),
                F.lit("v1").alias("model_version"),
                F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("event_timestamp"),
                F.col("id").alias("stream_entry_id"),
                (F.hash("id") % 1000 / 1000 + F.when(F.col("id") > n / 2, 1.0).otherwise(0.0)).alias("prediction"),
            )
            for m, n in counts.items()
        ]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    return make


def test_the_two_eligibility_rules(events):
    df = events({"few": 19, "full": 200, "overlap": 399, "double": 400})
    checked = {r.model_name: r for r in drift.check_drift(df).collect()}
    assert set(checked) == {"full", "overlap", "double"}
    assert checked["full"].psi == 0.0  # both windows are the same 200 events
    status = {r.model_name: r for r in drift.drift_status(df).collect()}
    assert [m for m, r in status.items() if r.has_enough_data] == ["double"]
    assert (status["few"].event_count, status["few"].events_needed, status["few"].psi) == (19, 400, None)
    assert status["double"].psi == checked["double"].psi >= 0
    assert status["double"].label == "drift detected" and checked["double"].is_drifted


def test_alerts(spark, events):
    df = alerts.drift_alerts(drift.check_drift(events({"double": 400, "full": 200})))
    (row,) = df.collect()
    assert row.severity == "warning" and row.log_level == "WARNING"
    assert row.message == (
        f"Drift detected for double/v1: PSI={row.psi} (threshold=0.25, baseline_n=200, recent_n=200)"
    )
    assert row.payload == '{"text":"[WARNING] Model Monitoring: ' + row.message + '"}'
    one = spark.createDataFrame([("x",)], "message string")
    levels = {s: alerts.alert_rows(one, s).first().log_level for s in ("info", "warning", "critical")}
    assert levels == {"info": "INFO", "warning": "WARNING", "critical": "ERROR"}
    with pytest.raises(ValueError):
        alerts.alert_rows(one, "fatal")
