"""Operators that replace a sort of the whole data: checked against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from runatlas.operators import ordering
from runatlas.operators.keyed import first_n_per_key, is_small
from runatlas.operators.quantiles import exact_quantiles

RNG = np.random.default_rng(7)
SAMPLES = {
    "normal": RNG.normal(0.3, 0.1, 3001),
    "wide": np.concatenate([RNG.normal(0, 1, 500) * 10.0**RNG.integers(-9, 12, 500), [1e300, -1e300]]),
    "narrow": 0.94 + RNG.random(2000) * 1e-9,
    "a third the same": np.concatenate([np.full(1000, 0.5), RNG.random(2000)]),
    "constant": np.full(50, 2.5),
    "single": np.array([3.0]),
    "pair": np.array([1.0, 2.0]),
    "negative": -RNG.exponential(5.0, 777),
    "infinite": np.concatenate([RNG.random(40), [np.inf, np.inf, -np.inf]]),
}


def test_quantiles_equal_sorting(spark):
    rows = [(k, float(v)) for k, vs in SAMPLES.items() for v in vs]
    rows += [("normal", None), ("normal", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    found = {r.k: r for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    assert set(found) == set(SAMPLES)
    for k, values in SAMPLES.items():
        assert found[k]["_count"] == len(values)
        for name, p in probs.items():
            ordered = sorted(values)
            place = (len(ordered) - 1) * p
            low, high = ordered[int(np.floor(place))], ordered[int(np.ceil(place))]
            want = low if low == high else low + (high - low) * (place - np.floor(place))
            got = found[k][name]
            if np.isinf(low) or np.isinf(high):
                continue  # an interpolation with an infinity has no value to compare
            assert got == pytest.approx(want, rel=1e-12, abs=1e-300), (k, name)


def test_quantiles_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("runatlas.operators.quantiles.BROADCAST_ROWS", 1)
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    found = exact_quantiles(df, ["k"], "v", {"m": 0.5}).orderBy("k").collect()
    assert [r.m for r in found] == [499.5, 499.0, 500.0]


def test_positions_are_dense_and_ordered(spark):
    names = [f"n{i}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "n string").repartition(7)
    placed = ordering.with_position(df, ordering.hash_bucket(F.col("n")), [F.col("n")], "p", 100)
    want = sorted(names, key=lambda n: (hashlib.md5(n.encode()).hexdigest()[:4], n))
    assert {r.n: r.p for r in placed.collect()} == {n: 101 + i for i, n in enumerate(want)}


def test_rank_nulls_first_and_ties(spark):
    values = [None, None, 0.9, 0.9, 0.5, 0.5001, -1.0, 0.0, 0.9]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    ranked = {r.i: r.r for r in ordering.with_rank(df, F.col("v"), "r").collect()}
    keys = [float("inf") if v is None else v for v in values]
    assert ranked == {i: 1 + sum(o > k for o in keys) for i, k in enumerate(keys)}


def test_sample_is_exact_and_reproducible(spark):
    df = spark.range(2000)
    one = {r.id for r in ordering.sample_n(df, "id", 300, 1).collect()}
    assert len(one) == 300
    assert one == {r.id for r in ordering.sample_n(df.repartition(9), "id", 300, 1).collect()}
    assert one != {r.id for r in ordering.sample_n(df, "id", 300, 2).collect()}
    assert ordering.sample_n(df, "id", 5000, 1).count() == 2000


@pytest.mark.parametrize("n", [3, 1500])
def test_first_n_with_and_without_salt(spark, n):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    kept = first_n_per_key(df, ["k"], [F.desc("v")], n)
    assert kept.count() == 2 * n
    assert kept.agg(F.min("v")).first()[0] == 5000 - 2 * n


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    plan = first_n_per_key(df, ["k"], [F.col("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_is_small(spark):
    assert is_small(spark.range(10), 10)
    assert not is_small(spark.range(11), 10)


def test_infinite_values_keep_their_median_and_their_average(spark):
    from pyspark.sql import functions as F

    from runatlas.functions.scalars import half_up, settled

    df = spark.createDataFrame([("a", float("inf"))] * 3 + [("b", 1.0), ("b", float("inf"))], "k string, v double")
    medians = {r.k: r.m for r in exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert medians == {"a": float("inf"), "b": float("inf")}
    row = df.agg(half_up(F.avg("v"), 2).alias("h"), settled(F.max("v")).alias("s")).first()
    assert row.h == row.s == float("inf")


def test_estimates_keep_runs_on_unknown_hardware(spark):
    from runatlas.operators import enrich

    df = spark.createDataFrame(
        [("none", "my_model", "success", 10, 32, 0.01, 60.0, 0.5), ("NVIDIA T4", "gpt2_small", "success", 10, 32, 0.01, 60.0, 0.5)],
        "gpu string, model_name string, status string, epochs int, batch_size int, learning_rate double, training_time_sec double, accuracy double",
    )
    for made, column in ((enrich.energy_estimate, "estimated_kwh"), (enrich.time_residual, "time_ratio"), (enrich.accuracy_residual, "accuracy_residual")):
        rows = {r.gpu: r[column] for r in made(df).collect()}
        assert len(rows) == 2 and rows["none"] is None and rows["NVIDIA T4"] is not None


def test_list_files_have_a_bounded_number_of_records(spark, tmp_path, monkeypatch):
    from runatlas.plans import catalog
    from runatlas.sources import json_records

    rows = [(k % 2, 8 if k % 10 else k, (k * 7) % 1000, float(k), f"r{k:04d}") for k in range(1000)]
    raw = spark.createDataFrame(rows, "source_rank int, l_suppkey long, l_partkey long, l_extendedprice double, experiment_id string")
    monkeypatch.setattr(catalog, "LIST_RECORDS", 40, raising=False)
    catalog.write_lists(raw, str(tmp_path / "lists"))
    read = json_records.read_sources(spark, f"{tmp_path}/lists/source_rank=0", [f"{tmp_path}/lists/source_rank=1"], lines=False)
    assert max(r["count"] for r in read.groupBy("_file").count().collect()) <= 40
    found = [r.experiment_id for r in read.orderBy(*json_records.input_order()).collect()]
    assert found == [r[4] for r in sorted(rows, key=lambda r: (r[0], r[1] % 4, r[2], r[1], r[3], r[4]))]


def test_values_that_cluster_beside_an_outlier_are_cut_until_slots_are_small(spark, monkeypatch):
    """A million different values within one part in 10**9, and one far away: two reads, no large slot."""
    from runatlas.operators import quantiles

    bound, slots, reads = 60_000, [], []
    monkeypatch.setattr(quantiles, "SLOT_ROWS", bound)
    located, bucketed = quantiles._locate, quantiles.bucketed

    def seen(counts, group, order):
        if order == "_v":
            slots.append(counts.groupBy(*group).count().agg(F.max("count")).first()[0])
        return located(counts, group, order)

    monkeypatch.setattr(quantiles, "_locate", seen)
    monkeypatch.setattr(quantiles, "bucketed", lambda *a: (reads.append(1), bucketed(*a))[1])
    n = 1_000_000
    v = F.when(F.col("id") == n, 1e12).otherwise(1 + F.col("id") * 1e-15 * 2)
    df = spark.range(n + 1).select(F.lit("k").alias("k"), v.alias("v"))
    distinct = df.select("v").distinct().count()
    assert distinct > n * 0.9
    row = exact_quantiles(df, ["k"], "v", {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}).first()
    assert len(reads) == 2 and max(slots) <= bound
    want = [1 + k * 1e-15 * 2 for k in (0, n // 2, 95 * n // 100)]
    assert [row.p0, row.p50, row.p95, row.p100] == [*want, 1e12]


@pytest.mark.parametrize("bound", [3, 50])
def test_quantiles_equal_sorting_in_small_slots(spark, monkeypatch, bound):
    monkeypatch.setattr("runatlas.operators.quantiles.SLOT_ROWS", bound)
    values = np.concatenate([np.full(70, 0.5), 0.5 + RNG.random(300) * 1e-6])
    df = spark.createDataFrame([("a", float(x)) for x in values] + [(None, 1.0)], "k string, v double")
    found = {r.k: r for r in exact_quantiles(df, ["k"], "v", {"a": 0.1, "b": 0.5}).collect()}
    assert [found["a"].a, found["a"].b] == pytest.approx(np.quantile(values, [0.1, 0.5]).tolist(), rel=1e-15)
    assert found[None].b == 1.0


def test_summary_counts_rows_without_a_number(spark):
    from runatlas.operators.quantiles import quantile_summary

    rows = [("a", 1.0), ("a", None), ("a", 3.0), ("b", None), (None, 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = {r.k: (r.n, r.m, r.p) for r in quantile_summary(df, ["k"], "v", {"p": 0.5}, "n", "m").collect()}
    assert found == {"a": (3, 2.0, 2.0), "b": (1, None, None), None: (1, 4.0, 4.0)}
