"""What the plans of the larger queries read, shuffle and hold."""

import datetime

import pytest
from pyspark.sql import functions as F

from runatlas.operators.validate import audit
from runatlas.plans import adapter, catalog
from runatlas.streaming import metrics

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz")


@pytest.fixture
def tables(spark, tmp_path):
    """Twelve orders of three lines, one line twice."""
    day = datetime.datetime(1997, 5, 2)
    lines = [(o, o + n, 1, n, 3.0, 10.0 * o + n, 0.01, 0.02, "RAN"[n - 1], day) for o in range(1, 13) for n in (1, 2, 3)]
    orders = [(o, o, f"{1 + o % 5}-PRIORITY", day) for o in range(1, 13)]
    made = {
        "lineitem": (lines + lines[:1], LINE),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate timestamp_ntz"),
        "part": ([(p, "TIN", 2, 90.0) for p in range(1, 16)], "p_partkey long, p_type string, p_size int, p_retailprice double"),
        "supplier": ([(1, 2)], "s_suppkey long, s_nationkey int"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_queries_on_staging_do_not_load_the_star(spark, tables):
    assert catalog.QUERIES["time_residual"](spark, tables).count() > 0
    store = catalog.staged_store(spark, tables)
    assert not store.exists("fact_training_run")
    assert catalog.star_store(spark, tables).root == store.root
    assert store.read("fact_training_run").count() == store.read("staging").count()


def test_audited_rows_are_not_sorted_by_validity(spark, tables):
    store = catalog.staged_store(spark, tables)
    assert not [n for n in store._names(store.path("audited")) if n.startswith("is_valid=")]
    audited = spark.read.parquet(store.path("audited"))
    assert audited.count() == 37
    assert audited.filter("is_valid").select("experiment_id").distinct().count() == store.read("staging").count()


def test_other_runs_go_before_steps_become_metrics(spark, tables):
    runs = adapter.tracked_runs(spark, tables).filter("experiment_name = 'experiment-1'")
    for make in (adapter.tracked_metrics, adapter.tracked_params):
        some = make(spark, tables, runs)
        whole = make(spark, tables).join(runs, "run_id", "left_semi")
        assert some.exceptAll(whole).isEmpty() and whole.exceptAll(some).isEmpty() and not some.isEmpty()
        plan = some._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate") < plan.index("LeftSemi")  # the join lies below


def test_merged_sources_are_counted_in_slices(spark, tables):
    merged = catalog.QUERIES["merge_sources"](spark, tables)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    counted = {(r.source_rank, r.source): (r.record_count, r.experiments) for r in merged.collect()}
    assert counted == {(0, "synthetic"): (24, 24), (1, "mlflow"): (13, 12)}


def test_text_is_read_as_a_number_once(spark):
    raw = spark.range(1).select(F.lit("32.0").alias("batch_size"), F.lit("7").alias("epochs"))
    plan = audit(raw.withColumn("id", F.rand().cast("string")))._jdf.queryExecution().analyzed().toString()
    assert plan.count("batch_size#") and plan.lower().count("rlike") == 2
    row = audit(raw.withColumn("epochs", F.lit("7.5"))).first()
    assert (row.batch_size, row.epochs) == (32, None) and "epochs:type" in row.errors


def test_located_cells_are_worked_out_once(spark, tmp_path, monkeypatch):
    start = datetime.datetime(2025, 3, 1)
    rows = [(f"m{n % 2}", "v1", float(n % 17), start + datetime.timedelta(minutes=n)) for n in range(200)]
    stored = spark.createDataFrame(rows, "model_name string, model_version string, latency_ms double, event_timestamp timestamp")
    panes, plans = metrics.LatencyPanes(str(tmp_path / "panes")), []
    panes(stored, 0)
    ranked = metrics.rank_values

    def watched(values, hits, keys):
        plans.append(hits._jdf.queryExecution().optimizedPlan().toString())
        return ranked(values, hits, keys)

    monkeypatch.setattr(metrics, "rank_values", watched)
    whole = {(r.window_start, r.model_name): r for r in panes.sliding(stored).collect()}
    assert plans and "Window" not in plans[0]  # a stored table
    one = whole[start, "m0"]
    values = sorted(float(n % 17) for n in range(0, 60, 2))
    assert one.event_count == 30 and one.p50_latency_ms == (values[14] + values[15]) / 2
