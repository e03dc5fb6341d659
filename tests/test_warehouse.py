import pytest
from pyspark.sql import functions as F

from runatlas.operators.dimensions import calendar
from runatlas.operators.fact import attach_keys, out_of_calendar, unresolved_count
from runatlas.operators.validate import audit, records
from runatlas.plans import views
from runatlas.plans.pipeline import Settings, load_calendar, run_pipeline
from runatlas.schemas import DIMENSIONS, VIEW_NAMES
from runatlas.sources.tables import TableStore

ORDER = ["seq"]


@pytest.fixture
def raw(spark, record):
    def make(*changes):
        rows = [record(**{"experiment_id": f"e{i}", "seq": i, **c}) for i, c in enumerate(changes)]
        columns = sorted({k for r in rows for k in r} | {"accuracy", "loss"})
        schema = ", ".join(f"`{c}` {'int' if c == 'seq' else 'string'}" for c in columns)
        data = [tuple(r.get(c) if c == "seq" or r.get(c) is None else str(r.get(c)) for c in columns) for r in rows]
        return spark.createDataFrame(data, schema)

    return make


def test_pipeline_end_to_end(spark, raw, tmp_path):
    runs = raw(
        {"accuracy": 0.9},
        {"accuracy": 0.8, "model_name": "vit_base"},
        {"model_name": "alexnet", "status": "failed"},
        {"model_name": "vit_base", "status": "running", "accuracy": None},
        {"experiment_id": "e0", "accuracy": 0.1},
        {"framework": "Keras"},
    )
    root = str(tmp_path / "w")
    star = run_pipeline(spark, runs, ORDER, root)
    assert star.fact.count() == 4
    board = {r.model_name: r for r in spark.table("vw_model_leaderboard").collect()}
    # A model without a successful run comes first.
    assert {m: r.accuracy_rank for m, r in board.items()} == {"alexnet": 1, "yolo_v8": 2, "vit_base": 3}
    assert board["alexnet"].avg_accuracy is None and board["yolo_v8"].avg_accuracy == 0.9
    kpis = spark.table("vw_executive_kpis").first()
    assert (kpis.total_runs, kpis.failed_runs, kpis.running_runs) == (4, 1, 1)
    assert kpis.failure_rate_pct == 25.0 and kpis.avg_accuracy == 0.85
    assert TableStore(spark, root).read("dim_date").count() == 4018
    assert spark.read.json(root + "/rejects").count() == 1


def test_keys_survive_a_second_load(spark, raw, tmp_path):
    root = str(tmp_path / "w")
    store = TableStore(spark, root)
    settings = Settings(skip_views=True)
    run_pipeline(spark, raw({}, {"model_name": "vit_base"}), ORDER, root, settings)
    before = {t: {tuple(r) for r in store.read(t).collect()} for t in DIMENSIONS}
    changed = raw({"epochs": 99}, {"model_name": "alexnet", "gpu": "NVIDIA T4"}, {})
    run_pipeline(spark, changed, ORDER, root, settings)
    for table, (key, _, _) in DIMENSIONS.items():
        rows = store.read(table).collect()
        assert before[table] <= {tuple(r) for r in rows}, table
        assert len({r[key] for r in rows}) == len(rows)
    models = {r.model_name for r in store.read("dim_model").collect()}
    assert models == {"yolo_v8", "vit_base", "alexnet"}
    assert store.read("fact_training_run").count() == 3
    assert store.read("dim_date").count() == 4018


def test_nothing_valid_stops_before_staging(spark, raw, tmp_path):
    root = str(tmp_path / "w")
    assert run_pipeline(spark, raw({"framework": "Keras"}), ORDER, root) is None
    assert not TableStore(spark, root).exists("staging")


def test_empty_staging_stops_before_the_warehouse(spark, raw, tmp_path):
    root = str(tmp_path / "w")
    store = TableStore(spark, root)
    store.overwrite(records(audit(raw({}))).limit(0), "staging")
    assert run_pipeline(spark, None, ORDER, root, Settings(skip_etl=True)) is None
    assert not store.exists("fact_training_run")


def test_skipped_stages_use_earlier_tables(spark, raw, tmp_path):
    root = str(tmp_path / "w")
    run_pipeline(spark, raw({}, {}), ORDER, root)
    star = run_pipeline(spark, None, ORDER, root, Settings(skip_etl=True, skip_warehouse=True))
    assert star.fact.count() == 2


def test_unresolved_and_out_of_calendar(spark, raw, tmp_path):
    root = str(tmp_path / "w")
    runs = raw({}, {"model_name": "vit_base"}, {"timestamp": "1999-12-31T23:00:00"})
    star = run_pipeline(spark, runs, ORDER, root)
    store = TableStore(spark, root)
    dims = {t: store.read(t) for t in DIMENSIONS}
    dims["dim_model"] = dims["dim_model"].filter("model_name <> 'vit_base'")
    assert tuple(unresolved_count(attach_keys(store.read("staging"), dims)).first()) == (1, 2)
    assert [tuple(r) for r in out_of_calendar(star.fact, star.dim_date).collect()] == [(19991231, 1)]
    assert views.training_timeline(star).count() == 1


def test_rolling_average_counts_rows_not_days(spark, raw, tmp_path):
    days = [1, 2, 3, 4, 5, 6, 7, 20]
    runs = raw(*[{"timestamp": f"2024-03-{d:02}T00:00:00", "accuracy": i / 10} for i, d in enumerate(days)])
    star = run_pipeline(spark, runs, ORDER, str(tmp_path / "w"), Settings(skip_views=True))
    rows = views.training_timeline(star).collect()
    assert [r.rolling_7day_avg_accuracy for r in rows] == [0.0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4]


def test_views_exist_and_apply_twice(spark, raw, tmp_path):
    star = run_pipeline(spark, raw({}), ORDER, str(tmp_path / "w"))
    assert views.register_views(star) == VIEW_NAMES
    assert views.missing_views(spark).count() == 0
    assert views.missing_views(spark, (*VIEW_NAMES, "vw_other")).first().view_name == "vw_other"


def test_calendar_rows(spark, tmp_path):
    days = calendar(spark, "2024-02-28", "2024-03-02").orderBy("date_key").collect()
    assert [r.date_key for r in days] == [20240228, 20240229, 20240301, 20240302]
    saturday = days[3]
    assert (saturday.day_of_week, saturday.day_name, saturday.is_weekend) == (5, "Saturday", True)
    assert (saturday.month_name, saturday.quarter) == ("March", 1)
    store = TableStore(spark, str(tmp_path / "c"))
    load_calendar(store, "2024-01-01", "2024-01-10")
    assert load_calendar(store, "2024-01-05", "2024-01-20").count() == 20


def test_aggregation_happens_below_the_dimension_join(spark, raw, tmp_path):
    star = run_pipeline(spark, raw({}, {}), ORDER, str(tmp_path / "w"), Settings(skip_views=True))
    plan = views.dataset_comparison(star)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")
