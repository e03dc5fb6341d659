import pytest
from pyspark.sql import functions as F

from runatlas.operators import evaluate
from runatlas.operators.tracking import runs_to_records
from runatlas.operators.validate import audit

AS_OF = "2024-01-01 00:00:00"
RUNS = [
    ("a" * 32, "exp", "FINISHED", 1_700_000_000_000),
    ("b" * 32, "exp", "SCHEDULED", None),
    ("c" * 32, "exp", "FAILED", 1_700_000_000_000),
    ("d" * 32, "exp", "PAUSED", 0),
    ("e" * 32, "other", "FINISHED", 1_700_000_000_000),
]
PARAMS = [(r[0], k, v) for r in RUNS for k, v in (("model_name", "cnn"), ("batch_size", "64.0"))]
PARAMS += [(r[0], "sys_ram_gb", "16") for r in RUNS[:2]]
METRICS = [
    ("a" * 32, "accuracy", 0.5, 1, 10),
    ("a" * 32, "accuracy", 0.8, 2, 5),
    ("a" * 32, "accuracy", 0.7, 2, 6),
    ("a" * 32, "training_duration_sec", 0.0, 0, 1),
    ("a" * 32, "model_size_mb", -1.0, 0, 1),
    ("b" * 32, "accuracy", 0.9, 1, 1),
]


@pytest.fixture
def found(spark):
    def make(name):
        return runs_to_records(
            spark.createDataFrame(RUNS, "run_id string, experiment_name string, status string, start_time long"),
            spark.createDataFrame(PARAMS, "run_id string, key string, value string"),
            spark.createDataFrame(METRICS, "run_id string, key string, value double, step int, ts long"),
            name,
            F.lit(AS_OF).cast("timestamp"),
        )

    return make


def test_records(found):
    rows = {r.mlflow_run_id[0]: r for r in found("exp").collect()}
    assert set(rows) == set("abcd")
    a, b, c, d = (rows[k] for k in "abcd")
    assert a.experiment_id == "mlflow_" + "a" * 16
    assert (a.status, b.status, c.status, d.status) == ("success", "running", "failed", "running")
    assert a.accuracy == 0.7  # the later of the two values at the last step
    assert (a.training_time_sec, a.model_size_mb, a.batch_size, a.epochs) == (0.001, -1.0, 64, 1)
    assert b.accuracy is None and c.accuracy == 0.0 and a.recall == 0.0
    assert str(b.timestamp) == str(d.timestamp) == AS_OF
    assert (a.dataset, a.gpu, a.scheduler, a.source) == ("unknown_dataset", "none", "Constant", "mlflow")


def test_records_pass_through_validation(found):
    errors = {r.mlflow_run_id[0]: r.errors for r in audit(found("exp")).collect()}
    assert errors["b"] == []
    assert errors["a"] == ["model_size_mb:range"]
    assert errors["c"] == ["ram_gb:range"]


def test_unknown_experiment_has_no_records(found):
    assert found("absent").count() == 0


def test_macro_scores(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)]
    df = spark.createDataFrame(pairs, "t int, p int")
    row = evaluate.macro_precision_recall_f1(df, "t", "p", 4).first()
    precision = (1 / 2 + 2 / 3 + 0 + 0) / 4
    recall = (1 / 2 + 1 + 0 + 0) / 4
    assert row.macro_precision == pytest.approx(precision)
    assert row.macro_recall == pytest.approx(recall)
    assert row.macro_f1 == pytest.approx(2 * precision * recall / (precision + recall))
    none = evaluate.macro_precision_recall_f1(df.filter("t = 2"), "t", "p", 4).first()
    assert none.macro_f1 == 0.0
