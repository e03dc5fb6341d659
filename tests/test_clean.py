import pytest
from pyspark.sql import functions as F

from runatlas.operators import clean
from runatlas.schemas import METRICS, RECORD_SCHEMA


@pytest.fixture
def frame(spark, record):
    def make(*changes):
        rows = []
        for i, c in enumerate(changes):
            row = record(**{"experiment_id": f"e{i}", **c})
            row.setdefault("source", "synthetic")
            rows.append({f.name: row.get(f.name) for f in RECORD_SCHEMA.fields} | {"seq": i})
        df = spark.createDataFrame(
            [tuple(r.values()) for r in rows],
            RECORD_SCHEMA.simpleString()[7:-1].replace("timestamp:timestamp", "timestamp:string")
            + ",seq:int",
        )
        return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))

    return make


def test_first_occurrence_stays(frame):
    df = frame({"experiment_id": "x", "epochs": 2}, {"experiment_id": "x", "epochs": 3}, {"experiment_id": "y"})
    kept = clean.deduplicate(df, [F.col("seq")]).orderBy("seq").collect()
    assert [(r.experiment_id, r.seq) for r in kept] == [("x", 0), ("y", 2)]


def test_median_per_status(frame):
    df = frame(
        {"accuracy": 0.2},
        {"accuracy": 0.4},
        {"accuracy": 0.9},
        {"accuracy": 0.7},
        {"accuracy": None},
        {"status": "failed", "accuracy": 0.1},
        {"status": "failed", "accuracy": None},
        {"status": "killed", "accuracy": None},
    )
    rows = clean.handle_missing_metrics(df, "median").orderBy("seq").collect()
    assert rows[4].accuracy == pytest.approx(0.55)
    assert rows[6].accuracy == 0.1
    assert rows[7].accuracy is None
    assert [f.name for f in RECORD_SCHEMA.fields] + ["seq"] == list(rows[0].asDict())


def test_status_without_values_stays_null(frame):
    df = frame({"status": "failed", "loss": None}, {"loss": 0.3})
    rows = clean.handle_missing_metrics(df, "median").orderBy("seq").collect()
    assert rows[0].loss is None


@pytest.mark.parametrize("metric", METRICS)
def test_drop_flag_and_count(frame, metric):
    df = frame({}, {metric: None}, {"status": "running", metric: None})
    assert clean.handle_missing_metrics(df, "drop").count() == 2
    flags = clean.handle_missing_metrics(df, "flag").orderBy("seq").collect()
    assert [r.data_quality_flag for r in flags] == [False, True, False]
    assert clean.missing_metrics_count(df).first().affected_rows == 1


def test_unknown_strategy(frame):
    with pytest.raises(ValueError, match="unknown strategy"):
        clean.clean(frame({}), [F.col("seq")], "mean")
