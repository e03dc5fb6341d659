"""Run-tracking tables (runs, params, metrics) turned into run records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runatlas.functions.coerce import to_double

from runatlas.schemas import RECORD_COLUMNS

# Tracking status -> record status; any other status counts as running.
STATUS_OF = {
    "FINISHED": "success",
    "FAILED": "failed",
    "KILLED": "killed",
    "RUNNING": "running",
    "SCHEDULED": "running",
}

# Fixed values: (record column, parameter, default).
TEXT_PARAMS = (
    ("model_name", "model_name", "unknown_model"),
    ("dataset", "dataset", "unknown_dataset"),
    ("framework", "framework", "PyTorch"),
    ("researcher", "researcher", "unknown"),
    ("optimizer", "optimizer", "Adam"),
    ("scheduler", "scheduler", "Constant"),
    ("gpu", "sys_gpu_name", "none"),
    ("cpu", "sys_cpu_name", "unknown"),
)
DOUBLE_PARAMS = (("learning_rate", "learning_rate", 0.001), ("ram_gb", "sys_ram_gb", 0.0))
INT_PARAMS = (("batch_size", "batch_size", 32), ("epochs", "epochs", 1))

# Fixed values: (record column, metric).
POSITIVE_METRICS = (
    ("training_time_sec", "training_duration_sec"),
    ("inference_time_ms", "inference_latency_ms"),
    ("model_size_mb", "model_size_mb"),
)
QUALITY_METRICS = (
    ("accuracy", "accuracy"),
    ("precision", "precision"),
    ("recall", "recall"),
    ("f1_score", "f1"),
    ("loss", "training_loss"),
    ("validation_loss", "validation_loss"),
)
SMALLEST = 0.001


def record_status(status: Column) -> Column:
    pairs = [F.lit(part) for pair in STATUS_OF.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), status), F.lit("running"))


def last_metric_values(metrics: DataFrame) -> DataFrame:
    """The value logged last for every (run, metric)."""
    latest = F.max_by("value", F.struct("step", "ts", "value"))
    return metrics.groupBy("run_id", "key").agg(latest.alias("value"))


def wide_params(params: DataFrame) -> DataFrame:
    """One row per run with a ``p_`` column per known parameter."""
    known = [p for _, p, _ in TEXT_PARAMS + DOUBLE_PARAMS + INT_PARAMS]
    return (
        params.filter(F.col("key").isin(*known))
        .groupBy("run_id")
        .agg(*[F.max(F.when(F.col("key") == p, F.col("value"))).alias(f"p_{p}") for p in known])
    )


def wide_metrics(metrics: DataFrame) -> DataFrame:
    """One row per run with an ``m_`` column per known metric: its last value.

    Steps are cut to one value per (run, metric) first, so a run with very
    many steps does not weigh on one task.
    """
    known = [m for _, m in POSITIVE_METRICS + QUALITY_METRICS]
    last = last_metric_values(metrics.filter(F.col("key").isin(*known)))
    return last.groupBy("run_id").agg(
        *[F.max(F.when(F.col("key") == m, F.col("value"))).alias(f"m_{m}") for m in known]
    )


def runs_to_records(
    runs: DataFrame, params: DataFrame, metrics: DataFrame, experiment_name: str, as_of: Column
) -> DataFrame:
    """Record-shaped rows for all runs of one experiment; none if it is unknown.

    A run without start time takes ``as_of``. A parameter that does not read as
    a number comes out null, so that validation rejects the record.
    """
    chosen = runs.filter(F.col("experiment_name") == experiment_name)
    ids = chosen.select("run_id")
    # Rows of other experiments go before anything is grouped.
    joined = chosen.join(
        wide_params(params.join(ids, "run_id", "left_semi")), "run_id", "left"
    ).join(wide_metrics(metrics.join(ids, "run_id", "left_semi")), "run_id", "left")
    status = record_status(F.col("status"))
    measured = status.isin("success", "failed")

    def number(param: str, default: float) -> Column:
        raw = f"p_{param}"
        return F.when(F.col(raw).isNull(), F.lit(float(default))).otherwise(F.expr(to_double(raw, T.StringType())))

    columns: dict[str, Column] = {
        "experiment_id": F.concat(F.lit("mlflow_"), F.substring("run_id", 1, 16)),
        **{c: F.coalesce(F.col(f"p_{p}"), F.lit(d)) for c, p, d in TEXT_PARAMS},
        **{c: number(p, d) for c, p, d in DOUBLE_PARAMS},
        **{c: number(p, d).try_cast("int") for c, p, d in INT_PARAMS},
        "energy_consumption_kwh": F.lit(0.0),
        "timestamp": F.coalesce(F.timestamp_millis(F.nullif("start_time", F.lit(0))), as_of),
        "status": status,
        "source": F.lit("mlflow"),
        "mlflow_run_id": F.col("run_id"),
        "mlflow_experiment_name": F.col("experiment_name"),
    }
    for column, metric in POSITIVE_METRICS:
        value = F.coalesce(F.col(f"m_{metric}"), F.lit(0.0))
        columns[column] = F.when(value == 0, F.lit(SMALLEST)).otherwise(value)
    for column, metric in QUALITY_METRICS:
        columns[column] = F.when(measured, F.coalesce(F.col(f"m_{metric}"), F.lit(0.0)))
    return joined.select(*[columns[c].alias(c) for c in RECORD_COLUMNS])
