"""The analytical views over the star schema.

Where a view groups by a dimension whose natural key is unique, the fact table
is grouped by the surrogate key first and the few groups are joined to the
dimension afterwards: only keys and partial sums are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from runatlas.functions.scalars import half_up, learning_rate_bucket, percent, settled
from runatlas.operators.ordering import with_rank
from runatlas.schemas import VIEW_NAMES
from runatlas.sources.tables import TableStore


@dataclass(frozen=True)
class Star:
    """The tables of the star schema."""

    fact: DataFrame
    dim_model: DataFrame
    dim_dataset: DataFrame
    dim_hardware: DataFrame
    dim_framework: DataFrame
    dim_researcher: DataFrame
    dim_experiment: DataFrame
    dim_date: DataFrame

    @classmethod
    def load(cls, store: TableStore) -> Star:
        names = [f for f in cls.__dataclass_fields__ if f != "fact"]
        return cls(store.read("fact_training_run"), **{n: store.read(n) for n in names})


def _runs() -> Column:
    return F.count(F.lit(1)).alias("total_runs")


def _when_success(column: str) -> Column:
    return F.when(F.col("status") == "success", F.col(column))


def _success_avg(column: str, alias: str | None = None) -> Column:
    return F.avg(_when_success(column)).alias(alias or f"avg_{column}")


def _successes() -> Column:
    return F.count_if(F.col("status") == "success").alias("successful_runs")


def _failures() -> Column:
    return F.count_if(F.col("status") == "failed").alias("failed_runs")


def _rounded(digits: dict[str, int]) -> dict[str, Column]:
    return {c: half_up(F.col(c), d) for c, d in digits.items()}


def executive_kpis(star: Star) -> DataFrame:
    totals = star.fact.agg(
        _success_avg("accuracy"),
        _success_avg("f1_score"),
        (F.sum("training_time_sec") / 3600.0).alias("total_training_hours"),
        F.sum("energy_consumption_kwh").alias("total_energy_kwh"),
        _runs(),
        _failures(),
        F.count_if(F.col("status") == "running").alias("running_runs"),
    )
    digits = {
        "avg_accuracy": 4,
        "avg_f1_score": 4,
        "total_training_hours": 2,
        "total_energy_kwh": 2,
    }
    return totals.select(
        *[half_up(F.col(c), d).alias(c) for c, d in digits.items()],
        "total_runs",
        "failed_runs",
        percent(F.col("failed_runs"), F.col("total_runs")).alias("failure_rate_pct"),
        "running_runs",
    )


def model_leaderboard(star: Star) -> DataFrame:
    """Models by mean accuracy of their successful runs; one without any ranks first."""
    by_key = star.fact.groupBy("model_key").agg(
        _runs(), _successes(), *[_success_avg(c) for c in ("accuracy", "f1_score", "loss")]
    )
    named = by_key.join(star.dim_model, "model_key").drop("model_key")
    ranked = with_rank(named, settled(F.col("avg_accuracy")), "accuracy_rank")
    return ranked.withColumns(
        _rounded({"avg_accuracy": 4, "avg_f1_score": 4, "avg_loss": 4})
    ).select(
        "model_name",
        "total_runs",
        "successful_runs",
        "avg_accuracy",
        "avg_f1_score",
        "avg_loss",
        "accuracy_rank",
    )


def dataset_comparison(star: Star) -> DataFrame:
    by_key = star.fact.groupBy("dataset_key").agg(
        _runs(), _failures(), _success_avg("accuracy"), _success_avg("training_time_sec")
    )
    return by_key.join(star.dim_dataset, "dataset_key").select(
        "dataset_name",
        "total_runs",
        half_up(F.col("avg_accuracy"), 4).alias("avg_accuracy"),
        half_up(F.col("avg_training_time_sec"), 2).alias("avg_training_time_sec"),
        percent(F.col("failed_runs"), F.col("total_runs")).alias("failure_rate_pct"),
    )


def framework_comparison(star: Star) -> DataFrame:
    by_key = star.fact.groupBy("framework_key").agg(
        _runs(), _success_avg("accuracy"), _success_avg("training_time_sec")
    )
    return by_key.join(star.dim_framework, "framework_key").select(
        "framework",
        "optimizer",
        "scheduler",
        "total_runs",
        half_up(F.col("avg_accuracy"), 4).alias("avg_accuracy"),
        half_up(F.col("avg_training_time_sec"), 2).alias("avg_training_time_sec"),
    )


def gpu_performance(star: Star) -> DataFrame:
    """Energy and inference time over all runs, training time and accuracy over successes."""
    # A GPU spans several hardware keys, so sums and counts are carried to it.
    measures = {
        "training_time_sec": _when_success("training_time_sec"),
        "energy_kwh": F.col("energy_consumption_kwh"),
        "accuracy": _when_success("accuracy"),
        "inference_time_ms": F.col("inference_time_ms"),
    }
    by_key = star.fact.groupBy("hardware_key").agg(
        _runs(),
        *[F.sum(c).alias(f"{n}_sum") for n, c in measures.items()],
        *[F.count(c).alias(f"{n}_n") for n, c in measures.items()],
    )
    digits = {"training_time_sec": 2, "energy_kwh": 4, "accuracy": 4, "inference_time_ms": 3}

    def mean(name: str) -> Column:
        total = F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0))
        return half_up(total, digits[name]).alias(f"avg_{name}")

    return (
        by_key.join(star.dim_hardware, "hardware_key")
        .groupBy("gpu")
        .agg(F.sum("total_runs").alias("total_runs"), *[mean(n) for n in digits])
    )


def hyperparameter_analysis(star: Star) -> DataFrame:
    """Learning-rate decades by batch size; epochs over all runs."""
    runs = star.fact.select("experiment_key", "status", "accuracy").join(
        star.dim_experiment.select(
            "experiment_key",
            learning_rate_bucket(F.col("learning_rate")).alias("learning_rate_bucket"),
            "batch_size",
            "epochs",
        ),
        "experiment_key",
    )
    return (
        runs.groupBy("learning_rate_bucket", "batch_size")
        .agg(_runs(), _success_avg("accuracy"), F.avg("epochs").alias("avg_epochs"))
        .withColumns(_rounded({"avg_accuracy": 4, "avg_epochs": 1}))
        .orderBy("learning_rate_bucket", "batch_size")
    )


def training_timeline(star: Star) -> DataFrame:
    """Runs per day and the mean daily accuracy over the last seven days that had runs."""
    daily = (
        star.fact.groupBy("date_key")
        .agg(F.count(F.lit(1)).alias("runs_count"), _success_avg("accuracy", "daily_avg_accuracy"))
        .join(star.dim_date.select("date_key", "full_date"), "date_key")
    )
    # One row per calendar day at most, so one task holds the window.
    week = Window.orderBy("full_date").rowsBetween(-6, 0)
    rolling = F.avg("daily_avg_accuracy").over(week)
    return daily.select(
        "full_date",
        "runs_count",
        half_up(F.col("daily_avg_accuracy"), 4).alias("daily_avg_accuracy"),
        half_up(rolling, 4).alias("rolling_7day_avg_accuracy"),
    ).orderBy("full_date")


def source_breakdown(star: Star) -> DataFrame:
    """Runs by origin. The origin is one of a fixed list, so one task ranks them."""
    runs = star.fact.select(
        "experiment_key", "status", "accuracy", "training_time_sec", "run_timestamp"
    ).join(star.dim_experiment.select("experiment_key", "source"), "experiment_key")
    grouped = runs.groupBy("source").agg(
        _runs(),
        _successes(),
        _success_avg("accuracy"),
        F.avg("training_time_sec").alias("avg_training_time_sec"),
        F.min("run_timestamp").alias("earliest_run"),
        F.max("run_timestamp").alias("latest_run"),
    )
    best_first = Window.orderBy(settled(F.col("avg_accuracy")).desc_nulls_first())
    return grouped.withColumn("accuracy_rank", F.rank().over(best_first).cast("long")).withColumns(
        _rounded({"avg_accuracy": 4, "avg_training_time_sec": 2})
    )


VIEWS: dict[str, Callable[[Star], DataFrame]] = dict(
    zip(
        VIEW_NAMES,
        (
            executive_kpis,
            model_leaderboard,
            dataset_comparison,
            framework_comparison,
            gpu_performance,
            hyperparameter_analysis,
            training_timeline,
            source_breakdown,
        ),
        strict=True,
    )
)


def register_views(star: Star) -> tuple[str, ...]:
    """Create or replace all views; safe to call again."""
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)
    return tuple(VIEWS)


def missing_views(spark: SparkSession, expected: tuple[str, ...] = VIEW_NAMES) -> DataFrame:
    """Expected views that the catalog does not have."""
    wanted = spark.createDataFrame([(n,) for n in expected], "view_name string")
    present = spark.sql("SHOW VIEWS").select(F.col("viewName").alias("view_name"))
    return wanted.subtract(present)
