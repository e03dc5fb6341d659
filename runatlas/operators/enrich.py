"""Checks of recorded values against what the run's settings suggest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runatlas.functions.profiles import gpu_profiles, model_profiles
from runatlas.functions.scalars import (
    energy_kwh,
    expected_accuracy,
    expected_training_sec,
    f1,
    parameters_to_mb,
)


def _with_gpu(df: DataFrame) -> DataFrame:
    """The GPU's figures; a run on an unknown one keeps its row and gets null estimates."""
    return df.join(F.broadcast(gpu_profiles(df.sparkSession)), "gpu", "left")  # a fixed list


def _with_model(df: DataFrame) -> DataFrame:
    """The model's figures; a run of an unknown one keeps its row and gets null estimates."""
    return df.join(F.broadcast(model_profiles(df.sparkSession)), "model_name", "left")  # a fixed list


def f1_consistency(df: DataFrame) -> DataFrame:
    """Adds the F1 recomputed from precision and recall, and whether it agrees."""
    again = f1(F.col("precision"), F.col("recall"))
    return df.withColumn("f1_recomputed", again).withColumn(
        "f1_consistent", F.abs(F.col("f1_score") - F.col("f1_recomputed")) <= 1e-4 + 1e-9
    )


def energy_estimate(df: DataFrame) -> DataFrame:
    """Adds the energy that the GPU's power draw and the training time give."""
    kwh = energy_kwh(F.col("training_time_sec"), F.col("power_watts"))
    return _with_gpu(df).withColumn("estimated_kwh", kwh)


def time_residual(df: DataFrame) -> DataFrame:
    """Adds the expected training time and the ratio of actual to expected."""
    expected = expected_training_sec(F.col("epochs"), F.col("batch_size"), F.col("speed_factor"))
    return (
        _with_gpu(df)
        .withColumn("expected_time_sec", expected)
        .withColumn("time_ratio", F.col("training_time_sec") / F.col("expected_time_sec"))
    )


def accuracy_residual(df: DataFrame) -> DataFrame:
    """Adds the expected accuracy of successful runs and the distance from it."""
    curve = expected_accuracy(F.col("base_accuracy"), F.col("epochs"), F.col("learning_rate"))
    expected = F.when(F.col("base_accuracy").isNotNull(), curve)
    return (
        _with_model(df.filter(F.col("status") == "success"))
        .withColumn("expected_accuracy", expected)
        .withColumn("accuracy_residual", F.col("accuracy") - F.col("expected_accuracy"))
    )


def model_size(df: DataFrame, parameters: str) -> DataFrame:
    return df.withColumn("parameter_mb", parameters_to_mb(F.col(parameters)))
