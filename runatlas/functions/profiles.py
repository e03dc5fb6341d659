"""Reference figures per model and per GPU."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values: (model_name, base_accuracy).
MODEL_PROFILES = (
    ("resnet18", 0.90),
    ("resnet50", 0.94),
    ("resnet101", 0.95),
    ("vit_base", 0.96),
    ("vit_large", 0.97),
    ("bert_base", 0.91),
    ("bert_large", 0.93),
    ("gpt2_small", 0.88),
    ("efficientnet_b0", 0.89),
    ("efficientnet_b7", 0.95),
    ("mobilenet_v3", 0.85),
    ("yolo_v8", 0.92),
)

# Fixed values: (gpu, speed_factor, power_watts).
GPU_PROFILES = (
    ("NVIDIA T4", 1.0, 70.0),
    ("NVIDIA RTX 3090", 2.2, 350.0),
    ("NVIDIA RTX 4090", 3.0, 450.0),
    ("NVIDIA V100", 2.5, 300.0),
    ("NVIDIA A100", 4.0, 400.0),
    ("NVIDIA H100", 6.0, 700.0),
)


def model_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        MODEL_PROFILES, "model_name string, base_accuracy double"
    )


def gpu_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        GPU_PROFILES, "gpu string, speed_factor double, power_watts double"
    )
