import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from runatlas.session import get_spark

    session = get_spark(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def record():
    """One valid raw record; keyword arguments change or (``...``) remove fields."""

    def make(**changes):
        base = {
            "experiment_id": "run-7f3a",
            "model_name": "yolo_v8",
            "dataset": "street_scenes_v2",
            "framework": "JAX",
            "researcher": "Researcher#4",
            "optimizer": "SGD",
            "scheduler": "StepLR",
            "learning_rate": 0.025,
            "batch_size": 96,
            "epochs": 34,
            "gpu": "NVIDIA V100",
            "cpu": "CPU#3",
            "ram_gb": 128.0,
            "training_time_sec": 812.25,
            "inference_time_ms": 4.75,
            "model_size_mb": 52.5,
            "energy_consumption_kwh": 0.068,
            "accuracy": 0.71,
            "precision": 0.69,
            "recall": 0.73,
            "f1_score": 0.7094,
            "loss": 1.31,
            "validation_loss": 1.47,
            "timestamp": "2025-02-11T07:45:30+00:00",
            "status": "success",
        }
        base.update(changes)
        return {k: v for k, v in base.items() if v is not ...}

    return make
