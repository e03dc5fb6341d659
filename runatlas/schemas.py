"""Declared shapes of every table, and the constraints on a run record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One field of a run record: its type and the values it may take."""

    name: str
    dtype: T.DataType
    nullable: bool = False
    allowed: tuple[str, ...] = ()
    gt: float | None = None
    ge: float | None = None
    lt: float | None = None
    le: float | None = None
    default: str | None = None

    @property
    def bounded(self) -> bool:
        return any(b is not None for b in (self.gt, self.ge, self.lt, self.le))


# The vocabularies a record may use.
FRAMEWORKS = ("PyTorch", "TensorFlow", "JAX")
OPTIMIZERS = ("Adam", "AdamW", "SGD", "RMSprop")
SCHEDULERS = ("CosineAnnealing", "StepLR", "OneCycle", "Constant")
STATUSES = ("success", "failed", "running", "killed")
SOURCES = ("synthetic", "mlflow")

METRICS = ("accuracy", "precision", "recall", "f1_score", "loss", "validation_loss")
STATUSES_WITH_METRICS = ("success", "failed")

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()

RECORD_FIELDS = (
    Field("experiment_id", _S),
    Field("model_name", _S),
    Field("dataset", _S),
    Field("framework", _S, allowed=FRAMEWORKS),
    Field("researcher", _S),
    Field("optimizer", _S, allowed=OPTIMIZERS),
    Field("scheduler", _S, allowed=SCHEDULERS),
    Field("learning_rate", _D, gt=0, lt=1),
    Field("batch_size", _I, gt=0),
    Field("epochs", _I, gt=0),
    Field("gpu", _S),
    Field("cpu", _S),
    Field("ram_gb", _D, gt=0),
    Field("training_time_sec", _D, gt=0),
    Field("inference_time_ms", _D, gt=0),
    Field("model_size_mb", _D, gt=0),
    Field("energy_consumption_kwh", _D, ge=0),
    Field("accuracy", _D, nullable=True, ge=0, le=1),
    Field("precision", _D, nullable=True, ge=0, le=1),
    Field("recall", _D, nullable=True, ge=0, le=1),
    Field("f1_score", _D, nullable=True, ge=0, le=1),
    Field("loss", _D, nullable=True, ge=0),
    Field("validation_loss", _D, nullable=True, ge=0),
    Field("timestamp", T.TimestampType()),
    Field("status", _S, allowed=STATUSES),
    Field("source", _S, allowed=SOURCES, default="synthetic"),
    Field("mlflow_run_id", _S, nullable=True),
    Field("mlflow_experiment_name", _S, nullable=True),
)
RECORD_COLUMNS = tuple(f.name for f in RECORD_FIELDS)
RECORD_SCHEMA = T.StructType([T.StructField(f.name, f.dtype) for f in RECORD_FIELDS])

EVENT_FIELDS = (
    Field("model_name", _S),
    Field("model_version", _S),
    Field("prediction", _D),
    Field("ground_truth", _D, nullable=True),
    Field("latency_ms", _D, ge=0),
    Field("event_timestamp", T.TimestampType()),
)
EVENT_COLUMNS = tuple(f.name for f in EVENT_FIELDS)

# The event log carries every field as text, plus the id the log assigned.
EVENT_LOG_SCHEMA = T.StructType(
    [T.StructField("stream_entry_id", _S)] + [T.StructField(f.name, _S) for f in EVENT_FIELDS]
)
PREDICTION_SCHEMA = T.StructType(
    [T.StructField("stream_entry_id", _S)]
    + [T.StructField(f.name, f.dtype) for f in EVENT_FIELDS]
    + [T.StructField("ingested_at", T.TimestampType())]
)

DIMENSIONS: dict[str, tuple[str, tuple[str, ...], dict[str, str]]] = {
    # table: (surrogate key, natural key, attributes and natural columns by their staging name)
    "dim_model": ("model_key", ("model_name",), {"model_name": "model_name"}),
    "dim_dataset": ("dataset_key", ("dataset_name",), {"dataset_name": "dataset"}),
    "dim_hardware": (
        "hardware_key",
        ("gpu", "cpu", "ram_gb"),
        {"gpu": "gpu", "cpu": "cpu", "ram_gb": "ram_gb"},
    ),
    "dim_framework": (
        "framework_key",
        ("framework", "optimizer", "scheduler"),
        {"framework": "framework", "optimizer": "optimizer", "scheduler": "scheduler"},
    ),
    "dim_researcher": ("researcher_key", ("researcher_name",), {"researcher_name": "researcher"}),
    "dim_experiment": (
        "experiment_key",
        ("experiment_id",),
        {
            "experiment_id": "experiment_id",
            "learning_rate": "learning_rate",
            "batch_size": "batch_size",
            "epochs": "epochs",
            "source": "source",
            "mlflow_run_id": "mlflow_run_id",
            "mlflow_experiment_name": "mlflow_experiment_name",
        },
    ),
}

FACT_KEYS = (
    "experiment_key",
    "model_key",
    "dataset_key",
    "hardware_key",
    "framework_key",
    "researcher_key",
)
FACT_MEASURES = (
    "training_time_sec",
    "inference_time_ms",
    "model_size_mb",
    "energy_consumption_kwh",
) + METRICS

VIEW_NAMES = (
    "vw_executive_kpis",
    "vw_model_leaderboard",
    "vw_dataset_comparison",
    "vw_framework_comparison",
    "vw_gpu_performance",
    "vw_hyperparameter_analysis",
    "vw_training_timeline",
    "vw_experiment_source_breakdown",
)
