"""Alert rows; delivery is left to whatever reads the alert table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runatlas.operators.drift import THRESHOLD

# Severity -> log level.
LOG_LEVELS = {"info": "INFO", "warning": "WARNING", "critical": "ERROR"}


def alert_rows(messages: DataFrame, severity: str, platform: str = "Model Monitoring") -> DataFrame:
    """Severity, log level and payload for rows that have a ``message``."""
    if severity not in LOG_LEVELS:
        raise ValueError(f"unknown severity {severity!r}; choose one of {', '.join(LOG_LEVELS)}")
    text = F.concat(F.lit(f"[{severity.upper()}] {platform}: "), F.col("message"))
    return messages.withColumns(
        {
            "severity": F.lit(severity),
            "log_level": F.lit(LOG_LEVELS[severity]),
            "payload": F.to_json(F.struct(text.alias("text"))),
        }
    )


def drift_message(threshold: float) -> Column:
    return F.format_string(
        f"Drift detected for %s/%s: PSI=%s (threshold={threshold}, baseline_n=%d, recent_n=%d)",
        "model_name",
        "model_version",
        F.col("psi").cast("string"),
        "baseline_n",
        "recent_n",
    )


def drift_alerts(results: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One warning per drifted model."""
    drifted = results.filter("is_drifted").withColumn("message", drift_message(threshold))
    return alert_rows(drifted, "warning").select(
        "model_name", "model_version", "psi", "severity", "log_level", "message", "payload"
    )
