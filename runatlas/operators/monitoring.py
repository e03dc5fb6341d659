"""Queries over the prediction events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runatlas.operators.drift import MODEL
from runatlas.operators.quantiles import quantile_summary

#: The quantiles of the latency views.
TAILS = {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95}


def latest_minus(events: DataFrame, minutes: int) -> Column:
    """Start of the trailing window that ends at the newest event.

    A scalar subquery: Spark runs it first and gives the scan a plain bound.
    """
    bound = F.max("event_timestamp") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return events.agg(bound).scalar()


def trailing(events: DataFrame, cutoff: Column) -> DataFrame:
    return events.filter(F.col("event_timestamp") >= cutoff)


def recent_predictions(events: DataFrame, cutoff: Column, limit: int = 5000) -> DataFrame:
    """The newest ``limit`` events of the window; ties go to the higher entry id."""
    return (
        trailing(events, cutoff)
        .orderBy(F.desc("event_timestamp"), F.desc("stream_entry_id"))
        .limit(limit)
    )


def monitored_models(events: DataFrame) -> DataFrame:
    """Every model version with its events and its latest one, newest first."""
    return (
        events.groupBy(*MODEL)
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.max("event_timestamp").alias("latest_event"),
        )
        .orderBy(F.desc("latest_event"))
    )


def allow_listed(events: DataFrame, pairs: str) -> DataFrame:
    """Events of the models named in ``"name:version,name:version"``.

    Blanks and entries without a colon are skipped; a version may hold colons.
    """
    listed = (
        events.sparkSession.range(1)
        .select(F.explode(F.split(F.lit(pairs), ",")).alias("entry"))
        .select(F.trim("entry").alias("entry"))
        .filter(F.col("entry").contains(":"))
        .select(F.split("entry", ":", 2).alias("part"))
        .select(*[F.col("part")[i].alias(c) for i, c in enumerate(MODEL)])
    )
    # The list comes from a setting, so its size does not grow with the events.
    return events.join(F.broadcast(listed), list(MODEL), "left_semi")


def latency_summary(events: DataFrame, cutoff: Column) -> DataFrame:
    """Per model version: events, mean, median and 95th percentile of the latency."""
    window = trailing(events, cutoff).select(*MODEL, "latency_ms")
    return quantile_summary(window, MODEL, "latency_ms", TAILS, "event_count", "avg_latency_ms").orderBy(*MODEL)


def volume_per_minute(events: DataFrame) -> DataFrame:
    """Events per minute and model; minutes without events have no row."""
    return events.groupBy(
        F.date_trunc("minute", "event_timestamp").alias("minute"), "model_name"
    ).agg(F.count(F.lit(1)).alias("event_count"))


def latest_labels(labels: DataFrame) -> DataFrame:
    """One label per entry: that with the newest ``label_timestamp``, if there is such a column, else the largest."""
    newest = ["label_timestamp", "label"] if "label_timestamp" in labels.columns else ["label"]
    return labels.groupBy("stream_entry_id").agg(F.max(F.struct(*newest))["label"].alias("label"))


def with_late_labels(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Fill missing truths from label rows; every event stays one row, however many labels it has."""
    return (
        events.join(latest_labels(labels), "stream_entry_id", "left")
        .withColumn("ground_truth", F.coalesce("ground_truth", "label"))
        .drop("label")
    )


def daily_rollup(events: DataFrame) -> DataFrame:
    """Per day and model version: events, labelled events, mean error and mean latency."""
    error = F.abs(F.col("prediction") - F.col("ground_truth"))
    return events.groupBy(F.to_date("event_timestamp").alias("event_date"), *MODEL).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count("ground_truth").alias("labelled_count"),
        F.avg(error).alias("mean_abs_error"),
        F.avg("latency_ms").alias("avg_latency_ms"),
    )
