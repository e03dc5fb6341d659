"""Cleaning of valid records: duplicates and unexpectedly missing metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runatlas.operators.keyed import keep_first
from runatlas.operators.quantiles import exact_quantiles
from runatlas.schemas import METRICS, STATUSES_WITH_METRICS

STRATEGIES = ("median", "drop", "flag")
FLAG = "data_quality_flag"


def deduplicate(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """One row per experiment: the first in ingest order."""
    return keep_first(df, ["experiment_id"], order)


def expects_metrics() -> Column:
    return F.col("status").isin(*STATUSES_WITH_METRICS)


def metrics_missing() -> Column:
    """A finished or failed run that lacks one of its metrics."""
    return expects_metrics() & reduce(lambda a, b: a | b, [F.col(m).isNull() for m in METRICS])


def metric_medians(df: DataFrame) -> DataFrame:
    """Exact median of every metric per status: one row per status.

    All metrics go through one quantile plan over (status, metric), whose
    domain is fixed.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])
    long = df.filter(expects_metrics()).select("status", F.inline(pairs))
    medians = exact_quantiles(long, ["status", "metric"], "value", {"median": 0.5})
    return medians.groupBy("status").agg(
        *[
            F.max(F.when(F.col("metric") == m, F.col("median"))).alias(f"{m}_median")
            for m in METRICS
        ]
    )


def fill_with_medians(df: DataFrame) -> DataFrame:
    """Missing metrics take their status' median; a status without values stays null."""
    medians = F.broadcast(metric_medians(df))  # one row per finished status
    joined = df.join(medians, "status", "left")
    # The medians are null for the other statuses, so those rows keep their nulls.
    filled = {m: F.coalesce(F.col(m), F.col(f"{m}_median")) for m in METRICS}
    return joined.select(*[filled.get(c, F.col(c)).alias(c) for c in df.columns])


def handle_missing_metrics(df: DataFrame, strategy: str) -> DataFrame:
    """Apply one of the strategies ``median``, ``drop`` or ``flag``."""
    if strategy == "median":
        return fill_with_medians(df)
    if strategy == "drop":
        return df.filter(~metrics_missing())
    if strategy == "flag":
        return df.withColumn(FLAG, metrics_missing())
    raise ValueError(f"unknown strategy {strategy!r}; choose one of {', '.join(STRATEGIES)}")


def missing_metrics_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(metrics_missing()).alias("affected_rows"))


def clean(valid: DataFrame, order: Sequence[Column | str], strategy: str) -> DataFrame:
    """Duplicates out, then missing metrics handled."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; choose one of {', '.join(STRATEGIES)}")
    return handle_missing_metrics(deduplicate(valid, order), strategy)
