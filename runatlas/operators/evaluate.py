"""Evaluation of predictions and of training histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(
        *by, F.col(truth).cast("long").alias("truth"), F.col(predicted).cast("long").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def macro_precision_recall_f1(
    df: DataFrame, truth: str, predicted: str, num_classes: int, by: Sequence[str] = ()
) -> DataFrame:
    """Macro means over ``num_classes`` classes; a class that never occurs counts 0.

    F1 comes from the macro precision and the macro recall.
    """
    by = list(by)
    cells = confusion(df, truth, predicted, by)
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    # Each cell counts once for its true class and once for its predicted one.
    roles = F.array(
        F.struct(
            F.col("truth").alias("class"), hit.alias("hit"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("guessed")
        ),
        F.struct(
            F.col("predicted").alias("class"),
            F.lit(0).cast("long").alias("hit"),
            F.lit(0).cast("long").alias("actual"),
            F.col("n").alias("guessed"),
        ),
    )
    classes = (
        cells.select(*by, F.inline(roles))
        .filter(F.col("class").between(0, num_classes - 1))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("hit", "actual", "guessed")])
    )

    def mean_over_classes(base: str):
        share = F.when(F.col(base) > 0, F.col("hit") / F.col(base)).otherwise(0.0)
        return F.sum(share) / num_classes

    scores = classes.groupBy(*by).agg(
        mean_over_classes("guessed").alias("macro_precision"),
        mean_over_classes("actual").alias("macro_recall"),
    )
    p, r = F.col("macro_precision"), F.col("macro_recall")
    return scores.withColumn("macro_f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def accuracy(df: DataFrame, truth: str, predicted: str, by: Sequence[str]) -> DataFrame:
    """Share of rows whose prediction equals the truth."""
    hit = (F.col(truth) == F.col(predicted)).cast("double")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def weighted_loss(df: DataFrame, loss: str, samples: str, by: Sequence[str]) -> DataFrame:
    """Mean loss per sample from batch means."""
    total = F.sum(F.col(loss) * F.col(samples))
    return df.groupBy(*by).agg(
        F.sum(samples).alias("samples"), (total / F.nullif(F.sum(samples), F.lit(0.0))).alias("mean_loss")
    )


def final_epoch(history: DataFrame, run: str, epoch: str, tie: Sequence[str]) -> DataFrame:
    """The last history row of every run."""
    rest = [c for c in history.columns if c != run]
    last = F.max_by(F.struct(*rest), F.struct(epoch, *tie))
    return history.groupBy(run).agg(last.alias("_last")).select(run, "_last.*")
