"""Drift after every micro-batch, from windows that are carried along.

The job keeps, per model, the earliest and the latest events up to the window
length. New rows are merged into them, so a check never reads the history
again, and the outcome equals that of the batch query over all events. Models are dealt to ``PARTS`` parts by
their hash; a batch reads and rewrites only the parts of its models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runatlas.functions.scalars import half_up
from runatlas.operators.alerts import drift_alerts
from runatlas.operators.drift import MODEL, THRESHOLD, WINDOW, with_psi
from runatlas.operators.keyed import first_n_per_key
from runatlas.streaming.keyed_state import KeyedState

PARTS = 32
_EVENT = ("event_timestamp", "stream_entry_id", "prediction")
_WINDOW_TYPE = "array<struct<event_timestamp:timestamp,stream_entry_id:string,prediction:double>>"
_STATE = f"model_name string, model_version string, event_count bigint, baseline {_WINDOW_TYPE}, recent {_WINDOW_TYPE}, batch_id bigint"


class DriftJob:
    """Batch hook for the ingest; keeps its state and its alerts under ``root``."""

    def __init__(self, root: str, window: int = WINDOW, threshold: float = THRESHOLD):
        self.root = root
        self.window = window
        self.threshold = threshold

    def state(self, spark: SparkSession) -> KeyedState:
        return KeyedState(spark, f"{self.root}/state", _STATE)

    def alerts_path(self) -> str:
        return f"{self.root}/alerts"

    def __call__(self, fresh: DataFrame, batch_id: int) -> None:
        """Merge the new rows into the state, check the models they touch, write alerts.

        What is written carries the batch id, so a replayed batch overwrites itself.
        """
        spark = fresh.sparkSession
        dealt = fresh.select(*MODEL, *_EVENT).withColumn("part", F.pmod(F.xxhash64(*MODEL), F.lit(PARTS)).cast("int"))
        touched = [r["part"] for r in dealt.select("part").distinct().collect()]  # PARTS at most
        if batch_id > 0 and not self.seeded(spark):
            raise ValueError(f"no drift state after batch {batch_id - 1}; call seed() first")
        self._write(fresh, self.state(spark).read(batch_id - 1, touched), batch_id)
        results = self.check(spark, batch_id).filter("touched")
        drift_alerts(results, self.threshold).write.mode("overwrite").parquet(
            f"{self.alerts_path()}/batch_id={batch_id}"
        )

    def seed(self, events: DataFrame, batch_id: int) -> None:
        """Build the state after ``batch_id`` from all events so far, for a stream already running."""
        self._write(events, None, batch_id)

    def seeded(self, spark: SparkSession) -> bool:
        return bool(self.state(spark)._names(self.root, "state"))

    def _write(self, rows: DataFrame, old: DataFrame | None, batch_id: int) -> None:
        merged = self._merged(rows, old)
        newest = merged.withColumn("batch_id", F.when(F.col("touched"), F.lit(batch_id)).otherwise(F.lit(-1)).cast("bigint")).drop("touched")
        dealt = newest.withColumn("part", F.pmod(F.xxhash64(*MODEL), F.lit(PARTS)).cast("int"))
        self.state(rows.sparkSession).write(dealt, "part", batch_id)

    def _merged(self, fresh: DataFrame, old: DataFrame | None) -> DataFrame:
        """One row per model and side: its window as structs, and its event count."""
        rows = fresh.select(*MODEL, *_EVENT)
        counts = rows.groupBy(*MODEL).agg(F.count(F.lit(1)).alias("_new"))
        earliest, latest = rows, rows
        if old is not None:
            earliest = rows.unionByName(old.select(*MODEL, F.inline("baseline")))
            latest = rows.unionByName(old.select(*MODEL, F.inline("recent")))
            counts = (
                counts.withColumn("_old", F.lit(0))
                .unionByName(old.select(*MODEL, F.lit(0).alias("_new"), F.col("event_count").alias("_old")))
                .groupBy(*MODEL)
                .agg(F.sum("_new").alias("_new"), (F.sum("_old") + F.sum("_new")).alias("event_count"))
            )
        else:
            counts = counts.withColumn("event_count", F.col("_new"))

        def side(source: DataFrame, direction, name: str) -> DataFrame:
            order = [direction("event_timestamp"), direction("stream_entry_id")]
            kept = first_n_per_key(source, MODEL, order, self.window)
            return kept.groupBy(*MODEL).agg(F.collect_list(F.struct(*_EVENT)).alias(name))

        return (
            counts.select(*MODEL, "event_count", (F.col("_new") > 0).alias("touched"))
            .join(side(earliest, F.asc, "baseline"), list(MODEL))
            .join(side(latest, F.desc, "recent"), list(MODEL))
        )

    def check(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Drift results of all models with a full window after a batch."""
        state = self.state(spark).read(batch_id)
        if state is None:
            state = spark.createDataFrame([], _STATE)
        # A part that this batch left alone has the batch ids of earlier ones.
        state = state.filter(F.col("event_count") >= self.window).withColumn("touched", F.col("batch_id") == batch_id)
        values = state.withColumns(
            {side: F.transform(side, lambda e: e["prediction"]) for side in ("baseline", "recent")}
        )
        return with_psi(values).select(
            *MODEL,
            half_up(F.col("psi"), 4).alias("psi"),
            (F.col("psi") > self.threshold).alias("is_drifted"),
            F.size("baseline").cast("long").alias("baseline_n"),
            F.size("recent").cast("long").alias("recent_n"),
            "touched",
        )
