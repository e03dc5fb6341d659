"""Streaming twins of the volume, latency and label queries. No event is dropped for being late.

Volume, means and latency histograms are kept as mergeable partial results: every micro-batch adds, from the
rows that the ingest found new, counts and sums per minute and model, and counts per pane of five minutes, model and value bucket;
readers add them up. Percentiles stay exact: the histograms' cumulated counts tell which buckets hold a wanted rank, and
only the stored events of those panes and buckets are looked at.
Labels are stored as they come and joined when read: of any age, the latest one counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runatlas.operators.drift import MODEL
from runatlas.operators.keyed import is_small
from runatlas.operators.monitoring import TAILS
from runatlas.operators.quantiles import bucketed, buckets_with_ranks, coarse_counts, quantile_columns, rank_values, wanted_ranks
from runatlas.session import materialize
from runatlas.streaming.partials import COMPACT_EVERY, Partials

PANE_MINUTES = 5
BROADCAST_CELLS = 500_000  # panes' buckets (a counted bound: some 40 MB) that are broadcast; more are joined by shuffle


class VolumeJob:
    """Batch hook for the ingest: counts and latency sums per minute and model under ``root``."""

    def __init__(self, root: str, compact_every: int = COMPACT_EVERY):
        self.table = Partials(root, ("minute", *MODEL), ("event_count", "latency_sum"), compact_every)

    def __call__(self, fresh: DataFrame, batch_id: int) -> None:
        partial = fresh.groupBy(F.date_trunc("minute", "event_timestamp").alias("minute"), *MODEL).agg(
            F.count(F.lit(1)).alias("event_count"), F.sum("latency_ms").alias("latency_sum")
        )
        self.table.add(partial, batch_id)

    def volume(self, spark: SparkSession) -> DataFrame:
        """Events per minute and model so far."""
        return self.table.read(spark).groupBy("minute", "model_name").agg(F.sum("event_count").alias("event_count"))


class LatencyPanes:
    """Batch hook for the ingest: latency histograms per pane of ``PANE_MINUTES`` and model under ``root``.

    A cell is a bucket of values about 0.4 % wide; it holds how many events, values and what sum there is. Events without
    a usable latency have a cell of their own.
    """

    def __init__(self, root: str, compact_every: int = COMPACT_EVERY):
        self.root = root
        self.table = Partials(root, ("pane", *MODEL, "_b"), ("_n", "_rows", "_given", "_sum"), compact_every)

    def __call__(self, fresh: DataFrame, batch_id: int) -> None:
        self.table.add(coarse_counts(fresh.withColumn("pane", pane_of(F.col("event_timestamp"))), ["pane", *MODEL], "latency_ms"), batch_id)

    def _quantiles(self, cells: DataFrame, stored: DataFrame, keys: list[str], windows: Column, length: int, name: str) -> DataFrame:
        """One row per key from ``cells(keys, _b, _n, _rows, _given, _sum)`` and the events of the cells that matter."""
        folder = f"{self.root}/read/{name}-{uuid.uuid4().hex[:12]}"
        cells = materialize(cells.groupBy(*keys, "_b").agg(*[F.sum(c).alias(c) for c in self.table.sums]), f"{folder}/cells")
        whole = cells.groupBy(*keys).agg(
            F.sum("_rows").alias("event_count"), (F.sum("_sum") / F.nullif(F.sum("_given"), F.lit(0))).alias("avg_latency_ms")
        )
        # Read four times below, so the windows over all cells are worked out once.
        hits = materialize(buckets_with_ranks(cells, keys, wanted_ranks(TAILS)), f"{folder}/hits")
        near = events_near(stored, hits, length)
        values = near.withColumn("window_start", F.explode(windows)) if "window_start" in keys else near
        ranked = rank_values(values.select(*keys, "_b", "_v"), hits, keys).select(*keys, *quantile_columns(TAILS))
        return whole.join(ranked, keys, "left")

    def sliding(self, stored: DataFrame, length: int = 60, slide: int = PANE_MINUTES) -> DataFrame:
        """Events, mean and exact percentiles per model over sliding windows of ``length`` minutes, multiples of the panes."""
        if slide % PANE_MINUTES or length % slide:
            raise ValueError(f"windows must be made of whole slides, and slides of whole panes of {PANE_MINUTES} minutes")
        cells = self.table.read(stored.sparkSession).withColumn("window_start", F.explode(window_starts(F.col("pane"), length, slide)))
        windows = window_starts(F.col("event_timestamp"), length, slide)
        out = self._quantiles(cells, stored, ["window_start", *MODEL], windows, length, "sliding")
        end = F.timestamp_seconds(F.unix_seconds("window_start") + 60 * length).alias("window_end")
        return out.select("window_start", end, *MODEL, "event_count", "avg_latency_ms", *TAILS)

    def trailing(self, stored: DataFrame, minutes: int = 60) -> DataFrame:
        """The latency summary of the last ``minutes`` before the newest event, whatever the panes' borders.

        Whole panes come from the histograms; of the pane that the window begins in, the events are counted.
        """
        spark = stored.sparkSession
        # The stored events may be ahead of the panes, never behind.
        last_pane = self.table.read(spark).agg(F.max("pane")).first()[0]
        newest = _from(stored, F.lit(last_pane)).agg(F.max("event_timestamp")).first()[0]
        begin = F.lit(newest) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
        first = F.timestamp_seconds(F.unix_seconds(pane_of(begin)) + 60 * PANE_MINUTES)
        inside = _from(stored, begin)
        border = coarse_counts(inside.filter(F.col("event_timestamp") < first), MODEL, "latency_ms")
        cells = self.table.read(spark).filter(F.col("pane") >= first).select(*MODEL, "_b", *self.table.sums)
        return self._quantiles(cells.unionByName(border), inside, list(MODEL), F.array(), minutes, "trailing").orderBy(*MODEL)


def pane_of(time: Column) -> Column:
    """Start of the pane that holds a time."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(time) / (60 * PANE_MINUTES)) * 60 * PANE_MINUTES)


def _from(stored: DataFrame, begin: Column) -> DataFrame:
    """The stored events from a time on; folders of days before it are not read, whatever time zone they were written in."""
    return stored.filter((F.col("event_date") >= F.date_sub(F.to_date(begin), 2)) & (F.col("event_timestamp") >= begin))


def window_starts(time: Column, length: int, slide: int) -> Column:
    """Starts of all windows that hold a time; windows begin at multiples of ``slide`` minutes."""
    last = F.floor(F.unix_seconds(time) / (60 * slide)) * 60 * slide
    return F.transform(F.sequence(F.lit(0), F.lit(length // slide - 1)), lambda k: F.timestamp_seconds(last - k * 60 * slide))


def events_near(stored: DataFrame, hits: DataFrame, length: int) -> DataFrame:
    """The stored events, with ``_b`` and ``_v``, whose pane, model and bucket some located row of ``hits`` covers.

    Hits of sliding windows are spread over the panes of the window; others hold for all panes.
    """
    cell = [*MODEL, "_b"]
    wanted = hits.select(*[c for c in ("window_start", *cell) if c in hits.columns])
    if "window_start" in hits.columns:
        steps = F.transform(F.sequence(F.lit(0), F.lit(length // PANE_MINUTES - 1)), lambda k: F.timestamp_seconds(F.unix_seconds("window_start") + k * 60 * PANE_MINUTES))
        wanted = wanted.withColumn("pane", F.explode(steps))
        cell = ["pane", *cell]
    wanted = wanted.select(*cell).distinct()
    events = stored.withColumn("pane", pane_of(F.col("event_timestamp")))
    events = bucketed(events, [*MODEL, "pane", "event_timestamp"], "latency_ms").filter("_b is not null")
    return events.join(F.broadcast(wanted) if is_small(wanted, BROADCAST_CELLS) else wanted, cell, "left_semi")


def ingest_labels(spark: SparkSession, labels: DataFrame, table: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Store a stream of labels ``(stream_entry_id, label, label_timestamp)`` as it comes."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    writer = labels.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()
