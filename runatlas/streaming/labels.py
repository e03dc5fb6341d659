"""Late labels as a maintained table, and the daily rollup from signed changes.

A micro-batch of labels is brought to the newest label per entry. The index of ids tells which batches of the prediction
table brought the entries, so only those are read. Kept labels lie by event day: a batch reads and rewrites the days it touches. What
it changes goes into a table of signed sums per day and model: a corrected label takes its old error back and adds the new one. The
ingest adds the events' own sums, so the rollup is a sum of two tables and reads no event.

Cases: a label whose event is not there yet waits, and is tried again with each batch and when read. The newest label of an
entry counts (at one time the largest; a label without a time is older than any other), whatever the order of arrival; an older one
changes nothing. A newest label without a value takes the label back. A truth that came with the event stays. A replayed batch starts
from the same state and overwrites what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runatlas.operators.drift import MODEL
from runatlas.operators.keyed import is_small
from runatlas.session import materialize
from runatlas.streaming.id_index import IdIndex
from runatlas.streaming.ingest import index_path, read_batches, read_if_there
from runatlas.streaming.keyed_state import KeyedState
from runatlas.streaming.partials import COMPACT_EVERY, Partials, remove

BROADCAST_LABELS = 500_000  # labels of a batch (a counted bound: some 40 MB) that are broadcast; more are joined by shuffle
_LABEL = "stream_entry_id string, label double, label_timestamp timestamp"
_KEYS = ("event_date", *MODEL)


def newest_labels(labels: DataFrame) -> DataFrame:
    """The newest label of each entry, as ``stream_entry_id, label, label_timestamp``."""
    newest = labels.groupBy("stream_entry_id").agg(F.max(F.struct("label_timestamp", "label")).alias("_newest"))
    return newest.select("stream_entry_id", "_newest.label", "_newest.label_timestamp")


class LabelJob:
    """Kept labels and the rollup of the prediction table ``table``, under ``root``.

    ``add_events`` is a batch hook for the ingest, ``add_labels`` one for a stream of labels.
    """

    def __init__(self, root: str, table: str, compact_every: int = COMPACT_EVERY):
        self.root, self.table = root.rstrip("/"), table.rstrip("/")
        self.events = Partials(f"{self.root}/events", _KEYS, ("event_count", "labelled_count", "error_sum", "latency_sum", "latency_count"), compact_every)
        self.changes = Partials(f"{self.root}/changes", _KEYS, ("labelled_count", "error_sum"), compact_every)

    def kept(self, spark: SparkSession) -> KeyedState:
        """Newest labels of stored events, a part for each event day."""
        return KeyedState(spark, f"{self.root}/kept", _LABEL)

    # --- writing ---

    def add_events(self, fresh: DataFrame, batch_id: int) -> None:
        error = F.abs(F.col("prediction") - F.col("ground_truth"))
        sums = fresh.groupBy(F.to_date("event_timestamp").alias("event_date"), *MODEL).agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count("ground_truth").alias("labelled_count"),
            F.coalesce(F.sum(error), F.lit(0.0)).alias("error_sum"),
            F.coalesce(F.sum("latency_ms"), F.lit(0.0)).alias("latency_sum"),
            F.count("latency_ms").alias("latency_count"),
        )
        self.events.add(sums, batch_id)

    def add_labels(self, labels: DataFrame, batch_id: int) -> None:
        spark = labels.sparkSession
        work = f"{self.root}/work/batch-{batch_id}"
        given = labels.select("stream_entry_id", "label", "label_timestamp").filter("stream_entry_id is not null")
        waiting = self._waiting(spark, batch_id - 1)
        newest = materialize(newest_labels(given if waiting is None else given.unionByName(waiting)), f"{work}/newest")
        met = self._met(newest, batch_id - 1, f"{work}/stored")
        if met is not None:
            met = materialize(met, f"{work}/met")
            days = [r[0] for r in met.select("day").distinct().collect()]  # days, not labels
            self.changes.add(self._signed(met), batch_id)
            old = self._old(spark, batch_id - 1, days)
            now = met.select("day", "stream_entry_id", "label", "label_timestamp")
            now = now if old is None else now.unionByName(old)
            state = now.groupBy("day", "stream_entry_id").agg(F.max(F.struct("label_timestamp", "label")).alias("_newest"))
            state = state.select("day", "stream_entry_id", "_newest.label", "_newest.label_timestamp").hint("rebalance", "day")
            self.kept(spark).write(state, "day", batch_id)
            newest = newest.join(met.select("stream_entry_id"), "stream_entry_id", "left_anti")
        # Written last: it tells that the batch is complete.
        newest.write.mode("overwrite").parquet(f"{self.root}/waiting/batch_id={batch_id}")
        remove(spark, work)
        remove(spark, f"{self.root}/waiting/batch_id={batch_id - 3}")

    def _waiting(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        return read_if_there(spark, f"{self.root}/waiting/batch_id={batch_id}", _LABEL)

    def _old(self, spark: SparkSession, upto: int, days: list[str]) -> DataFrame | None:
        """Kept labels of the days after batch ``upto``, with their day."""
        return self.kept(spark).read(upto, days, "day")

    def _met(self, newest: DataFrame, upto: int, folder: str | None = None) -> DataFrame | None:
        """Labels whose event is stored, beside it and beside the label kept so far; None if there is no such event.

        With ``folder`` the labels' events are written there, so the stored events are read and joined once, not again for the days.
        """
        spark = newest.sparkSession
        index = IdIndex(spark, index_path(self.table))
        found = index.located(newest)
        batches = [] if found is None else [r[0] for r in found.select("batch_id").distinct().collect()]  # batches, not ids
        index.release()
        if not batches:
            return None
        few = is_small(newest, BROADCAST_LABELS)
        stored = read_batches(spark, self.table, batches)
        day = F.to_date("event_timestamp").alias("event_date")
        met = stored.select("stream_entry_id", day, *MODEL, "prediction", "ground_truth").join(
            F.broadcast(newest) if few else newest, "stream_entry_id"
        )
        met = met.withColumn("day", F.col("event_date").cast("string"))
        if folder is not None:
            met = materialize(met, folder)
        days = [r[0] for r in met.select("day").distinct().collect()]
        old = self._old(spark, upto, days)
        if old is None:
            none = {"old_label": F.lit(None).cast("double"), "old_timestamp": F.lit(None).cast("timestamp"), "had": F.lit(False)}
            return met.withColumns(none)
        old = old.select("day", "stream_entry_id", F.col("label").alias("old_label"), F.col("label_timestamp").alias("old_timestamp"), F.lit(True).alias("had"))
        return met.join(old, ["day", "stream_entry_id"], "left").withColumn("had", F.coalesce("had", F.lit(False)))

    @staticmethod
    def _signed(met: DataFrame) -> DataFrame:
        """What the labels change in the sums of each day and model."""
        newer = ~F.col("had") | (F.struct("label_timestamp", "label") > F.struct(F.col("old_timestamp").alias("label_timestamp"), F.col("old_label").alias("label")))

        def change(of: Callable[[str], Column]) -> Column:
            return F.sum(of("label") - of("old_label"))

        def counted(label: str) -> Column:
            return F.col(label).isNotNull().cast("long")

        def error(label: str) -> Column:
            return F.coalesce(F.abs(F.col("prediction") - F.col(label)), F.lit(0.0))

        changed = met.filter(F.col("ground_truth").isNull() & newer)
        return changed.groupBy(*_KEYS).agg(change(counted).alias("labelled_count"), change(error).alias("error_sum"))

    # --- reading ---

    def complete(self, spark: SparkSession) -> int:
        """Number of the last complete batch of labels; -1 before the first."""
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/waiting")
        fs = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
        folders = [s.getPath() for s in fs.listStatus(place)] if fs.exists(place) else []
        done = [p for p in folders if fs.exists(jvm.Path(p, "_SUCCESS"))]
        return max((int(p.getName().removeprefix("batch_id=")) for p in done), default=-1)

    def labelled(self, stored: DataFrame, days: list[str] | None = None) -> DataFrame:
        """``stored`` with missing truths filled in; with ``days`` events and labels of these days only."""
        spark = stored.sparkSession
        upto = self.complete(spark)
        events = stored if days is None else stored.filter(F.to_date("event_timestamp").cast("string").isin(days))
        kept, waiting = self.kept(spark).read(upto, days), self._waiting(spark, upto)
        parts = [p for p in (kept, waiting) if p is not None]
        if not parts:
            return events
        # An entry that waits may have come since; one that waits is not kept.
        labels = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        labels = labels.select("stream_entry_id", F.col("label").alias("ground_truth"))
        # An event that came with its truth keeps it, so only the others are shuffled and joined.
        filled = events.filter("ground_truth IS NULL").drop("ground_truth").join(labels, "stream_entry_id", "left")
        return events.filter("ground_truth IS NOT NULL").unionByName(filled.select(*events.columns))

    def rollup(self, spark: SparkSession) -> DataFrame:
        """Per day and model version: events, labelled events, mean error and mean latency, as ``monitoring.daily_rollup``."""
        sums = self.events.read(spark)
        upto = self.complete(spark)
        waiting = self._waiting(spark, upto)
        met = None if waiting is None else self._met(waiting, upto)
        if read_if_there(spark, f"{self.root}/changes/partial") is not None:
            sums = sums.unionByName(self.changes.read(spark), allowMissingColumns=True)
        if met is not None:
            sums = sums.unionByName(self._signed(met), allowMissingColumns=True)
        whole = self.events.summed(sums)
        return whole.select(
            *_KEYS,
            "event_count",
            "labelled_count",
            (F.col("error_sum") / F.nullif("labelled_count", F.lit(0))).alias("mean_abs_error"),
            (F.col("latency_sum") / F.nullif("latency_count", F.lit(0))).alias("avg_latency_ms"),
        )


def keep_labels(spark: SparkSession, labels: DataFrame, job: LabelJob, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Bring a stream of labels ``(stream_entry_id, label, label_timestamp)`` into the kept labels of ``job``."""
    writer = labels.writeStream.foreachBatch(job.add_labels).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()
