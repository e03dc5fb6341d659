"""Event log -> prediction table, exactly once in effect.

The table is laid out as ``batch_id=N/event_date=D``. A replayed micro-batch
overwrites its own folder, so a crash between write and checkpoint leaves no
duplicate. An entry that was delivered before, on whatever date, is found in an
index of ids beside the table (see ``id_index``), never in the table itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runatlas.operators.keyed import is_small, keep_first, missing_from
from runatlas.operators.validate import audit_events, rejected_rows, valid_rows
from runatlas.schemas import EVENT_COLUMNS, PREDICTION_SCHEMA
from runatlas.sources.event_log import stream_log
from runatlas.streaming.id_index import LISTED, IdIndex

_TABLE_SCHEMA = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in PREDICTION_SCHEMA.fields)}, batch_id bigint, event_date date"
_ID = "stream_entry_id"
MAX_FILES = 1000  # new files of the log in one micro-batch, so a backlog is not one batch

BatchHook = Callable[[DataFrame, int], None]


def read_if_there(spark: SparkSession, path: str, schema: str | None = None, base: str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or ``None`` if there is none."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return (reader.option("basePath", base) if base else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_predictions(spark: SparkSession, table: str) -> DataFrame | None:
    """The prediction table, or ``None`` before its first batch."""
    return read_if_there(spark, table, _TABLE_SCHEMA)


def read_batches(spark: SparkSession, table: str, batches: list[int]) -> DataFrame:
    """The rows that the named batches brought; no other folder is listed."""
    folders = [f"{table.rstrip('/')}/batch_id={b}" for b in sorted(batches)]
    return spark.read.schema(_TABLE_SCHEMA).option("basePath", table).parquet(*folders)


def index_path(table: str) -> str:
    return f"{table.rstrip('/')}-ids"


def _new_rows(rows: DataFrame, known: DataFrame | None, held: list[DataFrame]) -> DataFrame:
    """One row per id that ``known`` does not hold, the first in the order of time and fields.

    The ids are looked at first, without the other columns. Rows whose id came once and is not known pass as they are; only
    those of ids that came several times are sorted. What is held for this goes into ``held``.
    """
    # Shuffled partitions that are held are not merged by size, so it is done here.
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    ids = rows.groupBy(_ID).agg((F.count(F.lit(1)) > 1).alias("_several"), F.lit(False).alias("_known"))
    if known is not None:
        few = is_small(rows.select(_ID), LISTED)
        # Ids that can be listed go to the known ones, not these to them.
        met = known.join(F.broadcast(rows.select(_ID)), _ID, "left_semi") if few else known
        ids = ids.drop("_known").join(met.select(_ID, F.lit(True).alias("_met")), _ID, "left")
        ids = ids.withColumn("_known", F.col("_met").isNotNull()).drop("_met")
    marked = ids.filter("_several OR _known").coalesce(tasks).persist()
    held.append(marked)
    n, several = marked.agg(F.count(F.lit(1)), F.count_if(~F.col("_known"))).first()
    if not n:
        return rows

    def listed(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n <= LISTED else df

    new = missing_from(rows, listed(marked.select(_ID)), [_ID])
    if not several:
        return new
    order = [F.col(c) for c in ("event_timestamp", *EVENT_COLUMNS[:-1])]
    again = rows.join(listed(marked.filter("NOT _known").select(_ID)), _ID, "left_semi")
    return new.unionByName(keep_first(again, [_ID], order))


def store_batch(batch: DataFrame, batch_id: int, table: str, quarantine: str) -> DataFrame:
    """Write one micro-batch and return the rows that were new, read from the folder just written."""
    spark = batch.sparkSession
    judged = audit_events(batch).withColumn(
        "errors",
        F.when(F.col("stream_entry_id").isNull(), F.array(F.lit("stream_entry_id:missing"))).otherwise(
            F.col("errors")
        ),
    )
    index = IdIndex(spark, index_path(table))
    # The batch is read for the quarantine, for its ids and for the write.
    judged.persist()
    held: list[DataFrame] = []
    try:
        faulty = rejected_rows(judged).withColumn("validation_error", F.concat_ws("; ", "errors"))
        faulty.drop("errors").write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        valid = valid_rows(judged)
        fresh = _new_rows(valid, index.known(valid, batch_id), held).withColumns({"event_date": F.to_date("event_timestamp"), "ingested_at": F.current_timestamp()})
        folder = f"{table}/batch_id={batch_id}"
        # By date, so a day has a file or a few of its size instead of one from every task.
        fresh.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(folder)
    finally:
        for df in (judged, *held):
            df.unpersist()
        index.release()
    written = read_if_there(spark, folder, _TABLE_SCHEMA, table)
    index.add(written, batch_id)
    return written


def ingest(
    spark: SparkSession,
    log: str,
    table: str,
    quarantine: str,
    checkpoint: str,
    once: bool = True,
    max_files: int | None = MAX_FILES,
    after_batch: BatchHook | None = None,
) -> StreamingQuery:
    """Start the ingest: drain what is there (``once``) or poll every second.

    ``after_batch`` receives the new rows of every micro-batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        fresh = store_batch(batch, batch_id, table, quarantine)
        if after_batch is not None:
            after_batch(fresh, batch_id)

    writer = (
        stream_log(spark, log, max_files)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")
    return writer.start()
