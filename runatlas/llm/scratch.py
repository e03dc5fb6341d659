"""Intermediate tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from runatlas.session import workspace


class Scratch:
    """Tables of one operator call, under ``spark.checkpoint.dir``; ``drop`` frees those no longer read."""

    def __init__(self, spark: SparkSession, purpose: str):
        let_workers_import(spark)
        self.spark = spark
        self.folder = f"{workspace(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
        self.saved = 0

    def path(self, name: str) -> str:
        self.saved += 1
        return f"{self.folder}/{self.saved:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Remove written tables. Only those that no returned DataFrame still reads."""
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def plain_columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, renamed: other columns, whatever their names, cannot clash.

    ``wanted`` maps the new name to the column's name in ``df``.
    """
    return df.select(*[df[f"`{source}`"].alias(name) for name, source in wanted.items()])


#: Python workers live as long as their executor. By these settings of the C library their large
#: arrays go back to the system when freed, instead of staying with an idle worker beside the next stage's heap.
WORKER_MEMORY = {
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(4 << 20),
    "MALLOC_ARENA_MAX": "2",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS_DEFAULT, BATCH_ROWS_OF_TEXTS = "10000", "2000"


def let_workers_import(spark: SparkSession) -> None:
    """Prepare the Python workers that are started from now on.

    The folder of this package is put on their path: needed where the driver found the package by its own
    ``sys.path`` only. On a cluster whose executors have the package installed, or got it by ``--py-files``, that
    changes nothing. Rows of texts are long, so Arrow batches get fewer of them, unless the session sets its own number.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    if spark.conf.get(BATCH_ROWS) == BATCH_ROWS_DEFAULT:
        spark.conf.set(BATCH_ROWS, BATCH_ROWS_OF_TEXTS)
